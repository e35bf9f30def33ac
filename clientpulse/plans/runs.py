"""The batch runs: CRM landing, the daily run, the month-end backfill, the warehouse run and the export replay.

Each step reads the tables the step before wrote, so a lost executor costs the recomputation of one step.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clientpulse.functions.observed import Watched, watched
from clientpulse.operators import activity, alerts, backfill, dimensions, features, revenue, rules, scoring, upsell
from clientpulse.plans.lake import MONTH, Lake
from clientpulse.sources import readers, writers
from clientpulse.sources.schemas import ALERTS, HEALTH_SCORE, conformed


def crm_run(lake: Lake, landed: Mapping[str, str], client_id_property: str = "client_id") -> dict[str, DataFrame]:
    """Raw CRM tables from landed pages, and ``unparsed``: per kind and property the number of texts that did not parse.

    ``landed`` maps companies, deals, calls, owners and feedback or contacts to folders of pages; kinds that
    are absent, or of which no object has landed, leave their table as it is. The numbers are taken while the tables
    are written.
    """
    spark, out = lake.spark, {}
    owners = (dimensions.owner_directory(readers.read_owner_pages(spark, landed["owners"]))
              if "owners" in landed else None)
    counted: dict[str, Watched] = {}

    def objects(kind: str, properties: Sequence[str]) -> DataFrame | None:
        if kind not in landed:
            return None
        counted[kind] = watched(readers.read_crm_pages(spark, landed[kind], properties), dimensions.unparsed_counts(kind))
        return counted[kind].rows

    def named(df: DataFrame) -> DataFrame:
        return writers.resolve_owner_names(df, owners) if owners is not None else df

    properties = [client_id_property if p == "client_id" else p for p in dimensions.COMPANY_PROPERTIES]
    companies = objects("companies", properties)
    if companies is not None:
        out["companies"] = named(dimensions.normalise_companies(companies, client_id_property))
    deals = objects("deals", dimensions.DEAL_PROPERTIES)
    if deals is not None:
        out["deals"] = dimensions.normalise_deals(deals)
    calls = objects("calls", dimensions.CALL_PROPERTIES)
    if calls is not None:
        out["calls"] = named(dimensions.normalise_calls(calls))
    feedback = objects("feedback", dimensions.FEEDBACK_PROPERTIES)
    contacts = objects("contacts", dimensions.CONTACT_PROPERTIES)
    if feedback is not None or contacts is not None:
        sought = readers.read_crm_pages(spark, landed["feedback"], dimensions.FEEDBACK_PROPERTIES) if feedback is not None else None
        out["nps"] = dimensions.normalise_nps(feedback, contacts, sought=sought)
    written = {name: lake.land(df, name) for name, df in out.items()}
    found = [(kind, column, value) for kind, one in counted.items() for column, value in one.summary().first().asDict().items()]
    return {name: df for name, df in written.items() if df is not None} | {
        "unparsed": spark.createDataFrame(found, "kind string, property string, unparsed bigint")}


# Columns read from the exported warehouse tables; all values are text.
_EXPORT_COLUMNS = {
    "dim_clients": ("client_id", "hubspot_company_id", "company_name", "csm_owner", "has_cs", "contract_start_date",
                    "churn_date", "onboarding_end_date", "mrr", "days_to_renewal"),
    "fct_health_score": tuple(HEALTH_SCORE.fieldNames()),
    "fct_alerts": ("client_id", "alert_date", "alert_id", "alert_name", "severity", "action_suggested", "resolved"),
    "fct_csm_activity_weekly": ("csm_owner", "week_start", "calls_total", "meetings_total", "total_duration_minutes"),
    "fct_coverage_monthly": ("csm_owner", "year_month", "client_name_slug"),
    "fct_revenue_retention_monthly": ("year_month", "mrr_start", "mrr_churn", "mrr_downgrade", "mrr_upsell",
                                      "mrr_cross_sell", "mrr_new", "mrr_end", "grr", "nrr"),
    "fct_upsell_flags": ("client_id", "has_sms", "has_email", "cashback_enabled"),
}


def replay_run(lake: Lake, exports: Mapping[str, Sequence[str]], as_of: date) -> dict[str, DataFrame]:
    """Local tables from exported warehouse tables; each export is one or more parts.

    Clients with a churn date drop out, and so do their scores, alerts and flags.
    """
    raw = {name: readers.read_export(lake.spark, list(exports[name]), {c: "string" for c in columns})
           for name, columns in _EXPORT_COLUMNS.items()}
    clients = lake.overwrite(dimensions.dashboard_clients(
        dimensions.active_clients(raw["dim_clients"]), raw["fct_upsell_flags"], as_of, "has_cs"), "dim_clients")

    def active(name: str) -> DataFrame:
        return writers.keep_active(raw[name], clients)

    out = {
        "fct_health_score": scoring.score_table(active("fct_health_score")),
        "fct_alerts": alerts.alert_table(active("fct_alerts")),
        "fct_csm_activity_weekly": activity.activity_table(raw["fct_csm_activity_weekly"]),
        "fct_coverage_monthly": activity.coverage_table(raw["fct_coverage_monthly"], clients),
        "fct_revenue_retention_monthly": revenue.revenue_table(raw["fct_revenue_retention_monthly"]),
        "campaigns": upsell.channel_marker_campaigns(active("fct_upsell_flags")),
    }
    return {"dim_clients": clients, **{name: lake.overwrite(df, name) for name, df in out.items()}}


def last_scores(lake: Lake, as_of: date) -> DataFrame:
    """The two newest score rows per client and window up to a day, and the state for the next run."""
    state = lake.newest("fct_health_score")
    state.record(lake.spark, as_of.isoformat())
    return state.upto(lake.spark, as_of.isoformat())


def newest_and_recent(lake: Lake, name: str, moment: str, as_of: date, days: int) -> tuple[DataFrame, DataFrame]:
    """(rows that hold every client's newest ones up to ``as_of``, rows that hold those of the last ``days`` days).

    A fact stored by month is read from the state of the months before and the months since; the state of the last
    closed month is kept for the next run. Otherwise both are the whole table.
    """
    table, state = lake.read(name), lake.newest(name)
    if state is None:
        return table, table
    month = as_of.strftime("%Y-%m")
    closed = (as_of.replace(day=1) - timedelta(days=1)).strftime("%Y-%m")
    state.record(lake.spark, closed)
    oldest = (as_of - timedelta(days=days - 1)).replace(day=1) - timedelta(days=1)
    recent = lake.between(name, MONTH, oldest.strftime("%Y-%m"), month)
    return state.upto(lake.spark, month, within=features.known_by(moment, as_of), before=month), recent


def daily_run(lake: Lake, as_of: date, current: str, previous: str, variant: str = "pandas_v1",
              period_days: int = 30, periods: Sequence[int] | None = None) -> dict[str, DataFrame]:
    """Dimension, today's scores and today's alerts from the raw tables.

    Reads companies, client_config, campaigns, automations, chat and messages_monthly, and for the base coverage
    companies_activity_summary if there is one; writes dim_clients, fct_health_score (one partition per day) and
    fct_alerts (one partition per day). One score row per client carries the ratio of the variant; with ``periods``
    there is one per analysis window, with the window's ratio. Alerts look at ``period_days``.

    ``score_summary`` and ``alert_summary`` of the run are taken while its rows are written. History is not read: previous scores come from the kept state and the days since, and the newest campaigns likewise
    where campaigns are stored by month (``Lake.land_months``).
    """
    dim = lake.overwrite(dimensions.client_dimension(lake.read("companies"), lake.read("client_config"), as_of),
                         "dim_clients")
    wanted = tuple(periods or (period_days,))
    newest, campaigns = newest_and_recent(lake, "campaigns", "sent_at", as_of, max(wanted))
    feats = features.local_features(dim, newest, lake.read("automations"), lake.read("chat"),
                                    lake.read("messages_monthly"), as_of, current, previous, variant,
                                    lake.read_or_none("companies_activity_summary"))
    feats = features.with_periods(feats, features.roi_by_period(campaigns, as_of, wanted), wanted, own_roi=periods is None)
    scored = watched(scoring.health_score(feats, rules.PROFILES[variant], as_of, period_days), scoring.score_totals())
    history = lake.replace_snapshot(scored.rows, "fct_health_score", "calculated_at")
    base = alerts.alert_base(last_scores(lake, as_of), dim, period_days)
    fired = watched(alerts.evaluate_alerts(base, rules.SCRIPT_ALERTS, as_of), alerts.alert_totals())
    rows = fired.rows.select(*conformed(fired.rows, ALERTS, keep_types=("client_id",)))
    stored = lake.append_unseen(rows, "fct_alerts")
    return {"dim_clients": dim, "fct_health_score": history, "fct_alerts": stored,
            "score_summary": scored.summary(), "alert_summary": fired.summary()}


def backfill_run(lake: Lake, first: date, last: date, period_days: int = 30) -> dict[str, DataFrame]:
    """Month-end scores, weekly calls, monthly coverage and the revenue waterfall of past months.

    Scores that exist stay; the three aggregates are replaced by key.
    """
    dim, calls = lake.read("dim_clients"), lake.read("calls")
    scores = backfill.backfill_scores(
        dim, lake.read("campaigns"), lake.read("automations"), lake.read("chat"), lake.read("messages_monthly"),
        lake.read("client_config"), first, last, period_days=period_days)
    weekly = activity.weekly_calls(calls, dim, first, last)
    cover = activity.coverage_from_calls(dim, calls, first, last)
    money = revenue.retention_from_deals(dim, lake.read("deals"), first, last)
    return {
        "fct_health_score": lake.append_unseen(scores, "fct_health_score"),
        "fct_csm_activity_weekly": lake.upsert(weekly, "fct_csm_activity_weekly"),
        "fct_coverage_monthly": lake.upsert(cover, "fct_coverage_monthly"),
        "fct_revenue_retention_monthly": lake.upsert(money, "fct_revenue_retention_monthly"),
    }


def warehouse_run(lake: Lake, as_of: date, internal_domain: str, spine: tuple[date, int],
                  periods: Sequence[int] = features.PERIODS, period_days: int = 30) -> dict[str, DataFrame]:
    """The seven service tables from the warehouse sources; scores per analysis window, alerts on ``period_days``.

    ``dim_clients`` and ``fct_health_score`` are written before their consumers read them.
    """
    summary, owners = lake.read("companies_activity_summary"), lake.read("owners")
    crm, meetings = lake.read("crm_companies"), lake.read("customer_success_meetings")
    automations, users = lake.read("automation_execution_summary"), lake.read("users")
    cashback = lake.read("cashback_configs")
    dim = lake.overwrite(dimensions.warehouse_client_dimension(lake.read("app_companies"), summary, crm, owners, as_of),
                         "service_dim_clients")
    newest, results = newest_and_recent(lake, "whatsapp_campaign_results", "whatsapp_campaign_sent_at", as_of, max(periods))
    feats = features.warehouse_features(dim, summary, newest, automations, lake.read("flow_execution_summary"), users,
                                        cashback, as_of)
    feats = features.with_periods(feats, features.results_by_period(
        results.withColumnRenamed("company_id", "client_id"), as_of, periods), periods)
    scored = scoring.health_score(feats, rules.WAREHOUSE_V1_1, as_of,
                                  extra=("company_name", "csm_owner", "mrr", "days_to_renewal"))
    health = lake.replace_snapshot(scored, "service_fct_health_score", "calculated_at")
    today = health.where((F.col("calculated_at") == F.lit(as_of)) & (F.col("period_days") == period_days))
    flags = upsell.upsell_flags(dim, summary, automations, lake.read("sms_campaigns"), lake.read("email_campaigns"),
                                users, cashback)
    out = {
        "fct_alerts": alerts.evaluate_alerts(today, rules.WAREHOUSE_ALERTS, as_of),
        "fct_upsell_flags": flags,
        "fct_csm_activity_weekly": activity.weekly_activity(meetings, lake.read("crm_calls"), owners),
        "fct_coverage_monthly": activity.coverage_granular(meetings, owners, internal_domain),
        "fct_revenue_retention_monthly": revenue.retention_by_state(revenue.contract_facts(crm), *spine, as_of),
    }
    written = {name: lake.overwrite(df, f"service_{name}") for name, df in out.items()}
    return {"dim_clients": dim, "fct_health_score": health, **written}
