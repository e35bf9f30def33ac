"""Per-client feature aggregates.

Each aggregate returns one row per client, so the assembly joins are one to one on one key and a client with
very many events is reduced before any join. Sums and counts combine on the map side; "newest n" uses the
group-limited row number of :mod:`clientpulse.functions.rows`.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientpulse.functions import (
    change_percent, days_between, elapsed_days, item_count, percent, ratio, top_rows,
)

PERIODS = (7, 30, 60, 90)


def newest_sent(sent: str, tie: str | None) -> list[Column]:
    order = [F.col(sent).desc_nulls_last()]
    return order + [F.col(tie).asc()] if tie else order


def known_by(moment: str, as_of: date) -> Column:
    """Whether a moment lies before the end of ``as_of``; a plain comparison, so that it reaches the scan."""
    return F.col(moment) < F.date_add(F.lit(as_of), 1).cast("timestamp_ntz")


def last_campaign(campaigns: DataFrame, as_of: date, key: str = "client_id", sent: str = "sent_at",
                  bounded: bool = True) -> DataFrame:
    """Newest send time up to ``as_of`` and calendar days since then; unless ``bounded``, of all campaigns."""
    known = campaigns.where(known_by(sent, as_of)) if bounded else campaigns
    return known.groupBy(key).agg(F.max(sent).alias("last_campaign_at")).withColumn(
        "days_since_last_campaign", days_between(F.lit(as_of), "last_campaign_at"))


def newest_campaigns(campaigns: DataFrame, as_of: date | None, n: int = 3, key: str = "client_id",
                     tie: str = "campaign_id") -> DataFrame:
    """Send time and both ratios of the newest ``n`` campaigns up to ``as_of``, from one pass over the table.

    Without a date all campaigns count, later ones too.

    ``roi_mean`` averages the per-campaign ratios (a campaign without cost counts as 0); ``roi_pooled`` divides
    summed revenue by summed cost (no cost gives 0). The newest of the ``n`` is the newest of all.
    """
    rows = newest_campaign_rows(campaigns, as_of, n, key, tie)
    return rows.groupBy(key).agg(*newest_campaign_values())


def newest_campaign_rows(campaigns: DataFrame, as_of: date | None, n: int = 3, key: str = "client_id",
                         tie: str = "campaign_id") -> DataFrame:
    """The rows of ``newest_campaigns`` before they are summed, each with its own ratio ``roi``."""
    known = campaigns if as_of is None else campaigns.where(known_by("sent_at", as_of))
    newest = top_rows(known.select(key, tie, "sent_at", "revenue_attributed", "cost"), [key],
                      newest_sent("sent_at", tie), n)
    return newest.select(key, "sent_at", "revenue_attributed", "cost",
                         ratio("revenue_attributed", "cost", missing=0.0).alias("roi"))


def newest_campaign_values() -> list[Column]:
    """Aggregates over ``newest_campaign_rows``; rows of other kinds, with NULL in all its columns, add nothing."""
    cost = F.sum("cost")
    return [F.max("sent_at").alias("last_campaign_at"), F.avg("roi").alias("roi_mean"),
            F.when(cost != 0, F.sum("revenue_attributed") / cost).otherwise(0.0).alias("roi_pooled")]


def roi_mean_last(campaigns: DataFrame, as_of: date | None, n: int = 3, key: str = "client_id",
                  tie: str = "campaign_id") -> DataFrame:
    """Mean of the per-campaign ratios of the newest ``n``."""
    return newest_campaigns(campaigns, as_of, n, key, tie).select(key, F.col("roi_mean").alias("campaign_roi"))


def roi_pooled_last(campaigns: DataFrame, as_of: date | None, n: int = 3, key: str = "client_id",
                    tie: str = "campaign_id") -> DataFrame:
    """Revenue over cost, both summed over the newest ``n``."""
    return newest_campaigns(campaigns, as_of, n, key, tie).select(key, F.col("roi_pooled").alias("campaign_roi"))


def roi_calendar_months(campaigns: DataFrame, as_of: date, months: int = 3, key: str = "client_id",
                        midnight_cut: bool = False) -> DataFrame:
    """Pooled ratio over the calendar month of ``as_of`` and the ones before it; NULL without cost.

    ``midnight_cut`` drops campaigns sent after 00:00 of ``as_of`` itself.
    """
    first = F.add_months(F.trunc(F.lit(as_of), "MM"), 1 - months)
    last = F.col("sent_at") <= F.lit(as_of).cast("timestamp_ntz") if midnight_cut else (
        F.col("sent_at") < F.date_add(F.lit(as_of), 1).cast("timestamp_ntz"))
    window = campaigns.where((F.col("sent_at") >= first.cast("timestamp_ntz")) & last)
    return window.groupBy(key).agg(F.sum("revenue_attributed").alias("r"), F.sum("cost").alias("c")).select(
        key, ratio("r", "c").alias("campaign_roi"))


def roi_values_last(results: DataFrame, as_of: date, n: int = 3, key: str = "client_id",
                    tie: str = "campaign_id") -> DataFrame:
    """Mean of the newest ``n`` given ratios up to ``as_of`` beside the newest send time; undated rows do not count."""
    dated = results.where(known_by("whatsapp_campaign_sent_at", as_of))
    newest = top_rows(dated, [key], newest_sent("whatsapp_campaign_sent_at", tie), n)
    return newest.groupBy(key).agg(
        F.max("whatsapp_campaign_sent_at").alias("last_campaign_at"),
        F.avg("campaign_roi").alias("campaign_roi")).withColumn(
            "days_since_last_campaign", days_between(F.lit(as_of), "last_campaign_at"))


def roi_by_period(campaigns: DataFrame, as_of: date, periods: Sequence[int] = PERIODS,
                  key: str = "client_id") -> DataFrame:
    """One row per client and analysis window: pooled ratio and number of campaigns in it.

    All windows come out of one aggregation; nothing is multiplied before the shuffle.
    """
    # A range of send times rather than of ages, so that the filter reaches the scan.
    oldest = F.date_sub(F.lit(as_of), max(periods) - 1).cast("timestamp_ntz")
    open_end = F.date_add(F.lit(as_of), 1).cast("timestamp_ntz")
    recent = campaigns.where((F.col("sent_at") >= oldest) & (F.col("sent_at") < open_end)).withColumn(
        "age", days_between(F.lit(as_of), "sent_at"))
    inside = {p: F.col("age") < p for p in periods}
    sums = recent.groupBy(key).agg(*[x for p in periods for x in (
        F.sum(F.when(inside[p], F.col("revenue_attributed"))).alias(f"r{p}"),
        F.sum(F.when(inside[p], F.col("cost"))).alias(f"c{p}"),
        F.count_if(inside[p]).alias(f"n{p}"))])
    per_window = F.array(*[F.struct(F.lit(p).alias("period_days"), ratio(f"r{p}", f"c{p}").alias("campaign_roi"),
                                    F.col(f"n{p}").alias("campaigns_in_period")) for p in periods])
    return sums.select(key, F.inline(per_window))


def results_by_period(results: DataFrame, as_of: date, periods: Sequence[int] = PERIODS,
                      key: str = "client_id") -> DataFrame:
    """As ``roi_by_period``, for sources that give a ratio per campaign: the mean ratio and the number of campaigns."""
    sent = "whatsapp_campaign_sent_at"
    oldest = F.date_sub(F.lit(as_of), max(periods) - 1).cast("timestamp_ntz")
    recent = results.where((F.col(sent) >= oldest) & known_by(sent, as_of)).withColumn(
        "age", days_between(F.lit(as_of), sent))
    inside = {p: F.col("age") < p for p in periods}
    sums = recent.groupBy(key).agg(*[x for p in periods for x in (
        F.avg(F.when(inside[p], F.col("campaign_roi"))).alias(f"r{p}"), F.count_if(inside[p]).alias(f"n{p}"))])
    per_window = F.array(*[F.struct(F.lit(p).alias("period_days"), F.col(f"r{p}").alias("campaign_roi"),
                                    F.col(f"n{p}").alias("campaigns_in_period")) for p in periods])
    return sums.select(key, F.inline(per_window))


def with_periods(features: DataFrame, windows: DataFrame, periods: Sequence[int] = PERIODS,
                 own_roi: bool = False, key: str = "client_id") -> DataFrame:
    """Features once per analysis window, with that window's ratio and number of campaigns (none: 0).

    ``windows`` comes from ``roi_by_period`` or ``results_by_period``. With ``own_roi`` the ratio of ``features``
    stays and only the number is taken. The list of windows has a fixed length and is attached by ``explode``.
    """
    each = features.withColumn("period_days", F.explode(F.array(*[F.lit(p) for p in periods])))
    found = windows.select(key, "period_days", F.col("campaign_roi").alias("_roi"), "campaigns_in_period")
    joined = each.join(found, [key, "period_days"], "left")
    roi = F.col("campaign_roi") if own_roi else F.coalesce("_roi", F.lit(0.0))
    return joined.withColumns({"campaign_roi": roi, "campaigns_in_period": F.coalesce(
        "campaigns_in_period", F.lit(0).cast("bigint"))}).drop("_roi")


def automation_counts(automations: DataFrame, active: Column, standard: Column, integration: Column,
                      key: str = "client_id") -> DataFrame:
    """Active automations of both kinds."""
    return automations.groupBy(key).agg(
        F.count_if(active & standard).alias("active_automations"),
        F.count_if(active & integration).alias("integration_automations"))


def flow_counts(flows: DataFrame, key: str = "client_id") -> DataFrame:
    return flows.groupBy(key).agg(F.count_if(F.col("flow_is_active")).alias("active_flows"))


def keys_having(df: DataFrame, condition: Column | None = None, key: str = "client_id") -> DataFrame:
    """Distinct keys of the rows that meet a condition."""
    rows = df.where(condition) if condition is not None else df
    return rows.select(key).where(F.col(key).isNotNull()).distinct()


def with_flag(df: DataFrame, keys: DataFrame, flag: str, key: str = "client_id") -> DataFrame:
    """Add a boolean that says whether the key is in ``keys``."""
    return df.join(keys.withColumn(flag, F.lit(True)), key, "left").withColumn(
        flag, F.coalesce(flag, F.lit(False)))


def chat_level(human: Column, flow: Column, ai: Column) -> Column:
    """AI alone is not a usage level."""
    human, flow, ai = (F.coalesce(c, F.lit(False)) for c in (human, flow, ai))
    return F.when(human & (flow | ai), "advanced").when(human | flow, "essential").otherwise("none")


def chat_usage(chat: DataFrame, key: str = "client_id") -> DataFrame:
    return chat.select(key, "has_human_agent", "has_chat_flow", "has_ai_enabled", chat_level(
        F.col("has_human_agent"), F.col("has_chat_flow"), F.col("has_ai_enabled")).alias("chat_usage_level"))


def messages_two_months(messages: DataFrame, current: str, previous: str, key: str = "client_id") -> DataFrame:
    """Volume of two months and the current plan limit side by side."""
    return messages.where(F.col("year_month").isin(current, previous)).groupBy(key).agg(
        *two_month_values(current, previous))


def two_month_values(current: str, previous: str) -> list[Column]:
    """Aggregates of ``messages_two_months``."""
    def of(month: str, value: str) -> Column:
        return F.max(F.when(F.col("year_month") == month, F.col(value)))

    return [of(current, "messages_sent").alias("messages_sent_current"),
            of(previous, "messages_sent").alias("messages_sent_previous"),
            of(current, "plan_limit").alias("plan_limit_current")]


def message_change(current: str = "messages_sent_current", previous: str = "messages_sent_previous",
                   missing: float | None = None, scale: int | None = 2) -> Column:
    return change_percent(F.coalesce(F.col(current), F.lit(0)), previous, scale, missing)


def plan_usage(current: str = "messages_sent_current", limit: str = "plan_limit_current",
               missing: float | None = None, scale: int | None = 2) -> Column:
    return percent(F.coalesce(F.col(current), F.lit(0)), limit, scale, missing)


def base_coverage(impacted: str = "total_impacted_customers_this_month", total: str = "total_customers") -> Column:
    return percent(F.coalesce(F.col(impacted), F.lit(0)), total, 2)


def client_coverage(activity: DataFrame) -> DataFrame:
    """Share of the customer base reached this month, from the newest activity row of each client."""
    from clientpulse.operators.dimensions import latest_activity

    summary = latest_activity(activity, "total_impacted_customers_this_month", "total_customers")
    return summary.select(F.col("id").alias("client_id"), base_coverage().alias("coverage_pct"))


def _zero(*names: str) -> dict[str, Column]:
    return {n: F.coalesce(F.col(n), F.lit(0).cast("bigint")) for n in names}


def local_features(dim: DataFrame, campaigns: DataFrame, automations: DataFrame, chat: DataFrame,
                   messages: DataFrame, as_of: date, current: str, previous: str,
                   variant: str = "sql_v1", activity: DataFrame | None = None) -> DataFrame:
    """Features from the raw product tables; ``coverage_pct`` from the activity summary, NULL without one.

    ``sql_v1`` averages the last three ratios, counts calendar days, leaves unknown change NULL and scores on
    shares with two decimals; ``pandas_v1`` pools the last three, counts elapsed 24-hour days, takes unknown
    change as 0 and scores on unrounded shares.

    Every source with one result per client goes through one common aggregation, so that a task which assembles
    the features holds one hash table and not a table and a sort per source.
    """
    active = F.col("status") == "active"
    kind = F.col("automation_type")
    if variant == "sql_v1":
        days, roi, missing_days, missing_change, scale = (
            days_between(F.lit(as_of), "last_campaign_at"), F.col("roi_mean"), 9999, None, 2)
        standard = kind != "integration"
    elif variant == "pandas_v1":
        days, roi, missing_days, missing_change, scale = (
            F.when(F.col("last_campaign_at").isNotNull(), F.greatest(elapsed_days(as_of, "last_campaign_at"), F.lit(0))),
            F.col("roi_pooled"), 999, 0.0, None)
        standard = kind == "standard"
    else:
        raise ValueError(f"unknown variant {variant}")
    facts = newest_campaign_rows(campaigns, as_of)
    for part in (
            automations.select("client_id", (active & standard).alias("is_standard"),
                               (active & (kind == "integration")).alias("is_integration")),
            messages.where(F.col("year_month").isin(current, previous)).select(
                "client_id", "year_month", "messages_sent", "plan_limit"),
            *([] if activity is None else [client_coverage(activity)])):
        facts = facts.unionByName(part, allowMissingColumns=True)
    coverage = F.lit(None).cast("double") if activity is None else F.max("coverage_pct")
    reduced = facts.where(F.col("client_id").isNotNull()).groupBy("client_id").agg(
        *newest_campaign_values(), F.count_if("is_standard").alias("active_automations"),
        F.count_if("is_integration").alias("integration_automations"), *two_month_values(current, previous),
        coverage.alias("coverage_pct"))
    usage = chat_usage(chat)
    joined = (dim.select("client_id", "company_name", "csm_owner", "mrr", "days_to_renewal", "cashback_enabled")
                 .join(usage, "client_id", "left")
                 .join(reduced, "client_id", "left")
                 .select("client_id", "company_name", "csm_owner", "mrr", "days_to_renewal", "cashback_enabled",
                         days.alias("days_since_last_campaign"), roi.alias("campaign_roi"), "active_automations",
                         "integration_automations", *[c for c in usage.columns if c != "client_id"],
                         "messages_sent_current", "messages_sent_previous", "plan_limit_current", "coverage_pct"))
    filled = joined.withColumns({
        "days_since_last_campaign": F.coalesce("days_since_last_campaign", F.lit(missing_days)),
        "campaign_roi": F.coalesce("campaign_roi", F.lit(0.0)),
        "chat_usage_level": F.coalesce("chat_usage_level", F.lit("none")),
        "cashback_enabled": F.coalesce("cashback_enabled", F.lit(False)),
        **_zero("active_automations", "integration_automations", "messages_sent_current",
                "messages_sent_previous", "plan_limit_current"),
        **{c: F.coalesce(c, F.lit(False)) for c in ("has_human_agent", "has_chat_flow", "has_ai_enabled")}})
    return filled.withColumns({"messages_mom_change": message_change(missing=missing_change, scale=scale),
                               "plan_usage_pct": plan_usage(missing=missing_change, scale=scale)})


def warehouse_features(dim: DataFrame, activity: DataFrame, campaign_results: DataFrame, automations: DataFrame,
                       flows: DataFrame, users: DataFrame, cashback_configs: DataFrame, as_of: date,
                       standard_type: str = "Personalizada") -> DataFrame:
    """Features from the warehouse sources; facts are keyed on ``company_id``."""
    from clientpulse.operators.dimensions import latest_activity

    def by_client(df: DataFrame) -> DataFrame:
        return df.withColumnRenamed("company_id", "client_id")

    summary = latest_activity(
        activity, "has_customer_service", "active_integrations", "total_messages_this_month", "total_messages_prev_month",
        "whatsapp_marketing_package_limit", "total_impacted_customers_this_month", "total_customers").withColumnRenamed(
            "id", "client_id")
    kind = F.col("automation_type")
    counts = automation_counts(by_client(automations), F.col("automation_is_active"), kind == standard_type,
                               kind != standard_type)
    base = dim.select("client_id", "company_name", "csm_owner", "mrr", "days_to_renewal")
    joined = (base.join(summary, "client_id", "left")
                  .join(roi_values_last(by_client(campaign_results), as_of).drop("last_campaign_at"),
                        "client_id", "left")
                  .join(counts, "client_id", "left")
                  .join(flow_counts(by_client(flows)), "client_id", "left"))
    ai_users = keys_having(by_client(users), F.col("ai_agent_id") != "")
    flagged = with_flag(joined, ai_users, "has_ai_enabled")
    flagged = with_flag(flagged, keys_having(by_client(cashback_configs), F.col("is_active")), "cashback_enabled")
    filled = flagged.withColumns({
        **_zero("active_automations", "integration_automations", "active_flows"),
        "days_since_last_campaign": F.coalesce("days_since_last_campaign", F.lit(9999)),
        "campaign_roi": F.coalesce("campaign_roi", F.lit(0.0)),
        "has_human_agent": F.coalesce("has_customer_service", F.lit(False)),
        "messages_sent_current": F.coalesce("total_messages_this_month", F.lit(0).cast("bigint")),
        "messages_sent_previous": F.coalesce("total_messages_prev_month", F.lit(0).cast("bigint")),
        "plan_limit_current": F.coalesce("whatsapp_marketing_package_limit", F.lit(0).cast("bigint")),
        "active_integrations_count": item_count("active_integrations")})
    filled = filled.withColumn("has_chat_flow", F.col("active_flows") > 0)
    return filled.withColumns({
        "chat_usage_level": chat_level(F.col("has_human_agent"), F.col("has_chat_flow"), F.col("has_ai_enabled")),
        "messages_mom_change": message_change(), "plan_usage_pct": plan_usage(),
        "coverage_pct": base_coverage()}).drop(
            "has_customer_service", "active_integrations", "total_messages_this_month", "total_messages_prev_month",
            "whatsapp_marketing_package_limit", "total_impacted_customers_this_month", "total_customers")
