"""Scores, backfill and alerts."""

from datetime import date

from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF, BACKFILL, CURRENT, PREVIOUS
from pulsechecks.sqlbase import TODAY, define, fired, with_sql
from clientpulse.functions.observed import watched
from clientpulse.operators import alerts, backfill, features, history, rules, scoring
from clientpulse.session import scratch_path

LOCAL_POINTS = ("score_recency", "score_roi", "score_automations", "score_integrations", "score_chat", "score_volume",
                "bonus_cashback")
WH_POINTS = ("score_recency", "score_automations", "score_integrations", "score_chat", "score_volume",
             "score_coverage")


def local_features(i, variant):
    return features.local_features(i.clients, i.campaigns, i.automations, i.chat, i.messages, AS_OF, CURRENT, PREVIOUS,
                                   variant, i.activity_summary)


@check("f16_score_sql_v1", with_sql(f"SELECT client_id, {', '.join(LOCAL_POINTS)} FROM x_scores_sql"))
def _(i):
    return scoring.score_points(local_features(i, "sql_v1"), rules.SQL_V1).select("client_id", *LOCAL_POINTS)


@check("f16_score_pandas_v1", with_sql(f"SELECT client_id, {', '.join(LOCAL_POINTS)} FROM x_scores_pandas"))
def _(i):
    return scoring.score_points(local_features(i, "pandas_v1"), rules.PANDAS_V1).select("client_id", *LOCAL_POINTS)


@check("f16_score_asof_backfill", with_sql(
    f"SELECT client_id, calculated_at, {', '.join(LOCAL_POINTS)} FROM x_backfill"))
def _(i):
    return i.backfill.select("client_id", "calculated_at", *LOCAL_POINTS)


@check("f16_score_warehouse_v1_1", with_sql(f"SELECT client_id, {', '.join(WH_POINTS)} FROM x_scores_wh"))
def _(i):
    return scoring.score_points(i.warehouse_features, rules.WAREHOUSE_V1_1).select("client_id", *WH_POINTS)


@check("f17_status_sql_v1", with_sql("SELECT client_id, total_score, health_status FROM x_scores_sql"))
def _(i):
    return i.local_scores("sql_v1").select("client_id", "total_score", "health_status")


@check("f17_status_pandas_v1", with_sql("""
SELECT client_id, total_score, health_status, round_even(messages_mom_change, 2) AS messages_mom_change,
  round_even(plan_usage_pct, 2) AS plan_usage_pct FROM x_scores_pandas"""))
def _(i):
    return i.local_scores("pandas_v1").select("client_id", "total_score", "health_status", "messages_mom_change",
                                              "plan_usage_pct")


@check("f17_status_warehouse_v1_1", with_sql(f"""
SELECT client_id, {TODAY} AS calculated_at, {', '.join(WH_POINTS)}, CAST(NULL AS INTEGER) AS score_roi, total_score,
  health_status FROM x_scores_wh"""))
def _(i):
    return i.warehouse_scores.select("client_id", "calculated_at", *WH_POINTS, "score_roi", "total_score",
                                     "health_status")


RULES_DOCUMENT = {
    "recency": {"rules": [{"condition": "days_since_last_campaign <= 7", "points": 5, "label": "week"},
                          {"condition": "days_since_last_campaign <= 20", "points": 3, "label": "weeks"},
                          {"condition": "days_since_last_campaign > 20 OR no_campaigns", "points": 0, "label": "old"}]},
    "chat_usage": {"rules": [{"condition": "has_human_agent AND (has_chat_flow OR has_ai)", "points": 5, "label": "a"},
                             {"condition": "has_human_agent OR has_chat_flow", "points": 4, "label": "b"},
                             {"condition": "no_chat_usage", "points": 0, "label": "c"}]},
    "message_volume": {"rules": [
        {"condition": "volume_trend == 'growing' OR plan_usage_pct >= 80", "points": 5, "label": "up"},
        {"condition": "volume_trend == 'stable'", "points": 3, "label": "flat"},
        {"condition": "volume_trend == 'declining' OR plan_usage_pct < 20", "points": 0, "label": "down"}]},
    "base_coverage": {"rules": [{"condition": "coverage_pct >= 15", "points": 5, "label": "wide"},
                                {"condition": "coverage_pct >= 5", "points": 3, "label": "some"},
                                {"condition": "coverage_pct < 5 OR no_customers", "points": 0, "label": "none"}]},
    "classification": {"low": {"min_score": 0}, "high": {"min_score": 14, "max_score": 20},
                       "middle": {"min_score": 8, "max_score": 13}},
}


@check("f18_rules_document", with_sql("""
SELECT client_id, score_recency, score_chat, score_volume, score_coverage,
  score_recency + score_chat + score_volume + score_coverage AS total_score,
  CASE WHEN score_recency + score_chat + score_volume + score_coverage > 13 THEN 'high'
    WHEN score_recency + score_chat + score_volume + score_coverage > 7 THEN 'middle' ELSE 'low' END AS health_status
FROM x_scores_wh"""))
def _(i):
    profile, _alerts = rules.profile_from_rules(RULES_DOCUMENT)
    scored = scoring.classify(scoring.score_points(i.warehouse_features, profile), profile)
    return scored.select("client_id", "score_recency", "score_chat", "score_volume", "score_coverage", "total_score",
                         "health_status")


ASOF = ("client_id", "calculated_at", "days_since_last_campaign", "active_automations", "integration_automations",
        "chat_usage_level", "messages_sent_current", "messages_sent_previous", "total_score", "health_status")
ASOF_SQL = f"""SELECT {', '.join(ASOF)}, round(campaign_roi, 6) AS campaign_roi,
  round(messages_mom_change, 2) AS messages_mom_change, round(plan_usage_pct, 2) AS plan_usage_pct FROM """


def _asof(df):
    return df.select(*ASOF, F.round("campaign_roi", 6).alias("campaign_roi"),
                     F.round("messages_mom_change", 2).alias("messages_mom_change"),
                     F.round("plan_usage_pct", 2).alias("plan_usage_pct"))


@check("f19_asof_backfill", with_sql(ASOF_SQL + "x_backfill"))
def _(i):
    return _asof(i.backfill)


@check("f19_asof_backfill_midnight_cut", with_sql(ASOF_SQL + "x_backfill_midnight"))
def _(i):
    return _asof(backfill.backfill_scores(i.clients, i.campaigns, i.automations, i.chat, i.messages, i.clients,
                                          *BACKFILL, midnight_cut=True))


# Days on which the snapshots of the check are taken; what they say changes from one to the next.
SNAPSHOTS = (date(2001, 1, 10), date(2001, 2, 20), date(2001, 4, 5), date(2001, 5, 28))
STATUS_DAYS = (date(2000, 12, 1), date(2001, 6, 30))


def status_history(i):
    day = F.explode(F.array(*[F.lit(d) for d in SNAPSHOTS])).alias("snapshot_day")
    month = F.month("snapshot_day")
    built = i.automations.select("*", day).where(F.col("created_at") < F.col("snapshot_day").cast("timestamp_ntz"))
    built = built.withColumn("status", F.when((F.col("automation_id") + month) % 3 == 0, "paused").otherwise(F.col("status")))
    chat = i.chat.select("*", day).where((F.col("client_id") + month) % 6 != 0).withColumn(
        "has_chat_flow", (F.col("client_id") + month) % 4 == 0)
    config = i.clients.select("client_id", day).withColumn("cashback_enabled", (F.col("client_id") + month) % 5 == 0)
    return history.StatusHistory(built, chat, config)


# The last snapshot up to each month end, or the first of all.
define("x_snapshot_of", """
SELECT last_day(m)::DATE AS month_end, coalesce((SELECT max(d) FROM (VALUES (DATE '2001-01-10'), (DATE '2001-02-20'), (DATE '2001-04-05'),
  (DATE '2001-05-28')) v(d) WHERE d <= last_day(m)), DATE '2001-01-10') AS d
FROM generate_series(DATE '2000-12-01', DATE '2001-06-01', INTERVAL 1 MONTH) t(m)""")


@check("f19_statuses_at_month_ends", with_sql("""
SELECT coalesce(a.client_id, h.client_id, g.client_id) AS client_id, coalesce(a.month_end, h.month_end, g.month_end) AS month_end,
  coalesce(active_automations, 0) AS active_automations, coalesce(integration_automations, 0) AS integration_automations,
  coalesce(chat_usage_level, 'none') AS chat_usage_level, coalesce(cashback_enabled, false) AS cashback_enabled
FROM (SELECT client_id, month_end, count(*) FILTER (on_ AND automation_type IS DISTINCT FROM 'integration') AS active_automations,
    count(*) FILTER (on_ AND automation_type = 'integration') AS integration_automations
  FROM (SELECT x.*, month_end, status = 'active' AND (automation_id + month(d)) % 3 <> 0 AS on_ FROM x_automations x
    JOIN x_snapshot_of s ON x.created_at < CAST(s.d AS TIMESTAMP)) GROUP BY ALL) a
FULL JOIN (SELECT client_id, month_end, CASE WHEN has_human_agent AND (flow OR has_ai_enabled) THEN 'advanced'
    WHEN has_human_agent OR flow THEN 'essential' ELSE 'none' END AS chat_usage_level
  FROM (SELECT c.*, month_end, (client_id + month(d)) % 4 = 0 AS flow FROM x_chat c, x_snapshot_of s
    WHERE (client_id + month(d)) % 6 <> 0)) h ON h.client_id = a.client_id AND h.month_end = a.month_end
FULL JOIN (SELECT client_id, month_end, (client_id + month(d)) % 5 = 0 AS cashback_enabled FROM x_clients, x_snapshot_of) g
  ON g.client_id = coalesce(a.client_id, h.client_id) AND g.month_end = coalesce(a.month_end, h.month_end)"""))
def _(i):
    return history.statuses_at(status_history(i), backfill.month_ends(*STATUS_DAYS))


SUMMARY = """SELECT count(*) AS clients, count(*) FILTER (health_status = 'green') AS green,
  count(*) FILTER (health_status = 'yellow') AS yellow, count(*) FILTER (health_status = 'red') AS red,
  count(*) FILTER (health_status = 'inactive') AS inactive, round(avg(total_score), 2) AS avg_score FROM """


@check("f20_score_summary", with_sql(SUMMARY + "x_scores_wh"))
def _(i):
    return scoring.score_summary(i.warehouse_scores)


@check("f20_score_summary_observed", with_sql(SUMMARY + "x_scores_wh"))
def _(i):
    """The summary taken while the scores are written."""
    scored = watched(i.warehouse_scores, scoring.score_totals())
    scored.rows.write.parquet(scratch_path(i.spark, "scores-observed"))
    return scored.summary()


@check("f20_score_summary_sql_v1", with_sql(SUMMARY + "x_scores_sql"))
def _(i):
    return scoring.score_summary(i.local_scores("sql_v1"))


@check("f21_criterion_labels", with_sql("""
SELECT client_id,
  CASE score_recency WHEN 5 THEN 'Ativa (ultimos 7 dias)' WHEN 3 THEN 'Moderada (8-20 dias)'
    ELSE 'Inativa (>20 dias)' END AS label_recency,
  CASE score_automations WHEN 5 THEN 'Completo (3+)' WHEN 3 THEN 'Basico (1-2)' ELSE 'Nenhuma' END AS label_automations,
  CASE score_integrations WHEN 5 THEN 'Multi-integracao (2+)' WHEN 3 THEN 'Basico (1)' ELSE 'Nenhuma' END
    AS label_integrations,
  CASE score_chat WHEN 5 THEN 'Avancado/Hibrido' WHEN 4 THEN 'Essencial' ELSE 'Nao utiliza' END AS label_chat,
  CASE WHEN score_volume = 5 THEN 'Alto/Crescente' WHEN score_volume = 3 THEN 'Estavel'
    WHEN messages_mom_change IS NOT NULL OR plan_usage_pct < 20 THEN 'Queda/Irrelevante' END AS label_volume,
  CASE score_coverage WHEN 5 THEN 'Alta cobertura (>=15%)' WHEN 3 THEN 'Moderada (5-14%)' ELSE 'Baixa (<5%)' END
    AS label_coverage
FROM x_scores_wh"""))
def _(i):
    return scoring.criterion_labels(i.warehouse_features, rules.WAREHOUSE_V1_1)


# --- alerts ---


@check("l1_latest_snapshot", with_sql(
    "SELECT client_id, calculated_at, total_score, health_status FROM x_ranked WHERE nth = 1"))
def _(i):
    return alerts.latest_snapshot(i.history).select("client_id", "calculated_at", "total_score", "health_status")


@check("l2_previous_snapshot", with_sql("""
SELECT client_id, health_status AS previous_status, round(campaign_roi, 6) AS previous_roi, calculated_at AS previous_at
FROM x_ranked WHERE nth = 2"""))
def _(i):
    return alerts.previous_snapshot(i.history).withColumn("previous_roi", F.round("previous_roi", 6))


@check("l1_latest_snapshot_period", with_sql(
    "SELECT client_id, calculated_at, period_days, total_score FROM x_window_ranked WHERE nth = 1 AND period_days = 90"))
def _(i):
    return alerts.latest_snapshot(i.window_history, 90).select("client_id", "calculated_at", "period_days", "total_score")


@check("l1_latest_snapshot_any_period", with_sql(
    "SELECT client_id, calculated_at, period_days, total_score FROM x_window_ranked WHERE nth = 1 AND period_days = 90"))
def _(i):
    return alerts.latest_snapshot(i.window_history, None).select("client_id", "calculated_at", "period_days", "total_score")


@check("l2_previous_snapshot_period", with_sql("""
SELECT client_id, health_status AS previous_status, calculated_at AS previous_at FROM x_window_ranked
WHERE nth = 2 AND period_days = 7"""))
def _(i):
    return alerts.previous_snapshot(i.window_history, 7).drop("previous_roi")


@check("l3_status_change_period", with_sql("""
SELECT client_id, n.total_score, n.health_status, p.health_status AS previous_status
FROM (SELECT * FROM x_window_ranked WHERE nth = 1 AND period_days = 60) n
LEFT JOIN (SELECT * FROM x_window_ranked WHERE nth = 2 AND period_days = 60) p USING (client_id)"""))
def _(i):
    both = alerts.latest_with_previous(i.window_history, 60)
    return both.select("client_id", "total_score", "health_status", "previous_status")


@check("l3_status_change", with_sql("""
SELECT client_id, health_status, previous_status, health_status IS DISTINCT FROM previous_status AS changed
FROM x_alert_base"""))
def _(i):
    both = alerts.latest_with_previous(i.history)
    return both.select("client_id", "health_status", "previous_status",
                       (~F.col("health_status").eqNullSafe(F.col("previous_status"))).alias("changed"))


@check("l4_score_dropped_to_red", with_sql(
    "SELECT client_id, alert_id, severity FROM x_script_alerts WHERE alert_id = 'score_dropped_to_red'"))
def _(i):
    return one_rule(i.alert_base, rules.SCRIPT_ALERTS, "score_dropped_to_red")


def one_rule(base, ruleset, rule_id, *extra):
    chosen = [r for r in ruleset if r.id == rule_id]
    return alerts.evaluate_alerts(base, chosen, AS_OF).select("client_id", "alert_id", "severity", *extra)


def _register_rule(key, ruleset, rule_id, source, table, metric=False):
    extra = ("alert_metric",) if metric else ()
    columns = ", ".join(("client_id", "alert_id", "severity") + extra)

    @check(key, with_sql(f"SELECT {columns} FROM {table} WHERE alert_id = '{rule_id}'"))
    def _(i):
        return one_rule(source(i), ruleset, rule_id, *extra)


for _key, _rule in (("l5_score_red", "score_red"), ("l6_no_campaign_14d_warehouse", "no_campaign_14d"),
                    ("l8_renewal_90d", "renewal_90d"), ("l9_renewal_30d_red_warehouse", "renewal_30d_red"),
                    ("l10_volume_drop_30pct", "volume_drop_30pct"), ("l11_low_base_coverage", "low_base_coverage"),
                    ("l12_inactive_client", "inactive_client"), ("l13_upsell_opportunity", "upsell_opportunity")):
    _register_rule(_key, rules.WAREHOUSE_ALERTS, _rule, lambda i: i.warehouse_scores, "x_wh_alerts", metric=True)
for _key, _rule in (("l6_no_campaign_14d_script", "no_campaign_14d"), ("l9_renewal_30d_red_script", "renewal_30d_red"),
                    ("l11_low_base_coverage_script", "low_base_coverage")):
    _register_rule(_key, rules.SCRIPT_ALERTS, _rule, lambda i: i.alert_base, "x_script_alerts")
_register_rule("l8_renewal_90d_sql_v1", rules.SQL_V1_ALERTS, "renewal_90d", lambda i: i.alert_base, "x_sql_alerts")
_register_rule("l7_roi_below_1_sql_v1", rules.SQL_V1_ALERTS, "roi_dropped_below_1", lambda i: i.alert_base,
               "x_sql_alerts")


@check("l7_roi_dropped_below_1", with_sql("""
SELECT client_id, 'roi_dropped_below_1' AS alert_id, 'warning' AS severity FROM x_alert_base
WHERE campaign_roi < 1 AND previous_roi >= 1"""))
def _(i):
    return one_rule(i.alert_base, rules.RULE_FILE_ALERTS, "roi_dropped_below_1")


ALERT_COLUMNS = "client_id, company_name, csm_owner, alert_id, severity"


def texts(ruleset):
    """Name and action of each rule as a VALUES list."""
    rows = ", ".join("('{}', '{}', '{}')".format(r.id, r.name, r.action) for r in ruleset)
    return f"(VALUES {rows}) t(alert_id, alert_name, action_suggested)"


def alert_set(table, ruleset, metric=False):
    columns = ALERT_COLUMNS + (", alert_metric" if metric else "")
    return with_sql(f"""
SELECT {columns}, alert_name, action_suggested, {TODAY} AS alert_date, false AS resolved
FROM {table} JOIN {texts(ruleset)} USING (alert_id)""")


@check("l14_alerts_script", alert_set("x_script_alerts", rules.SCRIPT_ALERTS))
def _(i):
    return alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF).drop("alert_metric")


@check("l14_alerts_sql_v1", alert_set("x_sql_alerts", rules.SQL_V1_ALERTS))
def _(i):
    base = alerts.alert_base(i.history, i.clients, how="inner")
    return alerts.evaluate_alerts(base, rules.SQL_V1_ALERTS, AS_OF).drop("alert_metric")


@check("l14_alerts_warehouse", alert_set("x_wh_alerts", rules.WAREHOUSE_ALERTS, metric=True))
def _(i):
    return i.warehouse_alerts


RULE_FILE_SQL = [
    ("score_dropped_to_red", "critical", "health_status = 'red' AND previous_status <> 'red'"),
    ("no_campaign_14d", "warning", "days_since_last_campaign > 13"),
    ("roi_dropped_below_1", "warning", "campaign_roi < 1 AND previous_roi >= 1"),
    ("renewal_90d", "info", "days_to_renewal < 91"),
    ("renewal_30d_red", "critical", "health_status = 'red' AND days_to_renewal < 31"),
    ("volume_drop_30pct", "warning", "messages_mom_change <= -30"),
    ("low_base_coverage", "warning", "coverage_pct < 5 AND health_status <> 'inactive'"),
    ("upsell_opportunity", "info", "plan_usage_pct >= 90 AND health_status = 'green'")]


@check("l14_alerts_rule_file", with_sql(
    f"SELECT client_id, alert_id, severity FROM ({fired(RULE_FILE_SQL, 'x_alert_base')})"))
def _(i):
    return alerts.evaluate_alerts(i.alert_base, rules.RULE_FILE_ALERTS, AS_OF).select("client_id", "alert_id", "severity")


@check("l15_alert_metric", with_sql("SELECT client_id, alert_id, alert_metric FROM x_wh_alerts"))
def _(i):
    return i.warehouse_alerts.select("client_id", "alert_id", "alert_metric")


@check("l16_severity_order", with_sql("""
SELECT client_id, company_name, alert_id, severity, CAST(list_position(['critical', 'warning', 'info'], severity) - 1 AS
  INTEGER) AS severity_rank FROM x_script_alerts ORDER BY severity_rank, company_name, alert_id"""))
def _(i):
    fired_now = alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF)
    return alerts.ordered_alerts(fired_now.select("client_id", "company_name", "alert_id", "severity"))


@check("l16_severity_order_sql_v1", with_sql("""
SELECT client_id, company_name, alert_id, severity, CAST(list_position(['critical', 'high', 'medium', 'low'], severity) AS
  INTEGER) AS severity_rank FROM x_sql_alerts ORDER BY severity_rank, company_name, alert_id"""))
def _(i):
    fired_now = alerts.evaluate_alerts(i.alert_base, rules.SQL_V1_ALERTS, AS_OF)
    return alerts.ordered_alerts(fired_now.select("client_id", "company_name", "alert_id", "severity"),
                                 alerts.SEVERITY_RANK_SQL_V1)


@check("l17_most_urgent", with_sql("""
SELECT client_id, company_name, alert_id, severity FROM x_script_alerts
ORDER BY list_position(['critical', 'warning', 'info'], severity), company_name, alert_id LIMIT 5"""))
def _(i):
    fired_now = alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF)
    return alerts.most_urgent(fired_now).select("client_id", "company_name", "alert_id", "severity")


@check("l18_alert_summary", with_sql("""
SELECT count(*) AS total, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning,
  count(*) FILTER (severity = 'info') AS info FROM x_script_alerts"""))
def _(i):
    return alerts.alert_summary(alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF))


@check("l18_alert_summary_observed", with_sql("""
SELECT count(*) AS total, count(*) FILTER (severity = 'critical') AS critical, count(*) FILTER (severity = 'warning') AS warning,
  count(*) FILTER (severity = 'info') AS info FROM x_script_alerts"""))
def _(i):
    """The summary taken while the alerts are written."""
    seen = watched(alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF), alerts.alert_totals())
    seen.rows.write.parquet(scratch_path(i.spark, "alerts-observed"))
    return seen.summary()
