"""Report queries."""

from datetime import date

from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF
from pulsechecks.sqlbase import with_sql
from clientpulse.operators import activity, reporting
from pulsechecks.activity import coverage

CARD = ("client_id", "company_name", "csm_owner", "calculated_at", "total_score", "health_status",
        "messages_sent_current")


@check("q1_client_360", with_sql(f"SELECT {', '.join('c.' + c if c in CARD[:3] else 'l.' + c for c in CARD)} "
                                 "FROM x_clients c LEFT JOIN x_latest l USING (client_id)"))
def _(i):
    return reporting.client_360(i.clients, i.history).select(*CARD)


@check("q1_client_360_period", with_sql(f"SELECT {', '.join('c.' + c if c in CARD[:3] else 'l.' + c for c in CARD)} "
                                        "FROM x_clients c LEFT JOIN (SELECT * FROM x_window_ranked WHERE nth = 1 AND "
                                        "period_days = 60) l USING (client_id)"))
def _(i):
    return reporting.client_360(i.clients, i.window_history, period_days=60).select(*CARD)


@check("q1_client_360_in_range", with_sql(f"""
SELECT {', '.join('c.' + c if c in CARD[:3] else 'l.' + c for c in CARD)} FROM x_clients c
LEFT JOIN (SELECT * FROM x_history WHERE calculated_at BETWEEN DATE '2001-03-01' AND DATE '2001-05-31'
  QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY calculated_at DESC) = 1) l USING (client_id)"""))
def _(i):
    return reporting.client_360(i.clients, i.history, date(2001, 3, 1), date(2001, 5, 31)).select(*CARD)


@check("q2_last_known_values", with_sql("""
SELECT client_id, max(calculated_at) AS calculated_at, arg_max(total_score, calculated_at) AS total_score,
  arg_max(messages_sent_current, calculated_at) FILTER (messages_sent_current IS NOT NULL) AS messages_sent_current,
  arg_max(days_since_last_campaign, calculated_at) FILTER (days_since_last_campaign IS NOT NULL)
    AS days_since_last_campaign,
  round(arg_max(messages_mom_change, calculated_at) FILTER (messages_mom_change IS NOT NULL), 2) AS messages_mom_change,
  arg_max(health_status, calculated_at) AS health_status, arg_max(chat_usage_level, calculated_at) AS chat_usage_level,
  arg_max(coverage_pct, calculated_at) FILTER (coverage_pct IS NOT NULL) AS coverage_pct
FROM x_history GROUP BY client_id"""))
def _(i):
    return reporting.last_known_values(i.history).select(
        "client_id", "calculated_at", "total_score", "messages_sent_current", "days_since_last_campaign",
        "messages_mom_change", "health_status", "chat_usage_level", "coverage_pct").withColumn("messages_mom_change", F.round("messages_mom_change", 2))


@check("q2_last_known_values_unlisted_text", with_sql("""
SELECT client_id, max(calculated_at) AS calculated_at, arg_max(total_score, calculated_at) AS total_score,
  arg_max(CASE WHEN (total_score + month(calculated_at)) % 3 <> 0 THEN health_status || '-' || month(calculated_at) END, calculated_at)
    FILTER ((total_score + month(calculated_at)) % 3 <> 0) AS health_status
FROM x_history GROUP BY client_id"""))
def _(i):
    month = F.month("calculated_at")
    text = F.when((F.col("total_score") + month) % 3 != 0, F.concat_ws("-", "health_status", month))
    return reporting.last_known_values(i.history.select("client_id", "calculated_at", "total_score", text.alias("health_status")))


def today(i):
    return reporting.client_360(i.clients, i.warehouse_scores)


@check("q3_status_kpis", with_sql("""
SELECT s AS health_status, (SELECT count(*) FROM x_clients) AS total, count(client_id) AS clients,
  round(count(client_id) * 100.0::DOUBLE / (SELECT count(*) FROM x_clients), 2) AS pct
FROM (VALUES ('green'), ('yellow'), ('red'), ('inactive')) v(s) LEFT JOIN x_scores_wh ON health_status = s GROUP BY s"""))
def _(i):
    return reporting.status_kpis(today(i))


@check("q4_mean_score", with_sql("SELECT round(avg(total_score), 4) AS avg_score FROM x_scores_wh"))
def _(i):
    return reporting.mean_score(today(i))


@check("q5_monthly_mean_score", with_sql("""
SELECT CAST(date_trunc('month', calculated_at) AS DATE) AS month, round(avg(total_score), 4) AS avg_score FROM x_history
GROUP BY 1 ORDER BY 1 DESC LIMIT 7"""))
def _(i):
    return reporting.monthly_mean_score(i.history)


@check("q6_status_by_month", with_sql("""
SELECT CAST(date_trunc('month', calculated_at) AS DATE) AS month, health_status, count(*) AS clients FROM x_history
WHERE calculated_at >= DATE '2001-05-01' GROUP BY 1, 2"""))
def _(i):
    return reporting.status_by_month(i.history, months=3)


TOP = """
SELECT c.client_id, c.company_name, c.segment_ipc, s.total_score, s.days_since_last_campaign,
  round(s.campaign_roi, 6) AS campaign_roi, c.days_to_renewal FROM x_clients c JOIN x_scores_wh s USING (client_id)
WHERE s.health_status = '{0}' ORDER BY s.total_score {1}, c.client_id LIMIT 10"""


def rounded(df):
    return df.withColumn("campaign_roi", F.round("campaign_roi", 6))


@check("q7_top10_red", with_sql(TOP.format("red", "ASC")))
def _(i):
    return rounded(reporting.top_clients(today(i)))


@check("q7_top10_green", with_sql(TOP.format("green", "DESC")))
def _(i):
    return rounded(reporting.top_clients(today(i), "green"))


@check("q8_portfolio_search", with_sql("""
SELECT client_id, company_name, csm_owner, health_status, total_score FROM x_scores_wh
WHERE csm_owner = 'csm_2' AND health_status = 'green' AND regexp_matches(company_name, 'CUSTOMER#0+[1-9]*[05]$', 'i')"""))
def _(i):
    rows = reporting.portfolio(today(i), "csm_2", "green", r"CUSTOMER#0+[1-9]*[05]$")
    return rows.select("client_id", "company_name", "csm_owner", "health_status", "total_score")


@check("q8_portfolio_search_literal", with_sql(
    "SELECT client_id, company_name FROM x_clients WHERE contains(lower(company_name), 'r#00000001')"))
def _(i):
    return reporting.portfolio(today(i), search="R#00000001", literal=True).select("client_id", "company_name")


@check("q9_criterion_breakdown", with_sql("""
SELECT client_id, r.criterion, r.points, 5 AS max_points, r.points / 5.0::DOUBLE AS fraction,
  CASE WHEN r.points >= 4 THEN 'green' WHEN r.points >= 3 THEN 'yellow' ELSE 'red' END AS band
FROM (SELECT client_id, unnest([{'criterion': 'Recencia de Campanha', 'points': score_recency},
  {'criterion': 'Automacoes Ativas', 'points': score_automations},
  {'criterion': 'Integracoes Conectadas', 'points': score_integrations},
  {'criterion': 'Uso do Atendimento', 'points': score_chat}, {'criterion': 'Volume de Mensagens', 'points': score_volume},
  {'criterion': 'Cobertura da Base', 'points': score_coverage}]) AS r FROM x_scores_wh)"""))
def _(i):
    return reporting.criterion_breakdown(today(i))


@check("q10_renewal_band", with_sql("""
SELECT client_id, days_to_renewal, CASE WHEN days_to_renewal > 90 THEN 'green' WHEN days_to_renewal > 30 THEN 'yellow'
  ELSE 'red' END AS renewal_band
FROM (SELECT client_id, CASE WHEN client_id % 10 <> 9 THEN days_to_renewal END AS days_to_renewal FROM x_clients)"""))
def _(i):
    days = F.when(F.col("client_id") % 10 != 9, F.col("days_to_renewal"))
    return i.clients.select("client_id", days.alias("days_to_renewal"),
                            reporting.renewal_band(days).alias("renewal_band"))


@check("q11_score_history", with_sql("""
SELECT CASE WHEN client_id % 3 = 0 AND calculated_at <> DATE '2001-07-20' THEN client_id + 1 ELSE client_id END AS client_id,
  calculated_at, total_score, health_status FROM x_history
QUALIFY count(*) OVER (PARTITION BY CASE WHEN client_id % 3 = 0 AND calculated_at <> DATE '2001-07-20' THEN client_id + 1
  ELSE client_id END) > 1"""))
def _(i):
    # The past of every third client belongs to the next one, which leaves clients of a single point.
    moved = (F.col("client_id") % 3 == 0) & (F.col("calculated_at") != F.lit(AS_OF))
    rows = i.history.withColumn("client_id", F.when(moved, F.col("client_id") + 1).otherwise(F.col("client_id")))
    return reporting.score_history(rows)


@check("q12_client_alerts", with_sql("""
SELECT client_id, alert_id, severity, count(*) OVER (PARTITION BY client_id) AS active_alerts FROM x_open_alerts"""))
def _(i):
    return reporting.client_alerts(i.script_alerts).select("client_id", "alert_id", "severity", "active_alerts")


CENTRE = """SELECT client_id, company_name, csm_owner, alert_id, severity,
  CAST(list_position(['critical', 'warning', 'info'], severity) - 1 AS INTEGER) AS severity_order FROM x_open_alerts"""


@check("q13_alert_centre", with_sql(CENTRE))
def _(i):
    return reporting.alert_centre(i.script_alerts, i.clients).select(
        "client_id", "company_name", "csm_owner", "alert_id", "severity", "severity_order")


@check("q13_alert_centre_filtered", with_sql(CENTRE + " WHERE csm_owner = 'csm_1' AND severity = 'warning'"))
def _(i):
    return reporting.alert_centre(i.script_alerts, i.clients, "csm_1", "warning").select(
        "client_id", "company_name", "csm_owner", "alert_id", "severity", "severity_order")


@check("q13_severity_counts", with_sql("""
SELECT count(*) AS total, count(*) FILTER (severity = 'critical') AS critical,
  count(*) FILTER (severity = 'warning') AS warning, count(*) FILTER (severity = 'info') AS info FROM x_open_alerts"""))
def _(i):
    return reporting.severity_counts(reporting.active_alerts(i.script_alerts))


@check("q14_nps_score", with_sql("""
SELECT responses, promoters, passives, detractors, nps, CASE WHEN nps >= 50 THEN 'green' WHEN nps >= 0 THEN 'yellow'
  ELSE 'red' END AS band
FROM (SELECT count(*) AS responses, count(*) FILTER (nps_score > 8) AS promoters,
  count(*) FILTER (nps_score IN (7, 8)) AS passives, count(*) FILTER (nps_score < 7) AS detractors,
  round((count(*) FILTER (nps_score > 8) - count(*) FILTER (nps_score < 7)) * 100.0::DOUBLE / count(*), 2) AS nps
  FROM x_nps)"""))
def _(i):
    return reporting.nps_score(i.nps)


@check("q15_nps_by_segment", with_sql("""
SELECT c.segment_ipc, n.nps_category, count(*) AS answers FROM x_nps n JOIN x_clients c USING (hubspot_company_id)
GROUP BY 1, 2"""))
def _(i):
    return reporting.nps_by_segment(i.nps, i.clients)


@check("q16_detractors", with_sql("""
SELECT n.response_id, c.company_name, c.segment_ipc, n.nps_score, n.response_date, c.csm_owner
FROM x_nps n LEFT JOIN x_clients c USING (hubspot_company_id) WHERE n.nps_score < 7"""))
def _(i):
    return reporting.detractors(i.nps, i.clients)


@check("q16_detractor_alert_count", with_sql("""
SELECT count(*) AS detractor_alerts FROM x_open_alerts
WHERE 'HS-' || client_id IN (SELECT hubspot_company_id FROM x_nps WHERE nps_score < 7)"""))
def _(i):
    return reporting.detractor_alert_count(i.nps, i.clients, i.script_alerts)


@check("q17_filter_values", with_sql(
    "SELECT DISTINCT csm_owner FROM x_clients WHERE csm_owner IS NOT NULL ORDER BY 1"))
def _(i):
    return reporting.filter_values(i.clients)


@check("q18_latest_coverage", with_sql("""
SELECT csm_owner, year_month, kind, total, contacted, coverage_pct FROM (
  SELECT csm_owner, year_month, 'Com CS' AS kind, clients_with_cs_total AS total, clients_with_cs_contacted AS contacted,
    coverage_with_cs_pct AS coverage_pct FROM x_coverage
  UNION ALL SELECT csm_owner, year_month, 'Sem CS', clients_without_cs_total, clients_without_cs_contacted,
    coverage_without_cs_pct FROM x_coverage)
QUALIFY year_month = max(year_month) OVER (PARTITION BY csm_owner)"""))
def _(i):
    return activity.latest_coverage_rows(coverage(i))
