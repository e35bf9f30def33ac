"""Named DuckDB subqueries over the given tables; ``with_sql`` puts the needed ones in front of a query."""

from __future__ import annotations

import re

TODAY = "DATE '2001-07-20'"
CUR, PREV = "'2001-07'", "'2001-06'"

# Squeezed order day: days before 2001-08-01 divided by 16.
SQUEEZED = "(DATE '2001-08-01' - CAST((DATE '2001-08-01' - CAST(o_orderdate AS DATE)) // 16 AS INTEGER))"
CENTS = "(CAST(floor(o_totalprice / 100) AS DOUBLE) / 100)"

SUBQUERIES: dict[str, str] = {}


def define(name: str, sql: str) -> None:
    SUBQUERIES[name] = sql.strip()


def with_sql(body: str) -> str:
    """``body`` preceded by every subquery it mentions, directly or through others."""
    order: list[str] = []

    def visit(text: str) -> None:
        for word in dict.fromkeys(re.findall(r"\bx_\w+", text)):
            if word in order:
                continue
            if word not in SUBQUERIES:
                raise KeyError(word)
            visit(SUBQUERIES[word])
            order.append(word)

    visit(body)
    if not order:
        return body.strip()
    parts = ",\n".join(f"{n} AS (\n{SUBQUERIES[n]}\n)" for n in order)
    return f"WITH {parts}\n{body.strip()}"


def exact(expression: str, scale: int = 2) -> str:
    """Nearest decimal to the binary value, through its text."""
    return f"CAST(format('{{:.{scale}f}}', {expression}) AS DOUBLE)"


def ladder(steps: list[tuple[str, int]], otherwise: str = "0") -> str:
    return "CASE " + " ".join(f"WHEN {c} THEN {p}" for c, p in steps) + f" ELSE {otherwise} END"


define("x_clients", f"""
SELECT c_custkey AS client_id, 'HS-' || c_custkey AS hubspot_company_id, 'app' || c_custkey AS gupshup_app_name,
  c_name AS company_name, c_mktsegment AS segment_ipc,
  CASE WHEN c_custkey % 13 <> 0 THEN 'csm_' || (c_custkey % 7) END AS csm_owner, c_custkey % 2 = 0 AS has_cs,
  {TODAY} - CAST(180 + (c_custkey * 37) % 361 AS INTEGER) AS contract_start_date,
  {TODAY} - CAST(180 + (c_custkey * 37) % 361 AS INTEGER) + 365 AS contract_end_date,
  greatest(c_acctbal, 0.0) AS mrr, ['Starter', 'Growth', 'Enterprise'][c_custkey % 3 + 1] AS plan_type,
  c_custkey % 5 = 0 AS cashback_enabled, c_custkey % 6 <> 0 AS onboarding_completed,
  CAST(180 + (c_custkey * 37) % 361 AS INTEGER) AS days_as_client,
  CAST(185 - (c_custkey * 37) % 361 AS INTEGER) AS days_to_renewal
FROM customer""")
define("x_campaigns", f"""
SELECT o_orderkey AS campaign_id, CASE WHEN o_custkey % 17 = 0 THEN o_custkey + 1 ELSE o_custkey END AS client_id,
  CAST({SQUEEZED} AS TIMESTAMP) + to_hours(CAST(8 + o_orderkey % 11 AS INTEGER)) AS sent_at,
  {CENTS} * CASE o_custkey % 4 WHEN 0 THEN 0.5::DOUBLE WHEN 1 THEN 4.0::DOUBLE ELSE 12.0::DOUBLE END
    AS revenue_attributed,
  CASE WHEN o_orderkey % 29 = 0 THEN 0.0::DOUBLE ELSE {CENTS} END AS cost,
  CASE WHEN o_orderpriority = '3-MEDIUM' AND o_custkey % 3 = 0 THEN 'sms'
       WHEN o_orderpriority = '4-NOT SPECIFIED' AND o_custkey % 4 = 0 THEN 'email' ELSE 'whatsapp' END AS campaign_type
FROM orders""")
define("x_automations", f"""
SELECT o_orderkey AS automation_id, o_custkey AS client_id,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL WHEN o_orderkey % 2 = 0 THEN 'integration' ELSE 'standard' END
    AS automation_type,
  CASE WHEN (o_orderkey // 2) % 2 = 1 THEN 'draft' WHEN o_orderstatus = 'O' THEN 'paused' ELSE 'active' END AS status,
  CAST({SQUEEZED} AS TIMESTAMP) AS created_at
FROM orders""")
define("x_messages", f"""
SELECT o_custkey AS client_id, strftime({SQUEEZED}, '%Y-%m') AS year_month,
  CAST(sum(l_quantity) AS BIGINT) AS messages_sent, CAST([150, 300, 600][o_custkey % 3 + 1] AS BIGINT) AS plan_limit
FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL""")
define("x_chat", """
SELECT CASE WHEN c_custkey % 23 = 0 THEN -c_custkey ELSE c_custkey END AS client_id, c_custkey % 3 <> 0 AS has_human_agent,
  c_custkey % 5 = 1 AS has_chat_flow, c_custkey % 4 = 3 AS has_ai_enabled FROM customer""")

# --- warehouse sources ---
define("x_activity", f"""
SELECT client_id AS id, gupshup_app_name, TIMESTAMP '2001-07-20' AS created_at, client_id % 3 <> 0 AS has_customer_service,
  CAST(client_id % 5 = 1 AS BIGINT) AS total_active_flows,
  CASE WHEN client_id % 11 <> 0 THEN [('tool' || g) FOR g IN range(1, client_id % 4 + 1)] END AS active_integrations,
  c.messages_sent AS total_messages_this_month, p.messages_sent AS total_messages_prev_month,
  CAST([150, 300, 600][client_id % 3 + 1] AS BIGINT) AS whatsapp_marketing_package_limit,
  (client_id * 7) % 300 AS total_impacted_customers_this_month,
  CAST(CASE WHEN client_id % 19 = 0 THEN 0 ELSE 1000 END AS BIGINT) AS total_customers
FROM x_clients
LEFT JOIN (SELECT client_id, messages_sent FROM x_messages WHERE year_month = {CUR}) c USING (client_id)
LEFT JOIN (SELECT client_id, messages_sent FROM x_messages WHERE year_month = {PREV}) p USING (client_id)""")
define("x_activity_all", """
SELECT * FROM x_activity UNION ALL BY NAME
SELECT * REPLACE (TIMESTAMP '2001-07-01' AS created_at, false AS has_customer_service, 9 AS total_active_flows,
  1 AS total_messages_this_month, 0 AS total_impacted_customers_this_month) FROM x_activity WHERE id % 5 = 0""")
define("x_results", """
SELECT client_id, campaign_id, CASE WHEN cost > 0 THEN revenue_attributed / cost END AS campaign_roi,
  CASE WHEN campaign_id % 37 <> 0 THEN sent_at END AS sent_at FROM x_campaigns""")
define("x_auto_summary", """
SELECT client_id, status = 'active' AS is_active,
  CASE automation_type WHEN 'standard' THEN 'Personalizada' WHEN 'integration' THEN 'Integracao' END AS kind
FROM x_automations""")
define("x_flows", "SELECT CASE WHEN c_custkey % 5 IN (1, 2) THEN c_custkey ELSE -c_custkey END AS client_id, "
                  "c_custkey % 5 = 1 AS flow_is_active FROM customer")
define("x_ai", "SELECT c_custkey AS client_id FROM customer WHERE c_custkey % 4 = 3")
define("x_cashback", "SELECT c_custkey AS client_id FROM customer WHERE c_custkey % 5 = 0")
define("x_owners", """
SELECT CAST(n_nationkey AS VARCHAR) AS id, CASE WHEN n_nationkey % 9 <> 8 THEN 'First' || n_nationkey END AS firstname,
  CASE WHEN n_nationkey % 4 <> 3 AND n_nationkey <> 17 THEN 'Last' || n_nationkey END AS lastname,
  'Owner' || n_nationkey || '@corp.example' AS email FROM nation""")
define("x_people", """
SELECT id AS owner_id, nullif(concat_ws(' ', firstname, lastname), '') AS owner_name, lower(email) AS mail
FROM x_owners""")
define("x_crm", """
SELECT 'HS-' || c_custkey AS id, c_custkey AS k, 'app' || c_custkey AS app, c_name AS name,
  CASE WHEN c_custkey % 10 = 0 THEN '' WHEN c_custkey % 21 = 0 THEN 'abc'
       ELSE CAST(CAST(greatest(c_acctbal, 0.0) AS DECIMAL(12,2)) AS VARCHAR) END AS mrr_text,
  CASE WHEN c_custkey % 3 <> 0 THEN CAST(c_custkey % 25 AS VARCHAR) END AS cs_id,
  CASE WHEN c_custkey % 4 <> 0 THEN CAST((c_custkey + 1) % 25 AS VARCHAR) END AS cx_id,
  CAST((c_custkey + 2) % 40 AS VARCHAR) AS crm_id,
  CASE WHEN c_custkey % 23 <> 0 THEN make_date(2023 + c_custkey % 3, 1 + c_custkey % 12, 15) END AS start_day,
  CASE WHEN c_custkey % 9 = 0 THEN make_date(2025, 1 + c_custkey % 12, 20) END AS churn_date,
  CASE WHEN c_custkey % 18 = 0 THEN 500.0::DOUBLE END AS churn_value
FROM customer""")
define("x_contracts", """
SELECT id, TRY_CAST(mrr_text AS DOUBLE) AS mrr, start_day, churn_date, churn_value FROM x_crm WHERE mrr_text <> ''""")

# --- account managers ---
define("x_deals", f"""
SELECT o_orderkey AS deal_id, 'HS-' || o_custkey AS hubspot_company_id, CAST(CASE WHEN strftime(o_orderdate, '%Y-%m') =
    '1997-02' THEN o_orderdate + INTERVAL 1 MONTH ELSE o_orderdate END AS DATE) AS closed_date,
  ['new', 'upsell', 'cross_sell', 'downgrade', 'churn'][CAST(o_orderpriority[1] AS INTEGER)] AS deal_type,
  {CENTS} * CASE WHEN o_orderpriority[1] IN ('4', '5') THEN -1 ELSE 1 END AS mrr_delta
FROM orders""")
define("x_calls", """
SELECT event_id AS call_id, 'HS-' || user_id AS hubspot_company_id,
  CASE WHEN event_id % 11 <> 0 THEN 'csm_' || (user_id % 7) END AS csm_owner,
  CAST(CAST(ts AS DATE) + to_months(CAST(event_id % 6 AS INTEGER)) AS DATE) AS call_date,
  15 + event_id % 46 AS duration_minutes,
  CASE event_type WHEN 'click' THEN 'consultoria' WHEN 'purchase' THEN 'onboarding' WHEN 'error' THEN 'urgencia'
    ELSE 'follow_up' END AS call_type
FROM events WHERE event_type <> 'signup'""")
define("x_meetings", """
SELECT event_id AS id, lower('owner' || (user_id % 25) || '@CORP.example') AS mail, ts AS start_date,
  15 + event_id % 46 AS minutes, user_id, event_id % 4 <> 0 AS named,
  event_id % 5 <> 0 AND event_id % 23 <> 0 AS has_guest
FROM events WHERE event_type IN ('view', 'click')""")
define("x_crm_calls", """
SELECT event_id AS id, CASE WHEN event_id % 23 <> 0 AND event_id % 41 <> 0 THEN date_trunc('second', ts) END AS at,
  CASE WHEN event_id % 29 = 0 THEN 0 ELSE (event_id % 1000) * 1000 + 500 END AS ms,
  CASE WHEN event_id % 17 = 0 THEN '99' ELSE CAST(user_id % 25 AS VARCHAR) END AS owner_id
FROM events WHERE event_type IN ('purchase', 'error')""")
define("x_nps", """
SELECT event_id AS response_id, 'HS-' || user_id AS hubspot_company_id, CAST((event_id * 7) % 11 AS INTEGER) AS nps_score,
  CASE WHEN (event_id * 7) % 11 >= 9 THEN 'promoter' WHEN (event_id * 7) % 11 >= 7 THEN 'passive' ELSE 'detractor' END
    AS nps_category, CAST(ts AS DATE) AS response_date
FROM events WHERE event_type = 'signup'""")
define("x_owned_clients", """
SELECT c.* REPLACE (p.owner_name AS csm_owner) FROM x_clients c JOIN x_people p ON p.owner_id = CAST(c.client_id % 25 AS VARCHAR)""")

# --- features ---
define("x_recency", f"""
SELECT client_id, max(sent_at) AS last_campaign_at,
  CAST({TODAY} - CAST(max(sent_at) AS DATE) AS INTEGER) AS days_since_last_campaign FROM x_campaigns
WHERE CAST(sent_at AS DATE) <= {TODAY} GROUP BY client_id""")
define("x_newest3", f"""
SELECT * FROM x_campaigns WHERE CAST(sent_at AS DATE) <= {TODAY}
QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY sent_at DESC NULLS LAST, campaign_id) < 4""")
define("x_roi_mean3", """
SELECT client_id, avg(CASE WHEN cost > 0 THEN revenue_attributed / cost ELSE 0 END) AS campaign_roi
FROM x_newest3 GROUP BY client_id""")
define("x_roi_pooled3", """
SELECT client_id, coalesce(sum(revenue_attributed) / nullif(sum(cost), 0), 0) AS campaign_roi
FROM x_newest3 GROUP BY client_id""")
define("x_results3", f"""
SELECT client_id, max(sent_at) AS last_campaign_at, avg(campaign_roi) AS campaign_roi,
  CAST({TODAY} - CAST(max(sent_at) AS DATE) AS INTEGER) AS days_since_last_campaign
FROM (SELECT * FROM x_results WHERE CAST(sent_at AS DATE) <= {TODAY}
      QUALIFY row_number() OVER (PARTITION BY client_id ORDER BY sent_at DESC, campaign_id) < 4)
GROUP BY client_id""")
define("x_autos_sql", """
SELECT client_id, count(*) FILTER (status = 'active' AND automation_type = 'standard') AS active_automations,
  count(*) FILTER (status = 'active' AND automation_type = 'integration') AS integration_automations
FROM x_automations GROUP BY client_id""")
define("x_autos_wh", """
SELECT client_id, count(*) FILTER (is_active AND kind = 'Personalizada') AS active_automations,
  count(*) FILTER (is_active AND kind = 'Integracao') AS integration_automations
FROM (SELECT client_id, is_active, coalesce(kind, '?') AS kind FROM x_auto_summary) GROUP BY client_id""")
define("x_flow_counts", "SELECT client_id, count(*) FILTER (flow_is_active) AS active_flows FROM x_flows GROUP BY client_id")
define("x_chat_usage", """
SELECT *, CASE WHEN has_human_agent THEN if(has_chat_flow OR has_ai_enabled, 'advanced', 'essential')
  WHEN has_chat_flow THEN 'essential' ELSE 'none' END AS chat_usage_level FROM x_chat""")
define("x_two_months", f"""
SELECT client_id, max(messages_sent) FILTER (year_month = {CUR}) AS messages_sent_current,
  max(messages_sent) FILTER (year_month = {PREV}) AS messages_sent_previous,
  max(plan_limit) FILTER (year_month = {CUR}) AS plan_limit_current
FROM x_messages WHERE year_month IN ({CUR}, {PREV}) GROUP BY client_id""")
define("x_base_coverage", """
SELECT id AS client_id, CASE WHEN total_customers > 0 THEN round(total_impacted_customers_this_month * 100.0::DOUBLE
  / total_customers, 2) END AS coverage_pct FROM x_activity""")
define("x_features_sql", """
SELECT c.client_id, c.company_name, c.csm_owner, c.mrr, c.days_to_renewal, c.cashback_enabled,
  coalesce(r.days_since_last_campaign, 9999) AS days_since_last_campaign, coalesce(m3.campaign_roi, 0) AS campaign_roi,
  coalesce(a.active_automations, 0) AS active_automations,
  coalesce(a.integration_automations, 0) AS integration_automations,
  coalesce(u.chat_usage_level, 'none') AS chat_usage_level,
  coalesce(t.messages_sent_current, 0) AS messages_sent_current,
  coalesce(t.messages_sent_previous, 0) AS messages_sent_previous,
  CASE WHEN t.messages_sent_previous > 0 THEN round((coalesce(t.messages_sent_current, 0) - t.messages_sent_previous)
    * 100.0::DOUBLE / t.messages_sent_previous, 2) END AS messages_mom_change,
  CASE WHEN t.plan_limit_current > 0 THEN round(coalesce(t.messages_sent_current, 0) * 100.0::DOUBLE
    / t.plan_limit_current, 2) END AS plan_usage_pct, v.coverage_pct
FROM x_clients c LEFT JOIN x_base_coverage v USING (client_id) LEFT JOIN x_recency r USING (client_id) LEFT JOIN x_roi_mean3 m3 USING (client_id)
LEFT JOIN x_autos_sql a USING (client_id) LEFT JOIN x_chat_usage u USING (client_id)
LEFT JOIN x_two_months t USING (client_id)""")
define("x_features_pandas", f"""
SELECT f.* EXCLUDE (days_since_last_campaign, campaign_roi, messages_mom_change, plan_usage_pct),
  CAST(CASE WHEN r.last_campaign_at IS NULL THEN 999 WHEN r.last_campaign_at > CAST({TODAY} AS TIMESTAMP) THEN 0
    ELSE floor((epoch(CAST({TODAY} AS TIMESTAMP)) - epoch(r.last_campaign_at)) / 86400) END AS INTEGER)
    AS days_since_last_campaign,
  coalesce(p.campaign_roi, 0) AS campaign_roi,
  CASE WHEN f.messages_sent_previous > 0 THEN (f.messages_sent_current - f.messages_sent_previous) * 100.0::DOUBLE
    / f.messages_sent_previous ELSE 0 END AS messages_mom_change,
  CASE WHEN t.plan_limit_current > 0 THEN f.messages_sent_current * 100.0::DOUBLE / t.plan_limit_current ELSE 0 END
    AS plan_usage_pct
FROM x_features_sql f LEFT JOIN x_recency r USING (client_id) LEFT JOIN x_roi_pooled3 p USING (client_id)
LEFT JOIN x_two_months t USING (client_id)""")
define("x_features_wh", """
SELECT c.client_id, c.company_name, c.csm_owner, c.mrr, c.days_to_renewal,
  coalesce(r.days_since_last_campaign, 9999) AS days_since_last_campaign,
  coalesce(r.campaign_roi, 0) AS campaign_roi, coalesce(au.active_automations, 0) AS active_automations,
  coalesce(au.integration_automations, 0) AS integration_automations, coalesce(f.active_flows, 0) AS active_flows,
  a.has_customer_service AS has_human_agent, coalesce(f.active_flows, 0) > 0 AS has_chat_flow,
  ai.client_id IS NOT NULL AS has_ai_enabled, cb.client_id IS NOT NULL AS cashback_enabled,
  CASE WHEN has_human_agent AND (has_chat_flow OR has_ai_enabled) THEN 'advanced'
       WHEN has_human_agent OR has_chat_flow THEN 'essential' ELSE 'none' END AS chat_usage_level,
  coalesce(a.total_messages_this_month, 0) AS messages_sent_current,
  coalesce(a.total_messages_prev_month, 0) AS messages_sent_previous,
  CAST(coalesce(len(a.active_integrations), 0) AS INTEGER) AS active_integrations_count,
  CASE WHEN a.total_messages_prev_month > 0 THEN round((coalesce(a.total_messages_this_month, 0)
    - a.total_messages_prev_month) * 100.0::DOUBLE / a.total_messages_prev_month, 2) END AS messages_mom_change,
  round(coalesce(a.total_messages_this_month, 0) * 100.0::DOUBLE / a.whatsapp_marketing_package_limit, 2)
    AS plan_usage_pct,
  CASE WHEN a.total_customers > 0 THEN round(a.total_impacted_customers_this_month * 100.0::DOUBLE
    / a.total_customers, 2) END AS coverage_pct
FROM x_clients c JOIN x_activity a ON a.id = c.client_id LEFT JOIN x_results3 r USING (client_id)
LEFT JOIN x_autos_wh au USING (client_id) LEFT JOIN x_flow_counts f USING (client_id)
LEFT JOIN x_ai ai USING (client_id) LEFT JOIN x_cashback cb USING (client_id)""")

RECENCY = ladder([("days_since_last_campaign <= 7", 5), ("days_since_last_campaign <= 20", 3)])
ROI = ladder([("campaign_roi >= 10", 5), ("campaign_roi >= 1", 3)])
AUTOS = ladder([("active_automations > 2", 5), ("active_automations > 0", 3)])
INTEGRATIONS = ladder([("integration_automations > 3", 5), ("integration_automations = 3", 4),
                       ("integration_automations > 0", 2)])
CHAT = "CASE chat_usage_level WHEN 'advanced' THEN 5 WHEN 'essential' THEN 4 ELSE 0 END"
VOLUME = ladder([("plan_usage_pct >= 80", 5), ("messages_mom_change > 0", 5), ("messages_mom_change >= -10", 3)])
VOLUME_WIDE = ladder([("plan_usage_pct >= 80", 5), ("messages_mom_change > 10", 5), ("messages_mom_change >= -10", 3)])


def scored(features: str, volume: str, bonus: str, green: int, yellow: int) -> str:
    return f"""
SELECT *, score_recency + score_roi + score_automations + score_integrations + score_chat + score_volume
    + bonus_cashback AS total_score,
  CASE WHEN total_score >= {green} THEN 'green' WHEN total_score >= {yellow} THEN 'yellow' ELSE 'red' END AS health_status
FROM (SELECT *, {RECENCY} AS score_recency, {ROI} AS score_roi, {AUTOS} AS score_automations,
  {INTEGRATIONS} AS score_integrations, {CHAT} AS score_chat, {volume} AS score_volume, {bonus} AS bonus_cashback
  FROM {features})"""


define("x_scores_sql", scored("x_features_sql", VOLUME, "if(cashback_enabled, 2, 0)", 26, 16))
define("x_scores_pandas", scored("x_features_pandas", VOLUME_WIDE, "0", 19, 11))
define("x_scores_wh", f"""
SELECT *, score_recency + score_automations + score_integrations + score_chat + score_volume + score_coverage
    AS total_score,
  CASE WHEN total_score >= 19 THEN 'green' WHEN total_score >= 11 THEN 'yellow' WHEN total_score >= 4 THEN 'red'
    ELSE 'inactive' END AS health_status
FROM (SELECT *, {RECENCY} AS score_recency, {AUTOS} AS score_automations,
  {ladder([("active_integrations_count >= 2", 5), ("active_integrations_count = 1", 3)])} AS score_integrations,
  {CHAT} AS score_chat, {VOLUME} AS score_volume,
  {ladder([("coverage_pct >= 15", 5), ("coverage_pct >= 5", 3)])} AS score_coverage FROM x_features_wh)""")

# --- scores as of past month ends ---
define("x_month_ends", """
SELECT last_day(CAST(m AS DATE)) AS calculated_at, strftime(m, '%Y-%m') AS ym,
  strftime(m - INTERVAL 1 MONTH, '%Y-%m') AS prev_ym, CAST(m - INTERVAL 2 MONTH AS TIMESTAMP) AS roi_from
FROM generate_series(TIMESTAMP '2001-01-01', TIMESTAMP '2001-06-01', INTERVAL 1 MONTH) t(m)""")


def asof_features(cut: str) -> str:
    """``cut`` is the condition that makes an event at {at} known at a month end."""
    return f"""
SELECT c.client_id, m.calculated_at, c.cashback_enabled, coalesce(u.chat_usage_level, 'none') AS chat_usage_level,
  CAST(m.calculated_at - s.last_on AS INTEGER) AS days_since_last_campaign, s.campaign_roi,
  coalesce(a.std, 0) AS active_automations, coalesce(a.integ, 0) AS integration_automations,
  cur.messages_sent AS messages_sent_current, prv.messages_sent AS messages_sent_previous,
  CASE WHEN prv.messages_sent > 0 THEN (cur.messages_sent - prv.messages_sent) * 100.0::DOUBLE / prv.messages_sent END
    AS messages_mom_change,
  cur.messages_sent * 100.0::DOUBLE / cur.plan_limit AS plan_usage_pct, CAST(NULL AS DOUBLE) AS coverage_pct
FROM x_clients c CROSS JOIN x_month_ends m
LEFT JOIN (SELECT client_id, calculated_at, max(CAST(sent_at AS DATE)) AS last_on,
    sum(revenue_attributed) FILTER (sent_at >= roi_from) / nullif(sum(cost) FILTER (sent_at >= roi_from), 0)
      AS campaign_roi
  FROM x_campaigns JOIN x_month_ends ON {cut.format(at='sent_at')} GROUP BY ALL) s USING (client_id, calculated_at)
LEFT JOIN (SELECT client_id, calculated_at, count(*) FILTER (coalesce(automation_type, '') <> 'integration') AS std,
    count(*) FILTER (coalesce(automation_type, '') = 'integration') AS integ
  FROM x_automations JOIN x_month_ends ON {cut.format(at='created_at')} WHERE status = 'active' GROUP BY ALL) a
  USING (client_id, calculated_at)
LEFT JOIN x_messages cur ON cur.client_id = c.client_id AND cur.year_month = m.ym
LEFT JOIN x_messages prv ON prv.client_id = c.client_id AND prv.year_month = m.prev_ym
LEFT JOIN x_chat_usage u ON u.client_id = c.client_id"""


define("x_asof", asof_features("{at} < calculated_at + INTERVAL 1 DAY"))
define("x_asof_midnight", asof_features("{at} <= CAST(calculated_at AS TIMESTAMP)"))
define("x_backfill", scored("x_asof", VOLUME, "if(cashback_enabled, 5, 0)", 26, 16))
define("x_backfill_midnight", scored("x_asof_midnight", VOLUME, "if(cashback_enabled, 5, 0)", 26, 16))

SCORE_COLUMNS = """client_id, calculated_at, score_recency, score_roi, score_automations, score_integrations, score_chat,
  score_volume, bonus_cashback, days_since_last_campaign, campaign_roi, active_automations, integration_automations,
  chat_usage_level, messages_sent_current, messages_sent_previous, messages_mom_change, plan_usage_pct, coverage_pct,
  total_score, health_status"""
define("x_history", f"""
SELECT {SCORE_COLUMNS} FROM x_backfill
UNION ALL SELECT {SCORE_COLUMNS} FROM (SELECT *, {TODAY} AS calculated_at FROM x_scores_sql)""")
define("x_window_history", """
SELECT h.* REPLACE (h.total_score + w.p AS total_score), w.p AS period_days
FROM x_history h CROSS JOIN (VALUES (7), (30), (60), (90)) w(p)""")
define("x_window_ranked", """
SELECT *, row_number() OVER (PARTITION BY client_id, period_days ORDER BY calculated_at DESC) AS nth FROM x_window_history""")
define("x_ranked", """
SELECT *, row_number() OVER (PARTITION BY client_id ORDER BY calculated_at DESC) AS nth FROM x_history""")
define("x_alert_base", """
SELECT n.*, c.company_name, c.csm_owner, c.days_to_renewal, p.health_status AS previous_status,
  p.campaign_roi AS previous_roi
FROM (SELECT * FROM x_ranked WHERE nth = 1) n JOIN x_clients c USING (client_id)
LEFT JOIN (SELECT * FROM x_ranked WHERE nth = 2) p USING (client_id)""")

# The rules of the three alert sets as (id, severity, condition).
DROPPED = "health_status = 'red' AND previous_status IS DISTINCT FROM 'red'"
SCRIPT_RULES = [
    ("score_dropped_to_red", "critical", DROPPED), ("no_campaign_14d", "warning", "days_since_last_campaign > 13"),
    ("renewal_90d", "info", "days_to_renewal > 30 AND days_to_renewal < 91"),
    ("renewal_30d_red", "critical", "health_status = 'red' AND days_to_renewal < 31"),
    ("volume_drop_30pct", "warning", "messages_mom_change <= -30"),
    ("low_base_coverage", "warning", "health_status <> 'inactive' AND (coverage_pct IS NULL OR coverage_pct < 5)"),
    ("inactive_client", "critical", "health_status = 'inactive' AND days_to_renewal < 61"),
    ("upsell_opportunity", "info", "plan_usage_pct >= 90 AND health_status = 'green'")]
SQL_V1_RULES = [
    ("score_dropped_to_red", "critical", DROPPED), ("no_campaign_14d", "high", "days_since_last_campaign > 13"),
    ("roi_dropped_below_1", "high", "campaign_roi < 1"), ("renewal_90d", "medium", "days_to_renewal < 91"),
    ("renewal_30d_red", "critical", "health_status = 'red' AND days_to_renewal < 31"),
    ("volume_drop_30pct", "high", "messages_mom_change <= -30"),
    ("upsell_opportunity", "low", "plan_usage_pct >= 90 AND health_status = 'green'")]


def money2(c: str) -> str:
    return f"CAST(CAST({c} AS DECIMAL(10,2)) AS VARCHAR)"


WAREHOUSE_RULES = [
    ("no_campaign_14d", "warning", "days_since_last_campaign BETWEEN 14 AND 9998",
     "CAST(days_since_last_campaign AS VARCHAR)"),
    ("renewal_90d", "info", "days_to_renewal > 30 AND days_to_renewal < 91", "CAST(days_to_renewal AS VARCHAR)"),
    ("renewal_30d_red", "critical", "health_status = 'red' AND days_to_renewal >= 0 AND days_to_renewal < 31",
     "CAST(days_to_renewal AS VARCHAR)"),
    ("volume_drop_30pct", "warning", "messages_mom_change <= -30", money2("messages_mom_change")),
    ("low_base_coverage", "warning", "health_status <> 'inactive' AND ifnull(coverage_pct, 0) < 5",
     money2("ifnull(coverage_pct, 0)")),
    ("inactive_client", "critical", "health_status = 'inactive' AND days_to_renewal < 61",
     "CAST(days_to_renewal AS VARCHAR)"),
    ("upsell_opportunity", "info", "plan_usage_pct >= 90 AND health_status = 'green'", money2("plan_usage_pct")),
    ("score_red", "critical", "health_status = 'red'", "CAST(total_score AS VARCHAR)")]


def fired(rules: list[tuple], source: str, columns: str = "client_id, company_name, csm_owner") -> str:
    return "\nUNION ALL\n".join(
        f"SELECT {columns}, '{r[0]}' AS alert_id, '{r[1]}' AS severity, {r[3] if len(r) > 3 else 'CAST(NULL AS VARCHAR)'}"
        f" AS alert_metric FROM {source} WHERE {r[2]}" for r in rules)


define("x_script_alerts", fired(SCRIPT_RULES, "x_alert_base"))
define("x_sql_alerts", fired(SQL_V1_RULES, "x_alert_base"))
define("x_wh_alerts", fired(WAREHOUSE_RULES, "x_scores_wh"))
define("x_open_alerts", "SELECT * FROM x_script_alerts WHERE client_id % 4 <> 0")

# --- upsell ---
define("x_channels", """
SELECT client_id, coalesce(bool_or(campaign_type = 'sms'), false) AS has_sms,
  coalesce(bool_or(campaign_type = 'email'), false) AS has_email FROM x_campaigns GROUP BY client_id""")
define("x_upsell", """
SELECT *, CAST((NOT has_chat_flow)::INT + (NOT has_sms)::INT + (NOT has_email)::INT + (NOT has_ai_enabled)::INT
  + (NOT has_integration_automations)::INT + (NOT has_active_automations)::INT + (NOT cashback_enabled)::INT AS INTEGER)
  AS upsell_opportunities_count
FROM (SELECT c.client_id, c.company_name, c.csm_owner, c.mrr, a.total_active_flows > 0 AS has_chat_flow,
  c.client_id IN (SELECT client_id FROM x_campaigns WHERE campaign_type = 'sms') AS has_sms,
  c.client_id IN (SELECT client_id FROM x_campaigns WHERE campaign_type = 'email') AS has_email,
  c.client_id IN (SELECT client_id FROM x_ai) AS has_ai_enabled,
  ifnull(u.integration_automations, 0) > 1 AS has_integration_automations,
  ifnull(u.active_automations, 0) > 0 AS has_active_automations,
  c.client_id IN (SELECT client_id FROM x_cashback) AS cashback_enabled,
  ifnull(u.active_automations, 0) AS std_autos_count, ifnull(u.integration_automations, 0) AS integ_autos_count,
  a.total_active_flows AS active_flows_count,
  CAST(ifnull(len(a.active_integrations), 0) AS INTEGER) AS ecommerce_integrations_count
  FROM x_clients c JOIN x_activity a ON a.id = c.client_id LEFT JOIN x_autos_wh u USING (client_id))""")
define("x_latest", "SELECT * FROM x_ranked WHERE nth = 1")
PRODUCT_NAMES = ["Fluxo de Atendimento", "SMS", "Email", "Agente de IA", "Automacao de Integracao 2+",
                 "Automacao de Campanhas", "Cashback Ativo"]
PRODUCT_FLAGS = ["has_chat_flow", "has_sms", "has_email", "has_ai_enabled", "has_integration_automations",
                 "has_active_automations", "cashback_enabled"]
define("x_product_rows", "\nUNION ALL\n".join(
    f"SELECT '{n}' AS product, {f} AS has_it, client_id, company_name, csm_owner, segment_ipc, total_score, health_status,"
    f" mrr, days_to_renewal FROM x_product_flags" for n, f in zip(PRODUCT_NAMES, PRODUCT_FLAGS)))
define("x_product_flags", """
SELECT c.*, h.total_score, h.health_status, h.has_chat_flow, h.has_ai_enabled, ifnull(ch.has_sms, false) AS has_sms,
  ifnull(ch.has_email, false) AS has_email, h.integration_automations > 1 AS has_integration_automations,
  h.active_automations > 0 AS has_active_automations
FROM x_clients c JOIN x_scores_wh h USING (client_id) LEFT JOIN x_channels ch USING (client_id)""")

# --- activity and coverage ---
define("x_weekly_calls", """
SELECT coalesce(k.csm_owner, c.csm_owner) AS csm_owner, CAST(date_trunc('week', call_date) AS DATE) AS week_start,
  count(*) AS calls_total, count(*) FILTER (call_type = 'consultoria') AS calls_consultoria,
  count(*) FILTER (call_type = 'onboarding') AS calls_onboarding, count(*) FILTER (call_type = 'urgencia') AS calls_urgencia,
  count(*) FILTER (call_type = 'follow_up') AS calls_follow_up, count(DISTINCT hubspot_company_id) AS unique_clients_contacted,
  CAST(sum(duration_minutes) AS BIGINT) AS total_duration_minutes
FROM x_calls k LEFT JOIN x_clients c USING (hubspot_company_id)
WHERE call_date BETWEEN DATE '2024-01-01' AND DATE '2024-06-30' AND coalesce(k.csm_owner, c.csm_owner) IS NOT NULL
GROUP BY 1, 2""")
define("x_weekly_meetings", """
SELECT mail AS csm_email, CAST(date_trunc('week', start_date) AS DATE) AS week_start, count(DISTINCT id) AS meetings_total,
  CAST(sum(minutes) AS BIGINT) AS meeting_duration_minutes FROM x_meetings GROUP BY 1, 2""")
define("x_weekly_crm_calls", """
SELECT p.mail AS csm_email, CAST(date_trunc('week', k.at) AS DATE) AS week_start, count(DISTINCT k.id) AS calls_total,
  CAST(sum(k.ms) // 60000 AS BIGINT) AS calls_duration_minutes
FROM x_crm_calls k JOIN x_people p USING (owner_id) WHERE k.at IS NOT NULL GROUP BY 1, 2""")
define("x_weekly_activity", """
SELECT coalesce(p.owner_name, csm_email) AS csm_owner, csm_email, week_start, ifnull(m.meetings_total, 0) AS meetings_total,
  ifnull(k.calls_total, 0) AS calls_total, ifnull(m.meetings_total, 0) + ifnull(k.calls_total, 0) AS activities_total,
  ifnull(m.meeting_duration_minutes, 0) + ifnull(k.calls_duration_minutes, 0) AS total_duration_minutes
FROM x_weekly_meetings m FULL JOIN x_weekly_crm_calls k USING (csm_email, week_start)
LEFT JOIN x_people p ON p.mail = csm_email""")
define("x_granular", """
SELECT coalesce(p.owner_name, mail) AS csm_owner, strftime(m.start_date, '%Y-%m') AS year_month,
  CAST(date_trunc('month', m.start_date) AS DATE) AS month_start,
  'customer#' || lpad(CAST(m.user_id AS VARCHAR), 9, '0') AS client_name_slug,
  CAST(count(DISTINCT m.id) AS BIGINT) AS meetings_count
FROM x_meetings m JOIN x_people p USING (mail) WHERE m.named AND m.has_guest GROUP BY ALL""")
define("x_activity_table", """
SELECT csm_owner, week_start, CAST(sum(calls_total) AS BIGINT) AS calls_total, 0::BIGINT AS calls_consultoria,
  0::BIGINT AS calls_onboarding, 0::BIGINT AS calls_urgencia, 0::BIGINT AS calls_follow_up,
  CAST(sum(meetings_total) AS BIGINT) AS unique_clients_contacted,
  CAST(sum(total_duration_minutes) AS BIGINT) AS total_duration_minutes FROM x_weekly_activity GROUP BY 1, 2""")


def pct(num: str, den: str, scale: int | None = None) -> str:
    share = f"{num} * 100.0::DOUBLE / nullif({den}, 0)"
    return f"coalesce({exact(share) if scale is None else f'round_even({share}, {scale})'}, 0)"


define("x_call_coverage", f"""
SELECT csm_owner, ym AS year_month, w AS clients_with_cs_total, ifnull(cw, 0) AS clients_with_cs_contacted,
  wo AS clients_without_cs_total, ifnull(cwo, 0) AS clients_without_cs_contacted,
  {pct('ifnull(cw, 0)', 'w')} AS coverage_with_cs_pct, {pct('ifnull(cwo, 0)', 'wo')} AS coverage_without_cs_pct,
  0 AS sqls_identified
FROM (SELECT csm_owner, count(*) FILTER (has_cs) AS w, count(*) FILTER (NOT has_cs) AS wo FROM x_clients WHERE csm_owner IS NOT NULL
      GROUP BY 1)
CROSS JOIN (SELECT strftime(d, '%Y-%m') AS ym FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2024-06-01',
      INTERVAL 1 MONTH) t(d))
LEFT JOIN (SELECT c.csm_owner, strftime(k.call_date, '%Y-%m') AS ym, count(DISTINCT c.client_id) FILTER (c.has_cs) AS cw,
      count(DISTINCT c.client_id) FILTER (NOT c.has_cs) AS cwo
      FROM x_calls k JOIN x_clients c ON c.hubspot_company_id = k.hubspot_company_id AND c.csm_owner = k.csm_owner
      GROUP BY 1, 2) USING (csm_owner, ym)""")
define("x_coverage", f"""
SELECT csm_owner, year_month, w AS clients_with_cs_total, cw AS clients_with_cs_contacted,
  wo AS clients_without_cs_total, cwo AS clients_without_cs_contacted, {pct('cw', 'w', 1)} AS coverage_with_cs_pct,
  {pct('cwo', 'wo', 1)} AS coverage_without_cs_pct, 0 AS sqls_identified
FROM (SELECT g.csm_owner, g.year_month, count(*) FILTER (ifnull(o.has_cs, true)) AS cw, count(*) FILTER (NOT ifnull(o.has_cs, true)) AS cwo
      FROM x_granular g LEFT JOIN (SELECT csm_owner, lower(company_name) AS client_name_slug, has_cs
        FROM x_owned_clients) o USING (csm_owner, client_name_slug) GROUP BY 1, 2)
LEFT JOIN (SELECT csm_owner, count(*) FILTER (has_cs) AS w, count(*) FILTER (NOT has_cs) AS wo FROM x_owned_clients GROUP BY 1)
  USING (csm_owner)""")

# --- revenue ---
define("x_spine", """
SELECT CAST(m AS DATE) AS month_start, strftime(m, '%Y-%m') AS year_month
FROM generate_series(TIMESTAMP '2024-01-01', TIMESTAMP '2026-04-01', INTERVAL 1 MONTH) t(m)""")
define("x_states", """
SELECT year_month, month_start,
  round(coalesce(sum(mrr) FILTER (start_day < month_start AND (churn_date IS NULL OR churn_date >= month_start)), 0), 2)
    AS mrr_start,
  round(coalesce(sum(mrr) FILTER (date_trunc('month', start_day) = month_start), 0), 2) AS mrr_new,
  round(coalesce(sum(coalesce(churn_value, mrr)) FILTER (date_trunc('month', churn_date) = month_start), 0), 2) AS mrr_churn
FROM x_spine CROSS JOIN x_contracts GROUP BY ALL""")
define("x_retention", """
SELECT year_month, month_start, mrr_start, 0.0::DOUBLE AS mrr_downgrade, 0.0::DOUBLE AS mrr_upsell,
  0.0::DOUBLE AS mrr_cross_sell, mrr_new, mrr_churn, round(mrr_start - mrr_churn + mrr_new, 2) AS mrr_end,
  CASE WHEN mrr_start > 0 THEN round((mrr_start - mrr_churn) * 100.0::DOUBLE / mrr_start, 2) END AS grr, grr AS nrr
FROM x_states""")
define("x_movements", f"""
SELECT strftime(m, '%Y-%m') AS year_month, CAST(m AS DATE) AS month_start, count(deal_id) AS deals,
  {exact("coalesce(sum(mrr_delta) FILTER (deal_type = 'new'), 0)")} AS mrr_new,
  {exact("coalesce(sum(mrr_delta) FILTER (deal_type = 'upsell'), 0)")} AS mrr_upsell,
  {exact("coalesce(sum(mrr_delta) FILTER (deal_type = 'cross_sell'), 0)")} AS mrr_cross_sell,
  {exact("coalesce(sum(mrr_delta) FILTER (deal_type = 'churn'), 0)")} AS mrr_churn,
  {exact("coalesce(sum(mrr_delta) FILTER (deal_type = 'downgrade'), 0)")} AS mrr_downgrade
FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-08-01', INTERVAL 1 MONTH) t(m)
LEFT JOIN x_deals ON date_trunc('month', closed_date) = CAST(m AS DATE) GROUP BY m""")

# One step of the chain: the amounts of month i+1 given its start.
_STEP = {"new": "0.02", "upsell": "0.015", "cross_sell": "0.005", "churn": "-0.01", "downgrade": "-0.005"}
_MOVED = ", ".join(
    f"CASE WHEN n.deals = 0 THEN {exact(f's * {r}::DOUBLE')} ELSE n.mrr_{m} END AS mrr_{m}" for m, r in _STEP.items())
_END = exact("s + mrr_new + mrr_upsell + mrr_cross_sell - abs(mrr_churn) - abs(mrr_downgrade)")
_COLS = "mrr_new, mrr_upsell, mrr_cross_sell, mrr_churn, mrr_downgrade"
CHAIN = f"""numbered AS (SELECT *, row_number() OVER (ORDER BY month_start) AS i FROM x_movements),
chain(i, year_month, s, {_COLS}, e) AS (
  SELECT i, year_month, s, {_COLS}, {_END} FROM (
    SELECT n.i, n.year_month, s, {_MOVED} FROM numbered n, (SELECT {exact('sum(mrr)')} AS s FROM x_clients) WHERE n.i = 1)
  UNION ALL
  SELECT i, year_month, s, {_COLS}, {_END} FROM (
    SELECT n.i, n.year_month, s, {_MOVED} FROM (SELECT i AS done, e AS s FROM chain) c JOIN numbered n ON n.i = c.done + 1)),
waterfall AS (SELECT year_month, s AS mrr_start, mrr_churn, mrr_downgrade, mrr_upsell, mrr_cross_sell, mrr_new, e AS mrr_end,
  CASE WHEN s > 0 THEN {exact('(s - abs(mrr_churn) - abs(mrr_downgrade)) / s', 4)} ELSE 0 END AS grr,
  CASE WHEN s > 0 THEN {exact('e / s', 4)} ELSE 0 END AS nrr FROM chain)"""


def with_chain(body: str) -> str:
    """``body`` over ``waterfall``, the chained months."""
    base = with_sql("SELECT * FROM x_movements, x_clients")
    head = base[:base.rindex("\nSELECT * FROM x_movements, x_clients")]
    return f"WITH RECURSIVE {head.removeprefix('WITH ')},\n{CHAIN}\n{body.strip()}"
