"""Feature aggregates."""

from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF, CURRENT, PREVIOUS
from pulsechecks.sqlbase import CUR, PREV, TODAY, with_sql
from clientpulse.operators import features


@check("f1_last_campaign", with_sql("SELECT * FROM x_recency"))
def _(i):
    return features.last_campaign(i.campaigns, AS_OF)


@check("f1_last_campaign_literal", with_sql(f"""
SELECT client_id, max(sent_at) AS last_campaign_at, CAST({TODAY} - CAST(max(sent_at) AS DATE) AS INTEGER)
  AS days_since_last_campaign FROM x_campaigns GROUP BY client_id"""))
def _(i):
    return features.last_campaign(i.campaigns, AS_OF, bounded=False)


@check("f2_roi_mean_last3", with_sql("SELECT client_id, round(campaign_roi, 6) AS campaign_roi FROM x_roi_mean3"))
def _(i):
    return features.roi_mean_last(i.campaigns, AS_OF).withColumn("campaign_roi", F.round("campaign_roi", 6))


@check("f3_roi_pooled_last3", with_sql("SELECT client_id, round(campaign_roi, 6) AS campaign_roi FROM x_roi_pooled3"))
def _(i):
    return features.roi_pooled_last(i.campaigns, AS_OF).withColumn("campaign_roi", F.round("campaign_roi", 6))


CALENDAR = """
SELECT client_id, round(sum(revenue_attributed) / nullif(sum(cost), 0), 6) AS campaign_roi FROM x_campaigns
WHERE sent_at >= TIMESTAMP '2001-05-01' AND {cut} GROUP BY client_id"""


@check("f4_roi_calendar_months", with_sql(CALENDAR.format(cut=f"CAST(sent_at AS DATE) <= {TODAY}")))
def _(i):
    return features.roi_calendar_months(i.campaigns, AS_OF).withColumn("campaign_roi", F.round("campaign_roi", 6))


@check("f4_roi_calendar_months_midnight_cut", with_sql(CALENDAR.format(cut=f"sent_at <= CAST({TODAY} AS TIMESTAMP)")))
def _(i):
    return features.roi_calendar_months(i.campaigns, AS_OF, midnight_cut=True).withColumn(
        "campaign_roi", F.round("campaign_roi", 6))


@check("f5_roi_values_last3", with_sql(
    "SELECT client_id, last_campaign_at, days_since_last_campaign, round(campaign_roi, 6) AS campaign_roi FROM x_results3"))
def _(i):
    return features.roi_values_last(i.campaign_results.withColumnRenamed("company_id", "client_id"), AS_OF).withColumn(
        "campaign_roi", F.round("campaign_roi", 6))


@check("f6_roi_by_period", with_sql(f"""
SELECT client_id, p AS period_days, count(*) FILTER (age < p) AS campaigns_in_period,
  round(sum(revenue_attributed) FILTER (age < p) / nullif(sum(cost) FILTER (age < p), 0), 6) AS campaign_roi
FROM (SELECT *, {TODAY} - CAST(sent_at AS DATE) AS age FROM x_campaigns) CROSS JOIN (VALUES (7), (30), (60), (90)) w(p)
WHERE age BETWEEN 0 AND 89 GROUP BY client_id, p"""))
def _(i):
    return features.roi_by_period(i.campaigns, AS_OF).withColumn("campaign_roi", F.round("campaign_roi", 6))


@check("f6_score_rows", with_sql(f"""
SELECT s.client_id, {TODAY} AS calculated_at, p AS period_days, s.total_score, s.health_status,
  ifnull(n, 0) AS campaigns_in_period, round(ifnull(roi, 0), 6) AS campaign_roi
FROM x_scores_wh s CROSS JOIN (VALUES (7), (30), (60), (90)) w(p)
LEFT JOIN (SELECT client_id, p, count(*) AS n, avg(campaign_roi) AS roi FROM x_results, (VALUES (7), (30), (60), (90)) v(p)
  WHERE CAST(sent_at AS DATE) BETWEEN {TODAY} - p + 1 AND {TODAY} GROUP BY ALL) USING (client_id, p)"""))
def _(i):
    return i.window_scores.select("client_id", "calculated_at", "period_days", "total_score", "health_status",
                                  "campaigns_in_period", F.round("campaign_roi", 6).alias("campaign_roi"))


@check("f7_automation_counts", with_sql("SELECT * FROM x_autos_sql"))
def _(i):
    kind = F.col("automation_type")
    return features.automation_counts(i.automations, F.col("status") == "active", kind != "integration",
                                      kind == "integration")


@check("f7_automation_counts_warehouse", with_sql("SELECT * FROM x_autos_wh"))
def _(i):
    kind = F.col("automation_type")
    return features.automation_counts(i.automation_summary.withColumnRenamed("company_id", "client_id"),
                                      F.col("automation_is_active"), kind == "Personalizada",
                                      kind != "Personalizada")


@check("f8_flow_counts", with_sql("SELECT * FROM x_flow_counts"))
def _(i):
    return features.flow_counts(i.flows.withColumnRenamed("company_id", "client_id"))


@check("f9_existence_flags", with_sql("""
SELECT client_id, client_id IN (FROM x_ai) AS has_ai_enabled, client_id IN (FROM x_cashback) AS cashback_active,
  client_id IN (SELECT client_id FROM x_campaigns WHERE campaign_type = 'sms') AS has_sms,
  client_id IN (SELECT client_id FROM x_campaigns WHERE campaign_type = 'email') AS has_email FROM x_clients"""))
def _(i):
    out = i.clients.select("client_id")
    for df, condition, flag in ((i.users, F.col("ai_agent_id") != "", "has_ai_enabled"),
                                (i.cashback_configs, F.col("is_active"), "cashback_active"),
                                (i.channel("sms"), None, "has_sms"), (i.channel("email"), None, "has_email")):
        keys = features.keys_having(df.withColumnRenamed("company_id", "client_id"), condition)
        out = features.with_flag(out, keys, flag)
    return out


@check("f10_chat_usage", with_sql("SELECT * FROM x_chat_usage"))
def _(i):
    return features.chat_usage(i.chat)


@check("f11_messages_two_months", with_sql("SELECT * FROM x_two_months"))
def _(i):
    return features.messages_two_months(i.messages, CURRENT, PREVIOUS)


@check("f12_message_change", with_sql(f"""
SELECT client_id, CASE WHEN messages_sent_previous > 0 THEN round((ifnull(messages_sent_current, 0)
  - messages_sent_previous) * 100.0::DOUBLE / messages_sent_previous, 2) END AS messages_mom_change,
  ifnull(messages_mom_change, 0) AS change_or_zero FROM x_two_months"""))
def _(i):
    two = features.messages_two_months(i.messages, CURRENT, PREVIOUS)
    return two.select("client_id", features.message_change().alias("messages_mom_change"),
                      features.message_change(missing=0.0).alias("change_or_zero"))


@check("f13_plan_usage", with_sql("""
SELECT client_id, CASE WHEN plan_limit_current > 0 THEN round(ifnull(messages_sent_current, 0) * 100.0::DOUBLE
  / plan_limit_current, 2) END AS plan_usage_pct FROM x_two_months"""))
def _(i):
    two = features.messages_two_months(i.messages, CURRENT, PREVIOUS)
    return two.select("client_id", features.plan_usage().alias("plan_usage_pct"))


@check("f14_base_coverage", with_sql("""
SELECT id AS client_id, CASE WHEN total_customers > 0 THEN round(total_impacted_customers_this_month * 100.0::DOUBLE
  / total_customers, 2) END AS coverage_pct FROM x_activity"""))
def _(i):
    from clientpulse.operators.dimensions import latest_activity
    return latest_activity(i.activity_summary).select(F.col("id").alias("client_id"),
                                                      features.base_coverage().alias("coverage_pct"))


LOCAL = ("client_id", "days_since_last_campaign", "active_automations", "integration_automations", "chat_usage_level",
         "cashback_enabled", "messages_sent_current", "messages_sent_previous", "messages_mom_change", "plan_usage_pct",
         "days_to_renewal")


@check("f15_features_sql_v1", with_sql(
    f"SELECT {', '.join(LOCAL)}, round(campaign_roi, 6) AS campaign_roi FROM x_features_sql"))
def _(i):
    feats = features.local_features(i.clients, i.campaigns, i.automations, i.chat, i.messages, AS_OF, CURRENT, PREVIOUS)
    return feats.select(*LOCAL, F.round("campaign_roi", 6).alias("campaign_roi"))


PLAIN = LOCAL[:-3] + LOCAL[-1:]


@check("f15_features_pandas_v1", with_sql(f"""
SELECT {', '.join(PLAIN)}, round(messages_mom_change, 6) AS messages_mom_change, round(plan_usage_pct, 6) AS plan_usage_pct,
  round(campaign_roi, 6) AS campaign_roi FROM x_features_pandas"""))
def _(i):
    feats = features.local_features(i.clients, i.campaigns, i.automations, i.chat, i.messages, AS_OF, CURRENT, PREVIOUS,
                                    "pandas_v1")
    return feats.select(*PLAIN, *[F.round(c, 6).alias(c) for c in ("messages_mom_change", "plan_usage_pct",
                                                                  "campaign_roi")])


WAREHOUSE = ("client_id", "company_name", "csm_owner", "mrr", "days_to_renewal", "days_since_last_campaign",
             "active_automations", "integration_automations", "active_flows", "has_human_agent", "has_chat_flow",
             "has_ai_enabled", "cashback_enabled", "chat_usage_level", "messages_sent_current",
             "messages_sent_previous", "active_integrations_count", "messages_mom_change", "plan_usage_pct",
             "coverage_pct")


@check("f15_features_warehouse_v1_1", with_sql(
    f"SELECT {', '.join(WAREHOUSE)}, round(campaign_roi, 6) AS campaign_roi FROM x_features_wh"))
def _(i):
    return i.warehouse_features.select(*WAREHOUSE, F.round("campaign_roi", 6).alias("campaign_roi"))
