"""Upsell, activity and coverage."""

from datetime import date

from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF, CALL_WINDOW, DOMAIN
from pulsechecks.sqlbase import with_sql
from clientpulse.operators import activity, reporting, upsell


@check("u1_upsell_flags", with_sql("SELECT * FROM x_upsell"))
def _(i):
    return i.upsell_flags


@check("u2_opportunity_count", with_sql("""
SELECT upsell_opportunities_count, count(*) AS clients FROM x_upsell GROUP BY 1"""))
def _(i):
    return i.upsell_flags.groupBy("upsell_opportunities_count").agg(F.count("*").alias("clients"))


@check("u3_campaign_channels", with_sql("SELECT * FROM x_channels"))
def _(i):
    return upsell.campaign_channels(i.campaigns)


@check("u3_channel_marker_campaigns", with_sql("""
SELECT client_id || '-' || kind AS campaign_id, client_id, '_synthetic_' || kind || '_flag' AS campaign_name,
  CAST(NULL AS TIMESTAMP) AS sent_at, 0 AS recipients_count, 0 AS messages_sent, 0::DOUBLE AS revenue_attributed,
  0::DOUBLE AS cost, kind AS campaign_type
FROM (SELECT client_id, 'sms' AS kind FROM x_upsell WHERE has_sms
      UNION ALL SELECT client_id, 'email' FROM x_upsell WHERE has_email)"""))
def _(i):
    return upsell.channel_marker_campaigns(i.upsell_flags)


def product_base(i):
    return upsell.product_base(reporting.client_360(i.clients, i.warehouse_scores), upsell.campaign_channels(i.campaigns))


@check("u4_product_adoption", with_sql("""
SELECT product, count(*) FILTER (has_it) AS has_product, count(*) FILTER (NOT has_it) AS lacks_product,
  round(count(*) FILTER (has_it) * 100.0::DOUBLE / count(*), 2) AS adoption_pct FROM x_product_rows GROUP BY product"""))
def _(i):
    return upsell.product_adoption(product_base(i))


OPPORTUNITY = """
SELECT product, client_id, company_name, csm_owner, segment_ipc, total_score, health_status, mrr, days_to_renewal
FROM x_product_rows WHERE NOT has_it"""


@check("u5_product_opportunities", with_sql(OPPORTUNITY))
def _(i):
    return upsell.product_opportunities(product_base(i))


@check("u5_product_opportunities_filtered", with_sql(
    OPPORTUNITY + " AND csm_owner = 'csm_3' AND health_status = 'yellow'"))
def _(i):
    return upsell.product_opportunities(product_base(i), csm="csm_3", status="yellow")


# --- account managers ---


@check("a1_weekly_calls", with_sql("SELECT * FROM x_weekly_calls"))
def _(i):
    return activity.weekly_calls(i.calls, i.clients, *CALL_WINDOW)


@check("a2_weekly_meetings", with_sql("SELECT * FROM x_weekly_meetings"))
def _(i):
    return activity.weekly_meetings(i.meetings)


@check("a3_weekly_crm_calls", with_sql("SELECT * FROM x_weekly_crm_calls"))
def _(i):
    return activity.weekly_crm_calls(i.crm_calls, i.owners)


def weekly(i):
    return activity.weekly_activity(i.meetings, i.crm_calls, i.owners)


@check("a4_activity_full_join", with_sql("SELECT * FROM x_weekly_activity"))
def _(i):
    return weekly(i)


@check("a5_activity_table", with_sql("SELECT * FROM x_activity_table"))
def _(i):
    return activity.activity_table(weekly(i))


@check("a5_activity_table_blank_week", with_sql("""
SELECT csm_owner, CASE WHEN day(week_start) % 3 <> 0 THEN week_start END AS week_start, CAST(sum(calls_total) AS BIGINT) AS calls_total,
  0::BIGINT AS calls_consultoria, 0::BIGINT AS calls_onboarding, 0::BIGINT AS calls_urgencia, 0::BIGINT AS calls_follow_up,
  CAST(sum(meetings_total) AS BIGINT) AS unique_clients_contacted, CAST(sum(total_duration_minutes) AS BIGINT) AS total_duration_minutes
FROM x_weekly_activity GROUP BY 1, 2"""))
def _(i):
    text = F.when(F.day("week_start") % 3 != 0, F.col("week_start").cast("string")).when(F.day("week_start") % 2 == 0, "").otherwise("nan")
    return activity.activity_table(weekly(i).withColumn("week_start", text))


@check("a6_coverage_from_calls", with_sql("SELECT * FROM x_call_coverage"))
def _(i):
    return activity.coverage_from_calls(i.clients, i.calls, *CALL_WINDOW)


@check("a7_client_facing_meetings", with_sql(
    "SELECT id AS meeting_id, mail AS csm_email, start_date FROM x_meetings WHERE named AND has_guest"))
def _(i):
    return activity.client_facing_meetings(i.meetings, DOMAIN).drop("summary")


@check("a8_coverage_granular", with_sql("SELECT * FROM x_granular"))
def _(i):
    return activity.coverage_granular(i.meetings, i.owners, DOMAIN)


@check("a8_coverage_granular_first_part", with_sql("""
SELECT coalesce(p.owner_name, mail) AS csm_owner, strftime(m.start_date, '%Y-%m') AS year_month,
  CAST(date_trunc('month', m.start_date) AS DATE) AS month_start, split_part(m.mail, '@', 1) AS client_name_slug,
  count(DISTINCT m.id) AS meetings_count
FROM x_meetings m JOIN x_people p USING (mail) WHERE m.named AND m.has_guest GROUP BY ALL"""))
def _(i):
    return activity.coverage_granular(i.meetings, i.owners, DOMAIN, part=1)


def coverage(i):
    return activity.coverage_table(activity.coverage_granular(i.meetings, i.owners, DOMAIN), i.owned_clients)


@check("a9_coverage_table", with_sql("SELECT * FROM x_coverage"))
def _(i):
    return coverage(i)


@check("a10_target_tracking", with_sql("""
SELECT csm_owner, week_start, calls_total, 0 AS sqls_identified, round(calls_total * 100.0::DOUBLE / 20, 2) AS calls_pct,
  0::DOUBLE AS sqls_pct, CASE WHEN calls_total >= 20 THEN 'green' WHEN calls_total >= 14 THEN 'yellow' ELSE 'red' END
  AS calls_band, 'red' AS sqls_band
FROM x_weekly_calls QUALIFY row_number() OVER (PARTITION BY csm_owner ORDER BY week_start DESC) = 1"""))
def _(i):
    return activity.target_tracking(activity.weekly_calls(i.calls, i.clients, *CALL_WINDOW),
                                    activity.coverage_from_calls(i.clients, i.calls, *CALL_WINDOW))


@check("a11_recent_weeks", with_sql("""
SELECT csm_owner, week_start, calls_total FROM x_weekly_calls
QUALIFY dense_rank() OVER (PARTITION BY csm_owner ORDER BY week_start DESC) < 13"""))
def _(i):
    rows = activity.recent_weeks(activity.weekly_calls(i.calls, i.clients, *CALL_WINDOW))
    return rows.select("csm_owner", "week_start", "calls_total")


@check("a11_recent_weeks_in_range", with_sql("""
SELECT csm_owner, week_start, calls_total FROM x_weekly_calls
WHERE week_start BETWEEN DATE '2024-03-11' - 77 AND DATE '2024-03-11'"""))
def _(i):
    rows = activity.recent_weeks(activity.weekly_calls(i.calls, i.clients, *CALL_WINDOW), last=date(2024, 3, 17))
    return rows.select("csm_owner", "week_start", "calls_total")
