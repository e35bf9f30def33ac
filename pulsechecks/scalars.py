"""Scalar functions over columns of the tables."""

from datetime import date

from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF
from pulsechecks.sqlbase import TODAY, with_sql
from clientpulse import functions as fn


def orders(i, *columns):
    return i.table("orders", "o_orderkey", *columns)


@check("e1_coalesce_defaults", with_sql("""
SELECT client_id, ifnull(csm_owner, '-') AS csm_owner, ifnull(days_since_last_campaign, 9999) AS days,
  ifnull(campaign_roi, 0) >= 1 AS profitable FROM x_clients LEFT JOIN x_recency USING (client_id)
  LEFT JOIN x_roi_pooled3 USING (client_id)"""))
def _(i):
    from clientpulse.operators import features
    joined = i.clients.join(features.last_campaign(i.campaigns, AS_OF), "client_id", "left").join(
        features.roi_pooled_last(i.campaigns, AS_OF), "client_id", "left")
    return joined.select("client_id", F.coalesce("csm_owner", F.lit("-")).alias("csm_owner"),
                         F.coalesce("days_since_last_campaign", F.lit(9999)).alias("days"),
                         (F.coalesce("campaign_roi", F.lit(0.0)) >= 1).alias("profitable"))


@check("e2_case_bands", """
SELECT c_custkey, CASE WHEN c_acctbal >= 5000 THEN 'high' WHEN c_acctbal >= 0 THEN 'mid' ELSE 'debt' END AS balance_band
FROM customer""")
def _(i):
    return i.table("customer", "c_custkey", "c_acctbal").select(
        "c_custkey", fn.band("c_acctbal", [(5000, "high"), (0, "mid")], "debt").alias("balance_band"))


@check("e3_rounding", """
SELECT c_custkey, round((c_custkey % 64) / 8.0::DOUBLE, 2) AS half_up, round_even((c_custkey % 64) / 8.0::DOUBLE, 2) AS half_even,
  CAST(format('{:.1f}', c_acctbal) AS DOUBLE) AS exact_tenths FROM customer""")
def _(i):
    eighths = (F.col("c_custkey") % 64) / F.lit(8.0)
    return i.table("customer", "c_custkey", "c_acctbal").select(
        "c_custkey", fn.round_half_up(eighths).alias("half_up"), fn.round_half_even(eighths).alias("half_even"),
        fn.round_exact("c_acctbal", 1).alias("exact_tenths"))


MESSY = ("CASE o_orderkey % 6 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN CAST(o_orderkey AS VARCHAR) "
         "WHEN 3 THEN '-' || o_orderkey || '.75' WHEN 4 THEN '1999-0' || (1 + o_orderkey % 9) || '-15' END")


def messy():
    o = F.col("o_orderkey")
    text = o.cast("string")
    return (F.when(o % 6 == 0, "").when(o % 6 == 1, "abc").when(o % 6 == 2, text)
             .when(o % 6 == 3, F.concat(F.lit("-"), text, F.lit(".75")))
             .when(o % 6 == 4, F.concat(F.lit("1999-0"), (1 + o % 9).cast("string"), F.lit("-15"))))


@check("e4_try_cast", f"""
SELECT o_orderkey, TRY_CAST(t AS DOUBLE) AS as_double, CASE WHEN o_orderkey % 6 = 2 THEN o_orderkey END AS as_long,
  TRY_CAST(t AS DATE) AS as_date FROM (SELECT o_orderkey, {MESSY} AS t FROM orders)""")
def _(i):
    long_text = F.when(F.col("o_orderkey") % 6 != 3, messy())
    return orders(i).select("o_orderkey", fn.to_double(messy()).alias("as_double"),
                            fn.to_long(long_text).alias("as_long"),
                            fn.to_date(F.when(F.col("o_orderkey") % 6 != 2, messy())).alias("as_date"))


@check("e5_safe_numbers", f"""
SELECT o_orderkey, ifnull(TRY_CAST(t AS DOUBLE), 0) AS as_float,
  CAST(ifnull(trunc(TRY_CAST(t AS DOUBLE)), -1) AS BIGINT) AS as_int
FROM (SELECT o_orderkey, {MESSY} AS t FROM orders)""")
def _(i):
    return orders(i).select("o_orderkey", fn.safe_float(messy()).alias("as_float"),
                            fn.safe_int(messy(), -1).alias("as_int"))


@check("e6_truthy", """
SELECT o_orderkey, o_orderkey % 5 IN (0, 1) AS from_text, o_orderkey % 2 = 1 AS from_number, o_orderstatus = 'F' AS from_bool
FROM orders""")
def _(i):
    o = F.col("o_orderkey")
    text = (F.when(o % 5 == 0, "TRUE").when(o % 5 == 1, "1").when(o % 5 == 2, "yes").when(o % 5 == 3, ""))
    return orders(i, "o_orderstatus").select(
        "o_orderkey", fn.truthy(text).alias("from_text"), fn.truthy(o % 2).alias("from_number"),
        fn.truthy(F.col("o_orderstatus") == "F").alias("from_bool"))


@check("e7_iso_timestamp", """
SELECT event_id, CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
  ELSE date_trunc('second', ts) END AS at FROM events""")
def _(i):
    e = F.col("event_id")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    iso = (F.when(e % 10 == 0, "not a time").when(e % 5 == 0, "").when(e % 5 == 1, F.substring(text, 1, 10))
            .when(e % 5 == 2, F.concat(text, F.lit("Z"))).when(e % 5 == 3, F.concat(text, F.lit("-03:00")))
            .otherwise(text))
    return i.table("events", "event_id", "ts").select("event_id", fn.iso_timestamp(iso).alias("at"))


@check("e8_epoch_or_iso_date", """
SELECT event_id, CASE WHEN event_id % 4 < 2 THEN CAST(ts AS DATE) END AS day FROM events""")
def _(i):
    e = F.col("event_id")
    millis = (F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86_400_000 + F.hour("ts") * 3_600_000)
    text = (F.when(e % 4 == 0, millis.cast("string"))
             .when(e % 4 == 1, F.concat(F.col("ts").cast("date").cast("string"), F.lit("T23:59:59.000-03:00")))
             .when(e % 4 == 2, "Tuesday"))
    return i.table("events", "event_id", "ts").select("event_id", fn.epoch_or_iso_date(text).alias("day"))


@check("e9_date_difference", f"""
SELECT event_id, CAST(DATE '2024-02-01' - CAST(ts AS DATE) AS INTEGER) AS calendar_days,
  CAST(floor((epoch(TIMESTAMP '2024-02-01') - epoch(ts)) / 86400) AS INTEGER) AS elapsed_days FROM events""")
def _(i):
    until = date(2024, 2, 1)
    return i.table("events", "event_id", "ts").select(
        "event_id", fn.days_between(F.lit(until), "ts").alias("calendar_days"),
        fn.elapsed_days(until, "ts").alias("elapsed_days"))


@check("e10_date_arithmetic", """
SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 YEAR AS DATE) AS next_year,
  last_day(CAST(o_orderdate AS DATE)) AS month_end, strftime(o_orderdate - INTERVAL 1 MONTH, '%Y-%m') AS previous_month
FROM orders""")
def _(i):
    return orders(i, "o_orderdate").select(
        "o_orderkey", fn.add_years("o_orderdate").alias("next_year"), fn.month_end("o_orderdate").alias("month_end"),
        fn.previous_year_month("o_orderdate").alias("previous_month"))


@check("e11_date_trunc", """
SELECT o_orderkey, CAST(date_trunc('week', o_orderdate) AS DATE) AS week_start,
  CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders""")
def _(i):
    return orders(i, "o_orderdate").select("o_orderkey", fn.week_start("o_orderdate").alias("week_start"),
                                           fn.month_start("o_orderdate").alias("month_start"))


@check("e12_year_month", "SELECT strftime(o_orderdate, '%Y-%m') AS year_month, count(*) AS orders FROM orders GROUP BY 1")
def _(i):
    return orders(i, "o_orderdate").groupBy(fn.year_month("o_orderdate").alias("year_month")).agg(
        F.count("*").alias("orders"))


@check("e13_as_of_argument", with_sql(f"""
SELECT client_id, CAST({TODAY} - contract_start_date AS INTEGER) AS at_as_of,
  CAST(DATE '2001-12-31' - contract_start_date AS INTEGER) AS at_year_end FROM x_clients"""))
def _(i):
    return i.clients.select("client_id", fn.days_between(F.lit(AS_OF), "contract_start_date").alias("at_as_of"),
                            fn.days_between(F.lit(date(2001, 12, 31)), "contract_start_date").alias("at_year_end"))


@check("e14_text", """
SELECT c_custkey, lower(c_name) AS slug, split_part(c_name, '#', 2) AS part, left(c_name, 5) AS prefix,
  CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment WHEN c_custkey % 3 = 1 THEN c_name ELSE c_name || ' ' || c_mktsegment END
    AS full_name FROM customer""")
def _(i):
    k = F.col("c_custkey")
    padded = F.concat(F.lit(" \t"), "c_name", F.lit("\n "))
    return i.table("customer", "c_custkey", "c_name", "c_mktsegment").select(
        k, fn.slug(padded).alias("slug"), fn.text_part("c_name", "#", 2).alias("part"),
        F.substring("c_name", 1, 5).alias("prefix"),
        fn.person_name(F.when(k % 3 != 0, F.col("c_name")), F.when(k % 3 != 1, F.col("c_mktsegment"))).alias("full_name"))


@check("e15_search_ignoring_case", """
SELECT p_partkey, regexp_matches(p_name, '^PART.*[13]$', 'i') AS by_pattern, contains(lower(p_type), 'st') AS by_text,
  p_partkey % 7 <> 0 AS anything
FROM part""")
def _(i):
    name = F.when(F.col("p_partkey") % 7 != 0, F.col("p_name"))
    return i.table("part", "p_partkey", "p_name", "p_type").select(
        "p_partkey", fn.matches_ci("p_name", "^PART.*[13]$").alias("by_pattern"),
        fn.matches_ci("p_type", "ST", literal=True).alias("by_text"), fn.matches_ci(name, ".*").alias("anything"))


@check("e16_item_count", with_sql(
    "SELECT id, CAST(ifnull(len(active_integrations), 0) AS INTEGER) AS integrations FROM x_activity"))
def _(i):
    now = i.activity_summary.where(F.col("created_at") == F.lit(AS_OF).cast("timestamp_ntz"))
    return now.select("id", fn.item_count("active_integrations").alias("integrations"))


@check("e17_struct_and_first_item", with_sql("""
SELECT c.id, c.name, a.active_integrations[1] AS first_tool FROM x_crm c JOIN x_activity a ON a.id = c.k"""))
def _(i):
    tools = i.activity_summary.where(F.col("created_at") == F.lit(AS_OF).cast("timestamp_ntz")).select(
        F.concat(F.lit("HS-"), F.col("id").cast("string")).alias("id"),
        fn.first_item("active_integrations").alias("first_tool"))
    return i.crm_companies.select("id", F.col("properties.name").alias("name")).join(tools, "id")


@check("e18_abs", with_sql("SELECT deal_id, abs(mrr_delta) AS size FROM x_deals"))
def _(i):
    return i.deals.select("deal_id", F.abs("mrr_delta").alias("size"))


@check("e19_lookup", with_sql("""
SELECT client_id, CASE health_status WHEN 'green' THEN 'Campeao' WHEN 'yellow' THEN 'Alerta' WHEN 'red' THEN 'Em Risco'
  WHEN 'inactive' THEN 'Inativo' END AS status_label FROM x_scores_wh"""))
def _(i):
    from clientpulse.operators.rules import STATUS_LABELS
    return i.warehouse_scores.select("client_id", fn.lookup("health_status", STATUS_LABELS).alias("status_label"))


@check("e20_display_text", """
SELECT c_custkey, 'R$ ' || format('{:,.2f}', greatest(c_acctbal, 0)) AS money, format('{:.0f}', c_custkey % 101::DOUBLE) || '%'
  AS share FROM customer""")
def _(i):
    return i.table("customer", "c_custkey", "c_acctbal").select(
        "c_custkey", fn.money_text(F.greatest("c_acctbal", F.lit(0.0))).alias("money"),
        fn.percent_text((F.col("c_custkey") % 101).cast("double")).alias("share"))
