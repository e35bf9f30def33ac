"""Client dimension, owners and CRM normalisers."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF, CRM_AS_OF
from pulsechecks.sqlbase import TODAY, define, with_sql
from clientpulse.operators import dimensions


@check("d1_dim_clients_local", with_sql(f"""
SELECT client_id, hubspot_company_id, company_name, segment_ipc, csm_owner, has_cs, contract_start_date,
  CASE WHEN client_id % 10 <> 9 THEN contract_end_date END AS contract_end_date, mrr, plan_type, cashback_enabled,
  onboarding_completed, days_as_client, CASE WHEN client_id % 10 <> 9 THEN days_to_renewal END AS days_to_renewal
FROM x_clients WHERE client_id % 31 <> 0 AND client_id % 29 <> 0"""))
def _(i):
    return dimensions.client_dimension(i.companies, i.client_config, AS_OF)


NAMED = """
SELECT c.k AS client_id, coalesce(a.owner_name, b.owner_name, o.owner_name) AS csm_owner,
  coalesce(c.cs_id, c.cx_id, c.crm_id) AS csm_owner_id FROM x_crm c LEFT JOIN x_people a ON a.owner_id = c.cs_id
LEFT JOIN x_people b ON b.owner_id = c.cx_id LEFT JOIN x_people o ON o.owner_id = c.crm_id"""
define("x_named", NAMED)
define("x_dim_wh", """
SELECT c.k AS client_id, c.name AS company_name, c.app AS gupshup_app_name, c.id AS hubspot_company_id,
  TRY_CAST(c.mrr_text AS DOUBLE) AS mrr, n.csm_owner, n.csm_owner_id, 'customer' AS lifecyclestage,
  lower(k.c_mktsegment) AS business_sector, c.k % 8 <> 0 AS is_active, c.k % 3 <> 0 AS has_customer_service,
  CASE WHEN c.k % 2 = 0 THEN 'true' ELSE 'false' END AS consultoria_estrategica, 'neutral' AS csm_sentiment,
  CASE WHEN c.k % 15 <> 0 THEN CAST(c.k * 10 AS DOUBLE) END AS faturamento_mensal_estimado,
  make_timestamp(2022, 1 + c.k % 12, 1, 10, 30, 0) AS hs_createdate,
  c.start_day + INTERVAL 3 HOUR AS contract_start_date, c.churn_date, c.churn_value AS valor_do_churn,
  make_timestamp(2023, 1 + c.k % 12, 2, 0, 0, 0) AS onboarding_start_date,
  CASE WHEN c.k % 6 <> 0 THEN make_timestamp(2023, 1 + c.k % 12, 28, 23, 30, 0) END AS onboarding_end_date,
  CASE WHEN c.k % 5 <> 0 THEN TIMESTAMP '2025-01-31 12:00:00' END AS data_ultima_reuniao_cs,
  CASE WHEN c.k % 9 = 0 THEN 'preco' END AS motivo_de_churn, CAST(NULL AS VARCHAR) AS razao_do_churn,
  CAST(CAST(c.start_day + INTERVAL 1 YEAR AS DATE) - DATE '2025-03-10' AS INTEGER) AS days_to_renewal
FROM x_crm c JOIN customer k ON k.c_custkey = c.k JOIN x_named n ON n.client_id = c.k""")


def warehouse_dim(i) -> DataFrame:
    return dimensions.warehouse_client_dimension(i.app_companies, i.activity_summary, i.crm_companies, i.owners,
                                                 CRM_AS_OF)


@check("d2_dim_clients_warehouse", with_sql("SELECT * FROM x_dim_wh"))
def _(i):
    return warehouse_dim(i)


@check("d3_latest_row_dedup", with_sql("""
SELECT id, arg_max(created_at, created_at) AS created_at, arg_max(has_customer_service, created_at) AS has_customer_service,
  arg_max(total_active_flows, created_at) AS total_active_flows FROM x_activity_all GROUP BY id"""))
def _(i):
    return dimensions.latest_activity(i.activity_summary).select("id", "created_at", "has_customer_service",
                                                                 "total_active_flows")


@check("d4_owner_name", with_sql(
    "SELECT id AS owner_id, nullif(concat_ws(' ', firstname, lastname), '') AS owner_name, email AS owner_email FROM x_owners"))
def _(i):
    return dimensions.owner_directory(i.owners)


@check("d5_owner_fallback", with_sql("SELECT * FROM x_named"))
def _(i):
    p = "properties."
    ids = i.crm_companies.select(
        F.substring("id", 4, 20).cast("bigint").alias("client_id"), F.col(p + "cs_responsavel").alias("cs"),
        F.col(p + "cx_responsavel").alias("cx"), F.col(p + "hubspot_owner_id").alias("crm"))
    named = dimensions.with_owner(ids, dimensions.owner_directory(i.owners), ["cs", "cx", "crm"])
    return named.select("client_id", "csm_owner", "csm_owner_id")


@check("d6_dashboard_clients", with_sql("""
SELECT d.client_id, d.hubspot_company_id, d.company_name, CAST(NULL AS VARCHAR) AS segment_ipc, d.csm_owner,
  d.has_customer_service AS has_cs, CAST(d.contract_start_date AS DATE) AS contract_start_date,
  CAST(CAST(d.contract_start_date AS DATE) + INTERVAL 1 YEAR AS DATE) AS contract_end_date, ifnull(d.mrr, 0) AS mrr,
  CAST(NULL AS VARCHAR) AS plan_type, d.client_id % 5 = 0 AS cashback_enabled,
  d.onboarding_end_date IS NOT NULL AS onboarding_completed,
  CAST(DATE '2025-03-10' - CAST(d.contract_start_date AS DATE) AS INTEGER) AS days_as_client,
  CAST(d.days_to_renewal AS BIGINT) AS days_to_renewal
FROM x_dim_wh d WHERE d.churn_date IS NULL"""))
def _(i):
    active = dimensions.active_clients(warehouse_dim(i))
    # Exports write whole numbers with a decimal point.
    text = active.withColumn("days_to_renewal", F.col("days_to_renewal").cast("double").cast("string"))
    return dimensions.dashboard_clients(text, i.upsell_flags, CRM_AS_OF)


# --- landed CRM objects built from the tables: id, property struct of text, first company ---


def company_objects(i) -> DataFrame:
    k = F.col("c_custkey")
    day = F.date_sub(F.lit(AS_OF), (180 + (k * 37) % 361).cast("int"))
    millis = (F.unix_date(day).cast("bigint") * 86_400_000 + 3_600_000).cast("string")
    props = F.struct(
        F.col("c_name").alias("name"), F.when(k % 4 == 0, "").when(k % 4 != 1, F.lit("vip")).alias("segment_ipc"),
        F.col("c_mktsegment").alias("industry"), F.when(k % 13 != 0, (k % 25).cast("string")).alias("hubspot_owner_id"),
        F.when(k % 3 == 0, "true").when(k % 3 == 1, "1").otherwise("no").alias("has_cs"),
        F.when(k % 2 == 0, millis).alias("contract_start_date"),
        F.concat(day.cast("string"), F.lit("T03:00:00Z")).alias("hs_date_entered_customer"),
        F.lit(None).cast("string").alias("contract_end_date"),
        F.when(k % 7 == 0, "soon").otherwise(F.concat(F.date_add(day, 365).cast("string"), F.lit("T00:00:00Z"))).alias(
            "closedate"),
        F.when(k % 5 == 0, "").when(k % 5 == 1, "abc").when(k % 5 == 2, k.cast("string")).alias("mrr"),
        F.concat(k.cast("string"), F.lit(".5")).alias("annualrevenue"),
        F.when(k % 6 == 0, F.concat(F.lit("C"), k.cast("string"))).alias("client_id"))
    return i.table("customer", "c_custkey", "c_name", "c_mktsegment").select(
        F.concat(F.lit("HS-"), k.cast("string")).alias("id"), props.alias("properties"),
        F.lit(None).cast("string").alias("company_id"))


@check("d7_crm_companies", f"""
SELECT 'HS-' || c_custkey AS hubspot_company_id, c_name AS company_name,
  CASE WHEN c_custkey % 4 < 2 THEN c_mktsegment ELSE 'vip' END AS segment_ipc,
  CASE WHEN c_custkey % 13 <> 0 THEN CAST(c_custkey % 25 AS VARCHAR) ELSE '' END AS csm_owner,
  c_custkey % 3 < 2 AS has_cs, {TODAY} - CAST(180 + (c_custkey * 37) % 361 AS INTEGER) AS contract_start_date,
  CASE WHEN c_custkey % 7 <> 0 THEN {TODAY} - CAST(180 + (c_custkey * 37) % 361 AS INTEGER) + 365 END AS contract_end_date,
  CASE c_custkey % 5 WHEN 1 THEN 0 WHEN 2 THEN c_custkey ELSE c_custkey + 0.5 END::DOUBLE AS mrr,
  CASE WHEN c_custkey % 6 = 0 THEN 'C' || c_custkey ELSE 'HS-' || c_custkey END AS client_id FROM customer""")
def _(i):
    return dimensions.normalise_companies(company_objects(i))


def deal_objects(i) -> DataFrame:
    o = F.col("o_orderkey")
    text = F.col("o_totalprice").cast("decimal(14,2)").cast("string")
    props = F.struct(
        text.alias("amount"), F.when(o % 3 == 0, (o % 100).cast("string")).alias("mrr_before"),
        F.when(o % 4 == 0, ((o % 50) * 2).cast("string")).when(o % 4 == 1, "").alias("mrr_after"),
        F.when(o % 5 == 0, "upsell").when(o % 5 == 1, "").alias("deal_type_cs"),
        F.when(o % 2 == 0, "existingbusiness").alias("dealtype"),
        F.concat(F.col("o_orderdate").cast("date").cast("string"), F.lit("T12:00:00Z")).alias("closedate"),
        F.col("o_orderstatus").alias("dealstage"))
    return i.table("orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate", "o_orderstatus").select(
        o.cast("string").alias("id"), props.alias("properties"),
        F.when(o % 9 != 0, F.concat(F.lit("HS-"), F.col("o_custkey").cast("string"))).alias("company_id"))


@check("d8_crm_deals", """
SELECT CAST(o_orderkey AS VARCHAR) AS deal_id, CASE WHEN o_orderkey % 9 <> 0 THEN 'HS-' || o_custkey END AS hubspot_company_id,
  CASE WHEN o_orderkey % 5 = 0 THEN 'upsell' WHEN o_orderkey % 2 = 0 THEN 'existingbusiness' ELSE 'new' END AS deal_type,
  b AS mrr_before, a AS mrr_after, a - b AS mrr_delta, CAST(o_orderdate AS DATE) AS closed_date, o_orderstatus AS deal_stage
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 100 ELSE 0 END::DOUBLE AS b,
  CASE o_orderkey % 4 WHEN 0 THEN (o_orderkey % 50) * 2 WHEN 1 THEN 0::DOUBLE ELSE o_totalprice END::DOUBLE AS a FROM orders)""")
def _(i):
    return dimensions.normalise_deals(deal_objects(i))


def call_objects(i) -> DataFrame:
    e = F.col("event_id")
    props = F.struct(
        F.when(e % 23 == 0, "x").when(e % 7 == 0, "45.9").otherwise((e % 500).cast("string")).alias("hs_call_duration"),
        F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("hs_timestamp"),
        F.when(e % 11 != 0, (F.col("user_id") % 25).cast("string")).alias("hubspot_owner_id"),
        F.when(e % 3 == 0, "urgencia").alias("call_type"),
        F.when(e % 4 != 0, F.repeat(F.col("event_type"), 100)).alias("hs_call_body"))
    return i.table("events", "event_id", "ts", "user_id", "event_type").select(
        e.cast("string").alias("id"), props.alias("properties"),
        F.concat(F.lit("HS-"), F.col("user_id").cast("string")).alias("company_id"))


CALLS_SQL = """
SELECT CAST(event_id AS VARCHAR) AS call_id, 'HS-' || user_id AS hubspot_company_id,
  CASE WHEN event_id % 11 <> 0 THEN CAST(user_id % 25 AS VARCHAR) ELSE '' END AS csm_owner, CAST(ts AS DATE) AS call_date,
  CASE WHEN event_id % 23 = 0 THEN 0 WHEN event_id % 7 = 0 THEN 45 WHEN event_id % 500 > 60 THEN event_id % 500 // 60
    ELSE event_id % 500 END::BIGINT AS duration_minutes,
  CASE WHEN event_id % 3 = 0 THEN 'urgencia' ELSE 'follow_up' END AS call_type,
  CASE WHEN event_id % 4 <> 0 THEN {notes} ELSE '' END AS notes FROM events"""


@check("d9_crm_calls", CALLS_SQL.format(notes="repeat(event_type, 100)"))
def _(i):
    return dimensions.normalise_calls(call_objects(i))


@check("d9_crm_calls_500", CALLS_SQL.format(notes="left(repeat(event_type, 100), 500)"))
def _(i):
    return dimensions.normalise_calls(call_objects(i), notes_chars=500)


def answer_objects(i, score: str, when: str) -> DataFrame:
    e = F.col("event_id")
    value = F.when(e % 13 == 0, "").when(e % 17 == 0, "n/a").otherwise(((e * 7) % 11).cast("string"))
    millis = (F.unix_date(F.col("ts").cast("date")).cast("bigint") * 86_400_000).cast("string")
    props = F.struct(
        value.alias(score), millis.alias(when), F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("email"),
        F.concat(F.lit("HS-"), F.col("user_id").cast("string")).alias("associatedcompanyid"))
    return i.table("events", "event_id", "ts", "user_id", "event_type").where(F.col("event_type") == "signup").select(
        e.cast("string").alias("id"), props.alias("properties"), F.lit(None).cast("string").alias("company_id"))


ANSWERS = """
SELECT {rid} AS response_id, {company} AS hubspot_company_id, {mail} AS contact_email, s AS nps_score,
  CAST(ts AS DATE) AS response_date,
  CASE WHEN s > 8 THEN 'promoter' WHEN s > 6 THEN 'passive' ELSE 'detractor' END AS nps_category
FROM (SELECT *, CAST((event_id * 7) % 11 AS INTEGER) AS s FROM events WHERE event_type = 'signup')
WHERE event_id % 13 <> 0 AND event_id % 17 <> 0 {more}"""


@check("d10_nps_from_feedback", ANSWERS.format(rid="CAST(event_id AS VARCHAR)", company="CAST(NULL AS VARCHAR)",
                                               mail="''", more=""))
def _(i):
    return dimensions.normalise_nps(answer_objects(i, "hs_rating", "hs_submission_timestamp"),
                                    answer_objects(i, "nps_score", "nps_date"))


@check("d10_nps_from_contacts", ANSWERS.format(rid="'nps-' || event_id", company="'HS-' || user_id",
                                               mail="'u' || user_id", more="AND s > 0"))
def _(i):
    nobody = answer_objects(i, "hs_rating", "hs_submission_timestamp").where(F.col("id") == "none")
    return dimensions.normalise_nps(nobody, answer_objects(i, "nps_score", "nps_date"), drop_zero=True)
