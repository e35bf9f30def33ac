"""Sources, sinks and table maintenance. Files go to fresh paths under the shared folder."""

from datetime import date

from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.inputs import AS_OF, CURRENT, PREVIOUS
from pulsechecks.sqlbase import CUR, PREV, TODAY, with_sql
from clientpulse.operators import alerts, dimensions, reporting, rules
from clientpulse.session import scratch_path
from clientpulse.sources import readers, schemas, writers


@check("s1_scan_projection", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def _(i):
    return readers.scan(i.spark, f"{i.dir}/orders.parquet", ["o_orderkey", "o_custkey", "o_totalprice"])


@check("s2_filtered_scan", with_sql(f"SELECT * FROM x_messages WHERE year_month IN ({CUR}, {PREV})"))
def _(i):
    path = scratch_path(i.spark, "messages")
    writers.overwrite_table(i.messages, path, ["year_month"])
    months = F.col("year_month").isin(CURRENT, PREVIOUS)
    return readers.scan(i.spark, path, ["client_id", "year_month", "messages_sent", "plan_limit"], months)


@check("s2_filtered_scan_period", with_sql(
    "SELECT client_id, calculated_at, period_days, total_score FROM x_window_history WHERE period_days = 60"))
def _(i):
    path = scratch_path(i.spark, "window-history")
    writers.overwrite_table(i.window_history, path, ["calculated_at"])
    return readers.scan(i.spark, path, ["client_id", "calculated_at", "period_days", "total_score"],
                        F.col("period_days") == 60)


PART_ROWS = 500
EXPORT_TYPES = {"client_id": "bigint", "company_name": "string", "mrr": "double", "contract_start_date": "date",
                "days_to_renewal": "bigint", "not_there": "string"}


def write_export(df, path: str, columns: list[str], part_rows: int = PART_ROWS) -> None:
    """Export parts of at most ``part_rows`` rows, one JSON line each, all values text."""
    cells = F.array(*[F.col(c).cast("string") if c in df.columns else F.lit("x") for c in columns])
    parts = df.groupBy(F.floor(F.col("client_id") / part_rows).alias("part")).agg(F.collect_list(cells).alias("data"))
    line = F.to_json(F.struct(F.array(*[F.lit(c) for c in columns]).alias("columns"), "data"),
                     {"ignoreNullFields": "false"})
    parts.select(line.alias("value")).write.text(path)


EXPORT_SQL = """
SELECT client_id, company_name, CASE WHEN client_id % 7 <> 0 THEN mrr END AS mrr, contract_start_date,
  CAST(days_to_renewal AS BIGINT) AS days_to_renewal, CAST(NULL AS VARCHAR) AS not_there FROM x_clients"""


def messy_clients(i):
    money = F.when(F.col("client_id") % 7 == 0, "n/a").otherwise(F.col("mrr").cast("string"))
    return i.clients.withColumn("mrr", money)


@check("s3_export_reader", with_sql(EXPORT_SQL))
def _(i):
    path = scratch_path(i.spark, "export")
    write_export(messy_clients(i), path, ["client_id", "company_name", "mrr", "_pad", "contract_start_date",
                                          "days_to_renewal", "_p1"])
    return readers.read_export(i.spark, path, EXPORT_TYPES)


@check("s3_export_reader_ranges", with_sql(EXPORT_SQL))
def _(i):
    """The whole table as one part, read by ranges of 64 kB."""
    path = scratch_path(i.spark, "export-one")
    columns = ["client_id", "company_name", "mrr", "_pad", "contract_start_date", "days_to_renewal", "_p1"]
    write_export(messy_clients(i), path, columns, part_rows=1 << 40)
    return readers.read_large_export(i.spark, path, EXPORT_TYPES, range_bytes=1 << 16)


@check("s4_export_union", with_sql(EXPORT_SQL))
def _(i):
    rows = messy_clients(i)
    first, second = scratch_path(i.spark, "export-p1"), scratch_path(i.spark, "export-p2")
    write_export(rows.where(F.col("client_id") % 2 == 0), first,
                 ["client_id", "company_name", "mrr", "contract_start_date", "days_to_renewal"])
    write_export(rows.where(F.col("client_id") % 2 == 1), second,
                 ["days_to_renewal", "contract_start_date", "_p2", "mrr", "client_id", "company_name"])
    return readers.union_parts([readers.read_export(i.spark, p, EXPORT_TYPES) for p in (first, second)])


PAGE_ROWS = 100


@check("s5_crm_pages", with_sql("""
SELECT id, name, mrr_text AS mrr_fixo, CASE WHEN k % 3 = 0 THEN 'HS-' || (k + 1) END AS company_id FROM x_crm"""))
def _(i):
    path = scratch_path(i.spark, "pages")
    k = F.substring("id", 4, 20).cast("bigint")
    link = F.struct(F.concat(F.lit("HS-"), (k + 1).cast("string")).alias("id"), F.lit("deal_to_company").alias("type"))
    linked = F.struct(F.struct(F.array(link).alias("results")).alias("companies"))
    obj = F.struct("id", F.struct(F.col("properties.name").alias("name"), F.col("properties.mrr_fixo").alias("mrr_fixo")
                                  ).alias("properties"), F.when(k % 3 == 0, linked).alias("associations"))
    pages = i.crm_companies.groupBy(F.floor(k / PAGE_ROWS).alias("page")).agg(F.collect_list(obj).alias("results"))
    after = F.struct(F.struct(((F.col("page") + 1) * PAGE_ROWS).cast("string").alias("after")).alias("next"))
    pages.select(F.to_json(F.struct("results", after.alias("paging"))).alias("value")).write.text(path)
    rows = readers.read_crm_pages(i.spark, path, ["name", "mrr_fixo"])
    return rows.select("id", "properties.name", "properties.mrr_fixo", "company_id")


@check("s6_full_overwrite", with_sql("SELECT client_id, company_name FROM x_clients WHERE has_cs"))
def _(i):
    path = scratch_path(i.spark, "dim")
    rows = i.clients.select("client_id", "company_name", "has_cs")
    writers.overwrite_table(rows, path)
    writers.overwrite_table(rows.where("has_cs").drop("has_cs"), path)
    return writers.read_table(i.spark, path)


SLIM = ("client_id", "calculated_at", "period_days", "total_score", "health_status")


@check("s7_replace_snapshot", with_sql("""
SELECT client_id, calculated_at, 30 AS period_days, CASE WHEN calculated_at = DATE '2001-06-30' THEN total_score + 100
  ELSE total_score END AS total_score, health_status FROM x_backfill
WHERE calculated_at <> DATE '2001-06-30' OR client_id % 2 = 0"""))
def _(i):
    path = scratch_path(i.spark, "history")
    rows = i.backfill.select(*SLIM)
    writers.replace_snapshot(rows, path)
    again = rows.where((F.col("calculated_at") == F.lit(date(2001, 6, 30))) & (F.col("client_id") % 2 == 0))
    writers.replace_snapshot(again.withColumn("total_score", F.col("total_score") + 100), path)
    return writers.read_table(i.spark, path).select(*SLIM)


KEY = ["client_id", "calculated_at", "period_days"]


@check("s8_insert_or_ignore", with_sql("""
SELECT client_id, calculated_at, 30 AS period_days, total_score, health_status FROM x_backfill WHERE client_id % 3 = 0
UNION ALL SELECT client_id, calculated_at, 30, total_score + 1, health_status FROM x_backfill WHERE client_id % 3 <> 0"""))
def _(i):
    rows = i.backfill.select(*SLIM)
    new = rows.withColumn("total_score", F.col("total_score") + 1)
    twice = new.unionByName(rows.withColumn("total_score", F.col("total_score") + 2))
    return writers.insert_or_ignore(rows.where(F.col("client_id") % 3 == 0), twice, KEY, [F.col("total_score").asc()])


@check("s9_upsert", with_sql("""
SELECT client_id, calculated_at, 30 AS period_days, total_score, 'kept' AS health_status FROM x_backfill
  WHERE client_id % 3 = 0 AND client_id % 2 = 1
UNION ALL SELECT client_id, calculated_at, 30, total_score, 'new' FROM x_backfill WHERE client_id % 2 = 0"""))
def _(i):
    rows = i.backfill.select(*SLIM)
    return writers.upsert(rows.where(F.col("client_id") % 3 == 0).withColumn("health_status", F.lit("kept")),
                          rows.where(F.col("client_id") % 2 == 0).withColumn("health_status", F.lit("new")), KEY)


@check("s10_append_unseen_alerts", with_sql(f"""
SELECT client_id, alert_id, {TODAY} AS alert_date, alert_id LIKE 'renewal%' AS resolved FROM x_script_alerts"""))
def _(i):
    fired = alerts.evaluate_alerts(i.alert_base, rules.SCRIPT_ALERTS, AS_OF).select(*alerts.ALERT_KEY, "resolved")
    seen = fired.where(F.col("alert_id").startswith("renewal")).withColumn("resolved", F.lit(True))
    return writers.append_unseen(seen, fired, alerts.ALERT_KEY)


@check("s11_owner_names", with_sql("""
SELECT c.k AS client_id, ifnull(p.owner_name, c.crm_id) AS csm_owner FROM x_crm c
LEFT JOIN x_people p ON p.owner_id = c.crm_id"""))
def _(i):
    rows = i.crm_companies.select(F.substring("id", 4, 20).cast("bigint").alias("client_id"),
                                  F.col("properties.hubspot_owner_id").alias("csm_owner"))
    return writers.resolve_owner_names(rows, dimensions.owner_directory(i.owners))


@check("s12_absent_source", with_sql("""
SELECT client_id, CAST(NULL AS INTEGER) AS nps_score, CAST(NULL AS DATE) AS response_date FROM x_clients"""))
def _(i):
    absent = readers.scan_or_empty(i.spark, None, schemas.NPS)
    return i.clients.join(absent.select("hubspot_company_id", "nps_score", "response_date"), "hubspot_company_id",
                          "left").select("client_id", "nps_score", "response_date")


@check("s13_active_propagation", with_sql("""
SELECT client_id, alert_id FROM x_wh_alerts WHERE client_id % 9 <> 0"""))
def _(i):
    from pulsechecks.dimensions import warehouse_dim
    active = dimensions.active_clients(warehouse_dim(i))
    return writers.keep_active(i.warehouse_alerts, active).select("client_id", "alert_id")
