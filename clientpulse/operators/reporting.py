"""Queries behind the report pages."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.functions import band, latest_rows, matches_ci, month_start, percent
from clientpulse.operators.alerts import latest_snapshot, of_period, severity_rank

STATUSES = ("green", "yellow", "red", "inactive")

# Criteria shown in the breakdown, five points each.
CRITERIA = {
    "score_recency": "Recencia de Campanha",
    "score_automations": "Automacoes Ativas",
    "score_integrations": "Integracoes Conectadas",
    "score_chat": "Uso do Atendimento",
    "score_volume": "Volume de Mensagens",
    "score_coverage": "Cobertura da Base",
}
CRITERION_MAX = 5

# Orders of the lists, for ``writers.write_ordered``; the operators sort by them only if they are asked to.
HISTORY_ORDER = ("client_id", "calculated_at")
DETRACTOR_ORDER = ("nps_score", "response_id")


def centre_order() -> list[Column]:
    return [F.col("severity_order"), F.col("alert_date").desc(), F.col("client_id"), F.col("alert_id")]



# Types whose values a hash aggregate can keep in place.
FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType)


def in_range(scores: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    out = scores
    if start is not None:
        out = out.where(F.col("calculated_at") >= F.lit(start))
    if end is not None:
        out = out.where(F.col("calculated_at") <= F.lit(end))
    return out


def last_known_values(scores: DataFrame, key: str = "client_id", order: str = "calculated_at") -> DataFrame:
    """Per client the newest non-NULL value of every column on its own, whatever its type.

    One hash aggregate finds the newest values of fixed width and, for every other column, the newest day on which it
    is known. The values of those columns are then fetched by client and day; of several on one day the first in their
    order counts.
    """
    kinds = {f.name: f.dataType for f in scores.schema.fields if f.name != key}
    fetched = [c for c, kind in kinds.items() if not isinstance(kind, FIXED_WIDTH)]

    def known(column: str) -> Column:
        return F.when(F.col(column).isNotNull(), F.col(order))

    newest = scores.groupBy(key).agg(*[
        F.max(known(c)).alias(c) if c in fetched else F.max_by(c, known(c)).alias(c) for c in kinds])
    for column in fetched:
        rows = scores.where(F.col(column).isNotNull() & F.col(order).isNotNull()).select(
            F.col(key).alias("_key"), F.col(order).alias("_at"), F.col(column).alias("_value"))
        on_day = rows.join(newest.select(F.col(key).alias("_of"), F.col(column).alias("_day")),
                           F.col("_key").eqNullSafe(F.col("_of")) & (F.col("_at") == F.col("_day")))
        # Maps have no order; any of several on one day counts.
        first = F.lit(0) if kinds[column].typeName() in ("map", "variant") else F.col("_value")
        values = latest_rows(on_day, ["_key"], [first]).select("_key", "_value")
        newest = (newest.join(values, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key")
                  .withColumn(column, F.col("_value")).drop("_value"))
    return newest.select(key, *kinds)


def client_360(clients: DataFrame, scores: DataFrame, start: date | None = None, end: date | None = None,
               skip_nulls: bool = False, period_days: int | None = 30) -> DataFrame:
    """Every client beside its newest score row in the range, of one analysis window.

    ``skip_nulls`` takes the newest known value column by column instead of the newest row.
    """
    rows = in_range(scores, start, end)
    if "period_days" in rows.columns:
        rows = of_period(rows, period_days)
    shared = [c for c in rows.columns if c in clients.columns and c != "client_id"]
    rows = rows.drop(*shared)
    newest = last_known_values(rows) if skip_nulls else latest_snapshot(rows, None)
    return clients.join(newest, "client_id", "left")


def status_kpis(client_health: DataFrame) -> DataFrame:
    """Count and share of each status over all clients."""
    counts = client_health.agg(F.count("*").alias("total"),
                               *[F.count_if(F.col("health_status") == s).alias(s) for s in STATUSES])
    rows = F.array(*[F.struct(F.lit(s).alias("health_status"), F.col(s).alias("clients")) for s in STATUSES])
    return counts.select("total", F.inline(rows)).withColumn("pct", percent("clients", "total", 2, 0.0))


def mean_score(client_health: DataFrame) -> DataFrame:
    return client_health.agg(F.round(F.avg("total_score"), 4).alias("avg_score"))


def monthly_mean_score(scores: DataFrame, months: int = 7) -> DataFrame:
    """Mean over all rows of a calendar month, newest months, oldest first."""
    monthly = scores.groupBy(month_start("calculated_at").alias("month")).agg(
        F.round(F.avg("total_score"), 4).alias("avg_score"))
    return monthly.orderBy(F.col("month").desc()).limit(months).orderBy("month")


def status_by_month(scores: DataFrame, months: int = 7) -> DataFrame:
    """Rows per month and status over the newest months present."""
    counted = scores.groupBy(month_start("calculated_at").alias("month"), "health_status").agg(
        F.count("*").alias("clients"))
    # A few rows per month are left, so one ordered window is bounded by the calendar.
    recent = F.dense_rank().over(Window.orderBy(F.col("month").desc()))
    return counted.withColumn("_n", recent).where(F.col("_n") <= months).drop("_n").orderBy("month", "health_status")


def top_clients(client_health: DataFrame, status: str = "red", n: int = 10) -> DataFrame:
    """Worst first for red, best first for any other status."""
    score = F.col("total_score").asc() if status == "red" else F.col("total_score").desc()
    return client_health.where(F.col("health_status") == status).orderBy(score, "client_id").limit(n).select(
        "client_id", "company_name", "segment_ipc", "total_score", "days_since_last_campaign", "campaign_roi",
        "days_to_renewal")


def portfolio(client_health: DataFrame, csm: str | None = None, status: str | None = None,
              search: str | None = None, literal: bool = False) -> DataFrame:
    """Clients of one owner and status whose name matches."""
    out = client_health
    if csm is not None:
        out = out.where(F.col("csm_owner") == csm)
    if status is not None:
        out = out.where(F.col("health_status") == status)
    if search:
        out = out.where(matches_ci("company_name", search, literal))
    return out


def criterion_breakdown(client_health: DataFrame) -> DataFrame:
    """One row per client and criterion: points, share of the maximum and its band."""
    rows = F.array(*[F.struct(F.lit(label).alias("criterion"), F.coalesce(F.col(c), F.lit(0)).alias("points"))
                     for c, label in CRITERIA.items()])
    share = F.col("points") / F.lit(float(CRITERION_MAX))
    return client_health.select("client_id", F.inline(rows)).withColumns({
        "max_points": F.lit(CRITERION_MAX), "fraction": share,
        "band": band(share, [(0.8, "green"), (0.5, "yellow")], "red")})


def renewal_band(days: Column) -> Column:
    """Unknown days count as 0."""
    known = F.coalesce(days, F.lit(0))
    return F.when(known <= 30, "red").when(known <= 90, "yellow").otherwise("green")


def score_history(scores: DataFrame, ordered: bool = True) -> DataFrame:
    """Score series of the clients that have more than one point.

    Clients are counted by a combined aggregate and the rows filtered by a semi join, so no task holds all
    rows of one client.
    """
    several = scores.groupBy("client_id").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    rows = scores.join(several, "client_id", "left_semi").select("client_id", "calculated_at", "total_score", "health_status")
    return rows.orderBy(*HISTORY_ORDER) if ordered else rows


def active_alerts(alerts: DataFrame) -> DataFrame:
    return alerts.where(~F.coalesce("resolved", F.lit(False)))


def client_alerts(alerts: DataFrame) -> DataFrame:
    """Unresolved alerts, each with the number of its client's unresolved alerts."""
    unresolved = active_alerts(alerts).where(F.col("client_id").isNotNull())
    counted = unresolved.withColumn("active_alerts", F.count("*").over(Window.partitionBy("client_id")))
    return counted.select(
        "client_id", "active_alerts", "alert_id", "alert_name", "severity", "action_suggested", "alert_date")


def alert_centre(alerts: DataFrame, clients: DataFrame, csm: str | None = None,
                 severity: str | None = None, ordered: bool = True) -> DataFrame:
    """Unresolved alerts with client name and owner, most severe and newest first."""
    rows = active_alerts(alerts).drop("company_name", "csm_owner").join(
        clients.select("client_id", "company_name", "csm_owner"), "client_id", "left")
    if csm is not None:
        rows = rows.where(F.col("csm_owner") == csm)
    if severity is not None:
        rows = rows.where(F.col("severity") == severity)
    ranked = rows.withColumn("severity_order", severity_rank())
    return ranked.orderBy(*centre_order()) if ordered else ranked


def severity_counts(alerts: DataFrame) -> DataFrame:
    return alerts.agg(F.count("*").alias("total"),
                      *[F.count_if(F.col("severity") == s).alias(s) for s in ("critical", "warning", "info")])


def nps_with_clients(nps: DataFrame, clients: DataFrame) -> DataFrame:
    """Answers with the columns of their company; one client per company id."""
    company = latest_rows(
        clients.where(F.col("hubspot_company_id").isNotNull()).select(
            "hubspot_company_id", "client_id", "company_name", "segment_ipc", "csm_owner"),
        ["hubspot_company_id"], [F.col("client_id").asc()])
    return nps.join(company.drop("client_id"), "hubspot_company_id", "left")


def nps_score(nps: DataFrame) -> DataFrame:
    """Promoters minus detractors in percent of all answers, 0 without answers."""
    counts = nps.agg(F.count("*").alias("responses"), *[
        F.count_if(F.col("nps_category") == c).alias(f"{c}s") for c in ("promoter", "passive", "detractor")])
    score = percent(F.col("promoters") - F.col("detractors"), "responses", 2, 0.0)
    return counts.withColumn("nps", score).withColumn(
        "band", band("nps", [(50, "green"), (0, "yellow")], "red"))


def nps_by_segment(nps: DataFrame, clients: DataFrame) -> DataFrame:
    """Answers per segment and category.

    Answers are counted per company first, so only those counts meet the client table.
    """
    counted = nps.groupBy("hubspot_company_id", "nps_category").agg(F.count("*").alias("answers"))
    return nps_with_clients(counted, clients).where(F.col("segment_ipc").isNotNull()).groupBy(
        "segment_ipc", "nps_category").agg(F.sum("answers").alias("answers"))


def detractors(nps: DataFrame, clients: DataFrame, ordered: bool = True) -> DataFrame:
    """Detractor answers, lowest score first."""
    rows = nps_with_clients(nps.where(F.col("nps_category") == "detractor"), clients).select(
        "response_id", "company_name", "segment_ipc", "nps_score", "response_date", "csm_owner")
    return rows.orderBy(*DETRACTOR_ORDER) if ordered else rows


def detractor_alert_count(nps: DataFrame, clients: DataFrame, alerts: DataFrame) -> DataFrame:
    """Unresolved alerts of the clients that gave a detractor answer."""
    companies = nps.where(F.col("nps_category") == "detractor").select("hubspot_company_id").distinct()
    ids = clients.join(companies, "hubspot_company_id", "left_semi").select("client_id")
    return active_alerts(alerts).join(ids, "client_id", "left_semi").agg(F.count("*").alias("detractor_alerts"))


def filter_values(df: DataFrame, column: str = "csm_owner") -> DataFrame:
    """Sorted distinct values for a filter list."""
    return df.select(column).where(F.col(column).isNotNull()).distinct().orderBy(column)
