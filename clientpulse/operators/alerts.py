"""Alerts from the current and the previous score snapshot."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientpulse.functions import latest_rows, lookup, newest_first, to_date, top_rows, total_order, truthy
from clientpulse.operators.rules import AlertRule

# Order of the severities in both vocabularies.
SEVERITY_RANK = {"critical": 0, "warning": 1, "info": 2}
SEVERITY_RANK_SQL_V1 = {"critical": 1, "high": 2, "medium": 3, "low": 4}

ALERT_KEY = ("client_id", "alert_id", "alert_date")


def newest_score(history: DataFrame) -> list[Column]:
    """Newest day first, then the longest window, then every other column."""
    window = [F.col("period_days").desc_nulls_last()] if "period_days" in history.columns else []
    return total_order(history, ["client_id"], [F.col("calculated_at").desc_nulls_last(), *window])


def of_period(history: DataFrame, period_days: int | None) -> DataFrame:
    """One analysis window, so that a client has one row per day."""
    return history if period_days is None else history.where(F.col("period_days") == period_days)


def latest_snapshot(history: DataFrame, period_days: int | None = 30) -> DataFrame:
    rows = of_period(history, period_days)
    return latest_rows(rows, ["client_id"], newest_score(rows))


def previous_snapshot(history: DataFrame, period_days: int | None = 30) -> DataFrame:
    """The second newest row per client."""
    rows = of_period(history, period_days)
    ranked = top_rows(rows, ["client_id"], newest_score(rows), 2)
    return ranked.where(F.col("rn") == 2).select(
        "client_id", F.col("health_status").alias("previous_status"), F.col("campaign_roi").alias("previous_roi"),
        F.col("calculated_at").alias("previous_at"))


def latest_with_previous(history: DataFrame, period_days: int | None = 30) -> DataFrame:
    """The newest row per client beside the status and ROI before it.

    The two newest rows are kept first; the step back then looks at two rows per client at most.
    """
    rows = of_period(history, period_days)
    two = top_rows(rows, ["client_id"], newest_score(rows), 2)
    window = newest_first(["client_id"], newest_score(rows))
    paired = two.withColumns({"previous_status": F.lead("health_status").over(window),
                              "previous_roi": F.lead("campaign_roi").over(window),
                              "previous_at": F.lead("calculated_at").over(window)})
    return paired.where(F.col("rn") == 1).drop("rn")


def alert_base(history: DataFrame, dim: DataFrame, period_days: int | None = 30, how: str = "left") -> DataFrame:
    """Newest score row, previous status and ROI, company name, owner and days to renewal."""
    current = latest_with_previous(history, period_days)
    names = dim.select("client_id", "company_name", "csm_owner", "days_to_renewal")
    return current.join(names, "client_id", how)


def evaluate_alerts(base: DataFrame, rules: Sequence[AlertRule], alert_date: date | Column) -> DataFrame:
    """One row per client and rule that fires, from a single pass over ``base``.

    Columns a rule names but ``base`` lacks count as unknown.
    """
    needed = {"coverage_pct": "double", "previous_status": "string", "previous_roi": "double",
              "campaign_roi": "double"}
    filled = base.withColumns({c: F.lit(None).cast(t) for c, t in needed.items() if c not in base.columns})
    when = alert_date if isinstance(alert_date, Column) else F.lit(alert_date)

    def fired(rule: AlertRule) -> Column:
        metric = F.expr(rule.metric) if rule.metric else F.lit(None)
        row = F.struct(F.lit(rule.id).alias("alert_id"), F.lit(rule.name).alias("alert_name"),
                       F.lit(rule.severity).alias("severity"), F.lit(rule.action).alias("action_suggested"),
                       metric.cast("string").alias("alert_metric"))
        return F.when(F.expr(rule.condition), row)

    hits = F.array_compact(F.array(*[fired(r) for r in rules]))
    return filled.select("client_id", "company_name", "csm_owner", when.alias("alert_date"), F.inline(hits)).withColumn(
        "resolved", F.lit(False))


def run_date(history: DataFrame) -> Column:
    """Date of the newest run in a history, for ``evaluate_alerts``."""
    return history.select(F.max("calculated_at")).scalar()


def alert_table(export: DataFrame) -> DataFrame:
    """Exported alerts in the shape of the alert fact; resolution details are not exported."""
    return export.select(
        "client_id", to_date("alert_date").alias("alert_date"), "alert_id", "alert_name", "severity",
        "action_suggested", truthy("resolved").alias("resolved"),
        F.lit(None).cast("timestamp_ntz").alias("resolved_at"), F.lit(None).cast("string").alias("resolved_by"))


def severity_rank(ranks: dict[str, int] = SEVERITY_RANK) -> Column:
    return lookup("severity", ranks, max(ranks.values()) + 1)


# Orders of the lists, for ``writers.write_ordered``; the operators sort by them only if they are asked to.
ALERT_ORDER = ("severity_rank", "company_name", "alert_id", "client_id")


def ordered_alerts(alerts: DataFrame, ranks: dict[str, int] = SEVERITY_RANK, ordered: bool = True) -> DataFrame:
    """Most severe first, then company and rule."""
    ranked = alerts.withColumn("severity_rank", severity_rank(ranks))
    return ranked.orderBy(*ALERT_ORDER) if ordered else ranked


def most_urgent(alerts: DataFrame, n: int = 5, ranks: dict[str, int] = SEVERITY_RANK) -> DataFrame:
    return ordered_alerts(alerts, ranks).limit(n)


def alert_totals() -> list[Column]:
    """Alerts, and alerts per severity."""
    return [F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("severity") == s).alias(s) for s in SEVERITY_RANK]]


def alert_summary(alerts: DataFrame) -> DataFrame:
    """Totals of one run by severity, by a scan; ``watched(alerts, alert_totals())`` takes them from a write."""
    return alerts.agg(*alert_totals())
