"""Scores as of past month ends."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientpulse.functions import change_percent, days_between, month_end, percent, ratio, year_month
from clientpulse.operators.features import chat_usage
from clientpulse.operators.history import StatusHistory, statuses_at
from clientpulse.operators.rules import ASOF_BACKFILL, Profile
from clientpulse.operators.scoring import classify, score_points
from clientpulse.sources.schemas import HEALTH_SCORE, conformed


def month_ends(first: date, last: date) -> Column:
    """Array of the month ends from the month of ``first`` to the month of ``last``."""
    start = F.trunc(F.lit(first), "MM")
    months = F.sequence(start, F.trunc(F.lit(last), "MM"), F.expr("interval 1 month"))
    return F.transform(months, F.last_day)


def monthly_features(dim: DataFrame, campaigns: DataFrame, automations: DataFrame, messages: DataFrame,
                     first: date, last: date, midnight_cut: bool = False,
                     unknown_from: int | None = None) -> DataFrame:
    """One row per client and month end with every feature known by that day.

    Each source is reduced to one row per (client, month) in a single map-side combined aggregation, and
    "up to this month" is a running window over at most a few rows per client, so no event is ever
    repeated per month. A client is one row until the sums are made, and gets its month ends after them: a map task
    then holds one group per client of its split, not one per client and month end. Events older than the three calendar months before ``first`` share one bucket;
    later ones are not read. With ``midnight_cut`` an event after 00:00 of a month's last day is known
    only from the next month end on. ``unknown_from`` is the number of days from which the last campaign counts as
    unknown; by default every known one counts.
    """
    oldest = F.last_day(F.add_months(F.trunc(F.lit(first), "MM"), -3))
    newest = F.last_day(F.lit(last))
    open_end = F.date_add(newest, 1).cast("timestamp_ntz")

    def bucket(moment: str) -> Column:
        return F.greatest(month_end(moment), oldest)

    def split(moment: str, **values: Column) -> list[Column]:
        """Each value under its own name when known by its month end, under ``late_`` otherwise."""
        if not midnight_cut:
            return [v.alias(n) for n, v in values.items()]
        late = F.col(moment) > month_end(moment).cast("timestamp_ntz")
        return [F.when(~late, v).alias(n) for n, v in values.items()] + [
            F.when(late, v).alias(f"late_{n}") for n, v in values.items()]

    sent = campaigns.where(F.col("sent_at") < open_end).select(
        "client_id", bucket("sent_at").alias("month_end"),
        *split("sent_at", sent_on=F.col("sent_at").cast("date"), revenue=F.col("revenue_attributed"),
               cost=F.col("cost")))
    kind = F.col("automation_type")
    built = automations.where((F.col("status") == "active") & (F.col("created_at") < open_end)).select(
        "client_id", bucket("created_at").alias("month_end"),
        *split("created_at", standard=F.when(kind.eqNullSafe("integration"), 0).otherwise(1),
               integration=F.when(kind == "integration", 1).otherwise(0)))
    month_of = F.last_day(F.to_date(F.concat("year_month", F.lit("-01"))))
    # Month texts order like months, and a plain comparison prunes month partitions.
    volume = messages.where(F.col("year_month").between(year_month(oldest), year_month(newest))
                            & month_of.isNotNull()).select(
        "client_id", month_of.alias("month_end"), "messages_sent", "plan_limit")
    # No event is without a month, so the rows of clients stay apart in the sums.
    clients = dim.select("client_id", F.lit(None).cast("date").alias("month_end"), F.lit(True).alias("wanted"))

    events = clients
    for part in (sent, built, volume):
        events = events.unionByName(part, allowMissingColumns=True)
    sums = ("revenue", "cost", "standard", "integration")
    kinds = ("", "late_") if midnight_cut else ("",)
    monthly = events.groupBy("client_id", "month_end").agg(
        F.max("wanted").alias("wanted"), *[F.max(f"{late}sent_on").alias(f"{late}sent_on") for late in kinds],
        *[F.sum(f"{late}{c}").alias(f"{late}{c}") for c in sums for late in kinds],
        F.max("messages_sent").alias("messages_sent"), F.max("plan_limit").alias("plan_limit"))
    each = F.when(F.col("wanted"), month_ends(first, last)).otherwise(F.array("month_end"))
    dated = monthly.withColumn("month_end", F.explode(each))

    # Months as numbers, so that a window frame can look back over calendar months with gaps.
    numbered = dated.withColumn("m", F.year("month_end") * 12 + F.month("month_end"))
    by_client = Window.partitionBy("client_id").orderBy("m")
    this_month = by_client.rangeBetween(0, 0)

    def total(name: str, since: int) -> Column:
        known = F.coalesce(F.sum(name).over(by_client.rangeBetween(since, 0)), F.lit(0))
        return known if not midnight_cut else known + F.coalesce(
            F.sum(f"late_{name}").over(by_client.rangeBetween(since, -1)), F.lit(0))

    ever = Window.unboundedPreceding
    last_sent = F.max("sent_on").over(by_client.rangeBetween(ever, 0))
    if midnight_cut:
        last_sent = F.greatest(last_sent, F.max("late_sent_on").over(by_client.rangeBetween(ever, -1)))
    running = numbered.select(
        "client_id", "month_end", "wanted", F.max("messages_sent").over(this_month).alias("messages_sent_current"),
        F.max("plan_limit").over(this_month).alias("plan_limit"), last_sent.alias("last_sent_on"),
        total("revenue", -2).alias("revenue3"), total("cost", -2).alias("cost3"),
        total("standard", ever).alias("active_automations"),
        total("integration", ever).alias("integration_automations"),
        F.max("messages_sent").over(by_client.rangeBetween(-1, -1)).alias("messages_sent_previous"))
    days = days_between("month_end", "last_sent_on")
    both = F.col("messages_sent_current").isNotNull() & F.col("messages_sent_previous").isNotNull()
    return running.where(F.col("wanted") & F.col("month_end").between(month_end(F.lit(first)), newest)).select(
        "client_id", "month_end",
        (days if unknown_from is None else F.when(days < unknown_from, days)).alias("days_since_last_campaign"),
        ratio("revenue3", "cost3").alias("campaign_roi"),
        "active_automations", "integration_automations",
        "messages_sent_current", "messages_sent_previous",
        F.when(both, change_percent("messages_sent_current", "messages_sent_previous", None)).alias(
            "messages_mom_change"),
        percent("messages_sent_current", "plan_limit", None).alias("plan_usage_pct"))


def backfill_scores(dim: DataFrame, campaigns: DataFrame, automations: DataFrame, chat: DataFrame,
                    messages: DataFrame, config: DataFrame, first: date, last: date,
                    profile: Profile = ASOF_BACKFILL, midnight_cut: bool = False,
                    period_days: int = 30, history: StatusHistory | None = None) -> DataFrame:
    """Score rows at every month end from ``first`` to ``last``.

    Automation status, chat modules and cashback are the values of today, as the original has them for lack of history;
    with the snapshots of ``history`` they are those of each month end.
    """
    features = monthly_features(dim, campaigns, automations, messages, first, last, midnight_cut)
    if history is None:
        static = (dim.select("client_id")
                     .join(chat_usage(chat), "client_id", "left")
                     .join(config.select("client_id", "cashback_enabled"), "client_id", "left"))
        known = features.join(static, "client_id")
    else:
        known = features.drop("active_automations", "integration_automations").join(
            statuses_at(history, month_ends(first, last)), ["client_id", "month_end"], "left")
        zero = F.lit(0).cast("bigint")
        known = known.withColumns({c: F.coalesce(c, zero) for c in ("active_automations", "integration_automations")})
    known = known.withColumns({"chat_usage_level": F.coalesce("chat_usage_level", F.lit("none")),
                               "cashback_enabled": F.coalesce("cashback_enabled", F.lit(False))})
    scored = classify(score_points(known, profile), profile)
    dated = scored.withColumnRenamed("month_end", "calculated_at").withColumn("period_days", F.lit(period_days))
    return dated.select(*conformed(dated, HEALTH_SCORE, keep_types=("client_id",)))
