"""What was true when: validity intervals out of daily snapshots, and their values at given days.

A snapshot table has a row per key and day on which it was taken. Most rows repeat the day before; an interval keeps a
run of equal rows as one, so a look-up by day reads the changes and not the days.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientpulse.functions import latest_rows, total_order
from clientpulse.operators.features import automation_counts, chat_usage


def validity_intervals(snapshots: DataFrame, key: Sequence[str], values: Sequence[str], day: str = "snapshot_day",
                       days: DataFrame | None = None) -> DataFrame:
    """(key, values, valid_from, valid_to): the runs of successive snapshots in which a key had the same values.

    ``valid_to`` is the day of the first snapshot that says otherwise, the key's absence included, and NULL while the
    last snapshot still says so. Before the first snapshot nothing is known, and what it says is taken to have been
    so: ``valid_from`` is NULL then. Of several rows of a key and day the first in the order of all values counts.
    ``days`` (a frame with ``day``) are the days on which snapshots were taken, empty ones included; by default those
    that have a row.
    """
    # One row per day, so a window over all of them stays small.
    in_order = Window.orderBy(day)
    calendar = (snapshots if days is None else days).select(day).where(F.col(day).isNotNull()).distinct().select(
        day, F.lead(day).over(in_order).alias("_next"), (F.row_number().over(in_order) == 1).alias("_first"))
    rows = snapshots.select(*key, day, *values).where(F.col(day).isNotNull())
    rows = latest_rows(rows, [*key, day], total_order(rows, [*key, day], [F.lit(0)])).join(calendar, day)
    by_key = Window.partitionBy(*key).orderBy(day)
    same = F.lag("_next").over(by_key).eqNullSafe(F.col(day))
    for value in values:
        same = same & F.lag(value).over(by_key).eqNullSafe(F.col(value))
    runs = rows.withColumn("_begins", (~same).cast("int")).withColumn(
        "_run", F.sum("_begins").over(by_key.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy(*key, *values, "_run").agg(
        F.min(F.when(~F.col("_first"), F.col(day))).alias("_from"), F.max("_first").alias("_first"),
        F.max_by("_next", day).alias("valid_to")).select(
            *key, *values, F.when(~F.col("_first"), F.col("_from")).alias("valid_from"), "valid_to")


def at_days(intervals: DataFrame, days: Column, name: str = "as_of") -> DataFrame:
    """The intervals' rows once per day of the array ``days`` at which they hold, without the interval."""
    def holds(d: Column) -> Column:
        begun = F.col("valid_from").isNull() | (d >= F.col("valid_from"))
        return begun & (F.col("valid_to").isNull() | (d < F.col("valid_to")))

    return intervals.withColumn(name, F.explode(F.filter(days, holds))).drop("valid_from", "valid_to")


@dataclass(frozen=True)
class StatusHistory:
    """Snapshots of the same days (``snapshot_day``) of automations, chat modules and product configuration."""

    automations: DataFrame
    chat: DataFrame
    config: DataFrame


def statuses_at(history: StatusHistory, days: Column, name: str = "month_end") -> DataFrame:
    """Per client and day: active automations of both kinds, chat level and cashback as the snapshots had them.

    A client of whom a snapshot says nothing has no automation, no chat and no cashback there. A day counts for all
    three kinds if one of them has a row of it.
    """
    taken = history.automations.select("snapshot_day")
    for other in (history.chat, history.config):
        taken = taken.unionAll(other.select("snapshot_day"))

    def intervals(snapshots: DataFrame, key: str, *values: str) -> DataFrame:
        return at_days(validity_intervals(snapshots, [key], values, days=taken), days, name)

    built = intervals(history.automations, "automation_id", "client_id", "automation_type", "status")
    kind = F.col("automation_type")
    active = F.coalesce(F.col("status") == "active", F.lit(False))
    client_day = F.struct("client_id", name).alias("_at")
    counts = automation_counts(built.withColumn("_at", client_day), active, ~kind.eqNullSafe("integration"),
                               kind.eqNullSafe("integration"), "_at").select("_at.*", "active_automations", "integration_automations")
    chat = intervals(history.chat, "client_id", "has_human_agent", "has_chat_flow", "has_ai_enabled")
    levels = chat_usage(chat.withColumn("_at", client_day), "_at").select("_at.*", "chat_usage_level")
    config = intervals(history.config, "client_id", "cashback_enabled")
    both = counts.join(levels, ["client_id", name], "full_outer").join(config, ["client_id", name], "full_outer")
    zero = F.lit(0).cast("bigint")
    return both.select("client_id", name, F.coalesce("active_automations", zero).alias("active_automations"),
                       F.coalesce("integration_automations", zero).alias("integration_automations"),
                       F.coalesce("chat_usage_level", F.lit("none")).alias("chat_usage_level"),
                       F.coalesce("cashback_enabled", F.lit(False)).alias("cashback_enabled"))
