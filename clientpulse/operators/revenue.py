"""Monthly recurring revenue: waterfall, gross and net retention."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from clientpulse.functions import (
    iso_timestamp, month_start, percent, ratio, round_exact, to_date, to_double, year_month,
)

# Retention targets in percent, and the organic movement rates of a month without deals.
TARGET_GRR = 87
TARGET_NRR = 105
ORGANIC_RATES = {"churn": -0.01, "downgrade": -0.005, "upsell": 0.015, "cross_sell": 0.005, "new": 0.02}
MOVEMENTS = ("new", "upsell", "cross_sell", "churn", "downgrade")


def month_spine(spark: SparkSession, first: date, months: int, as_of: date | None = None) -> DataFrame:
    """``months`` month starts from ``first``, none after ``as_of``."""
    start = F.trunc(F.lit(first), "MM")
    spine = spark.range(1).select(F.explode(F.sequence(
        start, F.add_months(start, months - 1), F.expr("interval 1 month"))).alias("month_start"))
    if as_of is not None:
        spine = spine.where(F.col("month_start") <= F.lit(as_of))
    return spine.select(year_month("month_start").alias("year_month"), "month_start")


def contract_facts(crm_companies: DataFrame) -> DataFrame:
    """MRR, start, churn date and churn value of the companies that have an MRR text."""
    p = "properties."
    return crm_companies.where(F.col(p + "mrr_fixo") != "").select(
        "id", to_double(p + "mrr_fixo").alias("mrr"),
        iso_timestamp(p + "closedate").cast("date").alias("contract_start_date"),
        to_date(p + "data_do_churn").alias("churn_date"), to_double(p + "valor_do_churn").alias("churn_value"))


def mrr_by_state(contracts: DataFrame, first: date, months: int, as_of: date) -> DataFrame:
    """Per month: MRR running at its start, MRR new in it, MRR churned in it.

    A contract runs at the start of every month after its start day up to its churn day. Instead of
    meeting every month, it gives one entry and one exit, which are summed per month; the running sum over
    the spine turns them into the level. The rows after the aggregation are months.
    """
    spine = month_spine(contracts.sparkSession, first, months, as_of)
    enters = F.add_months(month_start("contract_start_date"), 1)
    leaves = F.add_months(month_start("churn_date"), 1)
    # A contract that starts on the first day of a month is new in it, not running at its start.
    runs = F.col("contract_start_date").isNotNull() & (F.col("churn_date").isNull() | (leaves > enters))
    started, churned = month_start("contract_start_date"), month_start("churn_date")

    def move(kind: str, month: Column, amount: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), month.alias("month"), amount.alias("amount"))

    mrr = F.col("mrr")
    moves = F.array(move("enter", F.when(runs, enters), mrr), move("exit", F.when(runs, leaves), mrr),
                    move("new", started, mrr), move("churn", churned, F.coalesce("churn_value", mrr)))
    start = F.trunc(F.lit(first), "MM")
    # Entries and exits before the spine belong to its first month; new and churned MRR there do not.
    level_move = F.col("kind").isin("enter", "exit")
    per_month = contracts.select(F.inline(moves)).where(
        (F.col("month") <= F.lit(as_of)) & (level_move | (F.col("month") >= start))).groupBy(
            F.greatest("month", start).alias("month_start")).agg(
                *[F.sum(F.when(F.col("kind") == k, F.col("amount"))).alias(k)
                  for k in ("enter", "exit", "new", "churn")])
    zero = F.lit(0.0)
    running = Window.orderBy("month_start")
    level = F.sum(F.coalesce("enter", zero) - F.coalesce("exit", zero)).over(running)
    # One row per month from here on, so a single ordered window is bounded by the spine.
    return spine.join(per_month, "month_start", "left").select(
        "year_month", "month_start", F.round(level, 2).alias("mrr_start"),
        F.round(F.coalesce("new", zero), 2).alias("mrr_new"),
        F.round(F.coalesce("churn", zero), 2).alias("mrr_churn"))


def retention_by_state(contracts: DataFrame, first: date, months: int, as_of: date) -> DataFrame:
    """Waterfall and retention in percent; without classified expansion, net equals gross."""
    states = mrr_by_state(contracts, first, months, as_of)
    kept = percent(F.col("mrr_start") - F.col("mrr_churn"), "mrr_start")
    return states.select(
        "year_month", "month_start", "mrr_start", F.lit(0.0).alias("mrr_downgrade"), F.lit(0.0).alias("mrr_upsell"),
        F.lit(0.0).alias("mrr_cross_sell"), "mrr_new", "mrr_churn",
        F.round(F.col("mrr_start") - F.col("mrr_churn") + F.col("mrr_new"), 2).alias("mrr_end"),
        kept.alias("grr"), kept.alias("nrr"))


def deal_movements(deals: DataFrame, first: date, last: date) -> DataFrame:
    """Signed MRR change per month and deal type, with the number of deals; every month is present."""
    spine = month_spine(deals.sparkSession, first, _months(first, last))
    kind = F.col("deal_type")
    per_month = deals.where(F.col("closed_date").between(F.trunc(F.lit(first), "MM"), F.last_day(F.lit(last)))).groupBy(
        month_start("closed_date").alias("month_start")).agg(
            F.count("*").alias("deals"),
            *[F.sum(F.when(kind == m, F.col("mrr_delta"))).alias(f"mrr_{m}") for m in MOVEMENTS])
    return spine.join(per_month, "month_start", "left").select(
        "year_month", "month_start", F.coalesce("deals", F.lit(0).cast("bigint")).alias("deals"),
        *[round_exact(F.coalesce(f"mrr_{m}", F.lit(0.0))).alias(f"mrr_{m}") for m in MOVEMENTS])


def _months(first: date, last: date) -> int:
    return (last.year - first.year) * 12 + last.month - first.month + 1


def running_waterfall(movements: DataFrame, baseline: DataFrame) -> DataFrame:
    """Chain the months: each starts where the one before ended, from the baseline MRR on.

    ``movements`` has one row per month, so folding them as one array is bounded by the calendar. A month
    without any deal moves by the organic rates of its own start, which is why the fold is ordered.
    ``baseline`` is one row with ``mrr``.
    """
    step = F.struct("month_start", "year_month", "deals", *[f"mrr_{m}" for m in MOVEMENTS])
    months = movements.agg(F.array_sort(F.collect_list(step)).alias("months"))
    amounts = ["mrr_start", *[f"mrr_{m}" for m in MOVEMENTS], "mrr_end"]
    kinds = ", ".join(f"{a}: double" for a in amounts)
    nothing = F.array().cast(f"array<struct<year_month: string, {kinds}>>")

    def advance(done: Column, month: Column) -> Column:
        start = done["mrr"]
        moved = {m: F.when(month["deals"] == 0, round_exact(start * F.lit(rate))).otherwise(month[f"mrr_{m}"])
                 for m, rate in ORGANIC_RATES.items()}
        end = round_exact(start + moved["new"] + moved["upsell"] + moved["cross_sell"] - F.abs(moved["churn"])
                          - F.abs(moved["downgrade"]))
        row = F.struct(month["year_month"].alias("year_month"), start.alias("mrr_start"),
                       *[moved[m].alias(f"mrr_{m}") for m in MOVEMENTS], end.alias("mrr_end"))
        return F.struct(end.alias("mrr"), F.concat(done["rows"], F.array(row)).alias("rows"))

    begin = baseline.select(round_exact(F.coalesce("mrr", F.lit(0.0)))).scalar()
    opening = F.struct(F.col("begin").alias("mrr"), nothing.alias("rows"))
    return months.withColumn("begin", begin).select(
        F.aggregate("months", opening, advance)["rows"].alias("rows")).select(F.inline("rows"))


def baseline_mrr(clients: DataFrame) -> DataFrame:
    return clients.agg(F.sum("mrr").alias("mrr"))


def retention_from_deals(clients: DataFrame, deals: DataFrame, first: date, last: date) -> DataFrame:
    """Chained waterfall with gross and net retention as ratios."""
    chained = running_waterfall(deal_movements(deals, first, last), baseline_mrr(clients))
    lost = F.abs("mrr_churn") + F.abs("mrr_downgrade")
    return chained.select(
        "year_month", "mrr_start", "mrr_churn", "mrr_downgrade", "mrr_upsell", "mrr_cross_sell", "mrr_new", "mrr_end",
        ratio(F.col("mrr_start") - lost, "mrr_start", 1.0, 4, 0.0, round_exact).alias("grr"),
        ratio("mrr_end", "mrr_start", 1.0, 4, 0.0, round_exact).alias("nrr"))


def revenue_table(export: DataFrame) -> DataFrame:
    """Revenue export with numbers out of text, missing ones 0."""
    numbers = ("mrr_start", "mrr_churn", "mrr_downgrade", "mrr_upsell", "mrr_cross_sell", "mrr_new", "mrr_end",
               "grr", "nrr")
    return export.select("year_month", *[F.coalesce(to_double(c), F.lit(0.0)).alias(c) for c in numbers])


def recent_months(revenue: DataFrame, months: int = 6) -> DataFrame:
    return revenue.orderBy(F.col("year_month").desc()).limit(months).orderBy("year_month")


def waterfall_steps(revenue: DataFrame) -> DataFrame:
    """The latest month as seven ordered steps, losses negative."""
    latest = revenue.orderBy(F.col("year_month").desc()).limit(1)
    # Step names of the report.
    steps = (("MRR Inicio", F.col("mrr_start")), ("Novo", F.col("mrr_new")), ("Upsell", F.col("mrr_upsell")),
             ("Cross-sell", F.col("mrr_cross_sell")), ("Churn", -F.abs("mrr_churn")),
             ("Downgrade", -F.abs("mrr_downgrade")), ("MRR Final", F.col("mrr_end")))
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(name).alias("label"), value.alias("amount"))
                     for i, (name, value) in enumerate(steps, 1)])
    return latest.select("year_month", F.inline(rows))


def retention_vs_target(revenue: DataFrame, unit: str = "percent") -> DataFrame:
    """Latest month's retention in percent beside the targets; ``unit`` says whether the table has percent or ratios."""
    if unit not in ("percent", "ratio"):
        raise ValueError(f"unknown unit {unit}")
    latest = revenue.orderBy(F.col("year_month").desc()).limit(1)
    if unit == "ratio":
        latest = latest.withColumns({c: F.round(F.col(c) * 100, 2) for c in ("grr", "nrr")})
    return latest.select(
        "year_month", "grr", "nrr", F.lit(TARGET_GRR).alias("target_grr"), F.lit(TARGET_NRR).alias("target_nrr"),
        F.when(F.col("grr") >= TARGET_GRR, "green").otherwise("red").alias("grr_band"),
        F.when(F.col("nrr") >= TARGET_NRR, "green").otherwise("yellow").alias("nrr_band"))
