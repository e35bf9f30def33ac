"""Revenue retention."""

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsechecks.catalog import check
from pulsechecks.sqlbase import with_chain, with_sql
from clientpulse.operators import revenue

SPINE = (date(2024, 1, 1), 31)
TODAY = date(2026, 4, 18)
DEALS = (date(1995, 1, 1), date(2001, 8, 31))


def spine_used(i) -> DataFrame:
    """Number of contracts that run at the start of each month of the spine."""
    contracts = revenue.contract_facts(i.crm_companies)
    return revenue.mrr_by_state(contracts.withColumn("mrr", F.lit(1.0)), *SPINE, TODAY)


@check("r1_month_spine", with_sql("""
SELECT s.year_month, s.month_start, count(c.id)::DOUBLE AS running FROM x_spine s LEFT JOIN x_contracts c
  ON c.start_day < s.month_start AND (c.churn_date IS NULL OR c.churn_date >= s.month_start) GROUP BY ALL"""))
def _(i):
    return spine_used(i).select("year_month", "month_start", F.col("mrr_start").alias("running"))


@check("r2_mrr_waterfall", with_sql("SELECT * FROM x_states"))
def _(i):
    return revenue.mrr_by_state(revenue.contract_facts(i.crm_companies), *SPINE, TODAY)


def retention(i) -> DataFrame:
    return revenue.retention_by_state(revenue.contract_facts(i.crm_companies), *SPINE, TODAY)


@check("r3_retention_warehouse", with_sql("SELECT * FROM x_retention"))
def _(i):
    return retention(i)


@check("r4_deal_movements", with_sql("SELECT * FROM x_movements"))
def _(i):
    return revenue.deal_movements(i.deals, *DEALS)


def chained(i) -> DataFrame:
    return revenue.retention_from_deals(i.clients, i.deals, *DEALS)


@check("r5_running_waterfall", with_chain("""
SELECT year_month, mrr_start, mrr_new, mrr_upsell, mrr_cross_sell, mrr_churn, mrr_downgrade, mrr_end FROM waterfall"""))
def _(i):
    return revenue.running_waterfall(revenue.deal_movements(i.deals, *DEALS), revenue.baseline_mrr(i.clients))


@check("r6_organic_months", with_chain("""
SELECT year_month, mrr_start, mrr_new, mrr_upsell, mrr_cross_sell, mrr_churn, mrr_downgrade, mrr_end FROM waterfall
WHERE year_month IN (SELECT year_month FROM x_movements WHERE deals = 0)"""))
def _(i):
    moves = revenue.deal_movements(i.deals, *DEALS)
    empty = moves.where(F.col("deals") == 0).select("year_month")
    return revenue.running_waterfall(moves, revenue.baseline_mrr(i.clients)).join(empty, "year_month", "left_semi")


@check("r7_retention_local", with_chain("SELECT * FROM waterfall"))
def _(i):
    return chained(i)


@check("r8_revenue_table", with_sql("""
SELECT year_month, mrr_start, mrr_churn, mrr_downgrade, mrr_upsell, mrr_cross_sell, mrr_new, mrr_end,
  ifnull(grr, 0) AS grr, ifnull(nrr, 0) AS nrr FROM x_retention"""))
def _(i):
    rows = retention(i)
    text = rows.select("year_month", *[F.col(c).cast("string").alias(c) for c in rows.columns
                                       if c not in ("year_month", "month_start")])
    return revenue.revenue_table(text)


@check("r9_recent_months", with_sql("""
SELECT year_month, grr, nrr, mrr_churn, mrr_downgrade, mrr_upsell, mrr_cross_sell, mrr_new FROM x_retention
ORDER BY year_month DESC LIMIT 6"""))
def _(i):
    return revenue.recent_months(retention(i)).select(
        "year_month", "grr", "nrr", "mrr_churn", "mrr_downgrade", "mrr_upsell", "mrr_cross_sell", "mrr_new")


@check("r10_waterfall_steps", with_chain("""
SELECT year_month, s.step, s.label, s.amount FROM (
  SELECT *, unnest([{'step': 1, 'label': 'MRR Inicio', 'amount': mrr_start}, {'step': 2, 'label': 'Novo', 'amount': mrr_new},
    {'step': 3, 'label': 'Upsell', 'amount': mrr_upsell}, {'step': 4, 'label': 'Cross-sell', 'amount': mrr_cross_sell},
    {'step': 5, 'label': 'Churn', 'amount': -abs(mrr_churn)}, {'step': 6, 'label': 'Downgrade', 'amount': -abs(mrr_downgrade)},
    {'step': 7, 'label': 'MRR Final', 'amount': mrr_end}]) AS s
  FROM (SELECT * FROM waterfall ORDER BY year_month DESC LIMIT 1))"""))
def _(i):
    return revenue.waterfall_steps(chained(i))


@check("r11_retention_vs_target_ratio", with_chain("""
SELECT year_month, round(grr * 100, 2) AS grr, round(nrr * 100, 2) AS nrr, 87 AS target_grr, 105 AS target_nrr,
  CASE WHEN round(grr * 100, 2) >= 87 THEN 'green' ELSE 'red' END AS grr_band,
  CASE WHEN round(nrr * 100, 2) >= 105 THEN 'green' ELSE 'yellow' END AS nrr_band
FROM waterfall ORDER BY year_month DESC LIMIT 1"""))
def _(i):
    return revenue.retention_vs_target(chained(i), unit="ratio")


@check("r11_retention_vs_target", with_sql("""
SELECT year_month, grr, nrr, 87 AS target_grr, 105 AS target_nrr, CASE WHEN grr >= 87 THEN 'green' ELSE 'red' END AS grr_band,
  CASE WHEN nrr >= 105 THEN 'green' ELSE 'yellow' END AS nrr_band FROM x_retention ORDER BY year_month DESC LIMIT 1"""))
def _(i):
    return revenue.retention_vs_target(retention(i))
