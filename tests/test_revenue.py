from datetime import date

import pytest

from clientpulse.operators import revenue

CONTRACTS = "id string, mrr double, contract_start_date date, churn_date date, churn_value double"


def brute_force(data, months):
    """Month by month over every contract, as the definition reads."""
    out = {}
    for m in months:
        start = sum(c[1] or 0 for c in data if c[2] and c[2] < m and (not c[3] or c[3] >= m))
        new = sum(c[1] or 0 for c in data if c[2] and c[2].replace(day=1) == m)
        lost = sum((c[4] if c[4] is not None else c[1]) or 0 for c in data if c[3] and c[3].replace(day=1) == m)
        out[m] = (round(start, 2), round(new, 2), round(lost, 2))
    return out


def test_waterfall_equals_the_definition(rows):
    data = [("old", 100.0, date(2020, 5, 5), None, None), ("first", 10.0, date(2024, 1, 1), None, None),
            ("mid", 7.5, date(2024, 2, 15), date(2024, 4, 1), None), ("value", 5.0, date(2023, 2, 1), date(2024, 3, 31), 4.0),
            ("same", 3.0, date(2024, 3, 5), date(2024, 3, 20), None), ("back", 9.0, date(2024, 5, 1), date(2024, 2, 1), None),
            ("gone", 50.0, date(2019, 1, 1), date(2023, 12, 31), None), ("nostart", 8.0, None, date(2024, 2, 2), None),
            ("nomrr", None, date(2024, 2, 2), None, None), ("late", 1.0, date(2024, 5, 31), None, None)]
    months = [date(2024, m, 1) for m in range(1, 7)]
    got = {r["month_start"]: (r["mrr_start"], r["mrr_new"], r["mrr_churn"]) for r in revenue.mrr_by_state(
        rows(data, CONTRACTS), date(2024, 1, 1), 12, date(2024, 6, 20)).collect()}
    assert got == brute_force(data, months)


def test_retention_without_start_is_unknown(rows):
    data = [("a", 10.0, date(2024, 1, 10), date(2024, 3, 3), 4.0)]
    got = {r["year_month"]: r for r in revenue.retention_by_state(rows(data, CONTRACTS), date(2024, 1, 1), 4,
                                                                  date(2026, 1, 1)).collect()}
    assert got["2024-01"]["grr"] is None and got["2024-02"]["grr"] == 100.0
    assert got["2024-03"]["grr"] == got["2024-03"]["nrr"] == 60.0 and got["2024-03"]["mrr_end"] == 6.0
    # Churn value differs from the MRR, so the next month does not start where this one ended.
    assert got["2024-04"]["mrr_start"] == 0.0 and got["2024-04"]["grr"] is None


def test_chained_waterfall(rows):
    clients = rows([("a", 600.0), ("b", 400.0)], "client_id string, mrr double")
    deals = rows([("1", "churn", -50.0, date(2024, 1, 31)), ("2", "upsell", 20.0, date(2024, 1, 1)),
                  ("3", "new", 100.0, date(2024, 3, 1)), ("4", "other", 7.0, date(2024, 4, 1)),
                  ("5", "downgrade", -1e6, date(2024, 5, 1)), ("6", "new", 5.0, date(2024, 6, 1))],
                 "deal_id string, deal_type string, mrr_delta double, closed_date date")
    got = [r.asDict() for r in revenue.retention_from_deals(clients, deals, date(2024, 1, 1), date(2024, 5, 31)).collect()]
    assert [g["year_month"] for g in got] == ["2024-01", "2024-02", "2024-03", "2024-04", "2024-05"]
    assert [g["mrr_end"] for g in got[:-1]] == [g["mrr_start"] for g in got[1:]]
    assert (got[0]["mrr_start"], got[0]["mrr_churn"], got[0]["mrr_end"], got[0]["grr"], got[0]["nrr"]) == (
        1000.0, -50.0, 970.0, 0.95, 0.97)
    organic = {"mrr_churn": -9.7, "mrr_downgrade": -4.85, "mrr_upsell": 14.55, "mrr_cross_sell": 4.85, "mrr_new": 19.4}
    assert {k: got[1][k] for k in organic} == organic
    # A deal of another type makes the month non-organic without moving it.
    assert got[3]["mrr_start"] == got[3]["mrr_end"]
    # A month that starts at or below zero has no ratio.
    broke = rows([("a", 0.0)], "client_id string, mrr double")
    zero = revenue.retention_from_deals(broke, deals, date(2024, 2, 1), date(2024, 2, 29)).first()
    assert (zero["mrr_start"], zero["grr"], zero["nrr"]) == (0.0, 0.0, 0.0)


REVENUE = ("year_month string, mrr_start double, mrr_churn double, mrr_downgrade double, mrr_upsell double, "
           "mrr_cross_sell double, mrr_new double, mrr_end double, grr double, nrr double")


def test_report_rows(rows):
    table = rows([(f"2024-{m:02d}", 10.0, 2.0, -1.0, 3.0, 4.0, 5.0, 9.0, 86.0 + m, 105.0) for m in range(1, 9)], REVENUE)
    assert [r["year_month"] for r in revenue.recent_months(table).collect()] == [f"2024-{m:02d}" for m in range(3, 9)]
    steps = [(r["step"], r["label"], r["amount"]) for r in revenue.waterfall_steps(table).orderBy("step").collect()]
    assert steps == [(1, "MRR Inicio", 10.0), (2, "Novo", 5.0), (3, "Upsell", 3.0), (4, "Cross-sell", 4.0),
                     (5, "Churn", -2.0), (6, "Downgrade", -1.0), (7, "MRR Final", 9.0)]
    band = revenue.retention_vs_target(table).first()
    assert (band["grr_band"], band["nrr_band"]) == ("green", "green")
    low = revenue.retention_vs_target(table.where("year_month = '2024-01'").withColumn("nrr", table.nrr - 1)).first()
    assert (low["grr_band"], low["nrr_band"]) == ("green", "yellow")


def test_text_export(rows):
    names = [c.split()[0] for c in REVENUE.split(", ")]
    text = rows([("2024-01", "10.5", "", None, "x", "1", "2", "3", "90.0", "")], ", ".join(f"{n} string" for n in names))
    got = revenue.revenue_table(text).first()
    assert (got["mrr_start"], got["mrr_churn"], got["mrr_downgrade"], got["mrr_upsell"], got["nrr"]) == (
        10.5, 0.0, 0.0, 0.0, 0.0)
    assert got["grr"] == pytest.approx(90.0)
