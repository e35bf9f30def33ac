from datetime import date

from pyspark.sql import functions as F

from clientpulse.operators import reporting
from tests.conftest import as_dict, as_set

SCORES = "client_id string, calculated_at date, total_score int, health_status string, plan_usage_pct double"
CLIENTS = "client_id string, hubspot_company_id string, company_name string, segment_ipc string, csm_owner string"


def test_newest_row_versus_newest_values(rows):
    clients = rows([("a", "H1", "A", "s", "x"), ("b", "H2", "B", "s", "x")], CLIENTS)
    scores = rows([("a", date(2026, 1, 31), 9, "red", 70.0), ("a", date(2026, 2, 28), 20, "green", None),
                   ("z", date(2026, 2, 28), 1, "red", 1.0)], SCORES)
    by_row = {r["client_id"]: r for r in reporting.client_360(clients, scores).collect()}
    assert (by_row["a"]["total_score"], by_row["a"]["plan_usage_pct"]) == (20, None)
    assert by_row["b"]["total_score"] is None and len(by_row) == 2
    by_value = {r["client_id"]: r for r in reporting.client_360(clients, scores, skip_nulls=True).collect()}
    assert (by_value["a"]["total_score"], by_value["a"]["plan_usage_pct"]) == (20, 70.0)
    ranged = reporting.client_360(clients, scores, date(2026, 1, 1), date(2026, 1, 31)).where("client_id = 'a'").first()
    assert ranged["total_score"] == 9


def test_status_shares(rows):
    frame = rows([("a", None, 20, "green", None), ("b", None, 3, "inactive", None), ("c", None, None, None, None),
                  ("d", None, 5, "red", None)], SCORES)
    got = {r["health_status"]: (r["clients"], r["pct"]) for r in reporting.status_kpis(frame).collect()}
    assert got == {"green": (1, 25.0), "yellow": (0, 0.0), "red": (1, 25.0), "inactive": (1, 25.0)}
    empty = {r["pct"] for r in reporting.status_kpis(frame.where("false")).collect()}
    assert empty == {0.0}
    assert reporting.mean_score(frame).first()["avg_score"] == 9.3333


def test_months(rows):
    data = [("a", date(2025, m, 28), m, "red" if m % 2 else "green", None) for m in range(1, 10)]
    frame = rows(data + [("b", date(2025, 9, 1), 1, "green", None)], SCORES)
    means = [(r["month"].month, r["avg_score"]) for r in reporting.monthly_mean_score(frame).collect()]
    assert means == [(3, 3.0), (4, 4.0), (5, 5.0), (6, 6.0), (7, 7.0), (8, 8.0), (9, 5.0)]
    counts = as_set(reporting.status_by_month(frame, 2), "month", "health_status", "clients")
    assert counts == {(date(2025, 8, 1), "green", 1), (date(2025, 9, 1), "red", 1), (date(2025, 9, 1), "green", 1)}


def test_breakdown_and_renewal_bands(rows):
    frame = rows([("a", 5, 4, 3, 2, None, 0)], "client_id string, " + ", ".join(f"{c} int" for c in reporting.CRITERIA))
    got = as_dict(reporting.criterion_breakdown(frame), "criterion", "band")
    assert list(got.values()) == ["green", "green", "yellow", "red", "red", "red"]
    days = rows([(None,), (-5,), (30,), (31,), (90,), (91,)], "d int")
    assert [r[0] for r in days.select(reporting.renewal_band(F.col("d"))).collect()] == [
        "red", "red", "red", "yellow", "yellow", "green"]


def test_history_needs_two_points(rows):
    frame = rows([("a", date(2025, 2, 1), 1, "red", None), ("a", date(2025, 1, 1), 2, "red", None),
                  ("b", date(2025, 1, 1), 3, "red", None)], SCORES)
    assert [(r["client_id"], r["total_score"]) for r in reporting.score_history(frame).collect()] == [("a", 2), ("a", 1)]


ALERTS = "client_id string, alert_id string, alert_name string, severity string, action_suggested string, alert_date date, resolved boolean"


def alert_rows(rows):
    day = date(2025, 1, 1)
    return rows([("a", "1", "n", "info", "x", day, False), ("a", "2", "n", "critical", "x", day, True),
                 ("a", "3", "n", "odd", "x", day, None), ("b", "1", "n", "critical", "x", day, False),
                 ("z", "1", "n", "warning", "x", date(2025, 2, 1), False), ("z", "2", "n", "warning", "x", day, False)], ALERTS)


def test_alert_centre(rows):
    clients = rows([("a", "H1", "A", "s", "x"), ("b", "H2", "B", "s", "y")], CLIENTS)
    got = [(r["client_id"], r["alert_id"], r["company_name"]) for r in
           reporting.alert_centre(alert_rows(rows), clients).collect()]
    assert got == [("b", "1", "B"), ("z", "1", None), ("z", "2", None), ("a", "1", "A"), ("a", "3", "A")]
    assert reporting.alert_centre(alert_rows(rows), clients, csm="x", severity="info").count() == 1
    counts = as_dict(reporting.client_alerts(alert_rows(rows)), "client_id", "active_alerts")
    assert counts == {"a": 2, "b": 1, "z": 2}


def test_nps(rows):
    nps = rows([("1", "H1", 10, "promoter"), ("2", "H1", 9, "promoter"), ("3", "H2", 8, "passive"), ("4", "H2", 0, "detractor"),
                ("5", None, 3, "detractor"), ("6", "H9", 10, "promoter")],
               "response_id string, hubspot_company_id string, nps_score int, nps_category string").withColumn(
        "response_date", F.lit(date(2025, 1, 1)))
    clients = rows([("a", "H1", "A", "s1", "x"), ("b", "H2", "B", "s2", "y"), ("c", "H2", "C", "s3", "y")], CLIENTS)
    score = reporting.nps_score(nps).first()
    assert (score["responses"], score["nps"], score["band"]) == (6, 16.67, "yellow")
    none = reporting.nps_score(nps.where("false")).first()
    assert (none["responses"], none["nps"]) == (0, 0.0)
    assert as_set(reporting.nps_by_segment(nps, clients)) == {("s1", "promoter", 2), ("s2", "passive", 1), ("s2", "detractor", 1)}
    assert [(r["response_id"], r["company_name"]) for r in reporting.detractors(nps, clients).collect()] == [
        ("4", "B"), ("5", None)]
    assert reporting.detractor_alert_count(nps, clients, alert_rows(rows)).first()[0] == 1


def test_last_known_values_of_any_type_and_text(rows):
    """A status that no list names is a value like others; NULLs are stepped over column by column."""
    from datetime import date
    history = rows([("a", date(2026, 1, 1), 1, "green", "x"), ("a", date(2026, 2, 1), 2, "Vermelho", None), ("a", date(2026, 3, 1), None, None, None),
                    ("b", date(2026, 1, 1), 5, None, None), (None, date(2026, 1, 1), 7, "own", "y"), ("c", None, 8, "undated", "z")],
                   "client_id string, calculated_at date, total_score int, health_status string, note string")
    history = history.withColumn("tags", F.when(F.col("note").isNotNull(), F.array("note")))
    got = reporting.last_known_values(history)
    assert got.columns == ["client_id", "calculated_at", "total_score", "health_status", "note", "tags"]
    assert {r["client_id"]: (r["calculated_at"], r["total_score"], r["health_status"], r["note"], r["tags"]) for r in got.collect()} == {
        "a": (date(2026, 3, 1), 2, "Vermelho", "x", ["x"]), "b": (date(2026, 1, 1), 5, None, None, None),
        None: (date(2026, 1, 1), 7, "own", "y", ["y"]), "c": (None, None, None, None, None)}


def test_ordered_writes_compute_their_rows_once(spark, rows, tmp_path):
    """Files and rows are in order, and the rows' plan runs a single time although ranges are sampled."""
    from clientpulse.operators import alerts as alert_lists
    from clientpulse.sources import writers
    passed = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            passed.add(batch.num_rows)
            yield batch
    fired = rows([(f"c{k % 97}", f"name {k % 89}", ("info", "critical", "warning", "other")[k % 4], f"a{k % 7}") for k in range(4000)],
                 "client_id string, company_name string, severity string, alert_id string").repartition(5)
    listed = alert_lists.ordered_alerts(fired.mapInArrow(counted, fired.schema), ordered=False)
    writers.write_ordered(listed, str(tmp_path / "list"), alert_lists.ALERT_ORDER, files=6)
    assert passed.value == 4000
    files = sorted((tmp_path / "list").glob("part-*.parquet"))
    read = [tuple(r) for f in files for r in spark.read.parquet(str(f)).select(*alert_lists.ALERT_ORDER).collect()]
    assert len(files) > 3 and read == sorted(read) and read == [tuple(r) for r in alert_lists.ordered_alerts(fired).select(
        *alert_lists.ALERT_ORDER).collect()]
    plan = listed._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan
