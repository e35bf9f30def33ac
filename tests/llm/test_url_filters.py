"""URL filters: validity intervals, matching keys and the as-of join."""

from datetime import date

from pyspark.sql import functions as F

from clientpulse.llm import url_filters

ENTRY = "kind string, pattern string, listed_on date, action string"
CAPTURE = "page_id long, url string, fetched_on date, entry string, row int, of_url string, blocked int"


def day(n):
    return date(2024, 1, n)


def test_intervals(spark):
    rows = [("host", "a.b", day(1), "add"), ("host", "a.b", day(3), "add"), ("host", "a.b", day(5), "remove"),
            ("host", "a.b", day(7), "remove"), ("host", "a.b", day(9), "add"), ("host", "c.d", day(2), "remove"),
            ("host", "e.f", day(4), "add"), ("host", "e.f", day(4), "remove"), ("host", "g.h", day(4), "add"),
            ("host", "g.h", day(4), "add"), (None, "x", day(1), "add"), ("host", None, day(1), "add"),
            ("host", "x", None, "add"), ("host", "x", day(1), "rename")]
    got = {tuple(r) for r in url_filters.intervals(spark.createDataFrame(rows, ENTRY)).collect()}
    assert got == {("host", "a.b", day(1), day(5)), ("host", "a.b", day(9), None), ("host", "g.h", day(4), None)}


def test_keys_of_urls(spark):
    urls = {"https://User@M.Example.ORG.:8080//a/b.html?q=/x#/y": {
        ("host", "m.example.org"), ("domain", "m.example.org"), ("domain", "example.org"), ("prefix", "m.example.org/a"),
        ("prefix", "m.example.org/a/b.html")},
        "http://localhost": {("host", "localhost")}, "no url": None, "": None, None: None, "http:///path": None}
    rows = spark.createDataFrame([(u,) for u in urls], "u string").select("u", url_filters.match_keys(F.col("u")).alias("k"))
    assert {r.u: {tuple(k) for k in r.k} if r.k is not None else None for r in rows.collect()} == urls


def test_captures_meet_the_entries_of_their_day(spark):
    entries = spark.createDataFrame([
        ("domain", "ex.org", day(1), "add"), ("domain", "ex.org", day(10), "remove"), ("host", "m.ex.org", day(5), "add"),
        ("prefix", "m.ex.org/en", day(6), "add"), ("prefix", "m.ex.org/en/a", day(6), "add")], ENTRY)
    rows = [(1, "http://m.ex.org/en/a/b", day(1)), (2, "http://m.ex.org/en/a/b", day(9)), (3, "http://m.ex.org/fr", day(10)),
            (4, "http://other.ex.org", day(10)), (5, "http://notex.org", day(2)), (6, None, day(2)), (7, "http://ex.org", None),
            (None, "http://ex.org/", day(2)), (1, "http://m.ex.org/en/a/b", day(1))]
    captures = spark.createDataFrame([(*r, "x", 1, "y", 2) for r in rows], CAPTURE)
    found = url_filters.evaluated(captures, entries)
    got = sorted((r.row.page_id or 0, r.active_entries, r.entry or "", r.blocked) for r in found.collect())
    assert got == [(0, 1, "domain:ex.org", True), (1, 1, "domain:ex.org", True), (1, 1, "domain:ex.org", True),
                   (2, 4, "prefix:m.ex.org/en/a", True), (3, 1, "host:m.ex.org", True), (4, 0, "", False), (5, 0, "", False),
                   (6, 0, "", False), (7, 0, "", False)]
    assert found.select("row.*").columns == captures.columns


def test_hot_host_and_long_urls(spark):
    entries = spark.createDataFrame([("host", "hot.org", day(1), "add")], ENTRY)
    rows = [(k, "http://hot.org/" + "a/" * (k % 3), day(2 + k % 5)) for k in range(3000)] + [(9999, "http://hot.org/" + "s/" * 500, day(3))]
    captures = spark.createDataFrame(rows, "page_id long, url string, fetched_on date")
    assert url_filters.evaluated(captures, entries).where("active_entries = 1").count() == 3001


def test_empty_tables(spark):
    none = spark.createDataFrame([], ENTRY)
    captures = spark.createDataFrame([(1, "http://a.b", day(1), "x", 1, "y", 2)], CAPTURE)
    assert [r.blocked for r in url_filters.evaluated(captures, none).collect()] == [False]
    assert url_filters.evaluated(spark.createDataFrame([], CAPTURE), none).collect() == []


def test_no_python_in_the_plan(spark):
    entries = spark.createDataFrame([("host", "hot.org", day(1), "add")], ENTRY)
    captures = spark.createDataFrame([(1, "http://a.b", day(1), "x", 1, "y", 2)], CAPTURE)
    plan = url_filters.evaluated(captures, entries)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan
