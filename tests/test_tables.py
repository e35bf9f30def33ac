import json
from datetime import date

import pytest
from pyspark.sql import functions as F

from clientpulse import session
from clientpulse.sources import readers, schemas, writers
from tests.conftest import as_set

KEY = ["client_id", "calculated_at", "period_days"]
COLUMNS = "client_id string, calculated_at date, period_days int, total_score int"
D1, D2 = date(2026, 3, 31), date(2026, 4, 8)


def test_insert_or_ignore_twice_is_once(rows):
    existing = rows([("a", D1, 30, 1)], COLUMNS)
    new = rows([("a", D1, 30, 9), ("a", D1, 60, 2), ("b", D1, 30, 3), ("b", D1, 30, 4)], COLUMNS)
    once = writers.insert_or_ignore(existing, new, KEY, [F.col("total_score")])
    assert as_set(once) == {("a", D1, 30, 1), ("a", D1, 60, 2), ("b", D1, 30, 3)}
    assert as_set(writers.insert_or_ignore(once, new, KEY, [F.col("total_score")])) == as_set(once)


def test_upsert_last_wins(rows):
    existing = rows([("a", D1, 30, 1), ("c", D1, 30, 7)], COLUMNS)
    new = rows([("a", D1, 30, 9), ("a", D1, 30, 8), ("b", D1, 30, 3)], COLUMNS)
    got = writers.upsert(existing, new, KEY, [F.col("total_score").desc()])
    assert as_set(got) == {("a", D1, 30, 9), ("b", D1, 30, 3), ("c", D1, 30, 7)}


def test_append_unseen_keeps_duplicates_inside_the_batch(rows):
    existing = rows([("a", D1, 30, 1)], COLUMNS)
    new = rows([("a", D1, 30, 1), ("b", D1, 30, 2), ("b", D1, 30, 2)], COLUMNS)
    assert writers.append_unseen(existing, new, KEY).count() == 3


def test_replace_snapshot_leaves_other_days(spark, rows, tmp_path):
    path = str(tmp_path / "scores")
    writers.replace_snapshot(rows([("a", D1, 30, 1), ("a", D2, 30, 2), ("b", D2, 30, 3)], COLUMNS), path)
    writers.replace_snapshot(rows([("a", D2, 30, 5)], COLUMNS), path)
    assert as_set(writers.read_table(spark, path), "client_id", "calculated_at", "total_score") == {("a", D1, 1), ("a", D2, 5)}
    kept = writers.remove_snapshot(rows([("a", D1, 30, 1), ("a", D2, 30, 2), ("a", None, 30, 3)], COLUMNS), D2)
    assert as_set(kept, "total_score") == {(1,), (3,)}


def test_owner_names_keep_unknown_ids(rows):
    calls = rows([("1", "7"), ("2", "8"), ("3", None)], "call_id string, csm_owner string")
    owners = rows([("7", "Ana Lima"), ("9", "Bia")], "owner_id string, owner_name string")
    assert as_set(writers.resolve_owner_names(calls, owners), "call_id", "csm_owner") == {
        ("1", "Ana Lima"), ("2", "8"), ("3", None)}


def test_export_parts(spark, tmp_path):
    parts = [{"columns": ["client_id", "_pad", "mrr", "alert_date"], "data": [["1", "zz", "10.5", "2026-04-18"],
                                                                         ["2", "zz", "", None]], "row_count": 2},
             {"columns": ["mrr", "client_id"], "data": [["x", "3"], ["7"]]}, {"columns": ["mrr"], "data": []}]
    for n, part in enumerate(parts):
        (tmp_path / f"p{n}.json").write_text(json.dumps(part), encoding="utf-8")
    types = {"client_id": "bigint", "mrr": "double", "alert_date": "date", "_pad": "string"}
    got = readers.read_export(spark, [str(tmp_path / f"p{n}.json") for n in range(3)], types)
    assert got.dtypes == [("client_id", "bigint"), ("mrr", "double"), ("alert_date", "date")]
    assert as_set(got) == {(1, 10.5, date(2026, 4, 18)), (2, None, None), (3, None, None), (None, 7.0, None)}
    (tmp_path / "pretty.json").write_text(json.dumps(parts[0], indent=2), encoding="utf-8")
    assert readers.read_export(spark, str(tmp_path / "pretty.json"), types, multi_line=True).count() == 2


def test_crm_pages(spark, tmp_path):
    page = {"results": [
        {"id": "1", "properties": {"name": "A", "mrr": None}, "associations": {"companies": {"results": [
            {"id": "H1", "type": "t"}, {"id": "H2", "type": "t"}]}}},
        {"id": "2", "properties": {"name": "B", "extra": "x"}, "associations": {"companies": {"results": []}}},
        {"id": "3", "properties": {}}], "paging": {"next": {"after": "100", "link": "l"}}}
    (tmp_path / "a.json").write_text(json.dumps(page) + "\n" + json.dumps({"results": []}), encoding="utf-8")
    got = readers.read_crm_pages(spark, str(tmp_path), ["name", "mrr"])
    assert as_set(got, "id", "properties.name", "properties.mrr", "company_id") == {
        ("1", "A", None, "H1"), ("2", "B", None, None), ("3", None, None, None)}


def test_absent_source_has_the_right_shape(spark, tmp_path):
    for path in (None, str(tmp_path / "nothing")):
        frame = readers.scan_or_empty(spark, path, schemas.NPS)
        assert frame.count() == 0 and frame.columns == schemas.NPS.fieldNames()


def test_conformed_fills_and_casts(rows):
    frame = rows([(7, "3")], "client_id bigint, mrr string")
    got = frame.select(*schemas.conformed(frame, schemas.COMPANIES, keep_types=("client_id",)))
    assert dict(got.dtypes)["client_id"] == "bigint" and got.first()["mrr"] == 3.0 and got.first()["has_cs"] is None


class FakeContext:
    def __init__(self, master):
        self.master, self.folder = master, None

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder


class FakeSession:
    def __init__(self, master, **conf):
        self.sparkContext = FakeContext(master)
        self.settings = {k.replace("__", "."): v for k, v in conf.items()}
        self.conf = self

    def get(self, key, default=None):
        return self.settings.get(key, default)


def test_shared_folder_comes_from_the_session():
    named = FakeSession("spark://host:7077", spark__checkpoint__dir="s3a://bucket/work/")
    assert session.shared_dir(named) == "s3a://bucket/work"
    assert session.scratch_path(named, "x").startswith("s3a://bucket/work/x-")
    with pytest.raises(RuntimeError):
        session.shared_dir(FakeSession("spark://host:7077"))
    local = FakeSession("local[2]")
    assert session.shared_dir(local) == session.shared_dir(local)
