"""Tables published by version: what readers see while, and after, a write fails."""

import os
import time
from datetime import date

import pytest

from clientpulse.plans.lake import Lake
from clientpulse.sources import versions
from clientpulse.sources.versions import Conflict, VersionedTable
from tests.conftest import as_set

D1, D2, D3 = date(2026, 3, 31), date(2026, 4, 8), date(2026, 4, 9)
COLUMNS = "client_id string, calculated_at date, total_score int"


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def test_versions_replace_add_and_keep_partitions(table, rows):
    assert table.current() is None
    table.replace(table.prepare(rows([("a", D1, 1), ("b", D2, 2)], COLUMNS), "calculated_at"))
    first = table.current()
    table.replace_partitions(table.prepare(rows([("c", D2, 3), ("c", D3, 4)], COLUMNS), "calculated_at"))
    table.append(table.prepare(rows([("d", D3, 5)], COLUMNS), "calculated_at"))
    assert table.current().number == 3
    assert as_set(table.read(), "client_id", "calculated_at", "total_score") == {("a", D1, 1), ("c", D2, 3), ("c", D3, 4), ("d", D3, 5)}
    assert as_set(table.read(first), "client_id", "total_score") == {("a", 1), ("b", 2)}
    # The untouched day still lies in the folder of the first write, and reading one day lists one folder.
    assert table.current().folders[f"calculated_at={D1}"] == first.folders[f"calculated_at={D1}"]
    assert len(table.read(keep=lambda day: day < "2026-04").inputFiles()) == 1


def test_null_partitions_empty_tables_and_new_columns(table, rows):
    table.replace(table.prepare(rows([], COLUMNS), "calculated_at"))
    assert table.read().count() == 0 and table.read().columns == ["client_id", "total_score", "calculated_at"]
    table.append(table.prepare(rows([("a", None, 1), ("b", D1, 2)], COLUMNS), "calculated_at"))
    table.replace_partitions(table.prepare(rows([("c", None, 3, "x")], COLUMNS + ", note string"), "calculated_at"))
    assert as_set(table.read(), "client_id", "calculated_at", "note") == {("b", D1, None), ("c", None, "x")}
    with pytest.raises(ValueError, match="total_score is int"):
        table.append(table.prepare(rows([("a", D1, "1")], "client_id string, calculated_at date, total_score string"), "calculated_at"))


def test_a_job_that_dies_before_the_switch_leaves_the_old_table(spark, tmp_path, rows, monkeypatch):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(rows([("a", D1, 1)], COLUMNS), "fct_health_score")

    def killed(*_):
        raise KeyboardInterrupt
    monkeypatch.setattr(VersionedTable, "publish", killed)
    new = rows([("b", D1, 30, 2)], "client_id string, calculated_at date, period_days int, total_score int")
    for write in (lambda: lake.overwrite(new, "fct_health_score"), lambda: lake.replace_snapshot(new, "fct_health_score", "calculated_at"),
                  lambda: lake.upsert(new, "fct_health_score"), lambda: lake.append_unseen(new, "fct_health_score"),
                  lambda: lake.land(new, "companies"), lambda: lake.overwrite(new, "never_written")):
        with pytest.raises((KeyboardInterrupt, Exception)):
            write()
    monkeypatch.undo()
    assert as_set(lake.read("fct_health_score"), "client_id", "total_score") == {("a", 1)}
    # A first write that was never published is no table.
    assert lake.read_or_none("companies") is None and lake.read_or_none("never_written") is None
    assert lake.land(new, "companies").count() == 1


def test_a_reader_keeps_its_version_until_it_is_cleaned(table, rows):
    table.replace(table.prepare(rows([("a", D1, 1)], COLUMNS)))
    reader = table.read()
    lost = table.prepare(rows([("lost", D1, 9)], COLUMNS))
    table.replace(table.prepare(rows([("b", D1, 2)], COLUMNS)))
    assert as_set(reader, "client_id") == {("a",)} and as_set(table.read(), "client_id") == {("b",)}
    assert table.clean(age=3600) == []
    gone = table.clean(age=3600, now=time.time() + 7200)
    assert len(gone) == 2 and lost.mark in gone
    assert as_set(table.read(), "client_id") == {("b",)} and table.current().number == 2
    kept = [name for name in os.listdir(table.path) if name.startswith(versions.MARK)]
    assert len(kept) == 1 and [n for n in os.listdir(f"{table.path}/_log") if n.endswith(".json") and not n.startswith(".")] == [f"{2:020d}.json"]


def test_the_second_of_two_writers_fails(table, rows):
    table.replace(table.prepare(rows([("a", D1, 1)], COLUMNS)))
    seen = table.current()
    table.append(table.prepare(rows([("b", D1, 2)], COLUMNS)), seen)
    with pytest.raises(Conflict):
        table.append(table.prepare(rows([("c", D1, 3)], COLUMNS)), seen)
    assert as_set(table.read(), "client_id") == {("a",), ("b",)}


def test_plain_folders_are_taken_over(spark, tmp_path, rows):
    lake = Lake(spark, str(tmp_path))
    schema = "client_id string, calculated_at date, period_days int, total_score int"
    rows([("a", D1, 30, 1), ("b", D2, 30, 2)], schema).write.partitionBy("calculated_at").parquet(lake.path("fct_health_score"))
    lake.append_unseen(rows([("a", D1, 30, 9), ("c", D1, 30, 3)], schema), "fct_health_score")
    assert as_set(lake.read("fct_health_score"), "client_id", "calculated_at", "total_score") == {("a", D1, 1), ("b", D2, 2), ("c", D1, 3)}


def test_null_partitions_and_keys_in_keyed_writes(spark, tmp_path, rows):
    """Rows of a NULL partition stay when one of them is replaced, and are not appended twice."""
    lake = Lake(spark, str(tmp_path))
    schema = "csm_owner string, week_start date, calls_total bigint"
    lake.upsert(rows([("x", None, 1), ("y", None, 2), ("x", D1, 3)], schema), "fct_csm_activity_weekly")
    lake.upsert(rows([("x", None, 7), (None, D1, 8)], schema), "fct_csm_activity_weekly")
    want = {("x", None, 7), ("y", None, 2), ("x", D1, 3), (None, D1, 8)}
    assert as_set(lake.read("fct_csm_activity_weekly"), "csm_owner", "week_start", "calls_total") == want
    lake.append_unseen(rows([("y", None, 5), (None, D1, 6), ("z", None, 9), ("z", None, 4)], schema), "fct_csm_activity_weekly")
    assert as_set(lake.read("fct_csm_activity_weekly"), "csm_owner", "week_start", "calls_total") == want | {("z", None, 4)}
