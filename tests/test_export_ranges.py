"""Export parts by byte ranges against the reader of whole parts."""

import json
import random

import pytest

from clientpulse.sources import export_ranges, readers
from tests.conftest import as_set

TYPES = {"client_id": "bigint", "name": "string", "mrr": "double", "note": "string"}


def parts(seed, n):
    """Rows with brackets, quotes and backslashes inside texts, nested values, short rows and nulls."""
    chance = random.Random(seed)
    texts = ["plain", "a]b[c", '],["x"', 'quo"te', "back\\", '\\"', "\\\\", "é ] ü", "{", "", "line\nbreak", '"]]}', "\u2028"]
    rows = [[str(k), "".join(chance.choices(texts, k=chance.randrange(4))), chance.choice(["1.5", "x", None, 7, 2.25, True]),
             chance.choice([None, ["in", ["deep"]], {"a": [1]}, "t"])][:chance.choice([4, 4, 4, 3, 1])] for k in range(n)]
    return {"row_count": n, "columns": ["client_id", "name", "mrr", "note"], "data": rows, "more": [["not"], ["a row"]], "z": {"data": [["no"]]}}


def plain(row):
    """A row as text; nested values come in compact form from the ranges and as written from the whole parts."""
    note = row["note"]
    return str((*row[:3], json.dumps(json.loads(note)) if note and note[0] in "[{" else note))


@pytest.mark.parametrize("range_bytes", [5, 64, 1000, 1 << 20])
@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":")}, {"ensure_ascii": False}])
def test_equal_to_the_reader_of_whole_parts(spark, tmp_path, monkeypatch, range_bytes, layout):
    if range_bytes < 64 and layout:
        pytest.skip("many small ranges once")
    monkeypatch.setattr(export_ranges, "PIECE", 100)
    monkeypatch.setattr(export_ranges, "STEP", 50)
    n = 6 if range_bytes == 5 else 60
    for name, seed in (("p1", 1), ("p2", 2)):
        (tmp_path / f"{name}.json").write_text(json.dumps(parts(seed, n), **layout), encoding="utf-8")
    (tmp_path / "late.json").write_text(json.dumps({"data": [["9", "late"]], "columns": ["client_id", "name"]}), encoding="utf-8")
    (tmp_path / "none.json").write_text(json.dumps({"columns": ["client_id"], "data": []}), encoding="utf-8")
    (tmp_path / "empty.json").write_text("", encoding="utf-8")
    got = readers.read_large_export(spark, str(tmp_path / "*.json"), TYPES, range_bytes)
    want = readers.read_export(spark, str(tmp_path / "*.json"), TYPES, multi_line=True)
    assert got.dtypes == want.dtypes
    assert sorted(map(plain, got.collect())) == sorted(map(plain, want.collect()))
    if range_bytes == 64:
        assert got.rdd.getNumPartitions() > 20


def test_broken_tails_are_reported(spark, tmp_path):
    whole = json.dumps(parts(3, 40))
    inside = whole.index('"more"')
    for name, cut in (("row", inside // 2), ("string", whole.index("plain") + 2), ("array", inside - 4), ("document", len(whole) - 1)):
        path = tmp_path / f"{name}.json"
        path.write_text(whole[:cut], encoding="utf-8")
        with pytest.raises(export_ranges.BrokenPart, match=name):
            readers.read_large_export(spark, str(path), TYPES, 256)
    (tmp_path / "other.json").write_text(json.dumps({"columns": ["a"]})[:-1] + ' , "x": ', encoding="utf-8")
    with pytest.raises(export_ranges.BrokenPart, match="no data"):
        readers.read_large_export(spark, str(tmp_path / "other.json"), TYPES)
    (tmp_path / "two.json").write_text(whole + "\n" + whole, encoding="utf-8")
    with pytest.raises(ValueError, match="several documents"):
        readers.read_large_export(spark, str(tmp_path / "two.json"), TYPES, 256)
    assert readers.read_large_export(spark, str(tmp_path / "absent*.json"), TYPES).count() == 0


def test_a_part_without_data(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"columns": ["client_id"], "data": null}', encoding="utf-8")
    (tmp_path / "b.json").write_text('{"columns": ["client_id"], "data": [["5"]]}', encoding="utf-8")
    assert as_set(readers.read_large_export(spark, str(tmp_path), TYPES), "client_id") == {(5,)}
