"""Large export parts read by byte ranges.

An export part ``{"columns": [...], "data": [[...], ...]}`` is one JSON document, which Spark's reader takes as one task.
Here each task takes a range of bytes and delivers the rows that begin in it. Where a range begins inside a string or
inside a row cannot be seen from the range alone, so a first pass counts, for both cases, what a range changes: the
quotes, and the depth of brackets outside strings. Those few numbers per range, added up in order, tell every range its
exact state. The second pass cuts the rows; Spark's own JSON parser reads them, as it does for small parts.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Tasks need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RANGE = 16 << 20
#: Bytes of rows that are delivered as one value, and that are read at once to find the end of a row or of the head.
PIECE = 256 << 10
STEP = 1 << 20

_QUOTE, _BACKSLASH = 0x22, 0x5C
_DEPTH = np.zeros(256, np.int8)
_DEPTH[[ord("["), ord("{")]], _DEPTH[[ord("]"), ord("}")]] = 1, -1


class BrokenPart(ValueError):
    """An export part that ends before its data does."""


def _opened(path: str):
    from pyarrow import fs

    files, inner = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return files.open_input_file(inner)


def _bytes(path: str, start: int, end: int) -> bytes:
    with _opened(path) as file:
        return file.read_at(max(0, end - start), start)


def _escaped_before(path: str, start: int) -> int:
    """The number of backslashes right before a place in a file."""
    found, at = 0, start
    while at > 0:
        low = max(0, at - 4096)
        block = _bytes(path, low, at)
        run = len(block) - len(block.rstrip(b"\\"))
        found += run
        if run < len(block):
            break
        at = low
    return found


def _quotes(data: np.ndarray, escaped: int) -> np.ndarray:
    """Places of the quotes that begin or end a string; ``escaped`` backslashes stand before the data."""
    places = np.flatnonzero(data == _QUOTE)
    behind = np.where(places > 0, data[np.maximum(places, 1) - 1] == _BACKSLASH, escaped > 0)
    odd = np.zeros(len(places), bool)
    for k in np.flatnonzero(behind).tolist():
        at, run = int(places[k]) - 1, 0
        while at >= 0 and data[at] == _BACKSLASH:
            at, run = at - 1, run + 1
        odd[k] = (run + (escaped if at < 0 else 0)) % 2 == 1
    return places[~odd]


@dataclass(frozen=True)
class Scanned:
    """The brackets of some bytes that lie outside strings, as places and as the depth after each."""

    places: np.ndarray
    depth: np.ndarray
    inside: bool


def _scan(data: bytes, inside: bool, depth: int, escaped: int = 0) -> Scanned:
    raw = np.frombuffer(data, np.uint8)
    quotes = _quotes(raw, escaped)
    change = _DEPTH[raw]
    places = np.flatnonzero(change)
    free = (np.searchsorted(quotes, places) + inside) % 2 == 0
    places = places[free]
    return Scanned(places, depth + np.cumsum(change[places], dtype=np.int64), bool((len(quotes) + inside) % 2))


class _Range(InputPartition):
    def __init__(self, path: str, start: int, end: int, inside: bool = False, depth: int = 0, first: int = 0):
        self.path, self.start, self.end, self.inside, self.depth, self.first = path, start, end, inside, depth, first


class _Reader(DataSourceReader):
    def __init__(self, options: Mapping[str, str]):
        self._scanning = options["pass"] == "scan"
        self._ranges = [_Range(*r) for r in json.loads(options["ranges"])]

    def partitions(self) -> Sequence[InputPartition]:
        return self._ranges

    def read(self, part: _Range) -> Iterator[tuple]:
        data = _bytes(part.path, part.start, part.end)
        escaped = _escaped_before(part.path, part.start)
        if self._scanning:
            both = [_scan(data, state, 0, escaped) for state in (False, True)]
            sums = [(int(s.depth[-1]), int(s.depth.min())) if len(s.depth) else (0, 0) for s in both]
            yield (part.path, part.start, both[0].inside, *sums[0], *sums[1])
        else:
            yield from self._rows(part, data, escaped)

    def _rows(self, part: _Range, data: bytes, escaped: int) -> Iterator[tuple]:
        """(part, rows): texts of JSON arrays of the rows that begin in the range, after the place ``first``."""
        found = _scan(data, part.inside, part.depth, escaped)
        raw = np.frombuffer(data, np.uint8)
        # The data array is at depth 2: its rows begin with the step to 3 and end with the step back; at 1 it is over.
        live = part.start + found.places > part.first
        places, depth = found.places[live], found.depth[live]
        over = np.flatnonzero(depth < 2)
        if len(over):
            places, depth = places[:over[0]], depth[:over[0]]
        opens = raw[places] == ord("[")
        begins, ends = places[opens & (depth == 3)], places[~opens & (depth == 2)]
        if not len(begins):
            return
        ends = ends[ends > begins[0]]
        at = int(begins[0])
        for end in ends.tolist():
            if end + 1 - at >= PIECE or end == ends[-1] and len(begins) == len(ends):
                yield part.path, "[" + data[at:end + 1].lstrip(b" ,\r\n\t").decode("utf-8") + "]"
                at = end + 1
        if len(begins) > len(ends):
            if len(ends) and at <= ends[-1]:
                yield part.path, "[" + data[at:int(ends[-1]) + 1].lstrip(b" ,\r\n\t").decode("utf-8") + "]"
            yield part.path, "[" + self._last_row(part, data[int(begins[-1]):]) + "]"

    @staticmethod
    def _last_row(part: _Range, row: bytes) -> str:
        """The rest of a row that goes on behind the range."""
        at = part.end
        while True:
            found = _scan(row, False, 2)
            done = np.flatnonzero(found.depth == 2)
            if len(done):
                return row[:int(found.places[done[0]]) + 1].decode("utf-8")
            more = _bytes(part.path, at, at + STEP)
            if not more:
                raise BrokenPart(f"{part.path} ends inside a row")
            row, at = row + more, at + len(more)


class ExportRanges(DataSource):
    """Option ``ranges``: JSON of (path, start, end[, inside a string, depth, place of the data]); ``pass``: scan or rows."""

    @classmethod
    def name(cls) -> str:
        return "export_ranges"

    def schema(self) -> str:
        if self.options["pass"] == "scan":
            return "part string, start bigint, flips boolean, depth_0 bigint, least_0 bigint, depth_1 bigint, least_1 bigint"
        return "part string, rows string"

    def reader(self, schema) -> DataSourceReader:
        return _Reader(dict(self.options))


def _head(path: str, size: int) -> tuple[list[str] | None, int]:
    """(columns if they come first, the place of the data array's bracket), from the beginning of a part."""
    read = STEP
    while True:
        data = _bytes(path, 0, min(read, size))
        text = data.decode("utf-8", "ignore")
        decoder, at, columns = json.JSONDecoder(), text.find("{") + 1, None
        try:
            while at:
                while text[at] in " ,\r\n\t":
                    at += 1
                if text[at] == "}":
                    return columns, size  # no data
                key, at = decoder.raw_decode(text, at)
                at = text.index(":", at) + 1
                while text[at] in " \r\n\t":
                    at += 1
                if key == "data":
                    if text[at] != "[":  # null
                        return columns, size
                    return columns, len(text[:at].encode("utf-8"))
                value, at = decoder.raw_decode(text, at)
                if key == "columns":
                    columns = value
        except (ValueError, IndexError):
            pass
        if read >= size:
            raise BrokenPart(f"{path} has no data array")
        read *= 4


def _tail_columns(path: str, end: int, size: int) -> list[str] | None:
    """The columns of a part that names them after its data, whose end is given; one document to a file."""
    read, decoder = STEP, json.JSONDecoder()
    while True:
        rest = _bytes(path, end, min(end + read, size)).decode("utf-8", "ignore").lstrip(" ,\r\n\t")
        try:
            found, at = decoder.raw_decode("{" + rest)
        except ValueError:
            if end + read >= size:
                raise BrokenPart(f"{path} ends before its document does") from None
            read *= 4
            continue
        if ("{" + rest)[at:].strip():
            raise ValueError(f"{path} holds several documents; read_export reads those")
        return found.get("columns")


def export_rows(spark: SparkSession, sizes: Mapping[str, int], range_bytes: int = RANGE) -> DataFrame:
    """(columns, row) of all rows of the parts, whose sizes in bytes are given; a part of any size is read by many tasks.

    A part that ends before its data array does raises ``BrokenPart`` with its name, before any row is delivered.
    """
    spark.dataSource.register(ExportRanges)
    heads = {path: _head(path, size) for path, size in sizes.items()}
    ranges = [(path, at, min(at + range_bytes, size)) for path, size in sizes.items() for at in range(0, size, range_bytes)]

    def load(kind: str, wanted: list) -> DataFrame:
        return spark.read.format("export_ranges").option("pass", kind).option("ranges", json.dumps(wanted)).load()

    # One row of seven numbers per range.
    scanned = {(r["part"], r["start"]): r for r in load("scan", ranges).collect()} if ranges else {}
    wanted, columns = [], {}
    for path, size in sizes.items():
        named, first = heads[path]
        inside, depth, end = False, 0, None
        for start in range(0, size, range_bytes):
            stop = min(start + range_bytes, size)
            one = scanned[path, start]
            if end is None and stop > first:
                wanted.append((path, start, stop, inside, depth, first))
            change, least = (one["depth_1"], one["least_1"]) if inside else (one["depth_0"], one["least_0"])
            # Behind the range that holds the bracket, the data end where the depth first falls below 2.
            if end is None and (start > first and depth + least < 2 or start <= first < stop):
                end = _data_end(path, start, stop, inside, depth, first)
            inside, depth = inside != one["flips"], depth + change
        if first < size and (inside or depth or end is None):
            raise BrokenPart(f"{path} ends before its data does")
        late = _tail_columns(path, end, size) if end is not None else None
        columns[path] = named or late or []
    if not wanted:
        return spark.createDataFrame([], "columns array<string>, row array<string>")
    names = F.create_map(*[x for path, found in columns.items() for x in (F.lit(path), F.array(*[F.lit(c) for c in found]).cast("array<string>"))])
    rows = load("rows", wanted).select("part", F.explode(F.from_json("rows", "array<array<string>>", {"mode": "FAILFAST"})).alias("row"))
    return rows.select(names[F.col("part")].alias("columns"), "row")


def _data_end(path: str, start: int, stop: int, inside: bool, depth: int, first: int) -> int | None:
    """The place behind the data array's last bracket, if it lies in the range."""
    found = _scan(_bytes(path, start, stop), inside, depth, _escaped_before(path, start))
    after = np.flatnonzero((start + found.places > first) & (found.depth < 2))
    return start + int(found.places[after[0]]) + 1 if len(after) else None
