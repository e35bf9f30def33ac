"""Run check queries beside their SQL and report differences: ``python -m pulsechecks.compare SF_DIR [key ...]``."""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from datetime import date, datetime
from glob import glob
from os.path import basename

import duckdb

from pulsechecks import catalog

# Spark type name of each DuckDB type.
TYPES = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string", "BOOLEAN": "boolean",
         "DATE": "date", "TIMESTAMP": "timestamp_ntz", "VARCHAR[]": "array<string>"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob(f"{sf_dir}/*.parquet")):
        con.execute(f"CREATE VIEW {basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, float):
        if math.isnan(value):
            return "nan"
        return round(value, 6) + 0.0
    if isinstance(value, datetime):
        return value.isoformat()
    if isinstance(value, date):
        return value.isoformat()
    if isinstance(value, list):
        return tuple(plain(v) for v in value)
    return value


def spark_rows(df):
    columns = sorted(df.columns)
    types = dict(df.dtypes)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    return columns, [types[c] for c in columns], rows


def duck_rows(con, sql):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    order = sorted(range(len(names)), key=lambda j: names[j])
    rows = [tuple(plain(r[j]) for j in order) for r in result.fetchall()]
    return [names[j] for j in order], [TYPES.get(types[j], types[j]) for j in order], rows


def compare_frame(df, con, key: str) -> tuple[bool, str]:
    started = time.time()
    try:
        s_cols, s_types, s_rows = spark_rows(df)
    except Exception as error:  # report and go on with the other keys
        return False, f"spark failed: {str(error)[:600]}"
    took = time.time() - started
    try:
        d_cols, d_types, d_rows = duck_rows(con, catalog.ORACLES[key])
    except Exception as error:
        return False, f"duckdb failed: {str(error)[:600]}"
    if s_cols != d_cols:
        return False, f"columns {s_cols} vs {d_cols}"
    if s_types != d_types:
        return False, f"types {[(c, a, b) for c, a, b in zip(s_cols, s_types, d_types) if a != b]}"
    a, b = Counter(s_rows), Counter(d_rows)
    if a != b:
        return False, (f"rows {len(s_rows)} vs {len(d_rows)}; only spark {list((a - b).items())[:2]}; "
                       f"only duckdb {list((b - a).items())[:2]} {s_cols}")
    return True, f"{len(s_rows)} rows, {took:.2f}s"


def compare(spark, con, sf_dir: str, key: str) -> tuple[bool, str]:
    try:
        df = catalog.QUERIES[key](spark, sf_dir)
    except Exception as error:
        return False, f"spark failed: {str(error)[:600]}"
    return compare_frame(df, con, key)


def main(argv: list[str]) -> int:
    from clientpulse.session import build_session
    sf_dir, keys = argv[0], argv[1:]
    catalog.load()
    spark = build_session("checks", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="8",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(sf_dir)
    chosen = [k for k in catalog.QUERIES if not keys or any(k.startswith(p) for p in keys)]
    bad = 0
    for key in chosen:
        ok, text = compare(spark, con, sf_dir, key)
        bad += not ok
        print(("ok   " if ok else "DIFF ") + key + ": " + text, flush=True)
    print(f"{len(chosen) - bad} of {len(chosen)} agree")
    return bad


if __name__ == "__main__":
    sys.exit(1 if main(sys.argv[1:]) else 0)
