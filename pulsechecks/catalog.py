"""Every check query with the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from pulsechecks.inputs import Inputs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Input frames of each session and folder. They are plans, not data: nothing is computed or kept between runs.
_inputs: WeakKeyDictionary[SparkSession, dict[str, Inputs]] = WeakKeyDictionary()


def inputs_for(spark: SparkSession, sf_dir: str) -> Inputs:
    folders = _inputs.setdefault(spark, {})
    if sf_dir not in folders:
        folders[sf_dir] = Inputs(spark, sf_dir)
    return folders[sf_dir]


def check(key: str, sql: str):
    """Register ``fn(inputs)`` under ``key`` with its SQL counterpart."""
    def register(fn: Callable[[Inputs], DataFrame]):
        if key in QUERIES:
            raise ValueError(f"duplicate key {key}")
        QUERIES[key] = lambda spark, sf_dir: fn(inputs_for(spark, sf_dir))
        ORACLES[key] = sql
        return fn
    return register


def load() -> None:
    """Import the modules that register the queries."""
    from pulsechecks import activity, dimensions, features, reports, revenue, scalars, scores, tables  # noqa: F401
