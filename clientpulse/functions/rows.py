"""Row selection per key.

``row_number`` with a ``<= n`` filter is planned with a group limit on both sides of the shuffle: each
map task sends at most ``n`` rows per key, so a key that owns a third of the table stays cheap.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def newest_first(keys: Sequence[str], order: Sequence[Column]):
    return Window.partitionBy(*keys).orderBy(*order)


def total_order(df: DataFrame, keys: Sequence[str], first: Sequence[Column]) -> list[Column]:
    """``first``, then every other column, so that rows tie only if they are equal in all columns that can be sorted."""
    rest = [f.name for f in df.schema.fields if f.name not in keys and f.dataType.typeName() not in ("map", "variant")]
    return [*first, *[F.col(c).asc_nulls_last() for c in rest]]


def top_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int, rank: str = "rn") -> DataFrame:
    """The first ``n`` rows of each key under a total order, with their rank."""
    return df.withColumn(rank, F.row_number().over(newest_first(keys, order))).where(F.col(rank) <= n)


def latest_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key: the first under ``order``."""
    return top_rows(df, keys, order, 1, "_rank").drop("_rank")
