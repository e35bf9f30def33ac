"""Table maintenance.

The ``insert_*`` and ``upsert`` functions return the resulting table and leave the inputs alone; write it to
a fresh path, since Spark cannot overwrite what the same plan reads.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientpulse.functions.rows import latest_rows
from clientpulse.session import remove_path, scratch_path


def gathered(df: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    """Rows brought together by partition, so that each partition becomes a few files and not one per task.

    The rebalance step splits large partitions and joins small ones by their measured sizes.
    """
    return df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df


def overwrite_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Replace the whole table."""
    df = gathered(df, partition_by)
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partition_by).parquet(path)


def write_ordered(df: DataFrame, path: str, order: Sequence[Column | str], files: int | None = None) -> None:
    """Write rows so that the files, by name, and the rows within each are in order.

    A range partitioning samples its input first and reads it again to deal it out. So the rows are written to the
    shared folder once, in no order, and sampled and dealt from there: what computes them runs a single time. ``files``
    says how many files there are at most; otherwise Spark decides by the rows' size.
    """
    staged = scratch_path(df.sparkSession, "to-order")
    overwrite_table(df, staged)
    rows = df.sparkSession.read.schema(df.schema).parquet(staged)
    dealt = rows.repartitionByRange(files, *order) if files else rows.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
    remove_path(df.sparkSession, staged)


def replace_snapshot(df: DataFrame, path: str, snapshot_column: str = "calculated_at") -> None:
    """Replace only the snapshots present in ``df``; other partitions stay as they are."""
    (gathered(df, [snapshot_column]).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
       .partitionBy(snapshot_column).parquet(path))


def remove_snapshot(df: DataFrame, snapshot: date, snapshot_column: str = "calculated_at") -> DataFrame:
    return df.where(~F.col(snapshot_column).eqNullSafe(F.lit(snapshot)))


def _without(rows: DataFrame, known: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """The rows whose key is not among the known ones."""
    slim = known.select(*[F.col(k).alias(f"known_{n}") for n, k in enumerate(keys)])
    same = F.lit(True)
    for n, key in enumerate(keys):
        left, right = F.col(key), F.col(f"known_{n}")
        same = same & (left.eqNullSafe(right) if null_safe else left == right)
    return rows.join(slim, same, "left_anti")


def _one_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    return latest_rows(df, keys, order) if order else df.dropDuplicates(list(keys))


def insert_or_ignore(existing: DataFrame, new: DataFrame, keys: Sequence[str],
                     order: Sequence[Column] | None = None) -> DataFrame:
    """``existing`` plus the new rows whose key is not there yet.

    ``order`` says which of several new rows with one key comes first.
    """
    fresh = _one_per_key(new, keys, order).join(existing.select(*keys), list(keys), "left_anti")
    return existing.unionByName(fresh, allowMissingColumns=True)


def upsert(existing: DataFrame, new: DataFrame, keys: Sequence[str],
           order: Sequence[Column] | None = None, null_safe: bool = False) -> DataFrame:
    """``existing`` with rows replaced by the new row of the same key; ``null_safe`` makes NULL equal to NULL."""
    fresh = _one_per_key(new, keys, order)
    return _without(existing, fresh, keys, null_safe).unionByName(fresh, allowMissingColumns=True)


def unseen_rows(existing: DataFrame, new: DataFrame, keys: Sequence[str], null_safe: bool = False) -> DataFrame:
    """The new rows whose key does not occur in ``existing``; ``null_safe`` makes NULL equal to NULL."""
    return _without(new, existing, keys, null_safe)


def append_unseen(existing: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Append without checking duplicates inside ``new``."""
    return existing.unionByName(unseen_rows(existing, new, keys), allowMissingColumns=True)


def resolve_owner_names(df: DataFrame, owners: DataFrame, column: str = "csm_owner") -> DataFrame:
    """Replace owner ids by names; ids without an owner stay. ``owners`` has owner_id (unique), owner_name."""
    names = owners.select(F.col("owner_id").cast("string").alias(column), F.col("owner_name").alias("_name"))
    return (df.join(names, column, "left")
              .withColumn(column, F.coalesce("_name", column)).select(*df.columns))


def keep_active(fact: DataFrame, clients: DataFrame, key: str = "client_id") -> DataFrame:
    """Rows of a fact whose client is in the filtered dimension."""
    return fact.join(clients.select(key), key, "left_semi")


def append_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    gathered(df, partition_by).write.mode("append").partitionBy(*partition_by).parquet(path)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
