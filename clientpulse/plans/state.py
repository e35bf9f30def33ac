"""The newest rows per key, kept from run to run.

"Newest n per key" of a fact that grows by a partition a day (or a month) needs no scan of its history: the newest n up to
a day are among the newest n up to an earlier day and the rows of the days since. A state is that small table as of one
partition value; a run merges the last state with the partitions after it.

A write to a partition makes every state from that value on wrong, so writers call ``forget_from`` before they publish
(``Lake`` does). What is left is an earlier state, or none: the next run then reads more partitions and is right all the
same. So late partitions, partitions written again with fewer rows, and lost states need no case of their own.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession

from clientpulse.functions.rows import top_rows
from clientpulse.session import remove_path

#: States kept per table: a write into the past falls back on the one before it.
KEPT = 8


@dataclass(frozen=True)
class NewestRows:
    """The newest ``n`` rows per key of a table that is stored by partitions.

    ``read(after, last)`` gives the rows of the partitions after ``after`` (None: from the first) up to ``last``.
    Partition values must sort as text as they do in time (ISO dates or months). ``order`` gives the order of rows
    within a key, newest first; it must agree with the order of the partitions.
    """

    read: Callable[[str | None, str], DataFrame]
    path: str
    keys: tuple[str, ...]
    order: Callable[[DataFrame], list[Column]]
    n: int
    columns: tuple[str, ...] | None = None

    def kept(self, spark: SparkSession) -> list[str]:
        """The values with a complete state, oldest first."""
        folder = spark._jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return []
        done = [s.getPath() for s in files.listStatus(folder) if s.isDirectory()]
        marker = spark._jvm.org.apache.hadoop.fs.Path
        return sorted(p.getName().removeprefix("upto-") for p in done if files.exists(marker(p, "_SUCCESS")))

    def _folder(self, value: str) -> str:
        return f"{self.path}/upto-{value}"

    def forget_from(self, spark: SparkSession, value: str) -> None:
        """Drop the states that know of partitions from ``value`` on."""
        for known in self.kept(spark):
            if known >= value:
                remove_path(spark, self._folder(known))

    def upto(self, spark: SparkSession, last: str, within: Column | None = None, before: str | None = None) -> DataFrame:
        """The newest rows per key of all partitions up to ``last``.

        Reads the newest state up to ``last`` (earlier than ``before``, if given) and the partitions after it. ``within``
        is a condition on the rows of those partitions; it must hold for all rows of the state's partitions.
        """
        usable = [v for v in self.kept(spark) if v <= last and (before is None or v < before)]
        rows = self.read(usable[-1] if usable else None, last)
        names = list(self.columns or rows.columns)
        rows = (rows if within is None else rows.where(within)).select(*names)
        if usable:
            # A column that the table has got since is NULL in older rows.
            state = spark.read.parquet(self._folder(usable[-1]))
            rows = state.unionByName(rows, allowMissingColumns=True).select(*names)
        return top_rows(rows, list(self.keys), self.order(rows), self.n, "_newest").drop("_newest")

    def record(self, spark: SparkSession, last: str) -> None:
        """Keep the state as of ``last``; the oldest states go."""
        if last in self.kept(spark):
            return
        self.upto(spark, last).write.mode("overwrite").parquet(self._folder(last))
        for value in self.kept(spark)[:-KEPT]:
            remove_path(spark, self._folder(value))
