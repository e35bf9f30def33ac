"""A folder of Parquet tables and the writes that the runs need.

Every table that a run writes is published by version (``sources/versions.py``): it can be read at any moment, and a run
that dies leaves the version before.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.functions.rows import latest_rows, total_order
from clientpulse.operators.alerts import newest_score
from clientpulse.operators.features import newest_sent
from clientpulse.plans.state import NewestRows
from clientpulse.session import remove_path, scratch_path
from clientpulse.sources import schemas, writers
from clientpulse.sources.versions import DAY, LOG, Prepared, Version, VersionedTable

# The one layout of each fact that several runs write: its partition column and its key.
LAYOUT = {
    "fct_health_score": ("calculated_at", ("client_id", "calculated_at", "period_days")),
    "fct_alerts": ("alert_date", ("client_id", "alert_id", "alert_date")),
    "fct_csm_activity_weekly": ("week_start", ("csm_owner", "week_start")),
    "fct_coverage_monthly": ("year_month", ("csm_owner", "year_month")),
    "fct_revenue_retention_monthly": ("year_month", ("year_month",)),
}
# Declared columns of the raw tables; keys may be numbers or text, so they keep the type of the files.
RAW = {
    "companies": schemas.COMPANIES, "deals": schemas.DEALS, "calls": schemas.CALLS, "nps": schemas.NPS,
    "campaigns": schemas.CAMPAIGNS, "automations": schemas.AUTOMATIONS, "chat": schemas.CHAT,
    "messages_monthly": schemas.MESSAGES_MONTHLY, "client_config": schemas.CLIENT_CONFIG,
}
# The month a raw fact may be stored by.
MONTH = "sent_month"
# Newest rows that are kept from run to run: partition, key, order, how many, columns (None: all).
NEWEST = {
    "fct_health_score": ("calculated_at", ("client_id", "period_days"), newest_score, 2, None),
    "campaigns": (MONTH, ("client_id",), lambda df: newest_sent("sent_at", "campaign_id"), 3,
                  ("client_id", "campaign_id", "sent_at", "revenue_attributed", "cost")),
    "whatsapp_campaign_results": (MONTH, ("company_id",), lambda df: newest_sent("whatsapp_campaign_sent_at", "campaign_id"), 3,
                                  ("company_id", "campaign_id", "whatsapp_campaign_sent_at", "campaign_roi")),
}
KEYS = ("client_id", "hubspot_company_id", "campaign_id", "automation_id", "deal_id", "call_id", "response_id")


@dataclass(frozen=True)
class Lake:
    spark: SparkSession
    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"

    def table(self, name: str) -> VersionedTable:
        return VersionedTable(self.spark, self.path(name))

    def read(self, name: str, schema: T.StructType | None = None) -> DataFrame:
        """The current version of a table, or the plain Parquet folder that others have written there.

        A schema also allows a plain folder whose partitions are all empty. Raw tables come with their declared columns
        and types: absent columns are NULL, further ones are not read, but for the month they are stored by.
        """
        table = self.table(name)
        version = table.current()
        if version is not None:
            found = table.read(version)
        else:
            reader = self.spark.read if schema is None else self.spark.read.schema(_nullable(schema))
            plain = table.plain()
            if plain is None:
                found = reader.parquet(self.path(name))
            else:  # a first write that died before it was published; without other files this fails as an absent path
                found = reader.option("basePath", self.path(name)).parquet(*(plain or [f"{self.path(name)}/{LOG}"]))
        if schema is None and name in RAW:
            months = [MONTH] if MONTH in found.columns else []
            return found.select(*schemas.conformed(found, RAW[name], keep_types=KEYS), *months)
        return found

    def between(self, name: str, partition: str, after: str | None, last: str) -> DataFrame:
        """The rows of the partitions after ``after`` and up to ``last``; the others are not touched."""
        table = self.table(name)
        version = table.current()
        if version is not None and version.partition == partition:
            found = table.read(version, lambda value: (after is None or value > after) and value <= last)
            return found.select(*[c for c in self.read(name).columns if c in found.columns])
        found = self.read(name)
        kind = found.schema[partition].dataType
        wanted = F.col(partition) <= F.lit(last).cast(kind)
        return found.where(wanted if after is None else wanted & (F.col(partition) > F.lit(after).cast(kind)))

    def read_or_none(self, name: str, schema: T.StructType | None = None) -> DataFrame | None:
        try:
            return self.read(name, schema)
        except AnalysisException as error:
            if error.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
            return None

    def overwrite(self, df: DataFrame, name: str) -> DataFrame:
        """Replace the table in its layout and return it as read back, so that later steps start from files."""
        table = self.table(name)
        prepared = table.prepare(df, LAYOUT[name][0] if name in LAYOUT else None)
        self._forget(name, "")
        table.replace(prepared)
        return self.read(name, df.schema)

    def land(self, df: DataFrame, name: str) -> DataFrame | None:
        """Replace a raw table, unless nothing has landed: then the table, if there is one, stays as it is."""
        table = self.table(name)
        prepared = table.prepare(df)
        if table.rows_of(prepared).isEmpty():
            table.discard(prepared)
            return self.read_or_none(name)
        table.replace(prepared)
        return self.read(name, df.schema)

    def land_months(self, df: DataFrame, name: str, moment: str) -> DataFrame:
        """Store a raw fact by the calendar month of ``moment``: the months that ``df`` has rows of are replaced whole.

        A correction of an old month brings all rows of that month. Rows without a moment are a month of their own.
        """
        return self.replace_snapshot(df.withColumn(MONTH, F.date_format(moment, "yyyy-MM")), name, MONTH)

    def replace_snapshot(self, df: DataFrame, name: str, column: str) -> DataFrame:
        """Replace the partitions that ``df`` has rows of."""
        self._change(name, df, column, VersionedTable.replace_partitions)
        return self.read(name, df.schema)

    def append_unseen(self, df: DataFrame, name: str) -> DataFrame:
        """Append the rows whose key is new, NULL being a value like others. Only the partitions that ``df`` touches are
        read for their keys; of several new rows of a key the first in the order of all columns stays."""
        partition, keys = LAYOUT[name]
        with self.staged(latest_rows(df, keys, total_order(df, keys, [])), name) as rows:
            existing = self.touched(name, rows, partition)
            unseen = rows if existing is None else writers.unseen_rows(existing, rows, keys, null_safe=True)
            self._change(name, unseen, partition, VersionedTable.append)
        return self.read(name, df.schema)

    def upsert(self, df: DataFrame, name: str) -> DataFrame:
        """Replace rows by key, NULL being a value like others. Only the touched partitions are read and written."""
        partition, keys = LAYOUT[name]
        with self.staged(df, name) as rows:
            existing = self.touched(name, rows, partition)
            order = total_order(rows, keys, [])
            merged = (latest_rows(rows, keys, order) if existing is None
                      else writers.upsert(existing, rows, keys, order, null_safe=True))
            return self.replace_snapshot(merged, name, partition)

    def touched(self, name: str, new: DataFrame, partition: str) -> DataFrame | None:
        """The partitions of a table that ``new`` has rows for, or None when there is no table yet.

        Partitions are days, weeks or months, so their list is bounded by the calendar; as literals they
        prune the file listing.
        """
        existing = self.read_or_none(name, new.schema)
        if existing is None:
            return None
        values = [r[0] for r in new.select(partition).distinct().collect()]
        wanted = F.col(partition).isin([v for v in values if v is not None])
        return existing.where(wanted | F.col(partition).isNull() if None in values else wanted)

    def clean(self, name: str, age: float = 7 * DAY) -> list[str]:
        """Delete versions of a table that were replaced more than ``age`` seconds ago."""
        return self.table(name).clean(age)

    def newest(self, name: str) -> NewestRows | None:
        """The kept newest rows of a fact, or None where it is not stored by the partition they go by."""
        found = self.read_or_none(name) if name in NEWEST else None
        if found is None or NEWEST[name][0] not in found.columns:
            return None
        return self._state(name)

    def _state(self, name: str) -> NewestRows:
        partition, keys, order, n, columns = NEWEST[name]
        return NewestRows(lambda after, last: self.between(name, partition, after, last), self.path(f"state_{name}"), keys, order,
                          n, columns)

    def _change(self, name: str, df: DataFrame, column: str, publish: Callable[[VersionedTable, Prepared, Version | None], Version]) -> None:
        """Write rows by partition and publish them; a plain folder is first taken over as a version."""
        table = self.table(name)
        version = table.current()
        if version is None and (plain := self.read_or_none(name, df.schema)) is not None:
            version = table.replace(table.prepare(plain, column))
        prepared = table.prepare(df, column)
        if values := prepared.values():
            self._forget(name, values[0])
        publish(table, prepared, version)

    def _forget(self, name: str, value: str) -> None:
        """Drop the kept states that a write to the partitions from ``value`` on makes wrong."""
        if name in NEWEST:
            self._state(name).forget_from(self.spark, value)

    @contextmanager
    def staged(self, df: DataFrame, name: str) -> Iterator[DataFrame]:
        """A written copy in the shared folder for as long as a write needs it: later steps neither recompute it nor
        depend on an executor. It is removed once they have succeeded and left behind, as a trace, if they fail.
        """
        path = scratch_path(self.spark, f"stage-{name}")
        writers.overwrite_table(df, path)
        yield self.spark.read.schema(_nullable(df.schema)).parquet(path)
        remove_path(self.spark, path)


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
