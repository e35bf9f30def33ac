"""Readers: Parquet tables, columnar JSON exports and landed CRM pages."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.sources import export_ranges
from clientpulse.sources.schemas import CRM_PAGE, EXPORT_PART, OWNER_PAGE, empty_table

# Filler columns an export may carry, dropped on read.
EXPORT_PADDING = ("_p1", "_p2", "_pad")


def scan(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
         where: Column | None = None) -> DataFrame:
    """Parquet table; the projection and the filter reach the file scan."""
    df = spark.read.parquet(path)
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def scan_or_empty(spark: SparkSession, path: str | None, schema: T.StructType) -> DataFrame:
    """The table at ``path``, or a typed table without rows when there is none."""
    if path is None:
        return empty_table(spark, schema)
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return empty_table(spark, schema)


def read_export(spark: SparkSession, paths: str | Sequence[str], types: Mapping[str, str],
                multi_line: bool = False) -> DataFrame:
    """Export parts ``{"columns": [...], "data": [[...], ...]}`` as one typed table.

    Each part names its own column order. ``types`` gives the wanted columns and their Spark types;
    text that does not parse becomes NULL. A part is one line of JSON, so many parts read in parallel.
    """
    raw = spark.read.schema(EXPORT_PART).json(paths, multiLine=multi_line)
    return _typed_rows(raw.select("columns", F.explode("data").alias("row")), types)


def read_large_export(spark: SparkSession, paths: str | Sequence[str], types: Mapping[str, str],
                      range_bytes: int = export_ranges.RANGE) -> DataFrame:
    """As ``read_export``, for parts of any size and layout: each is read by many tasks, by byte ranges.

    A part that breaks off raises ``BrokenPart`` with its name. A cell that holds a nested value is its compact JSON
    text. The files must be reachable from the tasks by their
    address (a shared disk, or a store that Arrow knows).
    """
    sizes: dict[str, int] = {}
    for path in [paths] if isinstance(paths, str) else paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        for status in sorted(files.globStatus(place) or (), key=lambda s: s.getPath().toString()):
            inside = files.listStatus(status.getPath()) if status.isDirectory() else [status]
            sizes.update({s.getPath().toString(): s.getLen() for s in inside
                          if s.getLen() and not s.getPath().getName().startswith(("_", "."))})
    return _typed_rows(export_ranges.export_rows(spark, sizes, range_bytes), types)


def _typed_rows(rows: DataFrame, types: Mapping[str, str]) -> DataFrame:
    cell = {name: F.try_element_at(F.col("row"), F.nullif(F.array_position("columns", name), F.lit(0)).cast("int"))
            for name in types if name not in EXPORT_PADDING}
    return rows.select(*[cell[name].try_cast(types[name]).alias(name) for name in cell])


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Parts of one export stacked by column name."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def read_crm_pages(spark: SparkSession, path: str | Sequence[str], properties: Sequence[str]) -> DataFrame:
    """Landed list pages as one row per object: id, wanted properties, first associated company.

    ``properties`` values stay text; the normalisers parse them.
    """
    pages = spark.read.schema(CRM_PAGE).json(path)
    obj = pages.select(F.explode("results").alias("o"))
    props = F.struct(*[F.try_element_at(F.col("o.properties"), F.lit(p)).alias(p) for p in properties])
    return obj.select(F.col("o.id").alias("id"), props.alias("properties"),
                      F.try_element_at(F.col("o.associations.companies.results"), F.lit(1))["id"].alias("company_id"))


def read_owner_pages(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Landed owner pages as one row per owner with its names and e-mail."""
    pages = spark.read.schema(OWNER_PAGE).json(path)
    return pages.select(F.inline("results")).select(
        "id", F.col("firstName").alias("firstname"), F.col("lastName").alias("lastname"), "email")
