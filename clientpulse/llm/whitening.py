"""Whitening of embeddings with a covariance by polarisation.

Entries become whole numbers. Two passes over the different vectors (the fit list) are all the corpus work: the first
sums every dimension, the second adds up the squares of every centred dimension and of the centred sum of every pair of
dimensions. As var(a + b) = var(a) + var(b) + 2 cov(a, b), differences of those variances are all cross-covariances.
Every task sends one number per dimension or pair, so what is shuffled and what the driver assembles for ``eigh`` is
bounded by the width of the vectors, not by their number.

The sums are exact: a dimension is centred at the whole part of its mean, which leaves small whole numbers, and the
fraction that is left (``rest / n``) is taken off in whole numbers on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.llm.stored import stored

SCALE = 64
SHIFT = 1_000_000
COMPONENTS = 16
#: Entries of this size or more do not fit a long once scaled.
LIMIT = 2.0 ** 55
#: Rows squared at once, and the largest whole number that may be summed as a long; both only bound memory and error.
BLOCK = 1 << 10
EXACT = 1 << 62
WIDE = T.DecimalType(38, 0)


@dataclass(frozen=True)
class Whitening:
    """``base + rest / n`` is the mean; rows of ``axes`` are the components, divided by the root of their eigenvalue."""

    n: int
    base: tuple[int, ...]
    rest: tuple[int, ...]
    axes: np.ndarray
    explained: np.ndarray
    identity_error: float


def coded(vectors: DataFrame, embedding: str) -> DataFrame:
    """``row`` (all columns) and ``x``: floor(64 * entry) + 1000000 per entry, as longs.

    Left out are vectors that are null, empty, or hold entries that are null, not finite, or 2^55 and more in size.
    """
    finite = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(LIMIT)))
    packed = vectors.select(F.struct("*").alias("row"), F.col(embedding).cast("array<double>").alias("v"))
    usable = packed.where(F.col("v").isNotNull() & (F.size("v") > 0)).where(finite)
    return usable.select("row", F.transform("v", lambda c: F.floor(c * F.lit(float(SCALE))).cast("long") + F.lit(SHIFT)).alias("x"))


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _total(y: np.ndarray) -> list[int]:
    """Exact sums over the rows."""
    if int(np.abs(y).max(initial=0)) * len(y) < EXACT:
        return y.sum(axis=0).tolist()
    return y.astype(object).sum(axis=0).tolist()


def _squares(y: np.ndarray) -> list[int]:
    """Exact sums over the rows of the squares: of each dimension, then of each pair's sum (i < j, by i, then j)."""
    largest = int(np.abs(y).max(initial=0))
    if (2 * largest) ** 2 * len(y) >= EXACT:
        y = y.astype(object)
    parts = [(y * y).sum(axis=0)]
    parts += [((y[:, i:i + 1] + y[:, i + 1:]) ** 2).sum(axis=0) for i in range(y.shape[1] - 1)]
    return [int(v) for part in parts for v in part]


def _summed(fit: DataFrame, width: int, base: np.ndarray, numbers) -> list[int]:
    """``numbers`` of all blocks of the fit list, added up exactly: each task sends one row per number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[int] = []
        for batch in batches:
            y = _matrix(batch.column(0), width) - base
            for at in range(0, len(y), BLOCK):
                found = numbers(y[at:at + BLOCK])
                held = [a + b for a, b in zip(held, found)] if held else found
        if held:
            values = pa.array([Decimal(v) for v in held], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(held), dtype=np.int32)), values], names=["place", "value"])

    parts = fit.select("x").mapInArrow(run, T.StructType([T.StructField("place", T.IntegerType()), T.StructField("value", WIDE)]))
    found = parts.groupBy("place").agg(F.sum("value").cast(WIDE).alias("value")).collect()
    return [int(r["value"]) for r in sorted(found, key=lambda r: r["place"])]


def covariance(n: int, rest: list[int], squares: list[int]) -> np.ndarray:
    """The covariance matrix (divisor ``n``) out of the sums of ``_squares``, by polarisation.

    A variance times n^2 is n * (sum of squares) - (sum)^2, and the sums are the rests: all whole numbers, so that the
    difference of variances is exact and is rounded once, when it is divided.
    """
    width = len(rest)
    var = [n * q - r * r for q, r in zip(squares, rest)]
    matrix = np.empty((width, width))
    place = width
    for i in range(width):
        matrix[i, i] = var[i] / (n * n)
        for j in range(i + 1, width):
            both = n * squares[place] - (rest[i] + rest[j]) ** 2
            matrix[i, j] = matrix[j, i] = (both - var[i] - var[j]) / (2 * n * n)
            place += 1
    return matrix


def _projected(x: np.ndarray, base: np.ndarray, mean_rest: np.ndarray, axes: np.ndarray) -> np.ndarray:
    return ((x - base) - mean_rest) @ axes.T


def fit(vectors: DataFrame, embedding: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the different vectors of a table; None if there is no vector.

    Of vectors of several lengths the most frequent length counts (the longer of equally frequent ones). Components
    without variance are left out, as nothing can be divided by their eigenvalue; at most ``components`` stay. The sign
    of a component is that of its largest entry.
    """
    distinct = stored(coded(vectors, embedding).select("x").distinct(), "whitening-fit")
    widths = distinct.groupBy(F.size("x").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    if widths is None:
        return None
    width, n = widths["width"], widths["count"]
    own = distinct.where(F.size("x") == width)
    sums = _summed(own, width, np.zeros(width, np.int64), _total)
    base, rest = [s // n for s in sums], [s % n for s in sums]
    matrix = covariance(n, rest, _summed(own, width, np.array(base, np.int64), _squares))
    values, columns = np.linalg.eigh(matrix)
    kept = [k for k in np.argsort(-values, kind="stable")[:components] if values[k] > values.max() * width * 1e-14]
    axes = columns[:, kept].T
    axes = axes * np.sign(axes[np.arange(len(kept)), np.abs(axes).argmax(axis=1)])[:, None] if kept else axes
    model = Whitening(n, tuple(base), tuple(rest), axes / np.sqrt(values[kept])[:, None],
                      values[kept] / np.trace(matrix), 0.0)
    error = identity_error(own, model) if kept else 0.0
    return Whitening(n, model.base, model.rest, model.axes, model.explained, error)


def identity_error(distinct: DataFrame, model: Whitening) -> float:
    """The largest difference between the covariance of the whitened fit list, measured, and the identity."""
    wide, many = len(model.base), len(model.axes)
    base, mean_rest, axes = np.array(model.base, np.int64), np.array([r / model.n for r in model.rest]), model.axes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, products = np.zeros(many), np.zeros((many, many))
        for batch in batches:
            w = _projected(_matrix(batch.column(0), wide), base, mean_rest, axes)
            total, products = total + w.sum(axis=0), products + w.T @ w
        values = np.concatenate([total, products.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], names=["place", "value"])

    found = distinct.select("x").mapInArrow(run, "place int, value double").groupBy("place").agg(F.sum("value").alias("value"))
    sums = np.array([r["value"] for r in sorted(found.collect(), key=lambda r: r["place"])]) / model.n
    mean, products = sums[:many], sums[many:].reshape(many, many)
    return float(np.abs(products - np.outer(mean, mean) - np.eye(many)).max())


def applied(vectors: DataFrame, model: Whitening | None, embedding: str = "embedding", keep: list[str] | None = None) -> DataFrame:
    """(row, deviation, whitened) per usable vector of the fitted length.

    ``row`` holds the columns ``keep`` (all by default), ``deviation`` is the exact sum over the dimensions of
    (n * x - S)^2 as a decimal, and ``whitened`` the values of the components. Repeated rows are each a row; without a
    model there are no rows.
    """
    rows = coded(vectors, embedding)
    if keep is not None:
        rows = rows.withColumn("row", F.struct(*[F.col("row")[k].alias(k) for k in keep]))
    shape = T.StructType([rows.schema["row"], T.StructField("straight", WIDE), T.StructField("crossed", WIDE),
                          T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    if model is None:
        model = Whitening(1, (0,), (0,), np.zeros((0, 1)), np.zeros(0), 0.0)
        rows = rows.where(F.lit(False))
    n, many, wide = model.n, len(model.axes), len(model.base)
    base, rest = np.array(model.base, np.int64), np.array(model.rest, np.int64)
    mean_rest, axes = np.array([r / n for r in model.rest]), model.axes
    names = shape.names

    def exact(values: np.ndarray) -> pa.Array:
        if values.dtype != object:
            return pa.array(values).cast(pa.decimal128(38, 0))
        return pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(1), wide) - base
            largest = int(np.abs(y).max(initial=0))
            small = largest * max(largest, n) * wide < EXACT
            whole = y if small else y.astype(object)
            projected = _projected(y, np.zeros(wide, np.int64), mean_rest, axes)
            lists = pa.ListArray.from_arrays(np.arange(0, len(y) * many + 1, many, dtype=np.int32) if many else
                                             np.zeros(len(y) + 1, np.int32), projected.ravel())
            yield pa.RecordBatch.from_arrays([batch.column(0), exact((whole * whole).sum(axis=1)),
                                              exact((whole * rest).sum(axis=1)), lists], names=names)

    found = rows.where(F.size("x") == wide).select("row", "x").mapInArrow(run, shape)
    # sum (n y - r)^2 = n^2 sum y^2 - 2 n sum r y + sum r^2
    return found.select("row", (_wide(n * n) * F.col("straight") - _wide(2 * n) * F.col("crossed")
                                + _wide(sum(r * r for r in model.rest))).cast(WIDE).alias("deviation"), "whitened")


def _wide(value: int) -> Column:
    return F.lit(Decimal(value)).cast(WIDE)


def by_component(found: DataFrame, model: Whitening | None) -> DataFrame:
    """One row per vector and component: component (from 1), n, deviation, whitened, explained, identity_error.

    ``deviation`` is a long and null where it is too large for one; the rows of ``applied`` have it as a decimal.
    """
    model = model or Whitening(0, (), (), np.zeros((0, 0)), np.zeros(0), 0.0)
    shares = F.array(*[F.lit(float(e)) for e in model.explained]) if len(model.explained) else F.array().cast("array<double>")
    rows = found.select("row", "deviation", F.posexplode("whitened").alias("place", "whitened"))
    return rows.select("row", (F.col("place") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"),
                       F.col("deviation").try_cast("long").alias("deviation"), "whitened",
                       F.try_element_at(shares, F.col("place") + 1).alias("explained"),
                       F.lit(model.identity_error).alias("identity_error"))
