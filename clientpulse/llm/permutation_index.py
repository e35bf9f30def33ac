"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots. In each shard of the vectors the orders are posted in
inverted files, one per pivot, with the pivot's place in the order. A query adds up, along the files of its own nearest
pivots, how far the places are apart (the footrule distance; a vector missing from a file counts as if the pivot came
after its whole order), and the closest candidates are reranked by their exact inner product.

Inner products are not distances where vectors differ in length. So each vector gets one more component that brings all
to the length of the longest, and queries get a zero there: nearest by distance is then largest by inner product, and
long vectors come first in the lists of pivots as they do in the result.

Equal vectors are one entry of the index, with the smallest ids that can be among the neighbours of a query: a group of
copies, however large, neither crowds others out of the candidates nor loses the ids that are asked for.

Vectors are dealt to shards by a hash, so a shard is of bounded size and no vector or group of vectors makes one large;
queries pass through each shard as a stream, and the best of all shards are merged. What does not fit is never held:
a task keeps one shard and one batch of queries.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.llm.stored import stored

PIVOTS = 128
#: Pivots of a vector that are posted, and those of a query that are looked up.
POSTED = 64
LOOKED_UP = 32
#: Share of a shard's vectors that is reranked, and the least number: with a recall of at least 0.94 measured on
#: vectors of little structure, of equal and of uneven lengths.
RERANKED = 0.2
LEAST_RERANKED = 1000
SHARD_ROWS = 10_000
#: Parts of a group of equal vectors whose smallest ids are found apart first.
PARTS = 16
NEIGHBOURS = 20
EVERY = 20


def usable(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): one double vector per id.

    Left out are rows without id, and vectors that are null, empty, zero or hold null or non-finite components. Of
    several vectors of one id the smallest (as an array) counts; of several lengths the most frequent, then the
    shortest, so that inner products exist.
    """
    v = F.col("v")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    rows = (vectors.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(embedding).cast("array<double>").alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .where(finite).where(F.exists(v, lambda x: x != 0)))
    width = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), "width").first()
    if width is not None:
        rows = rows.where(F.size("v") == width["width"])
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def entries(rows: DataFrame, wanted: int) -> DataFrame:
    """(entry, vec_id, v): of each group of equal vectors the ``wanted`` + 1 smallest ids, ``entry`` being the smallest.

    That is one more than a query asks for, as it leaves itself out. Ids are ranked in parts of a group before the
    group, and Spark limits ranks on both sides of the shuffle, so no task reads a whole group.
    """
    part = F.pmod(F.xxhash64("vec_id"), F.lit(PARTS))
    few = rows.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("v", "part").orderBy("vec_id")))
    few = few.where(F.col("place") <= wanted + 1).drop("part", "place")
    few = few.withColumn("place", F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))).where(F.col("place") <= wanted + 1)
    return few.select(F.min("vec_id").over(Window.partitionBy("v")).alias("entry"), "vec_id", "v")


def choose_pivots(vectors: DataFrame, n: int = PIVOTS) -> np.ndarray:
    """Up to ``n`` different vectors by the order of a hash of their id; that sample is all the index is fitted on."""
    sample = vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(4 * n).select("v").collect()
    chosen = list(dict.fromkeys(tuple(r["v"]) for r in sample))[:n]
    return np.array(chosen, float)


def lengthened(vectors: np.ndarray, length: float) -> np.ndarray:
    """The vectors with a component more, that gives all of them one length."""
    rest = length * length - (vectors * vectors).sum(axis=1)
    return np.hstack([vectors, np.sqrt(np.maximum(rest, 0))[:, None]])


def orders(vectors: np.ndarray, pivots: np.ndarray, length: int) -> np.ndarray:
    """Per vector its nearest pivots (by inner product), nearest first; equal ones by number."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :length]


class Shard:
    """The inverted files of some vectors, in ascending order of their ids; ``copies`` are (id, further id) of equal ones.

    ``pivots`` are lengthened; vectors and queries are as they were given.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: np.ndarray, posted: int = POSTED,
                 copies: tuple[np.ndarray, np.ndarray] | None = None):
        self.ids, self.vectors, self._pivots = ids, vectors, pivots
        at, further = (np.searchsorted(ids, copies[0]), copies[1]) if copies else (np.zeros(0, int), np.zeros(0, int))
        at = np.concatenate([np.arange(len(ids)), at])
        self._members = np.concatenate([ids, further])[np.argsort(at, kind="stable")]
        self._counts = np.bincount(at, minlength=len(ids))
        self._firsts = np.cumsum(self._counts) - self._counts
        self._posted = min(posted, len(pivots))
        length = float(np.sqrt((pivots * pivots).sum(axis=1).max()))
        order = orders(lengthened(vectors, length), pivots, self._posted)
        by_pivot = np.argsort(order.reshape(-1), kind="stable")
        self._rows, self._places = np.divmod(by_pivot, self._posted)
        self._starts = np.searchsorted(order.reshape(-1)[by_pivot], np.arange(len(pivots) + 1))

    def footrule(self, query_order: np.ndarray) -> np.ndarray:
        """Per vector the sum over the query's pivots of the distance between the places."""
        total = np.full(len(self.ids), int((self._posted - np.arange(len(query_order))).sum()))
        for place, pivot in enumerate(query_order.tolist()):
            post = slice(self._starts[pivot], self._starts[pivot + 1])
            total[self._rows[post]] += np.abs(self._places[post] - place) - (self._posted - place)
        return total

    def _with_copies(self, rows: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of some entries, each with its entry's score."""
        counts = self._counts[rows]
        within = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        return self._members[np.repeat(self._firsts[rows], counts) + within], np.repeat(score, counts)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, wanted: int, looked_up: int,
               share: float, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query id, vec_id, score) of the best ``wanted`` candidates of each query, itself left out."""
        found = []
        enough = min(len(self.ids), max(ceil(share * len(self.ids)), least, wanted) + 1)
        look = orders(queries, self._pivots[:, :-1], min(looked_up, self._posted))
        for query_id, query, order in zip(query_ids.tolist(), queries, look):
            # The place in the shard decides among equal distances: ids ascend.
            near = self.footrule(order) * len(self.ids) + np.arange(len(self.ids))
            rows = np.argpartition(near, enough - 1)[:enough] if enough < len(near) else np.arange(len(near))
            score = (self.vectors[rows] * query).sum(axis=1)
            if len(rows) > wanted + 1:  # each entry has a member at least, and one may be the query
                best = score >= np.partition(score, len(score) - wanted - 1)[len(score) - wanted - 1]
                rows, score = rows[best], score[best]
            ids, score = self._with_copies(rows, score)
            other = ids != query_id
            ids, score = ids[other], score[other]
            best = np.lexsort((ids, -score))[:wanted]
            found.append((np.full(len(best), query_id), ids[best], score[best]))
        return tuple(np.concatenate(part) for part in zip(*found))


def nearest(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", every: int = EVERY,
            wanted: int = NEIGHBOURS, pivots: int = PIVOTS, posted: int = POSTED, looked_up: int = LOOKED_UP,
            share: float = RERANKED, least: int = LEAST_RERANKED, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score): for each vector whose id is divisible by ``every`` its nearest others.

    Nearness is the largest inner product in double precision, ties to the smaller vec_id. See ``usable`` for the
    vectors that take no part. A query meets every vector; a table of fewer vectors gives shorter lists, an empty
    table none. Other columns are not read.
    """
    rows = stored(usable(vectors, vec_id, embedding), "permutation-vectors")
    kept = stored(entries(rows, wanted), "permutation-entries")
    heads = kept.where(F.col("vec_id") == F.col("entry"))
    squared = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    seen = heads.agg(F.count(F.lit(1)).alias("n"), F.max(F.sqrt(squared)).alias("length")).first()
    n, chosen = seen["n"], choose_pivots(heads, pivots)
    if n:
        chosen = lengthened(chosen, seen["length"])
    shards = max(1, ceil(n / shard_rows))
    first = F.col("vec_id") == F.col("entry")
    # Of equal vectors only the entry's own row carries the vector.
    home = kept.select(F.pmod(F.xxhash64("entry"), F.lit(shards)).cast("int").alias("shard"),
                       F.when(first, 0).otherwise(1).alias("kind"), "entry", "vec_id",
                       F.when(first, F.col("v")).otherwise(F.array().cast("array<double>")).alias("v"))
    visits = rows.where(F.col("vec_id") % every == 0).select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1))).alias("shard"), F.lit(2).alias("kind"),
        F.col("vec_id").alias("entry"), "vec_id", "v")
    dealt = home.unionAll(visits).repartition("shard").sortWithinPartitions("shard", "kind", "entry", "vec_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, copies, shard = None, [], [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            number, kind, entry, ids = (batch.column(k).to_numpy() for k in range(4))
            cuts = np.flatnonzero((number[1:] != number[:-1]) | (kind[1:] != kind[:-1])) + 1
            for low, high in zip([0, *cuts], [*cuts, len(ids)]):
                if number[low] != at:
                    at, held, copies, shard = number[low], [], [], None
                if kind[low] == 1:
                    copies.append((entry[low:high], ids[low:high]))
                    continue
                matrix = np.asarray(batch.column(4).slice(low, high - low).flatten().to_numpy()).reshape(high - low, -1)
                if kind[low] == 0:
                    held.append((ids[low:high], matrix))
                    continue
                if shard is None and held:
                    more = tuple(np.concatenate(part) for part in zip(*copies)) if copies else None
                    shard = Shard(*(np.concatenate(part) for part in zip(*held)), chosen, posted, more)
                    held, copies = [], []
                if shard is not None:
                    found = shard.search(ids[low:high], matrix, wanted, looked_up, share, least)
                    yield pa.RecordBatch.from_arrays([pa.array(f) for f in found], names=["query_id", "vec_id", "score"])

    found = dealt.mapInArrow(run, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)
            .select("query_id", "rank", "vec_id", "score"))
