"""Ranked lexical search: compressed posting lists per shard, searched by Block-Max MaxScore.

The documents that a task reads become shards of bounded size, each with its own posting lists in blocks of 128; texts
are never shuffled. A block keeps, uncompressed, the pairs (occurrences, document length) that no other pair of the
block beats. Whatever the statistics of the whole corpus turn out to be, the best of them is the block's exact maximum,
so lists can be written before those statistics are known.

A search joins the queried terms with the lists and sends the lists of a shard and a block of queries to one task. There
the lists of a query are ordered by their largest contribution. As long as the smallest ones together cannot lift a
document over the query's 20th best score so far, they are non-essential: only documents of the other lists are
candidates, and the block maxima of the non-essential lists at a candidate's place reject it before any of those blocks
is decompressed. The best documents of all shards are merged by a rank that Spark limits before the shuffle.

Scores are whole numbers: the weight of a term times (10^9 tf) div (1000 tf + 12 m), with m = 75 + (25 n N) div L.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from clientpulse.llm.stored import stored

WANTED = 20
BLOCK = 128
#: A shard is closed when it holds so many documents or postings.
SHARD_DOCS = 1 << 16
SHARD_POSTINGS = 1 << 20
#: Queries that one task holds beside the lists of its shard.
QUERY_BLOCK = 256
#: Queried terms, and their bytes, up to which lists of other terms are not built; beyond, all terms are indexed.
ASKED_TERMS = 200_000
ASKED_BYTES = 8 << 20
#: Documents of a shard that are scored at once: few at first, so that a threshold is known early.
FIRST_WINDOW = 512
LARGEST_WINDOW = 8192
#: Tasks of the search at most.
TASKS = 4096

# Letters and digits stay (A-Z as a-z), other ASCII characters end a term, and all bytes of other characters stay.
_KEPT = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
TERM_BYTES = bytes(b if b in _KEPT else 0x20 for b in range(256)).lower()

INDEX = "shard long, term binary, n long, total long, head binary, body binary"


def terms_of(text: bytes | None) -> list[bytes]:
    """The terms of a text in UTF-8."""
    return text.translate(TERM_BYTES).split() if text else []


def _pack(values: np.ndarray) -> tuple[int, bytes]:
    """(bits per value, the values in so many bits)."""
    bits = int(values.max(initial=0)).bit_length()
    return bits, np.packbits((values[:, None] >> np.arange(bits)) & 1).tobytes() if bits else b""


def _unpack(body: np.ndarray, bits: int, count: int) -> np.ndarray:
    if not bits:
        return np.zeros(count, np.int64)
    found = np.unpackbits(body[:(bits * count + 7) // 8], count=bits * count).reshape(count, bits)
    return found @ (np.int64(1) << np.arange(bits, dtype=np.int64))


def frontier(tf: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The pairs (occurrences, length) that no other pair equals or beats by more occurrences in no greater length."""
    order = np.lexsort((length, -tf))
    tf, length = tf[order], length[order]
    new = np.ones(len(tf), bool)
    new[1:] = length[1:] < np.minimum.accumulate(length)[:-1]
    return np.stack([tf[new], length[new]], axis=1)


def encode(docs: np.ndarray, tf: np.ndarray, lengths: np.ndarray) -> tuple[bytes, bytes]:
    """(head, body) of one list: ascending documents, occurrences, and the documents' lengths.

    The head holds per block the first and last document, the bits of the two packed parts, where they start in the
    body, and the frontier pairs.
    """
    rows, pairs, body = [], [], bytearray()
    for at in range(0, len(docs), BLOCK):
        own, times = docs[at:at + BLOCK], tf[at:at + BLOCK]
        best = frontier(times, lengths[at:at + BLOCK])
        gap_bits, gaps = _pack(np.diff(own) - 1)
        tf_bits, counts = _pack(times - 1)
        rows.append((own[0], own[-1], gap_bits, tf_bits, len(body), len(best)))
        pairs.append(best)
        body += gaps + counts
    head = np.array(rows, np.int64).ravel()
    return np.concatenate([head, np.concatenate(pairs).ravel()]).astype("<i8").tobytes(), bytes(body)


class PostingList:
    """One list of a shard; blocks are decompressed when they are asked for, and stay so for the task's next queries."""

    def __init__(self, n: int, head: bytes, body: bytes, norms: np.ndarray, lengths_norm):
        blocks = ceil(n / BLOCK)
        whole = np.frombuffer(head, "<i8")
        rows, pairs = whole[:6 * blocks].reshape(blocks, 6), whole[6 * blocks:].reshape(-1, 2)
        self.first, self.last = rows[:, 0].copy(), rows[:, 1].copy()
        self._bits, self._start = rows[:, 2:4], rows[:, 4]
        self._body, self._norms, self._n = np.frombuffer(body, np.uint8), norms, n
        best = impact(pairs[:, 0], lengths_norm(pairs[:, 1]))
        self.block_max = np.maximum.reduceat(best, np.cumsum(rows[:, 5]) - rows[:, 5])
        self.max = int(self.block_max.max())
        # A block that is still packed reads as its last document, which keeps the whole array in order.
        self.docs = np.repeat(self.last, BLOCK)[:n]
        self.impact = np.zeros(n, np.int64)
        self.opened = np.zeros(blocks, bool)

    def open(self, blocks: np.ndarray) -> None:
        for b in blocks[~self.opened[blocks]].tolist():
            low, high = b * BLOCK, min((b + 1) * BLOCK, self._n)
            count, (gap_bits, tf_bits), at = high - low, self._bits[b].tolist(), int(self._start[b])
            gaps = _unpack(self._body[at:], gap_bits, count - 1)
            tf = _unpack(self._body[at + (gap_bits * (count - 1) + 7) // 8:], tf_bits, count) + 1
            docs = self.first[b] + np.concatenate(([0], np.cumsum(gaps + 1)))
            self.docs[low:high], self.impact[low:high] = docs, impact(tf, self._norms[docs])
            self.opened[b] = True

    def between(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents from ``low`` to before ``high`` and their contributions."""
        a, b = np.searchsorted(self.last, low), np.searchsorted(self.first, high)
        if a >= b:
            return self.docs[:0], self.impact[:0]
        self.open(np.arange(a, b))
        docs = self.docs[a * BLOCK:b * BLOCK]
        i, j = np.searchsorted(docs, (low, high))
        return docs[i:j], self.impact[a * BLOCK + i:a * BLOCK + j]

    def places(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per document its block, and the block's maximum (0 where no block can hold it)."""
        block = np.minimum(np.searchsorted(self.last, docs), len(self.last) - 1)
        inside = (self.first[block] <= docs) & (docs <= self.last[block])
        return block, np.where(inside, self.block_max[block], 0)

    def at(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """Contributions of documents that lie within the range of ``blocks``."""
        self.open(np.unique(blocks))
        place = np.minimum(np.searchsorted(self.docs, docs), self._n - 1)
        return np.where(self.docs[place] == docs, self.impact[place], 0)


def impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """(10^9 tf) div (1000 tf + 12 m), where ``norm`` is 12 m."""
    return 1_000_000_000 * tf // (1000 * tf + norm)


def norms_of(lengths: np.ndarray, docs: int, total: int) -> np.ndarray:
    """12 m for lengths of documents, with m = 100 - 25 + (25 n N) div L."""
    if 25 * int(lengths.max(initial=0)) * docs < 1 << 62:
        return 12 * (75 + 25 * lengths * docs // total)
    return np.array([12 * (75 + 25 * n * docs // total) for n in lengths.tolist()], np.int64)


def best_of(lists: list[tuple[PostingList, int]], docs: int, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(document, score) of the best of a shard's ``docs`` documents; equal scores by number.

    ``lists`` are pairs of a list and its weight. Documents come in ascending order, so one that only equals the
    threshold is behind those already found.
    """
    lists = sorted((pair for pair in lists if pair[1] > 0), key=lambda pair: pair[0].max * pair[1])
    bounds = np.cumsum([0] + [p.max * w for p, w in lists])
    found, scores, threshold = np.zeros(0, np.int64), np.zeros(0, np.int64), 0
    low, width = 0, FIRST_WINDOW
    while low < docs:
        # Lists before this one cannot lift a document over the threshold together.
        first = int(np.searchsorted(bounds, threshold, side="right")) - 1
        if first >= len(lists):
            break
        high = min(low + width, docs)
        total = np.zeros(high - low, np.int64)
        for p, w in lists[first:]:
            own, value = p.between(low, high)
            total[own - low] += w * value
        near = np.flatnonzero(total + np.where(total > 0, bounds[first], 0) > threshold)
        bound, near = total[near], near + low
        if first and len(near):
            bound, near = _with_non_essential(lists[:first], near, bound, threshold)
        if len(near):
            found, scores = np.concatenate([found, near]), np.concatenate([scores, bound])
            kept = np.lexsort((found, -scores))[:wanted]
            found, scores = found[kept], scores[kept]
            threshold = int(scores[-1]) if len(scores) == wanted else 0
        low, width = high, min(4 * width, LARGEST_WINDOW)
    return found, scores


def _with_non_essential(lists: list[tuple[PostingList, int]], docs: np.ndarray, score: np.ndarray,
                        threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """The candidates over the threshold with their whole scores, opening only blocks that may still matter."""
    places = [p.places(docs) for p, _ in lists]
    most = np.array([w * m for (_, m), (_, w) in zip(places, lists)])
    bound = score + most.sum(axis=0)
    alive = np.flatnonzero(bound > threshold)
    for k in range(len(lists) - 1, -1, -1):
        if not len(alive):
            break
        p, w = lists[k]
        hit = alive[most[k, alive] > 0]
        if len(hit):
            bound[hit] += w * p.at(docs[hit], places[k][0][hit]) - most[k, hit]
            alive = alive[bound[alive] > threshold]
    return bound[alive], docs[alive]


def build_index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", only: set[bytes] | None = None) -> DataFrame:
    """The shards of a table: columns ``INDEX``, one row per shard and term, and one per shard without a term.

    ``n`` is the number of postings, in a shard's own row that of documents with a term, and ``total`` the number of
    their terms. With ``only`` lists of other terms are left out; the numbers still count every document. Every row of
    ``docs`` is a document; a null doc_id comes after all others.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, shard, builder = TaskContext.get().partitionId() << 32, 0, _Builder(only)
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                builder.add(name, content.as_py())
                if builder.full():
                    yield from builder.rows(base + shard)
                    shard, builder = shard + 1, _Builder(only)
        if builder.docs:
            yield from builder.rows(base + shard)

    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text"))
    return slim.mapInArrow(run, INDEX)


class _Builder:
    def __init__(self, only: set[bytes] | None):
        self._only = only
        self.docs = self._total = self._postings = 0
        self._names: list[int | None] = []
        self._lengths: list[int] = []
        self._number: dict[bytes, int] = {}
        self._terms: list[np.ndarray] = []
        self._times: list[np.ndarray] = []

    def add(self, name: int | None, text: bytes | None) -> None:
        words = terms_of(text)
        if not words:
            return
        self.docs += 1
        self._total += len(words)
        counts = Counter(words if self._only is None else filter(self._only.__contains__, words))
        if counts:
            numbers = self._number
            self._names.append(name)
            self._lengths.append(len(words))
            self._terms.append(np.fromiter((numbers.setdefault(t, len(numbers)) for t in counts), np.int32, len(counts)))
            self._times.append(np.fromiter(counts.values(), np.int32, len(counts)))
            self._postings += len(counts)

    def full(self) -> bool:
        return self._postings >= SHARD_POSTINGS or len(self._names) >= SHARD_DOCS

    def rows(self, shard: int) -> Iterator[pa.RecordBatch]:
        # Documents are numbered by their id, so that numbers decide among equal scores.
        unnamed = np.array([name is None for name in self._names], bool)
        names = np.array([name or 0 for name in self._names], np.int64)
        order = np.lexsort((names, unnamed))
        lengths = np.array(self._lengths, np.int64)[order]
        number = np.empty(len(order), np.int64)
        number[order] = np.arange(len(order))
        yield _batch([(shard, None, self.docs, self._total, np.int64(unnamed.sum()).tobytes() + names[order].tobytes(),
                       lengths.tobytes())])
        if not self._terms:
            return
        terms, times = np.concatenate(self._terms), np.concatenate(self._times).astype(np.int64)
        docs = np.repeat(number, [len(t) for t in self._terms])
        by = np.lexsort((docs, terms))
        docs, times = docs[by], times[by]
        ends = np.cumsum(np.bincount(terms, minlength=len(self._number)))
        held, size = [], 0
        for term, at in self._number.items():
            cut = slice(ends[at - 1] if at else 0, ends[at])
            head, body = encode(docs[cut], times[cut], lengths[docs[cut]])
            held.append((shard, term, cut.stop - cut.start, 0, head, body))
            size += len(head) + len(body)
            if size > 1 << 22 or len(held) == 10_000:
                yield _batch(held)
                held, size = [], 0
        if held:
            yield _batch(held)


def _batch(rows: Iterable[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    names = ["shard", "term", "n", "total", "head", "body"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)


def asked_terms(items: DataFrame, item: str, text: str) -> DataFrame:
    """(item, term, times): the terms of every item. Rows equal in both columns count once, further texts of an item
    add their terms."""
    slim = items.select(F.col(item).alias("item"), F.col(text).cast("binary").alias("text")).distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([terms_of(t.as_py()) for t in batch.column(1)], pa.list_(pa.binary()))
            yield pa.RecordBatch.from_arrays([batch.column(0), found], names=["item", "terms"])

    shape = f"item {slim.schema['item'].dataType.simpleString()}, terms array<binary>"
    found = slim.mapInArrow(run, shape).select("item", F.explode("terms").alias("term"))
    return found.groupBy("item", "term").agg(F.count(F.lit(1)).alias("times"))


def search(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text", wanted: int = WANTED, query_block: int = QUERY_BLOCK) -> DataFrame:
    """(item, rank, doc_id, score): the ``wanted`` best documents with a score above 0 of every item.

    Null and empty texts have no term: such documents are not counted, such items find nothing. Every row of ``docs``
    is a document of its own, so repeated rows appear as often; a null doc_id comes last among equal scores. Repeated
    items count once (see ``asked_terms``). Other columns are not read.
    """
    asked = stored(asked_terms(items, item, item_text), "search-asked")
    size = asked.select("term").distinct().agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("term")).alias("bytes")).first()
    # Within the bound the queried terms travel with the job; beyond it all lists are written and the join picks.
    only = None
    if size["n"] <= ASKED_TERMS and (size["bytes"] or 0) <= ASKED_BYTES:
        only = {bytes(r["term"]) for r in asked.select("term").distinct().collect()}
    index = stored(build_index(docs, doc_id, text, only), "search-index")
    corpus = index.where(F.col("term").isNull()).agg(
        F.sum("n").alias("docs"), F.sum("total").alias("total"), F.count(F.lit(1)).alias("shards")).first()
    count, total, shards = corpus["docs"] or 0, corpus["total"] or 0, corpus["shards"]
    blocks = max(1, ceil(asked.select("item").distinct().count() / query_block))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)).cast("int"))

    known = index.where(F.col("term").isNotNull()).groupBy("term").agg(F.sum("n").alias("df"))
    weight = F.floor(1000 * F.log((2 * F.lit(float(count)) + 2) / (2 * F.col("df") + 1))).cast("long") * F.col("times")
    weighted = stored(asked.join(known, "term").select("block", "item", "term", weight.alias("weight")), "search-weights")
    queries = weighted.groupBy("block", "item").agg(F.collect_list(F.struct("term", "weight")).alias("terms"))

    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    homes = index.where(F.col("term").isNull()).select("shard", every_block, "n", "head", "body")
    lists = index.join(weighted.select("block", "term").distinct(), "term")
    no_item, no_terms = F.lit(None).cast(asked.schema["item"].dataType), F.lit(None).cast(queries.schema["terms"].dataType)
    rows = homes.select("shard", "block", F.lit(0).alias("kind"), F.lit(None).cast("binary").alias("term"), "n", "head",
                        "body", no_item.alias("item"), no_terms.alias("terms"))
    rows = rows.unionAll(lists.select("shard", "block", F.lit(1), "term", "n", "head", "body", no_item, no_terms))
    nothing = F.lit(None).cast("binary")
    rows = rows.unionAll(homes.select("shard", "block").join(queries, "block").select(
        "shard", "block", F.lit(2), nothing, F.lit(0), nothing, nothing, "item", "terms"))
    dealt = rows.repartition(max(1, min(shards * blocks, TASKS)), "shard", "block").sortWithinPartitions("shard", "block", "kind")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, at = None, None
        for batch in batches:
            keys = list(zip(*(batch.column(k).to_pylist() for k in range(3))))
            rows, docs, scores, unnamed = [], [], [], []
            for place, (shard, block, kind) in enumerate(keys):
                if (shard, block) != at:
                    held, at = None, (shard, block)
                if kind == 0:
                    held = _Shard(batch.column(5)[place].as_py(), batch.column(6)[place].as_py(), count, total)
                elif kind == 1:
                    term, n, head, body = (batch.column(k)[place].as_py() for k in (3, 4, 5, 6))
                    held.add(term, n, head, body)
                else:
                    found, score = held.search(batch.column(8)[place].as_py(), wanted)
                    rows.append(np.full(len(found), place))
                    docs.append(held.names[found])
                    unnamed.append(found >= held.named)
                    scores.append(score)
            if rows and sum(map(len, rows)):
                names = pa.array(np.concatenate(docs), mask=np.concatenate(unnamed))
                yield pa.RecordBatch.from_arrays([batch.column(7).take(pa.array(np.concatenate(rows))), names,
                                                  pa.array(np.concatenate(scores))], names=["item", "doc_id", "score"])

    shape = f"item {asked.schema['item'].dataType.simpleString()}, doc_id long, score long"
    found = dealt.mapInArrow(run, shape)
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= wanted)
            .select("item", "rank", "doc_id", "score"))


class _Shard:
    """The lists that one task holds: those of a shard for the terms of a block of queries."""

    def __init__(self, head: bytes, body: bytes, count: int, total: int):
        self.names = np.frombuffer(head, np.int64)[1:]
        self.named = len(self.names) - int(np.frombuffer(head, np.int64)[0])
        self._norm = lambda lengths: norms_of(lengths, count, total)
        self._norms = self._norm(np.frombuffer(body, np.int64))
        self._lists: dict[bytes, PostingList] = {}

    def add(self, term: bytes, n: int, head: bytes, body: bytes) -> None:
        self._lists[term] = PostingList(n, head, body, self._norms, self._norm)

    def search(self, terms: list[dict], wanted: int) -> tuple[np.ndarray, np.ndarray]:
        lists = [(self._lists[t["term"]], t["weight"]) for t in terms if t["term"] in self._lists]
        return best_of(lists, len(self.names), wanted)


ORACLE = r"""
WITH words AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts FROM documents),
docs AS (SELECT r, doc_id, len(ts) AS n FROM words WHERE len(ts) > 0),
corpus AS (SELECT count(*) AS nd, CAST(sum(n) AS BIGINT) AS l FROM docs),
asked AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(
      translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY item_id, term),
posts AS (
  SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(ts) AS term FROM words)
  WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2.0 * (SELECT nd FROM corpus) + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
  FROM posts GROUP BY term),
scored AS (
  SELECT item_id, r, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nd) // l)))) AS BIGINT) AS score
  FROM asked JOIN posts USING (term) JOIN weights USING (term) JOIN docs USING (r) CROSS JOIN corpus GROUP BY item_id, r),
ranked AS (
  SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST) AS INTEGER) AS rank,
    doc_id, score FROM scored JOIN docs USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 20
"""
