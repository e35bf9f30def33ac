"""SimHash near-duplicates: fingerprints, then a self-join of binary tries under a Hamming error budget.

The trie of all distinct fingerprints is traversed against itself. Spark does the top levels: the fingerprint is
rotated so that each of a few blocks of bits stands first once, and a block is a trie node. By the pigeonhole rule two
fingerprints within the budget agree on one block up to a small number of bits, so a fingerprint is sent to its own
node and to the nodes that differ from it in so many bits. Each task then walks its node pairs downwards, level by
level for all pairs at once, adds up differing bits, and drops a pair as soon as the budget is exceeded or when
everything below both nodes is known to be linked already. A task reports links as one edge per fingerprint and node,
never as all pairs, and connected components run on those edges.

Equal fingerprints are one trie leaf, so copies cost nothing after the first aggregation. Nodes with many
fingerprints are split into pieces that are joined piece against piece in separate tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.llm.components import connected_components
from clientpulse.llm.stored import drop, stored

BITS = 64
SEED = 42
#: Shingles hashed at once, and node pairs walked at once; both only bound memory.
HASH_BLOCK = 1 << 14
PAIR_BLOCK = 1 << 18
#: Fingerprints of one trie node that one task takes; a larger node is joined in pieces.
NODE_LIMIT = 1 << 14


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The SimHash of one text as a signed 64-bit number; 0 for a text without words (and for null).

    Words are the runs between ASCII white space after A-Z became a-z; shingles are ``shingle`` words joined by a
    space, repeats included, and the whole sequence where there are fewer words.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    width = min(shingle, len(words))
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - width + 1
    starts, ends = starts[:count], ends[width - 1:]
    digest, votes = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, count, HASH_BLOCK):
        pairs = zip(starts[at:at + HASH_BLOCK].tolist(), ends[at:at + HASH_BLOCK].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], np.dtype(">u8"))
        votes += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(votes * 2 > count).view(np.dtype(">i8"))[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text", shingle: int = 4) -> DataFrame:
    """The ``keys`` of every row with its SimHash ``fp`` (signed long)."""
    slim = docs.select(*[F.col(k).alias(f"k{n}") for n, k in enumerate(keys)], F.col(text).alias("text"))
    kept = T.StructType([f for f in slim.schema.fields if f.name != "text"] + [T.StructField("fp", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([fingerprint(t.as_py(), shingle) for t in batch.column(len(keys))], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], found], names=kept.names)

    return slim.mapInArrow(run, kept).toDF(*keys, "fp")


def blocks(budget: int) -> list[tuple[int, int, int]]:
    """(first bit, width, differing bits allowed) per block.

    Two fingerprints beyond the allowance of every block differ in more than ``budget`` bits: the allowances plus one
    each add up to ``budget + 1``.
    """
    n = min(3, budget + 1)
    edges = [BITS * k // n for k in range(n + 1)]
    spare = budget + 1 - n
    return [(edges[k], edges[k + 1] - edges[k], spare // n + (k < spare % n)) for k in range(n)]


def _rotated(fp: Column, by: int) -> Column:
    return fp if by == 0 else F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, BITS - by))


def _visits(width: int, allowed: int) -> list[int]:
    """All ways to differ in 1 to ``allowed`` bits of a block."""
    return [sum(1 << b for b in picked) for n in range(1, allowed + 1) for picked in combinations(range(width), n)]


def top_nodes(distinct: DataFrame, budget: int) -> DataFrame:
    """Rows (trie, node, mask, key): each fingerprint at its own node (mask 0) of each trie, and at the nodes it visits.

    Of two nodes that differ within the allowance only the larger visits, so each node pair meets once.
    """
    parts = []
    for trie, (first, width, allowed) in enumerate(blocks(budget)):
        key = _rotated(F.col("fp"), first)
        home = F.shiftrightunsigned(key, BITS - width)
        rows = distinct.select(F.lit(trie).alias("trie"), home.alias("home"), key.alias("key"))
        masks = [0, *_visits(width, allowed)]
        rows = rows.withColumn("mask", F.explode(F.array(*[F.lit(m).cast("long") for m in masks])))
        node = F.col("home").bitwiseXOR(F.col("mask"))
        parts.append(rows.withColumn("node", node).where(F.col("node") <= F.col("home"))
                     .select("trie", "node", "mask", "key"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole


def _pieces(distinct: DataFrame, budget: int, node_limit: int) -> DataFrame:
    """(trie, node, pieces) of the nodes with more fingerprints than a task takes, and of the nodes they visit."""
    parts = []
    for trie, (first, width, allowed) in enumerate(blocks(budget)):
        home = F.shiftrightunsigned(_rotated(F.col("fp"), first), BITS - width)
        large = (distinct.groupBy(home.alias("home")).count().where(F.col("count") > node_limit)
                 .withColumn("pieces", F.ceil(F.col("count") / node_limit).cast("int")))
        near = F.explode(F.array(*[F.lit(m).cast("long") for m in [0, *_visits(width, allowed)]]))
        parts.append(large.select(F.lit(trie).alias("trie"), "home", "pieces", near.alias("mask"))
                     .select("trie", F.col("home").bitwiseXOR(F.col("mask")).alias("node"), "pieces"))
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionAll(part)
    return whole.groupBy("trie", "node").agg(F.max("pieces").alias("pieces"))


def links(distinct: DataFrame, budget: int = 4, node_limit: int = NODE_LIMIT) -> DataFrame:
    """Edges (a, b) between fingerprints that join all those within ``budget`` bits of each other, by column ``fp``.

    Every edge is a path of real links found in one task: the edges have the same connected components as all links.
    """
    if budget < 1:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).where(F.lit(False))
    rows = top_nodes(distinct, budget)
    split = stored(_pieces(distinct, budget, node_limit), "simhash-pieces")
    if split.isEmpty():
        rows = rows.select("trie", "node", F.lit(0).alias("i"), F.lit(0).alias("j"),
                           F.when(F.col("mask") == 0, 0).otherwise(1).alias("side"), "mask", "key")
    else:
        rows = rows.join(split, ["trie", "node"], "left").fillna(1, ["pieces"])
        rows = rows.withColumn("piece", F.pmod(F.xxhash64("key"), F.col("pieces")).cast("int"))
        # Task (i, j) joins piece i of the node's own with piece j of the visitors, and with its own piece j if i < j;
        # task (i, i) also joins piece i with itself.
        others = F.sequence(F.lit(0), F.col("pieces") - 1)
        at_home = F.transform(others, lambda o: F.struct(F.col("piece").alias("i"), o.alias("j"), F.lit(0).alias("side")))
        lower = F.transform(F.filter(others, lambda o: o < F.col("piece")),
                            lambda o: F.struct(o.alias("i"), F.col("piece").alias("j"), F.lit(1).alias("side")))
        visit = F.transform(others, lambda o: F.struct(o.alias("i"), F.col("piece").alias("j"), F.lit(1).alias("side")))
        rows = rows.withColumn("to", F.explode(F.when(F.col("mask") == 0, F.concat(at_home, lower)).otherwise(visit)))
        rows = rows.select("trie", "node", "to.i", "to.j", "to.side", "mask", "key")
    group = ["trie", "node", "i", "j"]
    dealt = rows.repartition(*group).sortWithinPartitions(*group, "side", "mask", "key")
    shifts = np.array([first for first, _, _ in blocks(budget)], np.uint64)
    depths = np.array([width for _, width, _ in blocks(budget)], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, len(group)):
            a, b = _join_groups(table, shifts, depths, budget)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return dealt.mapInArrow(run, "a long, b long")


def _whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Columns as arrays, cut so that no group of equal leading columns is torn apart."""
    kept: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if kept is not None:
            columns = [np.concatenate(pair) for pair in zip(kept, columns)]
        same = np.ones(len(columns[0]), bool)
        for c in columns[:n_keys]:
            same &= c == c[-1:]
        cut = len(same) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut:
            yield [c[:cut] for c in columns]
        kept = [c[cut:] for c in columns]
    if kept is not None and len(kept[0]):
        yield kept


def _join_groups(columns: list[np.ndarray], shifts: np.ndarray, depths: np.ndarray, budget: int):
    """Edges between the fingerprints of each group, as two arrays of signed numbers."""
    trie, node, i, j, side, mask, key = columns
    keys = key.astype(np.int64).view(np.uint64)
    n = len(keys)

    def starts(*by: np.ndarray) -> np.ndarray:
        new = np.ones(n, bool)
        new[1:] = False
        for c in by:
            new[1:] |= c[1:] != c[:-1]
        return np.flatnonzero(new)

    ranges = starts(trie, node, i, j, side, mask)
    ends = np.append(ranges[1:], n)
    of_group = np.searchsorted(starts(trie, node, i, j), ranges, side="right") - 1
    own = side[ranges] == 0
    own_of = np.full(of_group[-1] + 1, -1)
    own_of[of_group[own]] = np.flatnonzero(own)
    with_self = np.flatnonzero(own & (i[ranges] == j[ranges]) & (ends - ranges > 1))
    guests = np.flatnonzero(~own & (own_of[of_group] >= 0))
    hosts = own_of[of_group[guests]]
    pairs = np.stack([
        np.concatenate([ranges[with_self], ranges[hosts]]), np.concatenate([ends[with_self], ends[hosts]]),
        np.concatenate([ranges[with_self], ranges[guests]]), np.concatenate([ends[with_self], ends[guests]]),
        np.concatenate([np.zeros(len(with_self), np.int64), np.bitwise_count(mask[ranges[guests]].astype(np.uint64))]),
        depths[trie[ranges[np.concatenate([with_self, hosts])]]]])
    label = _walk(keys, pairs, budget)
    far = np.flatnonzero(label != np.arange(n))
    turn = shifts[trie[far]]
    back = (np.uint64(BITS) - turn) % np.uint64(BITS)

    def original(x: np.ndarray) -> np.ndarray:
        return np.where(turn == 0, x, (x >> turn) | (x << back)).view(np.int64)

    return original(keys[far]), original(keys[label[far]])


def _walk(keys: np.ndarray, pairs: np.ndarray, budget: int) -> np.ndarray:
    """Per key the smallest index that it is linked with.

    ``pairs`` holds columns (low, high, low, high, differing bits so far, depth): two nodes as ranges of sorted keys.
    Depth first over blocks of node pairs, so memory is bounded by the block and the depth of the trie.
    """
    label = np.arange(len(keys))
    todo = [pairs[:, at:at + PAIR_BLOCK] for at in range(0, pairs.shape[1], PAIR_BLOCK)]
    while todo:
        alo, ahi, blo, bhi, bits, depth = block = todo.pop()
        # All below both nodes already linked: nothing to learn here.
        change = np.concatenate(([0], np.cumsum(label[1:] != label[:-1])))
        known = (change[ahi - 1] == change[alo]) & (change[bhi - 1] == change[blo]) & (label[alo] == label[blo])
        leaves = ~known & (ahi - alo == 1) & (bhi - blo == 1)
        # A path without branches on both sides is one step: its differing bits are those of the two leaves.
        u, v = alo[leaves], blo[leaves]
        linked = np.bitwise_count(keys[u] ^ keys[v]) <= budget
        if linked.any():
            _merge(label, u[linked], v[linked])
        inner = block[:, ~known & ~leaves]
        if not inner.shape[1]:
            continue
        alo, ahi, blo, bhi, bits, depth = inner
        amid, bmid = _middle(keys, alo, ahi, depth), _middle(keys, blo, bhi, depth)
        twin = (alo == blo) & (ahi == bhi)
        made = []
        for a0, a1, b0, b1, more, use in (
                (alo, amid, blo, bmid, 0, None), (amid, ahi, bmid, bhi, 0, None),
                (alo, amid, bmid, bhi, 1, None), (amid, ahi, blo, bmid, 1, ~twin)):
            ok = (a1 > a0) & (b1 > b0) & (bits + more <= budget)
            ok &= ~((a0 == b0) & (a1 == b1) & (a1 - a0 == 1))  # a leaf with itself
            if use is not None:
                ok &= use
            made.append(np.stack([a0[ok], a1[ok], b0[ok], b1[ok], bits[ok] + more, depth[ok] + 1]))
        below = np.concatenate(made, axis=1)
        todo.extend(below[:, at:at + PAIR_BLOCK] for at in range(0, below.shape[1], PAIR_BLOCK))
    return label


def _middle(keys: np.ndarray, low: np.ndarray, high: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Per node the index where its right child begins, by binary search for the bit at ``depth``."""
    low, high = low.copy(), high.copy()
    shift = (BITS - 1 - depth).astype(np.uint64)
    while (open_ := low < high).any():
        mid = (low + high) // 2
        one = ((keys[np.minimum(mid, len(keys) - 1)] >> shift) & np.uint64(1)).astype(bool)
        high = np.where(open_ & one, mid, high)
        low = np.where(open_ & ~one, mid + 1, low)
    return low


def _merge(label: np.ndarray, u: np.ndarray, v: np.ndarray) -> None:
    """Join the sets of each u and v; afterwards every label is the smallest index of its set."""
    while True:
        lu, lv = label[u], label[v]
        apart = lu != lv
        if not apart.any():
            return
        u, v = u[apart], v[apart]
        np.minimum.at(label, np.maximum(lu, lv)[apart], np.minimum(lu, lv)[apart])
        while not np.array_equal(nearer := label[label], label):
            label[:] = nearer


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 4,
                    budget: int = 4) -> DataFrame:
    """Every row's ``doc_id``, ``text_hash``, SimHash ``fp`` and component.

    ``component`` names the group (the smallest fingerprint in it, as a signed number) and ``component_id`` its
    smallest doc_id, the row's own included. Two rows are in one group if a chain of fingerprints, each within
    ``budget`` bits of the next, connects them.

    Null and empty texts have fingerprint 0 and link like others. Rows without doc_id take part; they never name a
    group, so a group of only such rows has a null component_id. Repeated rows stay rows. An empty table gives none.
    Columns other than the two named are not read.
    """
    named = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(text).alias("text_hash"))
    prints = stored(fingerprints(named, ["doc_id", "text_hash"], shingle=shingle), "simhash-prints")
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-distinct")
    edges = stored(links(distinct.select("fp"), budget).distinct(), "simhash-links")
    linked = connected_components(edges)
    drop(edges)
    group = distinct.join(linked.withColumnRenamed("node", "fp"), "fp", "inner")
    least = group.groupBy("component").agg(F.min("least").alias("component_id"))
    named_groups = group.select("fp", "component").join(least, "component")
    of_print = (distinct.join(named_groups, "fp", "left")
                .select("fp", F.coalesce("component", "fp").alias("component"),
                        F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("component_id"))
                        .alias("component_id")))
    # As a table, so that Spark sees two plain shuffles and can split the partition of a fingerprint with many rows.
    of_print = stored(of_print, "simhash-groups")
    return prints.join(of_print, "fp").select("doc_id", "text_hash", "fp", "component", "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with one row kept per group: the smallest doc_id, then the smallest text hash.

    Of a group without any doc_id one row stays. Exactly repeated rows (same doc_id, same text) count as one.
    Columns of any name pass through.
    """
    found = near_duplicates(docs, doc_id, text, **how)
    rows = found.groupBy("component", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash", "rows")).alias("o")
    keep = rows.groupBy("component").agg(first)
    keep = stored(keep.select(F.col("o.doc_id").alias("keep_id"), F.col("o.text_hash").alias("keep_hash"),
                              F.col("o.rows").alias("rows")), "simhash-keep")
    packed = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("row_id"), F.xxhash64(text).alias("row_hash"))
    same = F.col("row_id").eqNullSafe(F.col("keep_id")) & (F.col("row_hash") == F.col("keep_hash"))
    kept = packed.join(keep, same, "left_semi")
    if not keep.where("rows > 1").isEmpty():
        kept = kept.dropDuplicates(["row_id", "row_hash"])
    return kept.select("row.*")
