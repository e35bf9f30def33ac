"""N-gram Jaccard join with PartEnum signatures.

Sets are dealt to bands of sizes, so that linked sets lie in one band or in neighbouring ones. For two neighbouring bands
the similarity bounds the number k of shingles in which two linked sets can differ. The domain of shingle hashes is cut
into ``n1`` parts, so that linked sets differ in at most ``ERRORS`` shingles in one part at least; every part is cut into
``PARTS`` cells, and all but ``ERRORS`` of these agree there. A signature is what a set holds in the cells of one such
choice: linked sets share one, whatever they differ in. Signatures cost about a third of a number per shingle.

Equal sets are one node. Sets of a signature meet in a task as a stream: the smallest is paired with all others, which
is as many pairs as sets. Parity sketches (whose distance never exceeds that of the sets) and sizes rule out most other
pairs; the rest is checked exactly on the texts. Groups that are connected by then are done. In the others only sets of
different components are compared, inside tasks and by sketch, in pieces where a group is large; what passes is checked
exactly too. So no pair that could connect anything is left out, and nothing grows with the square of a group of copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.llm.components import connected_components
from clientpulse.llm.stored import drop, stored

#: Errors per part that signatures allow, and cells per part.
ERRORS = 1
PARTS = 3
#: Bits of a sketch at least, and per shingle in which two linked sets can differ.
LEAST_BITS = 512
BITS_PER_ERROR = 5
#: Word hashes and sets that a task remembers to save work, and sets and numbers compared at once; they bound memory only.
REMEMBERED = 1 << 18
PIECE = 1 << 12
COMPARED = 1 << 21
#: Rows of a join's small side up to which it is broadcast; a row has four numbers.
BROADCAST_ROWS = 200_000


class Similarity:
    """Sets link when den * intersection >= num * union; ``shingle`` words make an element."""

    def __init__(self, num: int = 90, den: int = 100, shingle: int = 3):
        if not 0 < num <= den or shingle < 1:
            raise ValueError("a similarity above 0 and up to 1, of shingles of a word at least")
        self.num, self.den, self.shingle = num, den, shingle
        # With a similarity of 1 linked sets are equal: one band, in which they differ in nothing.
        starts, low = [1] if num == den else [], 1
        while num < den and low < 1 << 40:
            starts.append(low)
            low = low * den // num + 1
        self._starts = np.array(starts, np.int64)

    def allowed(self, sizes):
        """In how many elements linked sets can differ, by the sum of their sizes."""
        return sizes * (self.den - self.num) // (self.den + self.num)

    def near(self, a, b):
        """Whether sets of these sizes can be linked at all."""
        return self.den * np.minimum(a, b) >= self.num * np.maximum(a, b)

    def linked(self, a: int, b: int, both: int) -> bool:
        return self.den * both >= self.num * (a + b - both)

    def meetings(self, size: int) -> tuple[int, int]:
        """The numbers of the two pairs of neighbouring bands that a size belongs to."""
        band = int(np.searchsorted(self._starts, size, side="right")) - 1
        return band, band + 1

    def errors(self, meeting: int) -> int:
        """In how many elements linked sets of a pair of bands can differ."""
        largest = int(self._starts[min(meeting + 1, len(self._starts) - 1)]) - 1
        return int(self.allowed(2 * largest))

    def sketch_bits(self, size: int) -> int:
        return max(LEAST_BITS, 1 << int(BITS_PER_ERROR * self.allowed(2 * size) - 1).bit_length())


# Odd multipliers of the splitmix64 finaliser and of word places.
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_PLACE = 0x9E3779B97F4A7C15


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class _Words(dict):
    """Hashes of words, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        found = self[word] = xxhash.xxh64_intdigest(word, 42)
        return found


def elements(text: bytes | None, shingle: int, words: _Words) -> np.ndarray:
    """The sorted hashes of the different shingles of a text in UTF-8; of the whole sequence where there are fewer words."""
    found = text.lower().split() if text else []
    if not found:
        return np.zeros(0, np.uint64)
    width = min(shingle, len(found))
    hashes = np.fromiter(map(words.__getitem__, found), np.uint64, len(found))
    count = len(found) - width + 1
    total = np.full(count, width, np.uint64)
    for k in range(width):
        total = _mixed(total * np.uint64(_PLACE) + hashes[k:k + count])
    return np.unique(total)


def node_of(found: np.ndarray) -> int:
    """A number of 64 bits for a set; sets of equal numbers are taken as equal."""
    return int(np.uint64(xxhash.xxh64_intdigest(found.tobytes(), len(found))).view(np.int64))


def sketch_of(found: np.ndarray, bits: int) -> bytes:
    """Per place (the low bits of an element) whether it holds an odd number of elements."""
    places = (found & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


@lru_cache(maxsize=1024)
def _cells(errors: int, meeting: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(where cells begin, cells chosen per choice, salt per choice and part) for a pair of bands."""
    parts = -(-(errors + 1) // (ERRORS + 1))
    many = parts * PARTS
    starts = np.array([-(-(j << 64) // many) for j in range(many)], np.uint64)
    chosen = np.array(list(combinations(range(PARTS), PARTS - ERRORS)))
    salt = np.arange(len(chosen) * parts, dtype=np.uint64).reshape(len(chosen), parts)
    return starts, chosen, _mixed(salt + np.uint64((meeting + 1) * _PLACE % (1 << 64)))


def signatures(found: np.ndarray, rule: Similarity) -> np.ndarray:
    """The signatures of a set, given by its sorted elements, for both pairs of bands it belongs to.

    A pair of bands in which linked sets cannot differ gives none: such sets are one node.
    """
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(found)])
    out = []
    for meeting in rule.meetings(len(found)):
        errors = rule.errors(meeting)
        if errors:
            starts, chosen, salt = _cells(errors, meeting)
            edges = np.append(np.searchsorted(found, starts), len(found))
            cells = np.diff(sums[edges]).reshape(-1, PARTS)
            content = sum(cells[:, chosen[:, k]] for k in range(chosen.shape[1])).T
            out.append(_mixed(content * np.uint64(_PLACE) + salt).ravel())
    return np.concatenate(out).view(np.int64) if out else np.zeros(0, np.int64)


SETS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text_hash", T.LongType()),
                     T.StructField("node", T.LongType()), T.StructField("n_shingles", T.LongType()),
                     T.StructField("sketch", T.BinaryType()), T.StructField("signatures", T.ArrayType(T.LongType()))])


def sets_of(docs: DataFrame, rule: Similarity) -> DataFrame:
    """A row per document: its node (null without words), size, sketch and signatures.

    A task gives the last two once per set that it remembers, so copies do not multiply them.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, seen = _Words(), set()
        for batch in batches:
            nodes, sizes, sketches, lists = [], [], [], []
            for text in batch.column(2):
                found = elements(text.as_py(), rule.shingle, words)
                node = node_of(found) if len(found) else None
                new = node is not None and node not in seen
                if new:
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(node)
                nodes.append(node)
                sizes.append(len(found))
                sketches.append(sketch_of(found, rule.sketch_bits(len(found))) if new else None)
                lists.append(signatures(found, rule) if new else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                 pa.array(sketches, pa.binary()), pa.array(lists, pa.list_(pa.int64()))], names=SETS.names)

    return docs.select("doc_id", "text_hash", F.col("text").cast("binary")).mapInArrow(run, SETS)


def sharing(sets: DataFrame) -> DataFrame:
    """(signature, node, pivot): the sets of every signature that several share; the pivot is the smallest of them.

    Groups pass through a task as a stream, so their size does not matter.
    """
    rows = sets.select(F.explode("signatures").alias("signature"), "node")
    dealt = rows.repartition("signature").sortWithinPartitions("signature", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # signature, node, pivot, and whether that row began its group
        for batch in batches:
            sig, node = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            before = (np.append(last[0] if last else sig[:1] - 1, sig[:-1]), np.append(last[1] if last else node[:1], node[:-1]))
            new = (sig != before[0]) | (node != before[1])
            sig, node, begins = sig[new], node[new], sig[new] != before[0][new]
            if not len(sig):
                continue
            at = np.maximum.accumulate(np.where(begins, np.arange(len(sig)), -1))
            pivot = np.where(at >= 0, node[at], last[2] if last else 0)
            second = ~begins & np.append(last[3] if last else False, begins[:-1])
            last = (sig[-1], node[-1], pivot[-1], begins[-1])
            if not begins.all():
                columns = (np.concatenate([sig[~begins], sig[second]]), np.concatenate([node[~begins], pivot[second]]),
                           np.concatenate([pivot[~begins], pivot[second]]))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["signature", "node", "pivot"])

    return dealt.mapInArrow(run, "signature long, node long, pivot long")


def _folded(sketches: list[bytes], to: int) -> np.ndarray:
    """Sketches as rows of ``to`` bytes: halves of a longer one are added up modulo 2."""
    out = np.empty((len(sketches), to), np.uint8)
    sizes = np.array([len(s) for s in sketches])
    for size in np.unique(sizes).tolist():
        rows = np.flatnonzero(sizes == size)
        part = np.frombuffer(b"".join(sketches[r] for r in rows), np.uint8).reshape(len(rows), size)
        while part.shape[1] > to:
            part = part[:, :part.shape[1] // 2] ^ part[:, part.shape[1] // 2:]
        out[rows] = part
    return out.view(np.uint64)


def _apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int64)


def possible(pairs: DataFrame, sketches: DataFrame, rule: Similarity) -> DataFrame:
    """The pairs (a, b) that sizes and sketches do not rule out."""
    def named(side: str) -> DataFrame:
        return sketches.select(F.col("node").alias(side), F.col("n_shingles").alias(f"n_{side}"), F.col("sketch").alias(f"s_{side}"))

    fits = rule.den * F.least("n_a", "n_b") >= rule.num * F.greatest("n_a", "n_b")
    both = pairs.join(named("a"), "a").join(named("b"), "b").where(fits).select("a", "b", "n_a", "n_b", "s_a", "s_b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = batch.column(4).to_pylist(), batch.column(5).to_pylist()
            widths = np.array([min(len(x), len(y)) for x, y in zip(left, right)])
            total = batch.column(2).to_numpy() + batch.column(3).to_numpy()
            kept = np.zeros(len(total), bool)
            for width in np.unique(widths).tolist():
                rows = np.flatnonzero(widths == width)
                apart = _apart(_folded([left[r] for r in rows], width), _folded([right[r] for r in rows], width))
                kept[rows] = apart <= rule.allowed(total[rows])
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(kept)) for k in (0, 1)], names=["a", "b"])

    return both.mapInArrow(run, "a long, b long")


class _Join:
    """The steps that need the documents beside the pairs."""

    def __init__(self, docs: DataFrame, prints: DataFrame, rule: Similarity):
        self._docs, self._rule = docs, rule
        place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "text_hash")
        copies = prints.where(F.col("node").isNotNull()).groupBy("node", "doc_id", "text_hash").agg(F.count(F.lit(1)).alias("rows"))
        self._first = stored(copies.groupBy("node").agg(F.min(F.struct(place.alias("at"), "rows")).alias("f")).select(
            "node", F.col("f.at.doc_id").alias("row_id"), F.col("f.at.text_hash").alias("row_hash"), F.col("f.rows").alias("rows")), "jaccard-first")
        self.links: DataFrame | None = None
        self.groups: DataFrame | None = None

    def check(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose sets are linked, by their texts.

        The sets of all ``b`` go to the task of their ``a``; an ``a`` with many goes to several.
        """
        rule = self._rule
        pieces = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PIECE).cast("int").alias("pieces"))
        sized = pairs.join(pieces, "a")
        members = sized.select("a", F.pmod(F.xxhash64("b"), F.col("pieces")).cast("int").alias("piece"), F.col("b").alias("node"))
        heads = pieces.select("a", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.col("a").alias("node"))
        wanted = stored(members.unionAll(heads).join(self._first, "node"), "jaccard-wanted")
        small = wanted.count() <= BROADCAST_ROWS
        same = F.col("row_id").eqNullSafe(F.col("doc_id")) & (F.col("row_hash") == F.col("text_hash"))
        texts = self._docs.join(F.broadcast(wanted) if small else wanted, same)
        if not wanted.where("rows > 1").isEmpty():
            texts = texts.dropDuplicates(["a", "piece", "node"])

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            words = _Words()
            for batch in batches:
                found = [elements(text.as_py(), rule.shingle, words).view(np.int64) for text in batch.column(3)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(found, pa.list_(pa.int64()))],
                                                 names=["a", "piece", "node", "elements"])

        held = texts.select("a", "piece", "node", F.col("text").cast("binary")).mapInArrow(
            read, "a long, piece int, node long, elements array<long>")
        order = ["a", "piece", (F.col("node") != F.col("a")).alias("member")]
        dealt = held.select(*order, "node", "elements").repartition("a", "piece").sortWithinPartitions("a", "piece", "member")

        def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            head = np.zeros(0, np.uint64)
            for batch in batches:
                a, member, node = (batch.column(k).to_pylist() for k in (0, 2, 3))
                found = []
                for row in range(len(a)):
                    own = batch.column(4)[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                    if not member[row]:
                        head = own
                        continue
                    place = np.minimum(np.searchsorted(head, own), len(head) - 1)
                    if rule.linked(len(head), len(own), int((head[place] == own).sum())):
                        found.append((a[row], node[row]))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

        return dealt.mapInArrow(compare, "a long, b long")

    def _add(self, pairs: DataFrame) -> None:
        links = stored(self.check(pairs), "jaccard-links")
        self.links = links if self.links is None else self.links.unionAll(links)
        self.groups = stored(connected_components(self.links), "jaccard-groups")

    def open(self, pairs: DataFrame) -> DataFrame:
        """The pairs whose sets are not known to be connected."""
        if self.groups is None:
            return pairs
        named = pairs
        for side in ("a", "b"):
            own = self.groups.select(F.col("node").alias(side), F.col("component").alias(f"c_{side}"))
            named = named.join(own, side, "left")
        return named.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")

    def settle(self, pairs: DataFrame) -> None:
        """Check pairs: for every ``b`` the smallest ``a`` first, then those that are not connected by that."""
        if pairs.isEmpty():
            return
        first = stored(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), "jaccard-nearest")
        self._add(first)
        rest = stored(self.open(pairs).join(first, ["a", "b"], "left_anti"), "jaccard-rest")
        if not rest.isEmpty():
            self._add(rest)

    def unsettled(self, shared: DataFrame, sketches: DataFrame, piece: int) -> DataFrame:
        """Pairs (a, b) of sets that share a signature, lie in different components and pass the sketches.

        The pivot of a group has met all its sets. Of the others, those of the pivot's component need not meet each
        other, so a large group of linked sets costs as much as its few exceptions. Groups of the same sets count once.
        """
        group = F.coalesce("component", "node")
        named = (shared.join(self.groups, "node", "left") if self.groups is not None
                 else shared.withColumn("component", F.lit(None).cast("long"))).select("signature", "node", "pivot", group.alias("component"))
        other = F.col("node") != F.col("pivot")
        kinds = named.groupBy("signature").agg(
            F.max(F.when(~other, F.col("component"))).alias("main"), F.min("component").alias("low"), F.max("component").alias("high"),
            F.count_if(other).alias("sets"), F.bit_xor(F.xxhash64("node")).alias("content"), F.first("pivot").alias("pivot"))
        kinds = kinds.where((F.col("sets") > 1) & (F.col("low") != F.col("high")))
        kinds = kinds.groupBy("sets", "content", "pivot", "main").agg(F.min("signature").alias("signature"))
        kinds = stored(kinds.select("signature", "main"), "jaccard-kinds")
        rows = named.where(other).join(kinds, "signature").withColumn("apart", F.col("component") != F.col("main"))
        rows = stored(rows.select("signature", "node", "component", "apart"), "jaccard-open")
        parts = rows.groupBy("signature").agg(
            F.ceil(F.count_if(~F.col("apart")) / piece).cast("int").alias("mains"),
            F.ceil(F.count_if(F.col("apart")) / piece).cast("int").alias("others")).where("others > 0")
        rows = rows.join(parts, "signature").join(sketches, "node")

        def numbers(count: str):
            return F.filter(F.sequence(F.lit(0), F.col(count)), lambda k: (k >= 0) & (k < F.col(count)))

        def to(kind, i, j, side):
            return F.struct(kind.alias("kind"), i.alias("i"), j.alias("j"), side.alias("side"))

        own = F.pmod(F.xxhash64("node"), F.when(F.col("apart"), F.col("others")).otherwise(F.col("mains"))).cast("int")
        rows = rows.withColumn("own", own)
        meets, among = F.lit(0), F.lit(1)
        apart = F.concat(F.transform(numbers("mains"), lambda k: to(meets, k, F.col("own"), F.lit(1))),
                         F.transform(numbers("others"), lambda k: to(among, F.least(k, "own"), F.greatest(k, "own"),
                                                                     (k < F.col("own")).cast("int"))))
        main = F.transform(numbers("others"), lambda k: to(meets, F.col("own"), k, F.lit(0)))
        rows = rows.select("signature", F.explode(F.when(F.col("apart"), apart).otherwise(main)).alias("to"), "node", "component",
                           "n_shingles", "sketch")
        key = ["signature", "kind", "i", "j"]
        dealt = (rows.select("signature", "to.kind", "to.i", "to.j", "to.side", "node", "component", "n_shingles", "sketch")
                 .repartition(*key).sortWithinPartitions(*key, "side"))
        rule = self._rule

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for table in _whole_groups(batches, len(key)):
                for a, b in _passing(table, rule):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])

        return dealt.mapInArrow(run, "a long, b long").distinct()


def _whole_groups(batches: Iterator[pa.RecordBatch], n_keys: int) -> Iterator[pa.Table]:
    """The rows of one group of equal leading columns at a time; a group is two pieces at most."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        keys = [batch.column(k).to_numpy() for k in range(n_keys)]
        cut = np.zeros(batch.num_rows, bool)
        for k, column in enumerate(keys):
            cut[1:] |= column[1:] != column[:-1]
            if held and batch.num_rows:
                cut[0] |= held[-1].column(k)[-1].as_py() != column[0]
        edges = [0, *np.flatnonzero(cut).tolist(), batch.num_rows]
        for low, high in zip(edges, edges[1:]):
            if held and low < batch.num_rows and cut[low]:
                yield pa.Table.from_batches(held)
                held = []
            if high > low:
                held.append(batch.slice(low, high - low))
    if held:
        yield pa.Table.from_batches(held)


def _passing(table: pa.Table, rule: Similarity) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of one group between the two sides, or among the sets of its only side, in different components."""
    side, node, component, size = (table.column(k).to_numpy() for k in (4, 5, 6, 7))
    sketches = table.column(8).to_pylist()
    words = _folded(sketches, min(map(len, sketches)))
    left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    alone = table.column("kind")[0].as_py() == 1 and table.column("i")[0].as_py() == table.column("j")[0].as_py()
    if alone:
        right = left
    if not len(left) or not len(right):
        return
    step = max(1, COMPARED // (len(right) * words.shape[1]))
    for at in range(0, len(left), step):
        own = left[at:at + step]
        total = size[own][:, None] + size[right][None, :]
        ok = (component[own][:, None] != component[right][None, :]) & rule.near(size[own][:, None], size[right][None, :])
        if alone:
            ok &= own[:, None] < right[None, :]
        ok &= _apart(words[own][:, None, :], words[right][None, :, :]) <= rule.allowed(total)
        x, y = np.nonzero(ok)
        if len(x):
            yield node[own[x]], node[right[y]]


def similar_documents(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rule: Similarity | None = None,
                      piece: int = PIECE) -> DataFrame:
    """Every row's ``doc_id``, ``n_shingles`` (the size of its set) and ``component_id``.

    Words are the runs between ASCII white space after A-Z became a-z. Two documents are in one component if a chain of
    links connects them; ``component_id`` is the smallest doc_id in it, the row's own included. Null and empty texts,
    and those without words, have an empty set and are linked with nothing, not even with each other. Equal sets are
    linked. Rows without doc_id take part and never name a component; repeated rows stay rows. An empty table gives
    none. Other columns are not read. Sets are told apart by hashes of 64 bits.
    """
    rule = rule or Similarity()
    slim = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn(
        "text_hash", F.xxhash64("text"))
    sets = stored(sets_of(slim, rule), "jaccard-sets")
    prints = sets.select("doc_id", "text_hash", "node", "n_shingles")
    own = sets.where(F.col("sketch").isNotNull())
    sketches = own.groupBy("node").agg(F.max("n_shingles").alias("n_shingles"), F.max("sketch").alias("sketch"))
    shared = stored(sharing(own), "jaccard-shared")
    join = _Join(slim, prints, rule)
    met = shared.where(F.col("node") != F.col("pivot")).select(F.col("pivot").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stored(possible(met, sketches, rule), "jaccard-pairs")
    join.settle(pairs)
    more = join.unsettled(shared, sketches, piece).join(pairs, ["a", "b"], "left_anti")
    join.settle(stored(more, "jaccard-more"))

    least = prints.where(F.col("node").isNotNull()).groupBy("node").agg(F.min("doc_id").alias("least"))
    if join.groups is not None:
        named = least.join(join.groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        names = named.groupBy("component").agg(F.min("least").alias("component_id"))
        least = named.join(names, "component").select("node", F.col("component_id").alias("least"))
    # As a table, so that Spark sees two plain shuffles and can split the partition of a set with many rows.
    least = stored(least, "jaccard-named")
    drop(shared)
    joined = prints.where(F.col("node").isNotNull()).join(least, "node").select("doc_id", "n_shingles", F.col("least").alias("component_id"))
    alone = prints.where(F.col("node").isNull()).select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return joined.unionAll(alone)
