"""BPE encoding and decoding of whole texts, equal to the tokenizers library for word-final BPE vocabularies.

The corpus's frequent words are counted, encoded once, and compiled into a transducer (``lexicon``) that every task
maps into memory. A task looks a batch's different words up in it; words it does not hold are merged exactly.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.llm.lexicon import Lexicon, compile_lexicon
from clientpulse.llm.stored import stored

#: Words in the lexicon, and the longest it takes (bytes); both only decide how a word is encoded, not its ids.
LEXICON_WORDS = 1 << 17
#: Classes of word counts per factor of e.
COUNT_CLASSES = 64
LEXICON_BYTES = 48
#: Characters split into words at once, and words a task remembers; both bound memory.
PART_CHARS = 1 << 20
KNOWN_WORDS = 1 << 17
#: Words that a task counts before it sends their counts.
COUNTED_WORDS = 1 << 19
#: Texts decoded at once.
DECODED_ROWS = 512
WORD_END = "</w>"
#: Bytes of words that are merged together, and how many at once.
SHORT_WORD = 32
MERGE_ROWS = 1 << 14
#: Up to here normal form, lower case and character classes do not depend on the Unicode version.
PLAIN_LIMIT = 0x250


def _byte_letters() -> list[str]:
    """The printable character that stands for each byte: itself if visible in Latin-1, else the next one from 256 on."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    letters, free = [""] * 256, 256
    for b in range(256):
        if b in shown:
            letters[b] = chr(b)
        else:
            letters[b], free = chr(free), free + 1
    return letters


BYTE_LETTERS = _byte_letters()


def _class(kind: str) -> str:
    """The characters of a general category, as a regular expression class, as far as plain texts have them."""
    plain = {c for k in range(PLAIN_LIMIT) for c in (chr(k), *chr(k).lower())}
    return "".join(re.escape(c) for c in sorted(plain) if unicodedata.category(c).startswith(kind))


_LETTERS, _DIGITS, _BLANKS = _class("L"), _class("N"), "\t-\r \x85\xa0"
_PIECE = re.compile(rf"[{_LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[{_DIGITS}]|[^{_BLANKS}{_LETTERS}{_DIGITS}]+")
_NOT_PLAIN = re.compile(f"[^\0-{chr(PLAIN_LIMIT - 1)}]")


@dataclass(frozen=True)
class Vocabulary:
    """What a tokenizer file says: ids of pieces, ranks of merges, special strings, and the file itself."""
    ids: dict[str, int]
    ranks: dict[tuple[str, str], int]
    special: dict[str, int]
    source: str

    @classmethod
    def read(cls, source: str) -> Vocabulary:
        spec = json.loads(source)
        model = spec["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        return cls(model["vocab"], {m: k for k, m in enumerate(merges)},
                   {t["content"]: t["id"] for t in spec["added_tokens"]}, source)

    @property
    def pieces(self) -> list[str | None]:
        """The piece of each id."""
        named = {i: p for p, i in (self.ids | self.special).items()}
        return [named.get(i) for i in range(max(named, default=-1) + 1)]

    def merge_table(self) -> dict[str, np.ndarray]:
        """The merges as arrays over ids: sorted pair keys, their ranks, the joined ids, and the ids of the 256 bytes."""
        ids, size = self.ids, max(self.ids.values(), default=0) + 1
        try:
            rows = np.array([(ids[a] * size + ids[b], rank, ids[a + b]) for (a, b), rank in self.ranks.items()], np.int64)
            letters = np.array([[ids[c], ids[c + WORD_END]] for c in BYTE_LETTERS], np.int64)
        except KeyError as missing:
            raise ValueError(f"a byte or a merge is not in the vocabulary: {missing}") from None
        rows = rows.reshape(-1, 3)
        rows = rows[np.argsort(rows[:, 0])]
        joined = np.zeros(len(rows) + 1, np.int64)
        joined[rows[:, 1]] = rows[:, 2]
        return {"size": np.array(size), "keys": rows[:, 0].copy(), "ranks": rows[:, 1].copy(), "joined": joined,
                "inner": letters[:, 0].copy(), "last": letters[:, 1].copy()}


class Merger:
    """Merges words to ids: the adjacent pair of the lowest rank is joined first, the leftmost among equals.

    Short words are merged many together, in a matrix with a row per word and one merge per row and step.
    """

    def __init__(self, table: dict[str, np.ndarray]):
        self._size, self._none = int(table["size"]), len(table["keys"])
        self._keys, self._ranks, self._joined = table["keys"], table["ranks"], table["joined"]
        self._inner, self._last = table["inner"], table["last"]
        self._by_pair: dict[int, int] | None = None

    def merge_one(self, word: bytes) -> tuple[int, ...]:
        """One word, with a heap: time grows with the length and its logarithm."""
        if not word:
            return ()
        if self._by_pair is None:
            self._by_pair = dict(zip(self._keys.tolist(), self._ranks.tolist()))
        size, ranks, joined = self._size, self._by_pair, self._joined
        parts = [*self._inner[list(word[:-1])].tolist(), int(self._last[word[-1]])]
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(ranks[p], k, p) for k in range(n - 1) if (p := parts[k] * size + parts[k + 1]) in ranks]
        heapq.heapify(heap)
        while heap:
            rank, k, pair = heapq.heappop(heap)
            right = after[k]
            if parts[k] < 0 or right >= n or parts[k] * size + parts[right] != pair:
                continue
            parts[k], parts[right] = int(joined[rank]), -1
            after[k] = right = after[right]
            if right < n:
                before[right] = k
                if (p := parts[k] * size + parts[right]) in ranks:
                    heapq.heappush(heap, (ranks[p], k, p))
            left = before[k]
            if left >= 0 and (p := parts[left] * size + parts[k]) in ranks:
                heapq.heappush(heap, (ranks[p], left, p))
        return tuple(i for i in parts if i >= 0)

    def _rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left * self._size + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (right >= 0), self._ranks[at], self._none)

    def merge(self, words: list[bytes]) -> list[tuple[int, ...]]:
        found: list[tuple[int, ...]] = [()] * len(words)
        by_size: dict[int, list[int]] = {}
        for k, word in enumerate(words):
            if 1 < len(word) <= SHORT_WORD and self._none:
                by_size.setdefault(-(-len(word) // 4) * 4, []).append(k)
            else:
                found[k] = self.merge_one(word)
        for width, places in by_size.items():
            for at in range(0, len(places), MERGE_ROWS):
                block = places[at:at + MERGE_ROWS]
                for k, ids in zip(block, self._merge_block([words[k] for k in block], width)):
                    found[k] = ids
        return found

    def _merge_block(self, words: list[bytes], width: int) -> list[tuple[int, ...]]:
        size = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in words), np.uint8).reshape(-1, width)
        column = np.arange(width)
        state = np.where(column < size[:, None], self._inner[raw], -1)
        rows = np.arange(len(words))
        state[rows, size - 1] = self._last[raw[rows, size - 1]]
        ranks = np.full((len(words), width), self._none, np.int64)
        ranks[:, :-1] = self._rank(state[:, :-1], state[:, 1:])
        done = state.copy()
        while len(rows):
            k = ranks.argmin(axis=1)
            line = np.arange(len(rows))
            best = ranks[line, k]
            more = best < self._none
            if not more.all():
                done[rows[~more]] = state[~more]
                rows, state, ranks, k, best = rows[more], state[more], ranks[more], k[more], best[more]
                line = np.arange(len(rows))
                if not len(rows):
                    break
            state[line, k] = self._joined[best]
            right = np.minimum(column + (column > k[:, None]), width - 1)
            state = np.take_along_axis(state, right, axis=1)
            state[:, -1] = -1
            ranks = np.take_along_axis(ranks, np.minimum(column + (column >= k[:, None]), width - 1), axis=1)
            ranks[:, -1] = self._none
            ranks[line, k] = self._rank(state[line, k], state[line, np.minimum(k + 1, width - 1)])
            inner = k > 0
            ranks[line[inner], k[inner] - 1] = self._rank(state[line[inner], k[inner] - 1], state[line[inner], k[inner]])
        count = (done >= 0).sum(axis=1).tolist()
        return [tuple(row[:n]) for row, n in zip(done.tolist(), count)]


class Splitter:
    """Texts to words. Special strings are words of their own."""

    def __init__(self, special: dict[str, int], source: str):
        names = "|".join(map(re.escape, sorted(special, key=len, reverse=True)))
        self._special = re.compile(f"({names})" if special else "(?!)")
        self._names, self._source, self._library = special, source, None

    def words(self, text: str) -> list[str]:
        found: list[str] = []
        for part in self._special.split(text):
            if part in self._names:
                found.append(part)
            elif not _NOT_PLAIN.search(part):
                found += _PIECE.findall(part.lower())
            elif part:
                found += self._by_library(part)
        return found

    def _by_library(self, text: str) -> list[str]:
        """The library's own normal form and word split, for texts beyond the plain characters."""
        if self._library is None:
            from tokenizers import Tokenizer
            self._library = Tokenizer.from_str(self._source)
            self._byte_of = {letter: b for b, letter in enumerate(BYTE_LETTERS)}
        pieces = self._library.pre_tokenizer.pre_tokenize_str(self._library.normalizer.normalize_str(text))
        return [bytes(self._byte_of[c] for c in piece).decode("utf-8", "surrogatepass") for piece, _ in pieces]


def parts_of(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """A long text in parts, cut at blanks only: no word and no special string has one."""
    at = 0
    while len(text) - at > size:
        cut = max(text.rfind(" ", at, at + size), text.rfind("\n", at, at + size))
        if cut <= at:
            nearest = [c for c in (text.find(" ", at + size), text.find("\n", at + size)) if c >= 0]
            if not nearest:
                break
            cut = min(nearest)
        yield text[at:cut]
        at = cut
    yield text[at:]


class Encoder:
    """Words to ids by the lexicon, else by merging; remembers a bounded number of words.

    A known word is a number into arrays of ids, so that the ids of many texts are gathered at once.
    """

    def __init__(self, table: dict[str, np.ndarray], special: dict[str, int], source: str, lexicon: Lexicon):
        self._merger, self._lexicon, self._splitter = Merger(table), lexicon, Splitter(special, source)
        self._special = {word: (i,) for word, i in special.items()}
        self._remember({})

    def _remember(self, found: dict[str, tuple[int, ...]]) -> None:
        """Know these words and the special ones, and no others."""
        found = self._special | found
        self._number = {word: k for k, word in enumerate(found)}
        self._ids, self._starts, self._sizes = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self._append(list(found.values()))

    def _append(self, lists: list[tuple[int, ...]]) -> None:
        sizes = np.fromiter(map(len, lists), np.int64, len(lists))
        ids = np.fromiter(chain.from_iterable(lists), np.int32, int(sizes.sum()))
        self._starts = np.concatenate([self._starts, len(self._ids) + np.cumsum(sizes) - sizes])
        self._sizes, self._ids = np.concatenate([self._sizes, sizes]), np.concatenate([self._ids, ids])

    def encode(self, texts: list[str]) -> list[list[int]]:
        """The ids of each text."""
        ids, sizes = self.gathered(texts)
        ends = np.cumsum(sizes).tolist()
        flat = ids.tolist()
        return [flat[low:high] for low, high in zip([0, *ends], ends)]

    def gathered(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(the ids of all texts in a row, the number of ids of each text)."""
        split = [self._splitter.words(t) for t in texts]
        self._learn(set(chain.from_iterable(split)))
        counts = np.fromiter(map(len, split), np.int64, len(split))
        numbers = np.fromiter(map(self._number.__getitem__, chain.from_iterable(split)), np.int64, int(counts.sum()))
        sizes = self._sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.repeat(self._starts[numbers] - (ends - sizes), sizes)
        places += np.arange(len(places))
        upto, last = np.concatenate([np.zeros(1, np.int64), ends]), np.cumsum(counts)
        return self._ids[places], upto[last] - upto[last - counts]

    def _learn(self, words: set[str]) -> None:
        new = list(words - self._number.keys())
        if len(self._number) + len(new) > KNOWN_WORDS:
            still = {w: k for w, k in self._number.items() if w in words and w not in self._special}
            self._remember({w: tuple(self._ids[self._starts[k]:self._starts[k] + self._sizes[k]].tolist()) for w, k in still.items()})
        raw = [w.encode("utf-8", "surrogatepass") for w in new]
        places = self._lexicon.places(raw)
        held, unseen = np.flatnonzero(places >= 0), np.flatnonzero(places < 0).tolist()
        at = len(self._number)
        self._number.update(zip((new[k] for k in chain(held.tolist(), unseen)), range(at, at + len(new))))
        self._append(self._lexicon.ids_at(places[held]))
        self._append(self._merger.merge([raw[k] for k in unseen]))


def _read(path: str) -> str:
    with open(path, encoding="utf-8") as file:
        return file.read()


def word_counts(docs: DataFrame, special: dict[str, int], source: str, text: str = "text") -> DataFrame:
    """(word, n): how often each word of at most ``LEXICON_BYTES`` bytes occurs in all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen = Splitter(special, source), Counter()
        for batch in batches:
            for value in batch.column(0):
                for part in parts_of(value.as_py() or ""):
                    seen.update(splitter.words(part))
                if len(seen) > COUNTED_WORDS:
                    yield from _counts(seen)
                    seen = Counter()
        yield from _counts(seen)

    counted = docs.select(F.col(text).alias("text")).mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _counts(seen: Counter) -> Iterator[pa.RecordBatch]:
    words = [w for w in seen if 0 < len(w.encode("utf-8", "surrogatepass")) <= LEXICON_BYTES]
    for at in range(0, len(words), MERGE_ROWS):
        some = words[at:at + MERGE_ROWS]
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.string()), pa.array([seen[w] for w in some], pa.int64())],
                                         names=["word", "n"])


def frequent_words(docs: DataFrame, special: dict[str, int], source: str, text: str = "text",
                   limit: int = LEXICON_WORDS) -> DataFrame:
    """The most frequent words, ``limit`` at most: all those in the highest classes of counts that fit whole.

    The classes are logarithmic, so their number is small however large the corpus; no more than ``limit`` words ever
    leave the executors.
    """
    counts = stored(word_counts(docs, special, source, text)
                    .withColumn("class", F.floor(F.log("n") * COUNT_CLASSES).cast("int")), "bpe-words")
    least, total = None, 0
    for row in counts.groupBy("class").count().orderBy(F.desc("class")).collect():
        total += row["count"]
        if total > limit:
            break
        least = row["class"]
    return counts.where(F.col("class") >= least if least is not None else F.lit(False)).select("word", "n")


def build_lexicon(docs: DataFrame, path: str, text: str = "text", limit: int = LEXICON_WORDS) -> bytes:
    """The image of the lexicon of the corpus's frequent words; at most ``limit`` words come to the driver."""
    vocabulary = Vocabulary.read(_read(path))
    words = [r["word"] for r in frequent_words(docs, vocabulary.special, vocabulary.source, text, limit).collect()]
    words = [w.encode("utf-8", "surrogatepass") for w in words if w not in vocabulary.special]
    return compile_lexicon(dict(zip(words, Merger(vocabulary.merge_table()).merge(words))))


def encode(docs: DataFrame, path: str, image: bytes, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, ids): a struct of the columns ``keep`` (all by default) and the text's token ids.

    ``path`` names the tokenizer file on the driver and ``image`` a lexicon; both are of a fixed size and are
    broadcast. Special strings in a text are their ids, as in the library. A null or empty text has no ids; repeated
    rows are encoded each; an empty table gives no rows.
    """
    names = docs.columns
    at, kept = names.index(text), [names.index(k) for k in (names if keep is None else keep)]
    packed = docs.select(F.struct("*").alias("row"))
    row = T.StructType([packed.schema["row"].dataType.fields[k] for k in kept])
    shape = T.StructType([T.StructField("row", row), T.StructField("ids", T.ArrayType(T.IntegerType()))])
    vocabulary = Vocabulary.read(_read(path))
    shared = docs.sparkSession.sparkContext.broadcast(
        (vocabulary.merge_table(), vocabulary.special, vocabulary.source, image))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, special, source, lexicon = shared.value
        encoder = Encoder(table, special, source, Lexicon(lexicon))
        for batch in batches:
            for low, texts in runs_of_texts(batch.column(0).field(at)):
                whole = batch.column(0).slice(low, len(texts))
                if len(texts) == 1:
                    flat = np.concatenate([encoder.gathered([p])[0] for p in parts_of(texts[0])])
                    sizes = [len(flat)]
                else:
                    flat, sizes = encoder.gathered(texts)
                offsets = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
                part = pa.StructArray.from_arrays([whole.field(k) for k in kept], names=row.names)
                yield pa.RecordBatch.from_arrays([part, ids], names=["row", "ids"])

    return packed.mapInArrow(run, shape)


def runs_of_texts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """(first row, texts) of successive rows that are small enough together; a very long text comes alone."""
    low, texts, chars = 0, [], 0
    for k, value in enumerate(column):
        content = value.as_py() or ""
        if texts and chars + len(content) > PART_CHARS:
            yield low, texts
            low, texts, chars = k, [], 0
        texts.append(content)
        chars += len(content)
    if texts:
        yield low, texts


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with the text of ``ids``: pieces joined by a space, as a tokenizer file without a decoder has it.

    Ids without a piece are skipped; null ids give an empty text.
    """
    at = encoded.columns.index(ids)
    shape = T.StructType([*encoded.schema.fields, T.StructField(name, T.StringType())])
    shared = encoded.sparkSession.sparkContext.broadcast(Vocabulary.read(_read(path)).pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = pa.array(shared.value, pa.string())
        shown = np.array([bool(piece) for piece in shared.value])
        for batch in batches:
            for low in range(0, batch.num_rows, DECODED_ROWS):
                some = batch.slice(low, DECODED_ROWS)
                lists = some.column(at)
                flat = lists.flatten().to_numpy(zero_copy_only=False)
                sizes = np.array([n or 0 for n in pc.list_value_length(lists).to_pylist()], np.int64)
                known = (flat >= 0) & (flat < len(shown))
                known[known] = shown[flat[known]]
                upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(known)])
                ends = np.cumsum(sizes)
                offsets = np.concatenate([np.zeros(1, np.int64), np.cumsum(upto[ends] - upto[ends - sizes])])
                words = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pieces.take(pa.array(flat[known])))
                texts = pc.binary_join(words, " ")
                yield pa.RecordBatch.from_arrays([*some.columns, texts], names=shape.names)

    return encoded.mapInArrow(run, shape)
