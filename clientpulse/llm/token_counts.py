"""Token counts under a unigram vocabulary, without making tokens.

An Aho-Corasick automaton enumerates the vocabulary's pieces in a word; dynamic programming over the word's positions
carries the best score and the number of pieces on the best path, nothing else. Ties follow the tokenizers library: of
equal scores the path whose last piece starts first wins, and a character without a piece of its own may be an unknown
at the lowest score minus ten, which counts its UTF-8 bytes where the vocabulary has pieces for bytes.

Texts are split as by a Metaspace pre-tokenizer over blanks made one: each word is led by the mark ``▁``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Sequence
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.llm.bpe import parts_of, runs_of_texts

MARK = "▁"
#: What an unknown character costs below the lowest score of a piece.
UNKNOWN_PENALTY = 10.0
#: Words whose counts a task remembers; bounds memory only.
KNOWN_WORDS = 1 << 18
# Unicode white space; str.split() would also part words at the four ASCII separators.
_BLANKS = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_SEPARATORS = re.compile("[\x1c-\x1f]")
_MARKED = re.compile(f"{MARK}[^{MARK}]*")
_BYTES = frozenset(f"<0x{b:02X}>" for b in range(256))


def zipf_vocabulary(model_file: str) -> list[tuple[str, float]]:
    """Pieces of a sentencepiece file with scores by Zipf's law: minus the logarithm of a piece's rank.

    For vocabularies whose file ranks pieces but gives no probabilities. Control and byte pieces get the lowest score.
    """
    import sentencepiece
    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    n, rank, pieces = model.get_piece_size(), 0, []
    for i in range(n):
        plain = not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
        rank += plain
        pieces.append((model.id_to_piece(i), -math.log(rank + 1) if plain else -math.log(n + 1)))
    return pieces


class Counter:
    """Numbers of pieces per word for one vocabulary."""

    def __init__(self, vocabulary: Sequence[tuple[str, float]]):
        self._pieces = ahocorasick.Automaton()
        for piece, score in dict(vocabulary).items():
            if piece:
                self._pieces.add_word(piece, (len(piece), score))
        if len(self._pieces):
            self._pieces.make_automaton()
        self._unknown = min((s for _, s in vocabulary), default=0.0) - UNKNOWN_PENALTY
        self._has_bytes = _BYTES <= {p for p, _ in vocabulary}
        self._known: dict[str, int] = {}

    def best(self, word: str) -> tuple[float, int]:
        """Score and number of pieces of the best path through a word."""
        n = len(word)
        scores, counts, unknown = [0.0] + [-math.inf] * n, [0] * (n + 1), [False] * (n + 1)
        at = 1
        matches: list[tuple[int, float]] = []
        found = self._pieces.iter(word) if len(self._pieces) else iter(())
        for end, piece in chain(found, ((n, None),)):
            while at <= end:  # all pieces that end at position ``at`` are known
                self._step(word, at, matches, scores, counts, unknown)
                matches, at = [], at + 1
            if piece is not None:
                matches.append(piece)
        return scores[n], counts[n]

    def _step(self, word: str, at: int, matches: list, scores: list, counts: list, unknown: list) -> None:
        best, count, single = -math.inf, 0, False
        for length, score in matches:  # the longest first, so the earliest start wins a tie
            single |= length == 1
            candidate = score + scores[at - length]
            if candidate > best:
                best, count = candidate, counts[at - length] + 1
        if not single and (candidate := self._unknown + scores[at - 1]) > best:
            best = candidate
            if self._has_bytes:
                count = counts[at - 1] + len(word[at - 1].encode("utf-8", "surrogatepass"))
            else:  # unknowns in a row are one token
                count = counts[at - 1] + (not unknown[at - 1])
            unknown[at] = True
        scores[at], counts[at] = best, count

    def words(self, text: str) -> list[str]:
        if _SEPARATORS.search(text):
            words = [w for w in _BLANKS.split(text) if w]
        else:
            words = text.split()
        if MARK not in text:
            return words
        joined = MARK.join(words)
        return [w[1:] for w in _MARKED.findall(joined if joined.startswith(MARK) else MARK + joined)]

    def count(self, texts: list[str]) -> list[int]:
        """The number of tokens of each text."""
        split = [self.words(t) for t in texts]
        needed = set(chain.from_iterable(split))
        new = needed - self._known.keys()
        if len(self._known) + len(new) > KNOWN_WORDS:
            self._known = {w: self._known[w] for w in needed & self._known.keys()}
        self._known.update((w, self.best(MARK + w)[1]) for w in new)
        return [sum(map(self._known.__getitem__, words)) for words in split]


def counted(docs: DataFrame, vocabulary: Sequence[tuple[str, float]], text: str = "text",
            keep: list[str] | None = None) -> DataFrame:
    """(row, n_tokens): a struct of the columns ``keep`` (all by default) and the text's number of tokens.

    The vocabulary, of a fixed size, is broadcast. A null, empty or blank text has none; long texts are counted in
    parts cut between words; repeated rows are counted each; an empty table gives no rows.
    """
    names = docs.columns
    at, kept = names.index(text), [names.index(k) for k in (names if keep is None else keep)]
    packed = docs.select(F.struct("*").alias("row"))
    row = T.StructType([packed.schema["row"].dataType.fields[k] for k in kept])
    shape = T.StructType([T.StructField("row", row), T.StructField("n_tokens", T.LongType())])
    shared = docs.sparkSession.sparkContext.broadcast(list(vocabulary))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(shared.value)
        for batch in batches:
            whole, counts = batch.column(0), []
            for _, texts in runs_of_texts(whole.field(at)):
                # A text with the mark is one sequence, as its words are not parted by blanks alone.
                if len(texts) == 1 and MARK not in texts[0]:
                    counts.append(sum(counter.count([p])[0] for p in parts_of(texts[0])))
                else:
                    counts += counter.count(texts)
            part = pa.StructArray.from_arrays([whole.field(k) for k in kept], names=row.names)
            yield pa.RecordBatch.from_arrays([part, pa.array(counts, pa.int64())], names=["row", "n_tokens"])

    return packed.mapInArrow(run, shape)
