"""Quality scores learned from pairs: a Bradley-Terry model over features of the text alone.

The chance that document i is better than document j is logistic in w·(x_i − x_j). Pairs of one good and one bad
labelled document are the preferences; w is found by Newton's method on the logistic loss of their feature
differences. The threshold is a quantile of the labelled documents' scores, the one that parts the labels best, and
the score shown is the logistic of the distance to it, moved so that the threshold is 0.7.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

THRESHOLD = 0.7
#: Labelled documents used for the fit, half of them per label, chosen by a hash of their id.
MAX_LABELLED = 20_000
PAIRS = 200_000
RIDGE = 1e-2
SEED = 7
BYTE_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "digit": b"0123456789", "marks": b"#*$%&<>", "bar": b"|", "bang": b"!",
    "stop": b".?", "comma": b",;:", "quote": b"'\"`", "bracket": b"()[]{}", "other": b"@/\\^_~+=-", "line": b"\n",
    "control": bytes(range(9)) + b"\x0b\x0c" + bytes(range(14, 32)) + b"\x7f",
}
_LETTERS = np.zeros(256, bool)
_LETTERS[list(range(65, 91)) + list(range(97, 123)) + list(range(128, 256))] = True
_CLASS = np.zeros((len(BYTE_CLASSES), 256))
for _row, _bytes in enumerate(BYTE_CLASSES.values()):
    _CLASS[_row, list(_bytes)] = 1
N_FEATURES = len(BYTE_CLASSES) + 8


def features(text: str | None) -> np.ndarray:
    """Shares of byte classes, letters, repeated words and lines, and lengths, of one whole text (null: empty)."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(len(raw), 1)
    seen = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n_words, n_lines = max(len(words), 1), max(len(lines), 1)
    letters = seen[_LETTERS].sum()
    shares = np.log1p(200 * (_CLASS @ seen) / size)
    distinct = len(set(words))
    more = [letters / size, np.log1p(200 * seen[65:91].sum() / max(letters, 1)), np.log1p(len(words)),
            np.log(size / n_words), distinct / n_words, np.log(distinct + 1) / np.log(n_words + 1),
            1 - len(set(lines)) / n_lines, np.log1p(n_words / n_lines)]
    return np.concatenate([shares, more])


def feature_matrix(column: pa.Array) -> np.ndarray:
    found = np.empty((len(column), N_FEATURES))
    for at, value in enumerate(column):
        found[at] = features(value.as_py())
    return found


@dataclass(frozen=True)
class Ranker:
    """A fitted model: strength(x) = w·(x − centre)/scale; the threshold's strength and the quantile it stands for."""
    weights: np.ndarray
    centre: np.ndarray
    scale: np.ndarray
    threshold: float
    quantile: float

    def strength(self, x: np.ndarray) -> np.ndarray:
        return ((x - self.centre) / self.scale) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, at least 0.7 exactly where the strength reaches the threshold."""
        above = np.clip(self.strength(x) - self.threshold, -30, 30)
        shown = 1 / (1 + (1 / THRESHOLD - 1) * np.exp(-above))
        return np.where(above >= 0, np.maximum(shown, THRESHOLD), np.minimum(shown, np.nextafter(THRESHOLD, 0)))


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs: int = PAIRS, ridge: float = RIDGE, seed: int = SEED) -> Ranker:
    """Bradley-Terry weights from (good, bad) pairs drawn evenly over both sides.

    Without a document on either side there is no preference: all documents score the threshold.
    """
    n = x.shape[1]
    won, lost = np.flatnonzero(good), np.flatnonzero(~good)
    if not len(won) or not len(lost):
        return Ranker(np.zeros(n), np.zeros(n), np.ones(n), 0.0, 0.0)
    centre, scale = x.mean(axis=0), x.std(axis=0)
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = (x - centre) / scale
    chance = np.random.default_rng(seed)
    count = min(pairs, len(won) * len(lost))
    if count == len(won) * len(lost):
        i, j = np.repeat(won, len(lost)), np.tile(lost, len(won))
    else:
        i, j = chance.choice(won, count), chance.choice(lost, count)
    difference, w = z[i] - z[j], np.zeros(n)
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(difference @ w, -30, 30)))
        slope = difference.T @ (1 - p) / count - ridge * w
        bend = (difference * (p * (1 - p))[:, None]).T @ difference / count + ridge * np.eye(n)
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    threshold, quantile = _best_quantile(z @ w, good)
    return Ranker(w, centre, scale, threshold, quantile)


def _best_quantile(strength: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """The quantile of the strengths above which the labels agree best, both labels counting alike."""
    order = np.argsort(strength, kind="stable")
    s, g = strength[order], good[order]
    cuts = np.flatnonzero(np.append(True, s[1:] > s[:-1]))  # the first of each run of ties
    bad_below = np.append(0, np.cumsum(~g))[cuts] / (~g).sum()
    good_above = 1 - np.append(0, np.cumsum(g))[cuts] / g.sum()
    agree = bad_below + good_above
    best = np.flatnonzero(agree >= agree.max() - 1e-12)
    cut = cuts[best[len(best) // 2]]
    return (s[cut] + s[cut - 1]) / 2 if cut else s[0], cut / len(s)


def held_out(doc_id: Column) -> Column:
    """Documents kept out of the fit: crc32 of the id as text leaves 2 by 4. Without an id: false."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        max_labelled: int = MAX_LABELLED, **how) -> Ranker:
    """Fit on the documents of ``labels`` that are not held out.

    At most ``max_labelled`` labelled ids are used, half per label, by the order of a hash of the id; their texts'
    features, a few numbers each, come to the driver. Labels other than 0 and 1, null ids, and ids with both labels
    are left out; repeated labels count once, and so do repeated documents: of several texts of an id the one of the
    smallest hash is taken, so that ``max_labelled`` bounds the rows.
    """
    given = (labels.select(F.col(doc_id).alias("id"), F.col(label).alias("label"))
             .where(F.col("id").isNotNull() & F.col("label").isin(0, 1) & ~held_out(F.col("id")))
             .groupBy("id").agg(F.min("label").alias("good"), F.max("label").alias("most"))
             .where(F.col("good") == F.col("most")).select("id", "good"))
    half = [given.where(F.col("good") == v).orderBy(F.xxhash64("id"), "id").limit(max_labelled // 2) for v in (0, 1)]
    # Bounded by max_labelled ids.
    chosen = F.broadcast(half[0].unionAll(half[1]))
    texts = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(chosen, "id")
    # One row per id; Spark limits the rows of an id on both sides of the shuffle.
    first = Window.partitionBy("id").orderBy(F.xxhash64("text"), "text")
    texts = texts.withColumn("place", F.row_number().over(first)).where(F.col("place") == 1).drop("place")
    shape = T.StructType([T.StructField("id", texts.schema["id"].dataType), T.StructField("good", T.IntegerType()),
                          T.StructField("x", T.ArrayType(T.DoubleType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix(batch.column(1))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "good", "x"])

    found = texts.select("id", "text", F.col("good").cast("int").alias("good")).mapInArrow(run, shape).toArrow()
    x = found["x"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, N_FEATURES)
    ids, good = found["id"].to_pylist(), found["good"].to_numpy()
    # The same order, whatever order the rows come in.
    order = sorted(range(len(ids)), key=lambda k: (ids[k], *x[k].tolist()))
    return fit_pairs(x[order], good[order] == 1, **how)


def scored(docs: DataFrame, model: Ranker, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(row, score) per input row: a struct of the columns ``keep`` (all by default), and the score of the text.

    A null text scores as an empty one; repeated rows are scored each; an empty table gives no rows.
    """
    names = docs.columns
    at, kept = names.index(text), [names.index(k) for k in keep or names]
    packed = docs.select(F.struct("*").alias("row"))
    row = T.StructType([packed.schema["row"].dataType.fields[k] for k in kept])
    shape = T.StructType([T.StructField("row", row), T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0)
            score = model.score(feature_matrix(whole.field(at)))
            part = pa.StructArray.from_arrays([whole.field(k) for k in kept], names=row.names)
            yield pa.RecordBatch.from_arrays([part, pa.array(score)], names=["row", "score"])

    return packed.mapInArrow(run, shape)


def accepted_documents(docs: DataFrame, model: Ranker, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that score at least the threshold, columns as they came."""
    return scored(docs, model, text).where(F.col("score") >= THRESHOLD).select("row.*")
