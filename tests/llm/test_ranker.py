"""The pairwise ranker: held-out accuracy, thresholds and odd tables."""

import numpy as np
from pyspark.sql import functions as F

from clientpulse.llm import ranker
from tests.conftest import SF

SCHEMA = "doc_id long, text string, score double, row string, good int"
LABELS = "doc_id long, quality int, toxic int"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, 0.1, "r", 1) for i, t in rows], SCHEMA)


def many(spark):
    good = [(k, f"a calm line of words number {k} that reads like prose, and ends well.") for k in range(0, 60, 2)]
    bad = [(k, f"BUY!! NOW!! {k} $$$ ||| *** ###") for k in range(1, 60, 2)]
    labels = [(k, 1 - k % 2, 0) for k in range(60)]
    return docs_of(spark, good + bad), spark.createDataFrame(labels, LABELS)


def test_held_out_documents_of_the_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = ranker.fit(docs, labels)
    found = ranker.scored(docs, model, keep=["doc_id"]).select("row.doc_id", "score").join(labels, "doc_id")
    held = found.where(ranker.held_out(F.col("doc_id"))).toPandas()
    assert len(held) and ((held.score >= 0.7) == (held.quality == 1)).mean() >= 0.95


def test_held_out_is_the_remainder_of_the_checksum(spark):
    import zlib
    ids = spark.createDataFrame([(k,) for k in [*range(200), None]], "i long")
    got = {r.i: r.h for r in ids.select("i", ranker.held_out(F.col("i")).alias("h")).collect()}
    assert got == {k: zlib.crc32(str(k).encode()) % 4 == 2 for k in range(200)} | {None: False}


def test_good_above_bad_and_columns_pass_through(spark):
    docs, labels = many(spark)
    model = ranker.fit(docs, labels)
    score = {r.doc_id: r.score for r in ranker.scored(docs, model, keep=["doc_id"]).select("row.doc_id", "score").collect()}
    assert min(score[k] for k in range(0, 60, 2)) >= 0.7 > max(score[k] for k in range(1, 60, 2))
    stay = ranker.accepted_documents(docs, model)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == list(range(0, 60, 2))
    assert {r.score for r in stay.collect()} == {0.1}


def test_held_out_labels_do_not_matter(spark):
    docs, labels = many(spark)
    flipped = labels.withColumn("quality", F.when(ranker.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(
        F.col("quality")))
    assert np.array_equal(ranker.fit(docs, labels).weights, ranker.fit(docs, flipped).weights)


def test_without_preferences_nothing_is_rejected(spark):
    docs, labels = many(spark)
    for some in (labels.where("quality = 1"), labels.where("false"),
                 labels.unionAll(labels.withColumn("quality", 1 - F.col("quality"))),
                 labels.withColumn("quality", F.lit(None).cast("int"))):
        model = ranker.fit(docs, some)
        assert {r.score for r in ranker.scored(docs, model).collect()} == {0.7}


def test_odd_texts(spark):
    docs, labels = many(spark)
    model = ranker.fit(docs, labels)
    odd = docs_of(spark, [(1, None), (1, ""), (None, " \n"), (2, "word " * 200_000), (2, "\x00\x1f"), (3, "😀")])
    scores = [r.score for r in ranker.scored(odd, model).collect()]
    assert len(scores) == 6 and all(0 <= s <= 1 for s in scores) and scores[0] == scores[1]
    assert ranker.scored(spark.createDataFrame([], SCHEMA), model).collect() == []
    assert ranker.fit(spark.createDataFrame([], SCHEMA), labels).quantile == 0.0


def test_sample_is_bounded(spark):
    docs, labels = many(spark)
    assert ranker.fit(docs, labels, max_labelled=10).weights.any()


def test_pairs_decide_the_weights():
    chance = np.random.default_rng(0)
    x = chance.normal(size=(400, 3))
    good = 1 / (1 + np.exp(-(2 * x[:, 0] - x[:, 1]))) > chance.random(400)
    model = ranker.fit_pairs(x, good)
    assert model.weights[0] > 0.5 and model.weights[1] < -0.3 and abs(model.weights[2]) < 0.3
    shown = model.score(x)
    assert np.array_equal(shown >= 0.7, model.strength(x) >= model.threshold)


def test_weights_equal_plain_gradient_steps_over_all_pairs():
    chance = np.random.default_rng(7)
    x = chance.normal(size=(24, 2)) * [3, 0.5] + [1, -2]
    good = x[:, 0] + chance.normal(size=24) > 1
    model = ranker.fit_pairs(x, good)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    pairs = np.array([z[i] - z[j] for i in range(24) if good[i] for j in range(24) if not good[j]])
    w = np.zeros(2)
    for _ in range(20_000):
        w += 0.5 * ((pairs / (1 + np.exp(pairs @ w))[:, None]).mean(axis=0) - ranker.RIDGE * w)
    assert np.abs(model.weights - w).max() < 1e-6


def test_a_hot_labelled_id_counts_once(spark):
    """A third of all documents carry one labelled id: the fit reads one row of it, and the others weigh as before."""
    docs, labels = many(spark)
    plain = ranker.fit(docs, labels)
    again = docs.where("doc_id = 1").crossJoin(spark.range(200)).drop("id").select(docs.columns)
    hot = docs.unionAll(again)
    assert np.array_equal(ranker.fit(hot.repartition(7), labels).weights, plain.weights)
