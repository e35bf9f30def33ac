"""The permutation index against brute force."""

import numpy as np
import pytest

from clientpulse.llm import permutation_index as index
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, label int, v string, shard int, kind int"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "v", 5, 7) for i, v in rows], SCHEMA)


def brute(ids, vectors, every=20, wanted=20):
    out = {}
    for i, v in zip(ids, vectors):
        if i % every == 0:
            score = (vectors * v).sum(axis=1)
            order = [k for k in np.lexsort((ids, -score)) if ids[k] != i][:wanted]
            out[i] = [(int(ids[k]), float(score[k])) for k in order]
    return out


def lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r.query_id, r.rank)):
        assert r.rank == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("shard_rows,share,least", [(10_000, 0.2, 400), (150, 0.4, 60)])
def test_recall_on_the_given_vectors(spark, shard_rows, share, least):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    want = brute(ids, vectors)
    got = lists(index.nearest(frame(spark, [(r.vec_id, r.embedding) for r in rows]), shard_rows=shard_rows, share=share,
                              least=least))
    assert got.keys() == want.keys() and {len(v) for v in got.values()} == {20}
    recall = np.mean([len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want])
    assert recall >= 0.9
    score_of = {q: dict(zip(ids.tolist(), (vectors * vectors[ids == q]).sum(axis=1))) for q in want}
    assert all(abs(s - score_of[q][i]) < 1e-12 for q in got for i, s in got[q])


@pytest.mark.parametrize("lengths", ["equal", "uniform", "lognormal"])
def test_recall_on_two_thousand_vectors_of_uneven_lengths(spark, lengths):
    rows = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").collect()
    chance = np.random.default_rng(4)
    size = {"equal": np.ones(len(rows)), "uniform": chance.uniform(0.5, 1.5, len(rows)), "lognormal": chance.lognormal(0, 0.5, len(rows))}[lengths]
    ids = np.array([r.vec_id for r in rows])
    vectors = (np.array([r.embedding for r in rows], float) * size[:, None]).astype(np.float32)
    want = brute(ids, vectors.astype(float))
    got = lists(index.nearest(frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)])))
    recall = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.93 and min(recall) >= 0.55


def test_reranking_everything_is_exact(spark):
    chance = np.random.default_rng(1)
    vectors = chance.normal(size=(300, 8)).astype(np.float32)
    vectors[50:120] = vectors[50]  # copies
    ids = np.arange(300)
    got = lists(index.nearest(frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)]), share=1.0, shard_rows=70))
    want = brute(ids, vectors.astype(float))
    assert {q: [i for i, _ in v] for q, v in got.items()} == {q: [i for i, _ in v] for q, v in want.items()}


def test_a_third_of_equal_vectors_keeps_its_smallest_ids(spark):
    chance = np.random.default_rng(2)
    n = 9000
    vectors = chance.normal(size=(n, 8)).astype(np.float32)
    copies = chance.choice(n, n // 3, replace=False)
    vectors[copies] = vectors[copies[0]]
    ids = np.arange(n)
    got = lists(index.nearest(frame(spark, [(int(i), v.tolist()) for i, v in zip(ids, vectors)])))
    want = brute(ids, vectors.astype(float))
    equal = set(copies.tolist())
    assert got.keys() == want.keys()
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in want if want[q][0][0] in equal and q in equal)
    recall = [len({i for i, _ in got[q]} & {i for i, _ in want[q]}) / 20 for q in want]
    assert np.mean(recall) >= 0.9


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 1.0]), (1, [0.5, 0.5]), (1, [0.5, 0.5]), (2, None), (3, [0.0, 0.0]), (40, [nan, 1.0]), (4, [inf, 1.0]),
            (5, [1.0, None]), (6, [1.0, 2.0, 3.0]), (7, []), (None, [1.0, 1.0]), (-20, [-1.0, 0.0]), (20, [0.0, 2.0])]
    got = lists(index.nearest(frame(spark, rows)))
    assert got == {0: [(1, 0.5), (20, 0.0), (-20, -1.0)], 20: [(1, 0.5), (-20, 0.0), (0, 0.0)],
                   -20: [(20, 0.0), (1, -0.5), (0, -1.0)]}


def test_empty_and_single(spark):
    assert index.nearest(spark.createDataFrame([], SCHEMA)).collect() == []
    assert index.nearest(frame(spark, [(20, [1.0])])).collect() == []


def test_footrule_by_inverted_files():
    chance = np.random.default_rng(3)
    vectors, pivots = chance.normal(size=(40, 5)), chance.normal(size=(12, 5))
    length = np.sqrt((vectors ** 2).sum(axis=1).max()) + 3
    pivots = index.lengthened(pivots, length)
    shard = index.Shard(np.arange(40), vectors, pivots, posted=6)
    order = index.orders(index.lengthened(vectors, length), pivots, 6)
    ask = index.orders(chance.normal(size=(1, 5)), pivots[:, :-1], 4)[0]
    plain = [sum(abs((o.tolist().index(p) if p in o else 6) - k) for k, p in enumerate(ask)) for o in order]
    assert shard.footrule(ask).tolist() == plain
