"""Whitening by polarisation against numpy."""

from fractions import Fraction

import numpy as np
import pytest

from clientpulse.llm import queries, whitening
from tests.conftest import SF

SCHEMA = "vec_id long, embedding array<float>, x int, row string, whitened int, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "r", 2, "v") for i, v in rows], SCHEMA)


def scaled(vectors):
    return np.floor(64 * np.array(vectors, np.float32).astype(float)).astype(np.int64) + 1_000_000


def held_to_numpy(rows, vectors, components=16):
    """Every column of by_component against plain numpy over the vectors that take part."""
    x = scaled([v for _, v in vectors])
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    cov = np.cov(fit.T, bias=True).reshape(fit.shape[1], -1)
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1].T
    got = {}
    for r in rows:
        got.setdefault(r.row.vec_id, []).append(r)
    assert sorted(got) == sorted(i for i, _ in vectors)
    want = {i: int(((n * a - total).astype(object) ** 2).sum()) for (i, _), a in zip(vectors, x)}
    many = min(components, int((values > 1e-9).sum()))
    projected = {i: (a - total / n) @ axes[:many].T / np.sqrt(values[:many]) for (i, _), a in zip(vectors, x)}
    signs = np.ones(many)
    for i, own in got.items():
        own.sort(key=lambda r: r.component)
        assert [r.component for r in own] == list(range(1, many + 1))
        assert {(r.n, r.deviation) for r in own} == {(n, want[i])}
        assert all(abs(r.explained - values[r.component - 1] / np.trace(cov)) < 1e-9 for r in own)
        assert len({r.identity_error for r in own}) == 1 and own[0].identity_error < 1e-4
    for k in range(many):
        i = max(projected, key=lambda i: abs(projected[i][k]))
        signs[k] = np.sign(projected[i][k] * got[i][k].whitened)
    for i, own in got.items():
        assert np.abs(np.array([r.whitened for r in own]) - projected[i] * signs).max() < 1e-6


def found(spark, rows, **how):
    df = frame(spark, rows)
    model = whitening.fit(df, **how)
    return whitening.by_component(whitening.applied(df, model), model).collect()


def test_given_vectors(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    held_to_numpy(found(spark, rows), rows)
    out = queries.op12_embedding_whitening(spark, SF)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert dict(out.dtypes)["component"] == "int" and dict(out.dtypes)["deviation"] == "bigint" and out.count() == 16 * len(rows)


def test_odd_rows(spark):
    """Nulls and non-finite entries go, copies are fitted once, other lengths take no part, extra columns clash."""
    chance = np.random.default_rng(3)
    good = [(i, (chance.normal(size=5) * 30).astype(np.float32).tolist()) for i in range(40)]
    good += [(100 + i, good[0][1]) for i in range(30)]  # copies
    good += [(200, good[0][1])]
    odd = [(300, None), (301, []), (302, [1.0, None, 2.0, 3.0, 4.0]), (303, [float("nan")] * 5), (304, [float("inf")] * 5),
           (305, [1.0, 2.0]), (306, [3e38] * 5)]
    held_to_numpy(found(spark, good + odd, components=3), good, 3)


def test_few_vectors(spark):
    assert found(spark, []) == [] and found(spark, [(1, None)]) == []
    assert found(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == []  # one different vector: no component has variance
    rows = [(1, [1.0, 2.0]), (2, [3.0, 2.0])]
    held_to_numpy(found(spark, rows), rows)


@pytest.mark.parametrize("size", [1, 1 << 31, 1 << 40])
def test_sums_are_exact(size):
    chance = np.random.default_rng(5)
    y = chance.integers(-size, size + 1, (200, 4))
    n, total = len(y), y.sum(axis=0)
    base, rest = [int(t) // n for t in total], [int(t) % n for t in total]
    assert whitening._total(y) == [int(t) for t in y.astype(object).sum(axis=0)]
    got = whitening.covariance(n, rest, whitening._squares(y - np.array(base)))
    for i in range(4):
        for j in range(4):
            a, b = ([Fraction(int(v)) - Fraction(int(total[k]), n) for v in y[:, k]] for k in (i, j))
            want = sum(p * q for p, q in zip(a, b)) / n
            assert got[i, j] == float(want)


def test_large_entries_keep_exact_deviations(spark):
    rows = [(1, [2.0 ** 40, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 2.0 ** 30])]
    df = frame(spark, rows)
    model = whitening.fit(df)
    x = scaled([v for _, v in rows]).astype(object)
    total = x.sum(axis=0)
    want = {i: int(((3 * a - total) ** 2).sum()) for (i, _), a in zip(rows, x)}
    assert {r.row.vec_id: int(r.deviation) for r in whitening.applied(df, model).collect()} == want
    assert {r.deviation for r in whitening.by_component(whitening.applied(df, model), model).collect()} == {None}
