"""The PartEnum join against all pairs of sets."""

import random

import numpy as np
import pytest

from clientpulse.llm import jaccard_join as join
from clientpulse.llm import queries
from tests.conftest import SF

DOCS = "doc_id long, text string, node string, a int, component string, text_hash int"


def plain_set(text, shingle=3):
    words = (text or "").encode().lower().split()
    width = min(shingle, len(words))
    return frozenset(b" ".join(words[i:i + width]) for i in range(len(words) - width + 1)) if words else frozenset()


def brute(docs, rule):
    """Rows (doc_id, n_shingles, component_id) of all documents, sorted."""
    sets = [plain_set(t, rule.shingle) for _, t in docs]
    label = list(range(len(docs)))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(sets):
        for k, b in enumerate(sets[:i]):
            if a and b and rule.den * len(a & b) >= rule.num * len(a | b):
                label[top(i)] = top(k)
    least = {}
    for i, (name, _) in enumerate(docs):
        if name is not None:
            least[top(i)] = min(name, least.get(top(i), name))
    return sorted(((n, len(s), least.get(top(i))) for i, ((n, _), s) in enumerate(zip(docs, sets))), key=str)


def frame(spark, docs):
    return spark.createDataFrame([(i, t, "n", 1, "c", 2) for i, t in docs], DOCS)


def found(spark, docs, **how):
    rows = join.similar_documents(frame(spark, docs).repartition(3), **how).collect()
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def families(n, seed, length=40):
    """Texts of families: a base text with some words changed, dropped or added."""
    chance = random.Random(seed)
    word = lambda: f"{chance.choice('abcdefgh')}{chance.randrange(400)}"
    out, bases = [], [[word() for _ in range(chance.randrange(1, length))] for _ in range(max(1, n // 12))]
    while len(out) < n:
        text = list(chance.choice(bases))
        for _ in range(chance.choice((0, 0, 1, 1, 2, 5))):
            at = chance.randrange(len(text))
            text[at:at + chance.randrange(2)] = [word()] * chance.randrange(1, 2)
        out.append((len(out), " ".join(text)))
    chance.shuffle(out)
    return out


@pytest.mark.parametrize("rule,piece,length", [
    (join.Similarity(), 1 << 12, 40), (join.Similarity(), 3, 150), (join.Similarity(80, 100, 5), 7, 60), (join.Similarity(1, 1, 1), 50, 9),
    (join.Similarity(2, 3, 1), 5, 30)])
def test_equal_to_all_pairs(spark, monkeypatch, rule, piece, length):
    monkeypatch.setattr(join, "PIECE", piece)
    monkeypatch.setattr(join, "COMPARED", 200)
    docs = families(260, piece, length)
    got = found(spark, docs, rule=rule, piece=piece)
    assert got == brute(docs, rule) and len({c for _, _, c in got}) < len(docs)


def test_no_broadcast_and_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(join, "BROADCAST_ROWS", 0)
    docs = families(120, 9) * 2
    assert found(spark, docs) == brute(docs, join.Similarity())


def test_a_large_group_of_near_copies(spark, monkeypatch):
    """A third of the rows differ from each other by a few words, so that most pairs are close to the threshold."""
    chance = random.Random(4)
    base = [f"w{k}" for k in range(150)]
    docs = families(400, 5, 100)
    for k in range(200):
        text = list(base)
        for _ in range(chance.randrange(1, 5)):
            text[chance.randrange(150)] = f"x{chance.randrange(1000)}"
        docs.append((1000 + k, " ".join(text)))
    monkeypatch.setattr(join, "PIECE", 40)
    assert found(spark, docs, piece=40) == brute(docs, join.Similarity())


def test_given_documents(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = queries.op13_ngram_jaccard_join(spark, SF)
    assert dict(out.dtypes) == {"doc_id": "bigint", "n_shingles": "bigint", "component_id": "bigint"}
    assert sorted(map(tuple, out.collect())) == sorted(brute(docs, join.Similarity()))


def test_odd_rows(spark):
    long = " ".join(f"word{k % 5000}" for k in range(60_000))
    docs = [(3, None), (1, ""), (2, " \n"), (None, "alone without an id"), (5, "Same text here now"), (4, "same\tTEXT here  now"),
            (4, "same TEXT here now"), (None, "same text here now"), (9, long), (8, long + " end"), (7, "two words"), (6, "TWO words"),
            (10, "word"), (11, "Wörd"), (12, "WöRD"), (13, "wÖrd")]
    assert found(spark, docs) == brute(docs, join.Similarity())
    assert found(spark, []) == [] and found(spark, [(1, None)]) == [(1, 0, 1)]


@pytest.mark.parametrize("rule", [join.Similarity(), join.Similarity(80, 100, 5), join.Similarity(2, 3)])
def test_linked_sets_share_a_signature_and_keep_within_the_sketch(rule):
    chance = np.random.default_rng(2)
    linked = 0
    for _ in range(600):
        a = np.unique(chance.integers(0, 1 << 63, chance.integers(2, 300)).astype(np.uint64) * np.uint64(2) + np.uint64(1))
        gone = chance.integers(0, len(a) // 8 + 2)
        new = chance.integers(0, 1 << 63, chance.integers(0, len(a) // 8 + 2)).astype(np.uint64)
        b = np.unique(np.concatenate([chance.permutation(a)[gone:], new]))
        both = len(np.intersect1d(a, b))
        if not len(b) or not rule.linked(len(a), len(b), both) or np.array_equal(a, b):
            continue
        linked += 1
        assert rule.near(len(a), len(b)) and len(a) + len(b) - 2 * both <= rule.allowed(len(a) + len(b))
        assert set(join.signatures(a, rule).tolist()) & set(join.signatures(b, rule).tolist())
        x, y = (join.sketch_of(s, rule.sketch_bits(len(s))) for s in (a, b))
        width = min(len(x), len(y))
        apart = join._apart(join._folded([x], width), join._folded([y], width))[0]
        assert apart <= rule.allowed(len(a) + len(b))
    assert linked > 100


def test_bands_hold_every_pair_that_can_link():
    for rule in (join.Similarity(), join.Similarity(80, 100), join.Similarity(1, 2)):
        for a in range(1, 400):
            for b in range(a, a * rule.den // rule.num + 1):
                shared = set(rule.meetings(a)) & set(rule.meetings(b))
                assert shared and all(rule.errors(m) >= rule.allowed(a + b) for m in shared)
