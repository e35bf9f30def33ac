"""Block-Max MaxScore against scores of all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from clientpulse.llm import lexical_search as search
from clientpulse.llm import queries
from clientpulse.llm.stored import stored
from tests.conftest import SF

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, item_id int, term string, shard int, score string"
ITEMS = "item_id long, text string, doc_id string, block int"
A_TO_Z = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(docs, items, wanted=20):
    """{item: [(doc_id, score), ...]} by the definition."""
    bags = [(i, Counter(TERM.findall((t or "").translate(A_TO_Z)))) for i, t in docs]
    bags = [(i, bag, sum(bag.values())) for i, bag in bags if bag]
    count, total = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    asked = {}
    for i, t in dict.fromkeys(items):
        asked.setdefault(i, Counter()).update(TERM.findall((t or "").translate(A_TO_Z)))
    out = {}
    for item, terms in asked.items():
        scores = []
        for i, bag, n in bags:
            m = 75 + 25 * n * count // total
            score = sum(times * math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * bag[t] // (1000 * bag[t] + 12 * m)) for t, times in terms.items() if t in bag)
            if score > 0:
                scores.append((i, score))
        if scores:
            out[item] = sorted(scores, key=lambda s: (-s[1], s[0] is None, s[0] or 0))[:wanted]
    return out


def lists(found):
    out = {}
    for r in sorted(found.collect(), key=lambda r: (r["item"] is None, r["item"] or 0, r["rank"])):
        assert r["rank"] == len(out.setdefault(r["item"], [])) + 1
        out[r["item"]].append((r["doc_id"], r["score"]))
    return out


def found(spark, docs, items, **how):
    return lists(search.search(spark.createDataFrame([(i, t, 1, "x", 2, "s") for i, t in docs], DOCS).repartition(3),
                               spark.createDataFrame([(i, t, "d", 3) for i, t in items], ITEMS), **how))


def corpus(n, seed):
    chance = random.Random(seed)
    words = [f"w{int(chance.paretovariate(0.7)) % 400}" for _ in range(5000)]
    return [(i, " ".join(chance.choices(words, k=chance.randrange(1, 80)))) for i in range(n)]


@pytest.mark.parametrize("limits", [{}, {"SHARD_POSTINGS": 700, "FIRST_WINDOW": 4, "LARGEST_WINDOW": 16}, {"ASKED_TERMS": 1},
                                    {"SHARD_DOCS": 50}])
def test_equal_to_brute_force(spark, monkeypatch, limits):
    for name, value in limits.items():
        monkeypatch.setattr(search, name, value)
    docs = corpus(600, 1)
    items = [(i, t[:60]) for i, t in corpus(60, 2)]
    assert found(spark, docs, items, query_block=25) == brute(docs, items)


def test_whole_tables_equal_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    out = queries.op11_lexical_search(spark, SF)
    assert dict(out.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert lists(out.withColumnRenamed("item_id", "item")) == brute(docs, items)


def test_odd_rows(spark):
    """Nulls, empty and very long texts, ties, repeated rows and items, columns of clashing names."""
    long = "needle " + "straw " * 200_000
    docs = [(1, None), (2, ""), (3, " ,.-"), (None, "needle in hay"), (4, "needle in hay"), (5, "NEEDLE\x00in_hay"), (5, "needle in hay"),
            (9, long), (8, "école Ecole ÉCOLE"), (7, "straw hay straw"), (6, "unrelated words here"), (10, "more unrelated words")]
    items = [(1, "needle"), (1, "needle"), (2, "hay hay école"), (2, "straw"), (3, None), (4, ""), (None, "École"), (5, "absent")]
    got = found(spark, docs, items)
    assert got == brute(docs, items)
    assert [i for i, _ in got[1]] == [4, 5, 5, None, 9]
    assert found(spark, [], items) == {} and found(spark, docs, []) == {} and found(spark, [(1, None)], items) == {}


def test_ties_beyond_the_wanted_go_by_id(spark, monkeypatch):
    monkeypatch.setattr(search, "FIRST_WINDOW", 8)
    docs = [(i, "same words in all") for i in range(300, 0, -1)] + [(1000 + i, f"other {i}") for i in range(400)]
    assert [i for i, _ in found(spark, docs, [(1, "same all")])[1]] == list(range(1, 21))


def test_blocks_round_trip():
    chance = np.random.default_rng(1)
    for n in (1, 2, 127, 128, 129, 1000):
        docs = np.sort(chance.choice(5000, n, replace=False)).astype(np.int64)
        tf, lengths = chance.integers(1, 9, n), chance.integers(1, 50, 5000)
        norm = search.norms_of(lengths, 5000, int(lengths.sum()))
        own = search.PostingList(n, *search.encode(docs, tf, lengths[docs]), norm, lambda x: search.norms_of(x, 5000, int(lengths.sum())))
        score = search.impact(tf, norm[docs])
        assert [own.block_max[b] for b in range(len(own.block_max))] == [score[b * 128:b * 128 + 128].max() for b in range(len(own.block_max))]
        found, value = own.between(0, 5000)
        assert (found == docs).all() and (value == score).all()


def test_blocks_stay_closed_when_they_cannot_matter():
    """A frequent, light term beside a rare one: most of its blocks are rejected by their maxima."""
    n = 20_000
    lengths = np.full(n, 100)
    norm = search.norms_of(lengths, n, int(lengths.sum()))

    def listed(docs, tf):
        docs, tf = np.array(docs), np.array(tf)
        return search.PostingList(len(docs), *search.encode(docs, tf, lengths[docs]), norm, lambda x: search.norms_of(x, n, int(lengths.sum())))

    rare = listed(range(0, n, 50), [9] * 40 + [1] * (n // 50 - 40))
    common = listed(range(n), [1] * n)
    found, scores = search.best_of([(rare, 9000), (common, 100)], n, 20)
    want = sorted(((9000 * int(rare.impact[k]) if rare.opened[k // 128] else 0), -int(d)) for k, d in enumerate(rare.docs))
    assert len(want) and list(found) == list(range(0, 1000, 50)) and not common.opened[n // 256:].any()


def test_huge_lengths_do_not_overflow():
    lengths = np.array([1, 10 ** 9])
    assert search.norms_of(lengths, 10 ** 12, 10 ** 14).tolist() == [12 * (75 + 25 * n * 10 ** 12 // 10 ** 14) for n in lengths.tolist()]


def test_index_counts_every_document_when_terms_are_left_out(spark):
    docs = spark.createDataFrame([(i, t, 1, "x", 2, "s") for i, t in corpus(100, 3)], DOCS)
    whole, some = stored(search.build_index(docs), "t"), stored(search.build_index(docs, only={b"w1"}), "t")
    assert some.where("term is null").agg({"n": "sum", "total": "sum"}).first() == whole.where("term is null").agg({"n": "sum", "total": "sum"}).first()
    assert [bytes(r.term) for r in some.select("term").where("term is not null").distinct().collect()] == [b"w1"]
