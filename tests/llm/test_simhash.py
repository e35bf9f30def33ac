"""SimHash fingerprints, the trie join and its groups against brute force."""

import random

import numpy as np
import pytest
import xxhash

from clientpulse.llm import simhash
from clientpulse.llm.components import connected_components

BLANKS = " \t\n\x0b\x0c\r"


def plain_fingerprint(text, width=4):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = "".join(" " if c in BLANKS else c for c in lowered).split(" ")
    words = [w for w in words if w]
    if not words:
        return 0
    shingles = [" ".join(words[k:k + width]) for k in range(max(1, len(words) - width + 1))]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    value = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    return value - (1 << 64) if value >> 63 else value


def plain_groups(prints, budget):
    names = sorted(set(prints))
    root = {p: p for p in names}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for k, a in enumerate(names):
        for b in names[k + 1:]:
            if ((a ^ b) & (1 << 64) - 1).bit_count() <= budget:
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {p: find(p) for p in names}


@pytest.mark.parametrize("text", [
    None, "", " \n\t", "one", "One two", "a b c d", "a b c d e", "A\x0bB\x0cC\rD E", "Ä É ü x \x1c y", "x " * 500,
    "the cat sat on the mat and the cat sat on the mat again " * 40])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_in_blocks(monkeypatch):
    text = " ".join(f"w{k % 97}" for k in range(1000))
    monkeypatch.setattr(simhash, "HASH_BLOCK", 64)
    assert simhash.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("budget", range(1, 9))
def test_blocks_leave_no_pair_out(budget):
    found = simhash.blocks(budget)
    assert sum(width for _, width, _ in found) == 64
    assert sum(allowed + 1 for _, _, allowed in found) == budget + 1


def clustered(n, seed):
    chance = random.Random(seed)
    centres = [chance.getrandbits(64) for _ in range(n // 10)]
    out = set()
    while len(out) < n:
        p = chance.choice(centres)
        for _ in range(chance.randrange(7)):
            p ^= 1 << chance.randrange(64)
        out.add(p - (1 << 64) if p >> 63 else p)
    return sorted(out)


@pytest.mark.parametrize("budget,node_limit", [(1, 1 << 14), (3, 1 << 14), (4, 1 << 14), (4, 3), (6, 40)])
def test_links_join_the_same_groups(spark, budget, node_limit):
    prints = clustered(400, budget)
    edges = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long"), budget, node_limit)
    pairs = [(r.a, r.b) for r in edges.collect()]
    want = plain_groups(prints, budget)
    assert all(want[a] == want[b] for a, b in pairs)
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert {p: got.get(p, p) for p in prints} == want


def test_walk_skips_known_pairs_but_loses_none(monkeypatch):
    monkeypatch.setattr(simhash, "PAIR_BLOCK", 8)
    keys = np.unique(np.array([x & 0xFFF for x in clustered(300, 5)], np.uint64))
    n = len(keys)
    label = simhash._walk(keys, np.array([[0], [n], [0], [n], [0], [0]]), 1)
    want = plain_groups([int(k) for k in keys], 1)
    where = {int(k): i for i, k in enumerate(keys)}
    assert [int(keys[x]) for x in label] == [want[int(k)] for k in keys] and len(where) == n


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(100)]
    star = [(1000, k) for k in range(1001, 1200)]
    found = connected_components(spark.createDataFrame(chain + star + [(5, 5), (0, 1)], "a long, b long"))
    got = {r.node: r.component for r in found.collect()}
    assert got == {k: 0 for k in range(101)} | {k: 1000 for k in range(1000, 1200)}


DOCS = "doc_id long, text string, fp string, row int, component string, keep_id int"


def test_odd_rows(spark):
    long = "some words that fill a long text " * 30_000
    data = [(3, None), (1, ""), (2, " \n"), (None, "alone without an id"), (5, "Same text here now"), (4, "same TEXT here now"),
            (4, "same TEXT here now"), (None, "same text here now"), (9, long), (8, long)]
    docs = spark.createDataFrame([(i, t, "x", 0, "y", 1) for i, t in data], DOCS)
    rows = simhash.near_duplicates(docs).collect()
    assert sorted((r.doc_id or -1, r.component_id) for r in rows if r.component_id is not None) == [
        (-1, 4), (1, 1), (2, 1), (3, 1), (4, 4), (4, 4), (5, 4), (8, 8), (9, 8)]
    assert [r.doc_id for r in rows if r.component_id is None] == [None]
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id or -1, r.fp, r.keep_id) for r in kept.collect()) == [
        (-1, "x", 1), (1, "x", 1), (4, "x", 1), (8, "x", 1)]


def test_empty_table(spark):
    docs = spark.createDataFrame([], DOCS)
    assert simhash.near_duplicates(docs).collect() == []
    assert simhash.one_of_each(docs).collect() == []
