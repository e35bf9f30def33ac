"""Unigram token counts against the tokenizers library's model with the same vocabulary."""

import random

import public_tokenizers
import pytest
from tokenizers import Regex, Tokenizer, models, normalizers, pre_tokenizers

from clientpulse.llm import token_counts

LETTERS = "abc the THE éñ中文😀 \t\n\x85\xa0\x1c ▁<s><0x41>.,!12"
TIES = [("<unk>", 0.0), ("▁", -1.0), ("a", -1.0), ("b", -1.0), ("ab", -2.0), ("ba", -2.0), ("▁a", -2.0), ("aba", -3.0), ("bb", -1.5)]


def library(vocabulary, byte_fallback):
    made = Tokenizer(models.Unigram(vocabulary, unk_id=0, byte_fallback=byte_fallback))
    made.normalizer = normalizers.Sequence([normalizers.Replace(Regex(r"\s+"), " "), normalizers.Strip()])
    made.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return made


@pytest.fixture(scope="module")
def vocabulary():
    return token_counts.zipf_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))


def texts(letters, n=400):
    chance = random.Random(6)
    made = ["".join(chance.choice(letters) for _ in range(chance.randrange(50))) for _ in range(n)]
    return ["", "  ", "▁", "▁▁a", "a▁", "<s>", "<unk>", "ﬁ", *made]


def test_counts_equal_the_library(vocabulary):
    given, counter = texts(LETTERS), token_counts.Counter(vocabulary)
    assert counter.count(given) == [len(e.ids) for e in library(vocabulary, True).encode_batch(given, add_special_tokens=False)]


def test_ties_and_runs_of_unknowns(vocabulary):
    given, counter = texts("aab b▁xyé"), token_counts.Counter(TIES)
    assert counter.count(given) == [len(e.ids) for e in library(TIES, False).encode_batch(given, add_special_tokens=False)]


def test_scores_are_those_of_the_best_path():
    counter = token_counts.Counter(TIES)
    assert counter.best("▁ab") == (-3.0, 2) and counter.best("▁x") == (-1.0 - 13.0, 2)
    assert token_counts.Counter([]).best("ab") == (-20.0, 1)


def test_small_memory_gives_the_same_counts(vocabulary, monkeypatch):
    given = texts(LETTERS, 60)
    want = token_counts.Counter(vocabulary).count(given)
    monkeypatch.setattr(token_counts, "KNOWN_WORDS", 3)
    counter = token_counts.Counter(vocabulary)
    assert [counter.count([t])[0] for t in given] == want


def test_table(spark, vocabulary):
    schema = "doc_id long, text string, n_tokens string, row int"
    long = "many words in one text " * 80_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "the cat"), (4, "the cat"), (None, "the cat"), (5, long), (6, "x▁" * 700_000)]
    docs = spark.createDataFrame([(i, t, "x", 0) for i, t in rows], schema)
    counter = token_counts.Counter(vocabulary)
    got = sorted((r.row.doc_id or 0, r.row.n_tokens, r.n_tokens) for r in token_counts.counted(docs, vocabulary).collect())
    assert got == sorted((i or 0, "x", counter.count([t or ""])[0]) for i, t in rows)
    assert token_counts.counted(spark.createDataFrame([], schema), vocabulary).collect() == []
