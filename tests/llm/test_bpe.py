"""Token ids equal to the tokenizers library's, the lexicon, and odd tables."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clientpulse.llm import bpe
from clientpulse.llm.lexicon import Lexicon, compile_lexicon
from clientpulse.llm.queries import token_digests

PATH = public_tokenizers.path("word_bpe_49k.json")
LETTERS = ("abcXYZ éÉñßçÜ'\"’ 0123½²  \t\n\x85\xa0\x1cΣσςΑİıǅ中文字カ゚がé​﻿😀"
           "ſK&%$#")
WHOLE = ["", "   ", "<|endoftext|>", "<|EndOfText|>x<|startoftext|>", "x" * 5000, "don't I'LL we've 'S '", "ſ K Å ﬁ Ǆ ẞ",
         "a" * 33 + " " + "b" * 32, "hello world 12 don't", "\x00", "Ⱥ Ⱦ ɏ ɐ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary.read(open(PATH, encoding="utf-8").read())


def texts():
    chance = random.Random(4)
    return WHOLE + ["".join(chance.choice(LETTERS) for _ in range(chance.randrange(60))) for _ in range(800)]


def test_ids_equal_the_library(library, vocabulary):
    one = bpe.Merger(vocabulary.merge_table()).merge_one
    words = {w.encode(): one(w.encode()) for w in ("hello", "world", "help", "yelp", "é", "!!")}
    encoder = bpe.Encoder(vocabulary.merge_table(), vocabulary.special, vocabulary.source, Lexicon(compile_lexicon(words)))
    given = texts()
    assert encoder.encode(given) == [e.ids for e in library.encode_batch(given, add_special_tokens=False)]


def test_words_merged_together_equal_words_merged_alone(vocabulary):
    chance = random.Random(5)
    words = ["".join(chance.choice("abcdeinstr éñ!?中") for _ in range(chance.randrange(1, 20))).encode() for _ in range(500)]
    merger = bpe.Merger(vocabulary.merge_table())
    assert merger.merge([*words, b""]) == [*map(merger.merge_one, words), ()]


def test_small_memory_gives_the_same_ids(library, vocabulary, monkeypatch):
    monkeypatch.setattr(bpe, "KNOWN_WORDS", 5)
    encoder = bpe.Encoder(vocabulary.merge_table(), vocabulary.special, vocabulary.source, Lexicon(compile_lexicon({})))
    for text in ("one two three four", "five six seven one <|endoftext|>", "two two eight"):
        assert encoder.encode([text]) == [library.encode(text, add_special_tokens=False).ids]


def test_parts_join_to_the_text_and_cut_at_blanks():
    text = "word " * 50 + "x" * 300 + "\nend of it" * 9
    parts = list(bpe.parts_of(text, 40))
    assert "".join(parts) == text and len(parts) > 5
    assert all(p[:1] in " \n" for p in parts[1:])
    assert list(bpe.parts_of("y" * 100, 10)) == ["y" * 100]


def test_lexicon_holds_its_words_and_shares_suffixes():
    words = {w.encode(): (k, k + 1) for k, w in enumerate(["a", "ab", "tap", "taps", "top", "tops", "übertaps", ""]) if w}
    lexicon = Lexicon(compile_lexicon(words))
    asked = [*words, b"", b"t", b"ta", b"tapsy", b"zzz", b"a" * 90]
    places = lexicon.places(asked)
    found = iter(lexicon.ids_at(places[places >= 0]))
    assert [next(found) if p >= 0 else None for p in places] == [words.get(w) for w in asked]
    assert len(lexicon.final) < len(set(w[:k] for w in words for k in range(len(w) + 1)))


SCHEMA = "doc_id long, text string, ids string, row string, decoded string"


def test_query_equals_the_library(spark, library):
    import hashlib
    given = [None, *texts()[:60], "many words again and again " * 60_000]
    docs = spark.createDataFrame([(k, t, "x", "y", "z") for k, t in enumerate(given)] + [(None, "id", "x", "y", "z")], SCHEMA)
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in token_digests(docs, PATH).collect()}

    def want(text):
        ids = library.encode(text or "", add_special_tokens=False).ids
        shown = library.decode(ids, skip_special_tokens=False)
        return len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), shown))

    assert got == {k: want(t) for k, t in enumerate(given)} | {None: want("id")}


def test_frequent_words_count_all_texts(spark, vocabulary):
    docs = spark.createDataFrame([("The cat the",), (None,), ("cat don't",)], "text string")

    def found(limit):
        return {tuple(r) for r in bpe.frequent_words(docs, vocabulary.special, vocabulary.source, limit=limit).collect()}

    assert found(3) == {("cat", 2), ("the", 2)}
    assert found(4) == {("cat", 2), ("the", 2), ("don", 1), ("'t", 1)}
    assert found(1) == set()


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert token_digests(docs, PATH).collect() == []
    odd = spark.createDataFrame([(1, None), (2, []), (3, [3306, 999_999, 49407])], "doc_id long, ids array<int>")
    assert [r.decoded for r in bpe.decode(odd, PATH).orderBy("doc_id").collect()] == ["", "", "hello</w> <|endoftext|>"]
