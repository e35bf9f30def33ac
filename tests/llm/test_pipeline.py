"""Queries against their SQL, and the pipeline stage by stage against brute force."""

import hashlib
from collections import Counter

import pytest

import __spark_entry__ as entry_module
import corpus_pipeline
from clientpulse.llm import mixing, queries, ranker
from clientpulse.llm.stored import stored
from pulsechecks import catalog, compare
from tests.conftest import SF
from tests.llm.test_host_rules import plain_measures
from tests.llm.test_simhash import plain_fingerprint, plain_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_query_matches_sql(spark, key, monkeypatch):
    monkeypatch.setitem(catalog.ORACLES, key, queries.ORACLES[key])
    con = compare.connect(SF)
    ok, text = compare.compare_frame(queries.QUERIES[key](spark, SF), con, key)
    con.close()
    assert ok, text


def test_all_queries_are_registered():
    names = {"pipeline", *queries.QUERIES}
    assert names <= set(entry_module.queries())
    assert {n.split("_")[0] for n in names if n != "pipeline"} == {f"op{n}" for n in range(1, 14)}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        docs = stored(stage(spark, docs, SF), "test-stage")
        kept[name] = {r.doc_id: r for r in docs.collect()}
        assert len(kept[name]) == docs.count()
        if name != "bpe_codec":
            assert docs.columns == COLUMNS and all(before[i] == r for i, r in kept[name].items())
        now = set(kept[name])
        if name == "quality_classifier":
            labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
            wrong = [i for i, q in labels.items() if i in before and (i in now) != (q == 1)]
            assert len(wrong) <= 0.05 * len(labels)
        if name == "quality_rules":
            assert now == {i for i, r in before.items() if not plain_measures(r.text)[-1]}
        if name == "simhash_near_dedup":
            prints = {i: plain_fingerprint(r.text) for i, r in before.items()}
            group = plain_groups(prints.values(), 4)
            least = {}
            for i in sorted(before):
                least.setdefault(group[prints[i]], i)
            assert now == set(least.values())
        if name == "source_mixing":
            chance = mixing.chances(spark.createDataFrame([tuple(r) for r in before.values()], docs.schema)).collect()
            assert now == {r.doc_id for r in chance if r.sampled} and 0 < len(now) < len(before)
        if name == "bpe_codec":
            from tokenizers import Tokenizer
            library = Tokenizer.from_file(queries.tokenizer_path())
            for i, r in kept[name].items():
                ids = library.encode(before[i].text, add_special_tokens=False).ids
                assert r.n_tokens == len(ids)
                assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
                assert r.decoded_sha256 == hashlib.sha256(
                    library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
            assert now == set(before)


def test_stages_take_odd_tables(spark):
    """Extra columns, nulls, repeated rows and no rows at all pass through every stage."""
    good = ("A calm line of prose, word after word, which says number {} and then goes on to end here. "
            "Another line follows {} it with other words, so nothing is said twice.")
    rows = [(k, good.format(k, k * k), "en", f"s{k % 3}", 1, "x") for k in range(30)]
    rows += [rows[0], (None, good.format("x", "y"), None, None, None, None), (99, None, "en", "s1", 0, "x"), (98, "", "en", "s1", 0, "x")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, row string"
    for given in (rows, []):
        docs = spark.createDataFrame(given, schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF), "test-odd")
            assert docs.columns == [*COLUMNS, "row"]
        assert max(Counter(r.doc_id for r in docs.collect()).values(), default=1) == 1
        last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
        assert last.count() == docs.count()


def test_ranker_reads_no_label_of_the_held_out_part():
    assert ranker.THRESHOLD == 0.7
