"""Raking and sampling: marginals, contradictions and odd tables."""

from collections import defaultdict

import pytest

from clientpulse.llm import mixing

SCHEMA = "doc_id long, text string, lang string, source string, topic string, tokens int, weight string, ratio string, row string"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, la, s, "t", 1, "w", "r", "row") for i, t, la, s in rows], SCHEMA)


def corpus(n=400):
    return [(k, "word " * (1 + k % 7) + ("License" if k % 5 == 0 else ""), ("en", "en", "de")[k % 3], f"s{min(k % 11, 4)}")
            for k in range(n)]


WANTED = {"source": 0.5, "lang": {"en": 0.5, "de": 0.5}, "topic": {"legal": 0.4}}


def test_expected_shares_are_the_wanted_ones(spark):
    rows = mixing.chances(frame(spark, corpus()), WANTED).collect()
    held = {s: defaultdict(float) for s in mixing.SIDES}
    tokens = defaultdict(float)
    for r in rows:
        assert 0 <= r.chance <= 1 + 1e-12
        tokens[r.source] += r.tokens
        for side in mixing.SIDES:
            held[side][r[side]] += r.tokens * r.chance
    total = sum(held["lang"].values())
    assert held["lang"]["en"] / total == pytest.approx(0.5, abs=1e-6)
    assert held["topic"]["legal"] / total == pytest.approx(0.4, abs=1e-6)
    roots = {s: t ** 0.5 for s, t in tokens.items()}
    for s in roots:
        assert held["source"][s] / total == pytest.approx(roots[s] / sum(roots.values()), abs=1e-6)
    assert total == pytest.approx(mixing.BUDGET * sum(tokens.values()), rel=1e-6)


def test_sample_follows_the_chances_and_repeats(spark):
    docs = frame(spark, corpus(3000))
    rows = mixing.chances(docs, WANTED).collect()
    expected = sum(r.chance for r in rows)
    kept = [r.doc_id for r in rows if r.sampled]
    assert abs(len(kept) - expected) < 4 * expected ** 0.5
    stay = mixing.sampled_documents(docs, wanted=WANTED)
    assert stay.columns == docs.columns and sorted(r.doc_id for r in stay.collect()) == sorted(kept)


def test_marginals_that_contradict_each_other_end(spark):
    cells = spark.createDataFrame([("a", "en", "x", 10), ("b", "de", "x", 10)],
                                  "source string, lang string, topic string, tokens long")
    with pytest.warns(UserWarning, match="cannot be met together"):
        found = mixing.fitted(cells, {"source": {"a": 0.9, "b": 0.1}, "lang": {"en": 0.1, "de": 0.9}, "topic": 1.0}, rounds=3)
    assert {r.source: round(r.weight, 6) for r in found.collect()} == {"a": 0.8, "b": 7.2}


def test_many_cells_give_the_same_weights(spark, monkeypatch):
    docs = frame(spark, [*corpus(500), (500, "word", "en", None)])
    cells = docs.select("source", "lang", mixing.topic_of(docs.text).alias("topic"), mixing.tokens_of(docs.text).alias("tokens"))
    cells = cells.groupBy(*mixing.SIDES).agg({"tokens": "sum"}).withColumnRenamed("sum(tokens)", "tokens")

    def weights():
        return {(r.source, r.lang, r.topic): r.weight for r in mixing.fitted(cells, WANTED, rounds=4).collect()}
    few = weights()
    monkeypatch.setattr(mixing, "FEW_CELLS", 0)
    many = weights()
    assert few.keys() == many.keys() and max(abs(few[k] - many[k]) for k in few) < 1e-9


def test_sql_knows_cells_that_are_kept_whole(spark, tmp_path):
    import duckdb
    documents = [(k, "word " * (1 + k % 9) + ("License" if k % 5 == 0 else "") + ("@" if k % 7 == 0 else ""),
                  ("en", "en", "de", "fr", "es")[k % 5], f"s{min(k % 11, 4)}") for k in range(900)] + [(900, "word", "en", "tiny")]
    docs = spark.createDataFrame(documents, "doc_id long, text string, lang string, source string")
    docs.coalesce(1).write.parquet(str(tmp_path / "documents"))
    base = duckdb.connect()
    base.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents/*.parquet'")
    want = {r[0]: r[1:] for r in base.execute(f"SELECT doc_id, chance, sampled FROM ({mixing.oracle()})").fetchall()}
    got = {r.doc_id: (round(r.chance, 6), r.sampled) for r in mixing.chances(docs).collect()}
    assert got == want and got[900] == (1.0, True) and sum(c == 1 for c, _ in got.values()) < 800


def test_odd_rows(spark):
    rows = [(1, None, None, None), (2, "", "en", "a"), (None, "x y", "en", "a"), (3, "x " * 100_000, "en", "a"), (3, "x " * 100_000, "en", "a"),
            (4, "x", None, "b"), (5, "@ mail", "fr", None), (6, " \n", "zz", "only-blank")]
    got = mixing.chances(frame(spark, rows)).collect()
    assert len(got) == 8
    by = {(r.doc_id, r.tokens): r for r in got}
    assert by[(1, 0)].chance == 0 and by[(6, 0)].chance == 0 and not by[(6, 0)].sampled
    assert len({r.sampled for r in got if r.doc_id == 3}) == 1
    assert by[(5, 2)].topic == "contact" and by[(None, 2)].chance > 0


def test_empty_table_and_tables_without_tokens(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.chances(empty).collect() == [] and mixing.sampled_documents(empty).collect() == []
    assert [r.sampled for r in mixing.chances(frame(spark, [(1, None, "en", "a"), (2, " ", "de", "b")])).collect()] == [False] * 2


def test_no_python_in_the_plan(spark):
    plan = mixing.chances(frame(spark, corpus(50)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


def test_a_tiny_source_does_not_empty_the_sample(spark):
    docs = frame(spark, [*corpus(4000), (4000, "word", "en", None)])
    found = mixing.chances(docs, WANTED)
    rows = found.collect()
    total = sum(r.tokens for r in rows)
    assert sum(r.tokens * r.chance for r in rows) / total == pytest.approx(mixing.BUDGET, rel=1e-3)
    assert all(0 <= r.chance <= 1 for r in rows)
    # The tiny source is kept whole, and the others keep the wanted proportions.
    assert [r.chance for r in rows if r.source is None] == [pytest.approx(1)]
    shares = {(r.side, r.category): (r.wanted, r.expected) for r in mixing.shortfall(found, WANTED).collect()}
    assert shares["source", None][1] < shares["source", None][0]
    assert shares["lang", "en"][1] == pytest.approx(0.5, abs=1e-3) and shares["topic", "legal"][1] == pytest.approx(0.4, abs=1e-3)
    ratio = [shares["source", f"s{k}"][1] / shares["source", f"s{k}"][0] for k in range(5)]
    assert max(ratio) - min(ratio) < 1e-3


def test_unnamed_and_null_languages_keep_their_share(spark):
    rows = [(k, "word " * 10, ("en", "de", "fr", "es", "it", None)[k % 6], f"s{k // 6 % 2}") for k in range(600)]
    found = mixing.chances(frame(spark, rows))
    assert all(r.chance > 0 for r in found.collect())
    shares = {r.category: (r.wanted, r.expected) for r in mixing.shortfall(found).collect() if r.side == "lang"}
    for name, share in {"it": 1 / 6, None: 1 / 6, **{k: v * 4 / 6 for k, v in mixing.LANG_SHARES.items()}}.items():
        assert shares[name] == (pytest.approx(share, abs=1e-6), pytest.approx(share, abs=1e-6))
