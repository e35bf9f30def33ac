"""Base measures against a plain reading of their definitions, and the verdicts on hosts."""

import random
import re
from collections import Counter

import pytest

from clientpulse.llm import host_rules


def plain_measures(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    seen, repeated = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            repeated += line in seen
            seen.add(line)
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    count = Counter(windows)
    covered = {k + o for k, w in enumerate(windows) if count[w] > 1 for o in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), repeated, len(covered), failed)


def texts():
    chance = random.Random(2)
    made = ["".join(chance.choice(["a ", "b ", "cé ", "a b c d e ", "#x ", "\n", "\t", " ", "|", "😀 "])
                    for _ in range(chance.randrange(60))) for _ in range(150)]
    return [None, "", " ", "\n\n", "a b c d e", "a a a a a a", "x y z\nx y z\n x y z\n\n\n", "w w \x1cx",
            "one two three four five " * 3000, *made]


SCHEMA = "doc_id long, text string, source string, rate double, host string, row string, base_failed int"


def table(spark, rows):
    return spark.createDataFrame([(i, t, s, 0.5, "h", "r", 7) for i, t, s in rows], SCHEMA)


def test_measures(spark):
    given = texts()
    docs = table(spark, [(k, t, "a") for k, t in enumerate(given)])
    got = {r.doc_id: tuple(r[m] for m in host_rules.MEASURES) + (r.base_failed,)
           for r in host_rules.apply_rules(docs).collect()}
    assert got == {k: plain_measures(t) for k, t in enumerate(given)}


GOOD = "this text has more than ten words and it never says one thing again"


def test_verdicts_follow_hosts(spark):
    rows = [(k, GOOD, "good") for k in range(60)] + [(100, "short", "good")]
    rows += [(200 + k, "short", "bad") for k in range(60)] + [(300, GOOD, "bad")]
    rows += [(400, GOOD, None), (401, GOOD, "new"), (402, None, "new")]
    docs = table(spark, rows)
    kept = {r.doc_id: r.kept for r in host_rules.apply_rules(docs).collect()}
    assert all(kept[k] for k in range(60)) and not kept[100]
    assert not any(kept[k] for k in kept if 200 <= k <= 300)
    assert kept[400] and not kept[402]
    rates = {r.host: r for r in host_rules.host_rates(
        host_rules.apply_rules(docs).select("doc_id", "base_failed").join(docs.select("doc_id", "source"), "doc_id"),
        host="source").collect()}
    assert 1 / 61 < rates["good"].rate < 0.5 < rates["bad"].rate < 60 / 61
    assert rates["new"].rate == pytest.approx(0.5, abs=0.1)
    stay = host_rules.kept_documents(docs)
    assert stay.columns == docs.columns
    assert sorted(r.doc_id for r in stay.collect()) == sorted(k for k, v in kept.items() if v)


def test_equal_hosts_are_not_told_apart(spark):
    docs = table(spark, [(k, GOOD if k % 10 else "short", f"s{k % 5 // 5}") for k in range(50)])
    assert sum(r.kept for r in host_rules.apply_rules(docs).collect()) == 45


def test_repeated_rows_and_empty_table(spark):
    docs = table(spark, [(1, GOOD, "a"), (1, GOOD, "a"), (None, GOOD, "a")])
    assert [r.kept for r in host_rules.apply_rules(docs).collect()] == [True] * 3
    empty = spark.createDataFrame([], SCHEMA)
    assert host_rules.apply_rules(empty).collect() == [] and host_rules.kept_documents(empty).collect() == []


def test_no_python_in_the_plan(spark):
    plan = host_rules.measured(table(spark, [(1, GOOD, "a")]))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
