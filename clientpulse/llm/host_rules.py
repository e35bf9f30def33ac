"""Quality rules per document and a verdict per host, in DataFrame expressions only.

Base rules look at one text. Their failures are counted per host (the ``source`` of a document), each host's failure
rate is drawn towards the rate of all hosts by a beta prior whose two parameters come from the hosts themselves, and
the verdict on the host is joined back to its documents: a host with few documents is judged by what hosts are like,
a host with many by its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clientpulse.llm.stored import stored

#: ASCII white space, which parts words.
BLANKS = r"[\x20\x09-\x0D]+"
NOT_BLANK = r"[^\x20\x09-\x0D]"
NOT_SYMBOL = r"[^#*$%&|<>]+"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
#: A host goes if its shrunken failure rate is above this share.
MAX_HOST_RATE = 0.5
#: Strength of the prior in documents: hosts that do not differ at all would give an infinite one.
MIN_STRENGTH, MAX_STRENGTH = 1e-3, 1e6
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _positions_with_twin(sorted_pairs: Column) -> Column:
    """The items of a sorted array of structs whose first field equals a neighbour's."""
    def twin(item: Column, at: Column) -> Column:
        left = F.get(sorted_pairs, at - 1)["key"]
        right = F.get(sorted_pairs, at + 1)["key"]
        return F.coalesce(left == item["key"], F.lit(False)) | F.coalesce(right == item["key"], F.lit(False))
    return F.filter(sorted_pairs, twin)


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the base measures of column ``text`` as longs, named as in ``MEASURES``, and ``base_failed``.

    ``docs`` must not have columns of these names or with a leading underscore. The repeated windows of a text are
    found by hash first; only windows that share a hash are compared as words, so the count is exact and texts
    without repeats never build them.
    """
    own = docs.columns
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS), "")
    step = docs.withColumn("_words", words)
    step = step.withColumn("_n", F.size("_words"))
    hashes = F.transform("_words", lambda w, i: F.xxhash64(
        w, *[F.get(F.col("_words"), i + k) for k in range(1, WINDOW)]))
    step = step.withColumn("_hashes", F.when(F.col("_n") > WINDOW, F.slice(hashes, 1, F.greatest(
        F.col("_n") - (WINDOW - 1), F.lit(0)))))
    step = step.withColumn("_repeats", F.coalesce(F.size(F.array_distinct("_hashes")) < F.size("_hashes"), F.lit(False)))
    step = step.withColumn("_by_hash", F.when(F.col("_repeats"), F.sort_array(F.transform(
        "_hashes", lambda h, i: F.struct(h.alias("key"), i.alias("at"))))))
    step = step.withColumn("_shared", F.when(F.col("_repeats"), _positions_with_twin(F.col("_by_hash"))))
    step = step.withColumn("_by_words", F.when(F.col("_repeats"), F.sort_array(F.transform(
        "_shared", lambda s: F.struct(F.array_join(F.slice("_words", s["at"] + 1, WINDOW), " ").alias("key"),
                                      s["at"].alias("at"))))))
    step = step.withColumn("_at", F.when(F.col("_repeats"), F.sort_array(F.transform(
        _positions_with_twin(F.col("_by_words")), lambda s: s["at"]))))
    # Each window covers five words, or as many as there are up to the next one.
    covered = F.aggregate(
        F.transform("_at", lambda p, k: F.least(F.coalesce(F.get(F.col("_at"), k + 1) - p, F.lit(WINDOW)),
                                                F.lit(WINDOW))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda line: line.rlike(NOT_BLANK))
    step = step.withColumn("_lines", lines)
    found = {
        "n_words": F.col("_n").cast("long"),
        "word_chars": F.length(F.array_join("_words", "")).cast("long"),
        "n_symbols": F.length(F.regexp_replace(F.coalesce(text, F.lit("")), NOT_SYMBOL, "")).cast("long"),
        "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
        "n_repeat_words": F.coalesce(covered, F.lit(0)).cast("long"),
    }
    step = step.select(*own, *[c.alias(n) for n, c in found.items()])
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    return step.withColumn("base_failed", failed)


def host_rates(judged: DataFrame, host: str = "host", max_rate: float = MAX_HOST_RATE) -> DataFrame:
    """(host, docs, failures, rate, host_kept) from rows with ``host`` and ``base_failed``.

    The prior beta(a, b) is fitted by moments: its mean is the failure rate over all documents, its variance what
    the hosts' rates vary beyond chance. ``rate`` is (failures + a) / (docs + a + b).
    """
    hosts = judged.groupBy(host).agg(F.count(F.lit(1)).alias("docs"),
                                     F.sum(F.col("base_failed").cast("long")).alias("failures"))
    hosts = stored(hosts.withColumnRenamed(host, "host"), "host-counts")
    total = hosts.agg(F.sum("docs").alias("n"), F.sum("failures").alias("k"), F.count(F.lit(1)).alias("hosts"),
                      F.sum(F.col("failures") * F.col("failures") / F.col("docs")).alias("squares"))
    total = total.select("n", "hosts", (F.col("k") / F.col("n")).alias("mean"), "squares")
    total = total.withColumn("chance", F.col("mean") * (1 - F.col("mean")))
    # Weighted variance of the hosts' rates, without what sampling alone gives.
    between = F.col("squares") / F.col("n") - F.col("mean") * F.col("mean") - F.col("chance") * F.col("hosts") / F.col("n")
    strength = F.when(between > 0, F.col("chance") / between - 1).otherwise(F.lit(MAX_STRENGTH))
    prior = total.select("mean", F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), strength)).alias("strength"))
    prior = prior.first()
    mean, strength = prior["mean"] or 0.0, prior["strength"]  # no rows: no mean, and no host to apply it to
    rate = (F.col("failures") + F.lit(mean * strength)) / (F.col("docs") + F.lit(strength))
    return hosts.withColumn("rate", rate).withColumn("host_kept", F.col("rate") <= F.lit(max_rate))


def apply_rules(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source",
                max_rate: float = MAX_HOST_RATE, whole_rows: bool = False) -> DataFrame:
    """Per row of ``docs``: doc_id, the base measures, ``base_failed``, ``host_rate`` and ``kept``.

    ``kept`` is false if a base rule failed, else the verdict on the row's host. With ``whole_rows`` the struct
    ``row`` holds the input row. A null text is measured as empty (no words, so it fails); rows without a host are
    one host; repeated rows are judged each; an empty table gives no rows. Column names in ``docs`` may be anything.
    """
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), F.col(text).alias("text"),
                       *([F.struct("*").alias("row")] if whole_rows else []))
    judged = stored(measured(slim).drop("text"), "host-rules")
    verdict = stored(host_rates(judged, max_rate=max_rate).select(
        F.col("host").alias("of_host"), F.col("rate").alias("host_rate"), "host_kept"), "host-verdicts")
    both = judged.join(verdict, F.col("host").eqNullSafe(F.col("of_host")), "left")
    return both.select("doc_id", *MEASURES, "base_failed", "host_rate",
                       (~F.col("base_failed") & F.col("host_kept")).alias("kept"), *(["row"] if whole_rows else []))


def kept_documents(docs: DataFrame, **how) -> DataFrame:
    """The rows of ``docs`` that the rules keep, columns as they came."""
    return apply_rules(docs, whole_rows=True, **how).where("kept").select("row.*")


ORACLE = r"""
WITH numbered AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
split AS (SELECT *, list_filter(string_split_regex(text, '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS words,
  list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')) AS lines FROM numbered),
windows AS (SELECT rid, unnest(range(1, len(words) - 3)) AS pos, words FROM split WHERE len(words) > 5),
keyed AS (SELECT rid, pos, array_to_string(words[pos:pos + 4], ' ') AS key FROM windows),
twice AS (SELECT rid, key FROM keyed GROUP BY rid, key HAVING count(*) > 1),
covered AS (SELECT rid, count(DISTINCT pos + o) AS n FROM keyed JOIN twice USING (rid, key),
  (SELECT unnest(range(5)) AS o) GROUP BY rid),
measured AS (SELECT split.rid, doc_id, source, len(words)::BIGINT AS n_words,
  length(array_to_string(words, ''))::BIGINT AS word_chars,
  (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words
  FROM split LEFT JOIN covered USING (rid)),
judged AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
hosts AS (SELECT source, count(*)::DOUBLE AS n, sum(base_failed::INT)::DOUBLE AS k FROM judged GROUP BY source),
total AS (SELECT sum(n) AS n, sum(k) / sum(n) AS mean, count(*) AS hosts, sum(k * k / n) AS squares FROM hosts),
spread AS (SELECT mean, mean * (1 - mean) AS chance,
  squares / n - mean * mean - mean * (1 - mean) * hosts / n AS between_hosts FROM total),
prior AS (SELECT mean, greatest(1e-3, least(1e6, CASE WHEN between_hosts > 0 THEN chance / between_hosts - 1
  ELSE 1e6 END)) AS strength FROM spread),
verdict AS (SELECT source, (k + mean * strength) / (n + strength) <= 0.5 AS host_kept FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND host_kept AS kept
FROM judged JOIN verdict ON judged.source IS NOT DISTINCT FROM verdict.source
"""
