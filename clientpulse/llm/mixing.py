"""Mixing sources to target weights: proportional fitting to marginals, then sampling, in DataFrame expressions only.

Documents are summed into cells (source, language, topic). The sample is to hold a stated share of all tokens, its
budget. Iterative proportional fitting scales the cells' token weights until the shares of every source, language and
topic are the wanted ones of that budget; a cell holds no more than its tokens, so one that is too small for its part is
kept whole and the others make up for it. A document's chance to be sampled is its cell's weight over its tokens: in
expectation the sample has the budget's tokens and the wanted shares on all three sides, as far as the cells have them.
"""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clientpulse.llm.stored import drop, stored

SIDES = ("source", "lang", "topic")
#: Wanted shares: named categories get these, the others share what is left in proportion to their tokens (if nothing is
#: left, unnamed and null ones keep the share they have, and the named ones share the rest; 0 leaves a category out) ...
LANG_SHARES = {"en": 0.55, "de": 0.17, "fr": 0.15, "es": 0.13}
TOPIC_SHARES = {"prose": 0.9}
#: ... and a number is a power of the tokens: 1 keeps the shares as they are, 0 makes all categories equal.
SOURCE_POWER = 0.5
#: Share of all tokens that the expected sample holds.
BUDGET = 0.4
#: Rounds at most, and the relative error of every marginal at which they end before.
ROUNDS, TOLERANCE = 48, 1e-10
#: An error left after the rounds that is worth a warning.
MISSED = 1e-3
#: Cells up to which a side is summed by a window within one small task, several rounds in one job; more cells are summed
#: by a combining aggregate and a join, one round in a job. Both give the same weights.
FEW_CELLS = 100_000
ROUNDS_A_JOB = 8
SEED = "mix-1"


def tokens_of(text: Column) -> Column:
    """White-space words of a text; 0 for null."""
    return F.size(F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")).cast("long")


def topic_of(text: Column) -> Column:
    """A coarse topic by what a text contains: legal, contact, table or prose."""
    text = F.coalesce(text, F.lit(""))
    return (F.when(F.contains(text, F.lit("License")), "legal").when(F.contains(text, F.lit("@")), "contact")
            .when(F.contains(text, F.lit("|")), "table").otherwise("prose"))


def targets(cells: DataFrame, side: str, wanted: dict[str, float] | float) -> DataFrame:
    """(category, target, held): the tokens each category of one side should hold, adding up to the tokens there are.

    Shares of named categories that do not occur are left out, and the rest is scaled up to one.
    """
    sums = cells.groupBy(side).agg(F.sum("tokens").alias("tokens"))
    if isinstance(wanted, dict):
        share = F.lit(None).cast("double")
        for name, value in wanted.items():
            share = F.when(F.col(side) == name, F.lit(float(value))).otherwise(share)
        sums = sums.withColumn("share", share)
        rest = sums.agg(F.sum(F.when(F.col("share").isNull(), F.col("tokens"))).alias("unnamed"),
                        F.sum(F.when(F.col("tokens") > 0, F.col("share"))).alias("named"), F.sum("tokens").alias("tokens")).first()
        left, unnamed, named = max(0.0, 1 - sum(wanted.values())), float(rest["unnamed"] or 0), float(rest["named"] or 0)
        if left < 1e-9 and unnamed:
            # Nothing is left for them: they keep the share they have, and the named ones have the rest.
            left = named * unnamed / (float(rest["tokens"]) - unnamed) if named else 1.0
        sums = sums.withColumn("share", F.coalesce("share", F.col("tokens") * (left / unnamed if unnamed else 0.0)))
    else:
        sums = sums.withColumn("share", F.when(F.col("tokens") > 0, F.pow(F.col("tokens").cast("double"), F.lit(float(wanted))))
                               .otherwise(0.0))
    both = sums.agg(F.sum("tokens").alias("tokens"), F.sum("share").alias("share")).first()
    scale = float(both["tokens"] or 0) / both["share"] if both["share"] else 0.0
    return sums.select(F.col(side).alias("category"), (F.col("share") * scale).alias("target"), F.col("tokens").alias("held"))


def fitted(cells: DataFrame, wanted: dict[str, dict[str, float] | float], budget: float = BUDGET, rounds: int = ROUNDS,
           tolerance: float = TOLERANCE) -> DataFrame:
    """``cells`` (source, lang, topic, tokens) with ``weight``, at most ``tokens``: ``budget`` of all tokens, raked.

    A category too small for its part is aimed at whole, and the others of its side share the rest. A round scales the
    cells to each side in turn. Marginals that cannot be met together (they contradict each other, or need more than
    the cells hold) leave an error after the last round: that is a warning here, and ``shortfall`` tells where.
    """
    now = cells.withColumn("weight", F.col("tokens") * F.lit(budget))
    aims = []
    for side in SIDES:
        aims.append(_within(stored(targets(cells, side, wanted[side]), f"mix-target-{side}"), budget))
        now = now.join(aims[-1].withColumnRenamed("target", f"aim_{side}"), F.col(side).eqNullSafe(F.col("category"))).drop("category")
    now = stored(now, "mix-round")
    for aim in aims:
        drop(aim)
    few, done, off = now.count() <= FEW_CELLS, 0, None
    while done < rounds and (off is None or off > tolerance):
        step = now.coalesce(1) if few else now
        many = min(ROUNDS_A_JOB if few else 1, rounds - done)
        for _ in range(many):
            step = step.withColumn("off", F.lit(0.0))
            for side in SIDES:
                step = _scaled(step, side, few)
        after = stored(step, "mix-round")
        off = after.agg(F.max("off").alias("off")).first()["off"] or 0.0
        drop(now)
        now, done = after, done + many
    if off is not None and off > MISSED:
        warnings.warn(f"the wanted shares cannot be met together: a marginal is off by {off:.1%} after {done} rounds", stacklevel=2)
    return now.select(*SIDES, "tokens", F.least("weight", F.col("tokens").cast("double")).alias("weight"))


def _within(aim: DataFrame, budget: float) -> DataFrame:
    """(category, target): the targets scaled to ``budget`` of all tokens, none above the tokens its category has."""
    rate = budget
    while True:
        full = F.col("target") * F.lit(rate) >= F.col("held")
        got = aim.agg(F.sum("held").alias("all"), F.sum(F.when(full, F.col("held")).otherwise(0)).alias("full"),
                      F.sum(F.when(full, 0.0).otherwise(F.col("target"))).alias("free")).first()
        left = budget * float(got["all"] or 0) - float(got["full"] or 0)
        # Each new rate is larger than the last, until no further category is full.
        if not got["free"] or left / got["free"] <= rate * (1 + 1e-12):
            break
        rate = left / got["free"]
    kept = stored(aim.select("category", F.least(F.col("target") * F.lit(rate), F.col("held").cast("double"))
                             .alias("target")), "mix-aim")
    drop(aim)
    return kept


def _scaled(cells: DataFrame, side: str, few: bool) -> DataFrame:
    """Cells scaled to one side's aims; ``off`` keeps the largest relative error met so far in this round."""
    full = F.col("weight") >= F.col("tokens")
    whole = F.sum(F.when(full, F.col("tokens")).otherwise(0).cast("double"))
    free = F.sum(F.when(full, 0.0).otherwise(F.col("weight")))
    if few:
        of_side = Window.partitionBy(side)
        summed = cells.withColumns({"whole": whole.over(of_side), "free": free.over(of_side)})
    else:
        sums = cells.groupBy(F.col(side).alias("category")).agg(whole.alias("whole"), free.alias("free"))
        summed = cells.join(sums, F.col(side).eqNullSafe(F.col("category"))).drop("category")
    held, aim = F.col("whole") + F.col("free"), F.col(f"aim_{side}")
    factor = (F.when(held <= 0, 0.0).when(held >= aim, aim / held)
              .when(F.col("free") > 0, (aim - F.col("whole")) / F.col("free")).otherwise(1.0))
    error = F.when(aim > 0, F.abs(held / aim - 1)).otherwise(0.0)
    return summed.withColumns({"weight": F.col("weight") * factor, "off": F.greatest("off", error)}).drop("whole", "free")


def uniform(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from a hash of the id, the same on every run."""
    hashed = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))
    return F.conv(F.substring(hashed, 1, 12), 16, 10).cast("double") / F.lit(float(16 ** 12))


def chances(docs: DataFrame, wanted: dict[str, dict[str, float] | float] | None = None, doc_id: str = "doc_id",
            text: str = "text", source: str = "source", lang: str = "lang", seed: str = SEED,
            whole_rows: bool = False, budget: float = BUDGET) -> DataFrame:
    """Per row of ``docs``: doc_id, source, lang, topic, tokens, its ``chance`` and whether it is ``sampled``.

    The chances are those of ``fitted``. With ``whole_rows`` the struct ``row`` holds the input row. Null sources and
    languages are categories of their own; a null text is a text without tokens; a cell without tokens has chance 0.
    Repeated rows of one id are sampled together, rows without id all alike. An empty table gives no rows. Column names
    in ``docs`` may be anything.
    """
    wanted = wanted or {"source": SOURCE_POWER, "lang": LANG_SHARES, "topic": TOPIC_SHARES}
    slim = docs.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(lang).alias("lang"),
                       topic_of(F.col(text)).alias("topic"), tokens_of(F.col(text)).alias("tokens"),
                       *([F.struct("*").alias("row")] if whole_rows else []))
    cells = stored(slim.groupBy(*SIDES).agg(F.sum("tokens").alias("tokens")), "mix-cells")
    ratio = _ratios(fitted(cells, wanted, budget))
    drop(cells)
    of_cell = F.lit(True)
    for side in SIDES:
        of_cell = of_cell & F.col(side).eqNullSafe(F.col(f"of_{side}"))
    both = slim.join(ratio, of_cell, "left").withColumn("chance", F.col("ratio"))
    return (both.withColumn("sampled", uniform(F.col("doc_id"), seed) < F.col("chance"))
            .select("doc_id", *SIDES, "tokens", "chance", "sampled", *(["row"] if whole_rows else [])))


def _ratios(cells: DataFrame) -> DataFrame:
    """Per cell its weight over its tokens; 0 without tokens."""
    return stored(cells.select(*[F.col(s).alias(f"of_{s}") for s in SIDES], F.when(
        F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0).alias("ratio")), "mix-ratios")


def shortfall(found: DataFrame, wanted: dict[str, dict[str, float] | float] | None = None) -> DataFrame:
    """(side, category, tokens, wanted, expected) of rows of ``chances``: the shares asked for and those to expect."""
    wanted = wanted or {"source": SOURCE_POWER, "lang": LANG_SHARES, "topic": TOPIC_SHARES}
    cells = stored(found.groupBy(*SIDES).agg(F.sum("tokens").alias("tokens"), F.sum(F.col("tokens") * F.col("chance"))
                                             .alias("kept")), "mix-kept")
    total = cells.agg(F.sum("tokens").alias("tokens"), F.sum("kept").alias("kept")).first()
    parts = []
    for side in SIDES:
        kept = cells.groupBy(F.col(side).alias("of")).agg(F.sum("kept").alias("kept"))
        aim = targets(cells, side, wanted[side])
        parts.append(aim.join(kept, F.col("of").eqNullSafe(F.col("category"))).select(
            F.lit(side).alias("side"), "category", F.col("held").alias("tokens"),
            (F.col("target") / F.lit(float(total["tokens"] or 1) or 1.0)).alias("wanted"),
            (F.col("kept") / F.lit(total["kept"] or 1.0)).alias("expected")))
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


def sampled_documents(docs: DataFrame, **how) -> DataFrame:
    """The sampled rows of ``docs``, columns as they came."""
    return chances(docs, whole_rows=True, **how).where("sampled").select("row.*")


def oracle(rounds: int = ROUNDS) -> str:
    """The SQL of the query over the documents table, its rounds written out."""
    shares = {"lang": LANG_SHARES, "topic": TOPIC_SHARES}
    sql = [r"""
docs AS (SELECT doc_id, source, lang, CASE WHEN contains(coalesce(text, ''), 'License') THEN 'legal'
  WHEN contains(coalesce(text, ''), '@') THEN 'contact' WHEN contains(coalesce(text, ''), '|') THEN 'table'
  ELSE 'prose' END AS topic,
  len(list_filter(string_split_regex(coalesce(text, ''), '[ \t\n\x0B\f\r]+'), lambda x: x <> ''))::BIGINT AS tokens
  FROM documents)""",
           """cells AS MATERIALIZED (SELECT source, lang, topic, sum(tokens)::BIGINT AS tokens FROM docs
  GROUP BY source, lang, topic)""", "total AS MATERIALIZED (SELECT sum(tokens)::DOUBLE AS n FROM cells)"]
    for side in SIDES:
        if side == "source":
            share = f"CASE WHEN sum(tokens) > 0 THEN pow(sum(tokens)::DOUBLE, {SOURCE_POWER}) ELSE 0.0 END"
            sql.append(f"raw_{side} AS MATERIALIZED (SELECT {side} AS c, {share} AS share, sum(tokens)::DOUBLE AS held "
                       f"FROM cells GROUP BY {side})")
        else:
            named = "CASE " + " ".join(f"WHEN {side} = '{k}' THEN {v}::DOUBLE" for k, v in shares[side].items()) + " END"
            left = max(0.0, 1 - sum(shares[side].values()))
            sql.append(f"sum_{side} AS MATERIALIZED (SELECT {side} AS c, {named} AS named, sum(tokens)::DOUBLE AS tokens "
                       f"FROM cells GROUP BY {side})")
            sql.append(f"raw_{side} AS MATERIALIZED (SELECT c, coalesce(named, tokens * {left!r}::DOUBLE / (SELECT "
                       f"sum(tokens) FROM sum_{side} WHERE named IS NULL)) AS share, tokens AS held FROM sum_{side})")
        # The rate at which the targets fill the budget: categories are full in the order of held over target.
        sql.append(f"goal_{side} AS MATERIALIZED (SELECT c, held, share * (SELECT n FROM total) / (SELECT sum(share) FROM "
                   f"raw_{side}) AS target FROM raw_{side})")
        sql.append(f"""fill_{side} AS MATERIALIZED (SELECT held / target AS full_at, ({BUDGET} * (SELECT n FROM total)
  - coalesce(sum(held) OVER (ORDER BY held / target, c ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(target) OVER (ORDER BY held / target, c ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate
  FROM goal_{side} WHERE target > 0)""")
        sql.append(f"""aim_{side} AS MATERIALIZED (SELECT c, CASE WHEN target > 0 THEN least(held, target * coalesce((SELECT rate
  FROM fill_{side} WHERE rate <= full_at ORDER BY full_at LIMIT 1), 1e300)) ELSE 0.0 END AS aim FROM goal_{side})""")
    before = "w0"
    sql.append(f"w0 AS MATERIALIZED (SELECT *, tokens * {BUDGET}::DOUBLE AS w FROM cells)")
    for k in range(rounds):
        for side in SIDES:
            now = f"w{k}_{side}"
            sql.append(f"""{now} AS MATERIALIZED (SELECT source, lang, topic, tokens, w * CASE WHEN whole + free <= 0 THEN 0.0
  WHEN whole + free >= aim THEN aim / (whole + free) WHEN free > 0 THEN (aim - whole) / free ELSE 1.0 END AS w
  FROM (SELECT *, sum(CASE WHEN w >= tokens THEN tokens ELSE 0 END) OVER (PARTITION BY {side})::DOUBLE AS whole,
    sum(CASE WHEN w >= tokens THEN 0.0 ELSE w END) OVER (PARTITION BY {side})::DOUBLE AS free FROM {before})
  JOIN aim_{side} ON {side} IS NOT DISTINCT FROM c)""")
            before = now
    sql.append(f"ratios AS MATERIALIZED (SELECT source, lang, topic, CASE WHEN tokens > 0 THEN least(w, tokens) / tokens "
               f"ELSE 0.0 END AS chance FROM {before})")
    sql.append(f"""chosen AS (SELECT docs.*, chance,
  ('0x' || substr(md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 12))::BIGINT / {16 ** 12}::DOUBLE AS u
  FROM docs JOIN ratios ON docs.source IS NOT DISTINCT FROM ratios.source AND docs.lang IS NOT DISTINCT FROM ratios.lang
  AND docs.topic = ratios.topic)""")
    return ("WITH " + ",\n".join(s.strip() for s in sql)
            + "\nSELECT doc_id, source, lang, topic, tokens, round(chance, 6) AS chance, u < chance AS sampled FROM chosen")
