"""Health score: points per criterion, total, status, labels and run summary."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clientpulse.functions import round_half_even, to_double, truthy
from clientpulse.operators.rules import (
    RULE_FEATURES, Profile, compile_bands, compile_labels, compile_points, rule_features,
)
from clientpulse.sources.schemas import HEALTH_SCORE, conformed


def score_points(features: DataFrame, profile: Profile) -> DataFrame:
    """Features plus one integer column per criterion and bonus of the profile."""
    ladders = {**profile.criteria, **profile.bonus}
    scored = rule_features(features).withColumns({c: compile_points(rules) for c, rules in ladders.items()})
    return scored.drop(*RULE_FEATURES)


def classify(scored: DataFrame, profile: Profile) -> DataFrame:
    """Total over the profile's columns, and the status of its band."""
    total = sum((F.col(c) for c in list(profile.criteria) + list(profile.bonus)), F.lit(0))
    return scored.withColumn("total_score", total).withColumn(
        "health_status", compile_bands(F.col("total_score"), profile.bands, profile.below))


def health_score(features: DataFrame, profile: Profile, as_of: date, period_days: int = 30,
                 extra: tuple[str, ...] = ()) -> DataFrame:
    """Score rows with the full fact columns; criteria a profile lacks stay NULL.

    ``extra`` names feature columns kept in front of the fact columns, as the stateless alerts need. Features with a
    ``period_days`` of their own (``features.with_periods``) give one row per client and window.
    """
    window = F.col("period_days") if "period_days" in features.columns else F.lit(period_days)
    dated = classify(score_points(features, profile), profile).withColumns(
        {"calculated_at": F.lit(as_of), "period_days": window,
         **{c: round_half_even(c, scale) for c, scale in profile.rounded.items()}})
    fact = conformed(dated, HEALTH_SCORE, keep_types=("client_id",))
    return dated.select(*extra, *fact)


def criterion_labels(features: DataFrame, profile: Profile) -> DataFrame:
    """Label of the rule that gave the points, per criterion."""
    with_names = rule_features(features)
    return with_names.select("client_id", *[
        compile_labels(rules).alias(c.replace("score_", "label_")) for c, rules in profile.criteria.items()
        if all(r.label for r in rules)])


def score_totals() -> list[Column]:
    """Rows, rows per status and mean score."""
    return [F.count(F.lit(1)).alias("clients"),
            *[F.count_if(F.col("health_status") == s).alias(s) for s in ("green", "yellow", "red", "inactive")],
            F.round(F.avg("total_score"), 2).alias("avg_score")]


def score_summary(scores: DataFrame) -> DataFrame:
    """Rows per status and mean score of a run, by a scan; ``watched(scores, score_totals())`` takes it from a write."""
    return scores.agg(*score_totals())


def score_table(export: DataFrame) -> DataFrame:
    """Exported scores, all text, in the shape of the score fact; what is missing or malformed is NULL."""
    def parsed(field):
        if field.name not in export.columns:
            return F.lit(None).cast(field.dataType).alias(field.name)
        text = F.col(field.name)
        if isinstance(field.dataType, (T.IntegerType, T.LongType)):
            text = to_double(text)
        elif isinstance(field.dataType, T.BooleanType):
            return F.when(text.isNotNull(), truthy(text)).alias(field.name)
        return text.try_cast(field.dataType).alias(field.name)

    return export.select(*[parsed(f) for f in HEALTH_SCORE.fields])
