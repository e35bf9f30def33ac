"""From raw documents to token ids: five stages, each a table that the next one reads.

Documents of low quality go, then those that the rules or their host's verdict reject, then all but one of each group
of near duplicates; the rest is sampled towards the wanted mix and encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clientpulse.llm import host_rules, mixing, queries, ranker, simhash
from clientpulse.llm.stored import drop, stored


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker, fitted on the labels outside the held-out part, scores 0.7 or more."""
    return ranker.accepted_documents(docs, ranker.fit(docs, queries.table(spark, sf_dir, "labels")))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host passes."""
    return host_rules.kept_documents(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of fingerprints linked at 4 or fewer differing bits, over 4-word shingles."""
    return simhash.one_of_each(docs, shingle=4, budget=4)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents sampled by their raked chances."""
    return mixing.sampled_documents(docs)


def bpe_codec(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the token ids and of the text decoded from them."""
    return queries.token_digests(docs, queries.tokenizer_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("bpe_codec", bpe_codec),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents table; each one's rows are written and read again by the next.

    A stage's table is removed when the next one's is there.
    """
    docs, made = queries.table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if made is not None:
            drop(made)
        made = docs
    return docs


#: A learned score and tokenization are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
