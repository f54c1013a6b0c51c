"""The corpus pipeline: five stages over ``documents``, each written as Parquet and read by the next.

Every stage takes the documents its predecessor kept, with all their columns,
and its models learn from those documents alone. All but the last return
documents; the last returns one row of token digests for each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import bpe, langid, simhash, toxicity, winnow
from tripmart.llm.common import read_table
from tripmart.operators.lookup import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or far from every language's centroids, go."""
    return langid.keep_identified(docs, langid.fit(docs, ~langid.held_out()))


def civility(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored toxic go."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.keep_civil(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.one_of_each_group(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with enough benchmark words go."""
    return winnow.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept document encoded, decoded again, and described by digests."""
    return bpe.round_trip(docs)


STAGES = [
    ("language_id", language_id),
    ("toxicity", civility),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("bpe", tokens),
]

#: SQL can express neither the trained stages nor the tokeniser; tests/llm runs brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the whole ``documents`` table."""
    docs = read_table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
