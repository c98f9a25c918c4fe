"""Corpus pipeline: from raw documents to token ids, as five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; a runner writes it as
Parquet and gives it, read again, to the next stage.  All but the last
return the columns of ``documents``.  ``run`` does that in the folder that the
cluster shares.

1. toxicity: documents that the counterfactual classifier rejects go.
2. exact_dedup: one document of each group of equal texts stays.
3. simhash: one document of each near-duplicate component stays.
4. mixing: documents are repeated or left out so that sources meet their target weights.
5. sentencepiece: token ids, with digests of the ids and of the text they decode to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mise.llm import exact_dedup, mixing, pieces, simhash, toxicity
from mise.llm.common import read_table, written


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents among ``docs``."""
    model = toxicity.fit(docs, read_table(spark, sf_dir, "labels"))
    return toxicity.reject(docs, model)


def exact_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.drop_near(docs, shingle=simhash.SHINGLE, distance=simhash.DISTANCE)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def sentencepiece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded_with_digests(docs, carry=("doc_id", "source"))


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("simhash", simhash_stage),
    ("mixing", mixing_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: No SQL: the classifier, the fingerprints and the encoder can't be put in it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each result is written and read again."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
