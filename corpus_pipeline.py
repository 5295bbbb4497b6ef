"""Training-data pipeline: each stage reads what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quire.llm.common import documents, written
from quire.llm.jaccard import keep_one
from quire.llm.mixing import mix_documents
from quire.llm.packing import pack_documents
from quire.llm.pii import pseudonymise
from quire.llm.quality import keep_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and their group's thresholds."""
    return keep_documents(spark, docs)


def ngram_jaccard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five words, 0.8)."""
    return keep_one(spark, docs)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with pseudonyms for personal data."""
    return pseudonymise(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mix_documents(spark, docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces and the sequences they are packed into."""
    return pack_documents(spark, docs)


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard", ngram_jaccard), ("pii", pii), ("mixing", mixing),
          ("packing", packing)]

#: Not expressible in SQL (tokenizer); tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``, each result written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(spark, stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
