"""The corpus pipeline: quality rules, near duplicates, benchmark decontamination, personal data, source mix.

Each stage works on all rows that the one before it kept; between stages the rows are written as Parquet.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.llm.common import saved, table
from shopflow.llm.decontaminate import without_leaks
from shopflow.llm.mixing import mixed_documents
from shopflow.llm.ngram_join import representatives
from shopflow.llm.pii import masked_text
from shopflow.llm.quality_rules import judged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rule and the learned rules keep."""
    return judged(docs, table(spark, sf_dir, "labels")).filter("__quality.kept").drop("__quality")


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of least doc_id of each near-duplicate class, null last; equal rows are one."""
    return representatives(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item."""
    return without_leaks(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data replaced by the name of its kind, and n_chars counted anew."""
    return docs.withColumn("text", masked_text(F.col("text"))).withColumn("n_chars", F.char_length("text").cast("long"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's rate and its draw say, numbered by copy."""
    return mixed_documents(docs).withColumnRenamed("__copy", "copy")


STAGES = [("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join),
          ("benchmark_decontamination", benchmark_decontamination), ("pii", pii), ("mixing", mixing)]

#: The learned rules can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return docs
