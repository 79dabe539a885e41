"""Cursor scans (A6, A7): rows after the last published position, as one
range job (no page loop).  The cursor is a Column, typically a scalar
subquery over the cursor table, so the predicate is evaluated in the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions.columns import id_number


def scan_since(df: DataFrame, pk: str, last: Column | int | None, numeric_suffix: bool = True) -> DataFrame:
    """Rows whose key is after ``last``; NULL/None cursor -> every row with a
    usable key (the others are in ``cursor_rejects``, on every run).

    ``numeric_suffix``: keys like ``u123`` compare by their number (so u10
    follows u9); the number is exposed as ``id_num``.  Store ``id_num``
    physically (and cluster on it) to let Parquet statistics skip row groups.
    """
    num = id_number(pk) if numeric_suffix else F.col(pk)
    out = df.withColumn("id_num", num).filter("id_num is not null")
    if last is None:
        return out
    last_col = last if isinstance(last, Column) else F.lit(last)
    return out.filter((F.col("id_num") > last_col) | last_col.isNull())


def write_clustered(df: DataFrame, pk: str, path: str, mode: str = "append") -> None:
    """Store rows clustered on the number of their key (``id_num``): every file
    holds a range of numbers in order, so the statistics of its row groups tell
    a cursor scan what to skip."""
    (df.withColumn("id_num", id_number(pk)).filter("id_num is not null").repartitionByRange("id_num").sortWithinPartitions("id_num")
     .write.mode(mode).parquet(path))


def scan_clustered(spark: SparkSession, path: str, last: int | None) -> DataFrame:
    """Rows of a clustered table after ``last``; a number, not a subquery, so
    that the comparison reaches the row groups."""
    df = spark.read.parquet(path)
    return df if last is None else df.filter(F.col("id_num") > F.lit(last))


def cursor_rejects(df: DataFrame, pk: str) -> DataFrame:
    """Rows that a numeric cursor can't place: their key has no number.  Such
    rows are in no export (the comparison above is never true for them), so
    they are reported instead of being dropped by the scan."""
    return df.filter(id_number(pk).isNull()).withColumn(
        "reason", F.when(F.col(pk).isNull(), F.lit("missing key")).otherwise(F.lit("key without a number")))


def scan_changes(df: DataFrame, last_version: Column | int | None, version: str = "_version") -> DataFrame:
    """Rows inserted or updated by a merge after ``last_version`` (see
    ``operators.merge.upsert(version=...)``): re-exports changed rows whose
    key is below an id cursor, which a key cursor never does."""
    if last_version is None:
        return df
    last_col = last_version if isinstance(last_version, Column) else F.lit(last_version)
    return df.filter((F.col(version) > last_col) | last_col.isNull())
