"""Pipeline state as tables: processed-file ledger and publish cursors.

Both are append-only tables read with an aggregate; no state value is
collected to drive a loop.  A cursor is applied as a scalar subquery
(``DataFrame.scalar()``), so the filter runs in the scan's job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.sinks.tables import append, read_appended

LEDGER = T.StructType([
    T.StructField("file_name", T.StringType()),
    T.StructField("processed_at", T.TimestampType()),
    T.StructField("status", T.StringType()),
    T.StructField("records_inserted", T.LongType()),
])

CURSOR = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("value", T.LongType()),
    T.StructField("updated_at", T.TimestampType()),
])


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    return read_appended(spark, path, LEDGER).select(*[f.name for f in LEDGER.fields])


def ledger_rows(read: DataFrame, inserted: DataFrame, status: str = "success") -> DataFrame:
    """One ledger row per file that was read, with the rows stored from it
    (0 for a file without any, Q16).  Both frames have ``source_file``."""
    seen = read.select("source_file", F.lit(0).alias("_n"))
    stored = inserted.select("source_file", F.lit(1).alias("_n"))
    return (seen.unionAll(stored).groupBy(F.col("source_file").alias("file_name"))
            .agg(F.sum("_n").cast("bigint").alias("records_inserted"))
            .select("file_name", F.current_timestamp().alias("processed_at"), F.lit(status).alias("status"),
                    "records_inserted"))


def read_cursor(spark: SparkSession, path: str, name: str) -> Column:
    """Latest value of cursor ``name`` as a scalar Column (NULL if unset)."""
    cur = read_appended(spark, path, CURSOR).filter(F.col("name") == name)
    return cur.agg(F.max("value").alias("v")).scalar()  # cursors only move forward


def advance_cursor(spark: SparkSession, path: str, name: str, published: DataFrame, column: str) -> None:
    """K3: store max(column) of what was published, after the sink committed
    (at-least-once: a crash before this line re-publishes, consumers dedupe).
    ``published`` is read back from the sink, not scanned anew from the source,
    where rows may have come in between."""
    row = published.agg(F.max(column).alias("value")).filter(F.col("value").isNotNull())
    append(row.select(F.lit(name).alias("name"), F.col("value").cast("bigint"),
                      F.current_timestamp().alias("updated_at")), path)
