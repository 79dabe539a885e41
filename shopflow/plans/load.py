"""The load job of a master table: gate, scan, clean, referential check,
upsert, publish, mark (A1, A5, B1, C1-C6, D4, E11).

One run takes the files under a folder that changed since their stored mark.
The files are scanned and checked once, into a staged table; what follows reads
that.  The target is a keyed table in hash buckets, of which the run rewrites
only those that its keys fall in, as the next generation.  The marks are written
last and carry the generation: a run that dies before is loaded again, readers
(``read_table``) don't see it, and the same files change nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.operators import clean, merge
from shopflow.schemas import MASTER_SCHEMAS, PRIMARY_KEYS
from shopflow.session import work_path
from shopflow.sinks import keyed
from shopflow.sinks.tables import append, read_appended
from shopflow.sources import csv_blocks
from shopflow.sources.files import changed_files, file_listing

MARKS = T.StructType([T.StructField("file_path", T.StringType()), T.StructField("modified", T.TimestampType()),
                      T.StructField("generation", T.LongType())])
LOADS = T.StructType([T.StructField("generation", T.LongType()), T.StructField("rows_read", T.LongType()),
                      T.StructField("rows_rejected", T.LongType()), T.StructField("buckets_written", T.LongType())])
REJECTS = ["table_name", "source_file", "reason", "raw"]


def load_table(spark: SparkSession, folder: str, table: str, target: str, marks: str, rejects: str,
               users: DataFrame | None = None, buckets: int = keyed.BUCKETS) -> list[str]:
    """Load the changed CSV files of one table; the paths taken.

    ``target`` is a keyed table, ``marks`` and ``rejects`` are append tables;
    ``<marks>_loads`` has a row of counts for each run.  ``users``: for orders,
    the users that an order may refer to.
    """
    seen = read_appended(spark, marks, MARKS).groupBy("file_path").agg(F.max("modified").alias("modified"))
    listing = file_listing(spark, folder, "*.csv")
    todo = changed_files(listing.drop("file_name"), seen, key="file_path").collect()  # file names: metadata
    if not todo:
        return []
    generation = (read_appended(spark, marks, MARKS).agg(F.max("generation")).first()[0] or 0) + 1
    keys = [PRIMARY_KEYS[table]]
    checked = clean.check_table(csv_blocks.scan(spark, sorted(r["file_path"] for r in todo)), table)
    if users is not None and table == "orders":
        checked = _with_known_users(checked, users)
    counts = Observation("load")
    staged = work_path(spark, "load", table, fresh=True)
    checked.observe(counts, F.count(F.lit(1)).alias("read"), F.count("reason").alias("rejected")).write.parquet(staged)
    checked = spark.read.schema(checked.schema).parquet(staged)

    rows = checked.filter("reason is null").drop("source_file", "reason", "raw")
    hit = keyed.touched(rows, keys, buckets)
    old = keyed.read(spark, target, MASTER_SCHEMAS[table], before=generation, buckets=hit, n=buckets)
    keyed.write(merge.upsert(old, rows, keys, order="_pos"), target, keys, generation, buckets)
    append(checked.filter("reason is not null").select(F.lit(table).alias("table_name"), "source_file", "reason", "raw"), rejects)
    done = counts.get
    append(spark.createDataFrame([(generation, done["read"], done["rejected"], len(hit))], LOADS), f"{marks}_loads")
    append(spark.createDataFrame([(r["file_path"], r["modified"], generation) for r in todo], MARKS), marks)
    keyed.vacuum(spark, target, generation, buckets)
    return sorted(r["file_path"] for r in todo)


def _with_known_users(checked: DataFrame, users: DataFrame) -> DataFrame:
    """D4 in the same pass: good orders of a user that is not there get a reason."""
    known = users.select(F.col("user_id").alias("_user")).distinct().withColumn("_known", F.lit(True))
    orphan = F.col("reason").isNull() & F.col("user_id").isNotNull() & F.col("_known").isNull()
    return checked.join(known, F.col("user_id") == F.col("_user"), "left").withColumns({
        "reason": F.when(orphan, "unknown user").otherwise(F.col("reason")),
        "raw": F.when(orphan, F.to_json(F.struct("order_id", "user_id"))).otherwise(F.col("raw")),
        "source_file": F.when(~orphan, F.col("source_file"))}).drop("_user", "_known")


def read_table(spark: SparkSession, table: str, target: str, marks: str, buckets: int = keyed.BUCKETS) -> DataFrame:
    """The table as the last finished load left it."""
    last = read_appended(spark, marks, MARKS).agg(F.max("generation")).first()[0] or 0
    return keyed.read(spark, target, MASTER_SCHEMAS[table], before=last + 1, n=buckets)
