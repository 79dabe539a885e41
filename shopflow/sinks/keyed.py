"""Keyed tables in hash buckets: a merge rewrites only the buckets that its keys fall in.

A table is a Parquet folder partitioned by ``bucket``, a hash of the key, and ``generation``, the number of the batch
that wrote it; the newest generation of a bucket holds all its rows.  A batch reads the buckets of its keys as they were
before it and writes them anew under its own number, so running it again reads the same rows and replaces what it wrote.
Readers never meet a half-written bucket of a batch that they do not ask for (``before``).

The number of buckets is part of the table's path and stays.  What a batch costs grows with its keys and the size of
their buckets, not with the table; only folder names and bucket numbers reach the driver.
"""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.sources.files import delete_path, list_folders

BUCKETS = 64
_FOLDER = re.compile(r"/of=(\d+)/bucket=(\d+)/generation=(\d+)$")


def bucket_of(keys: Sequence[str], n: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(n)).cast("int")


def generations(spark: SparkSession, path: str, n: int = BUCKETS) -> dict[int, list[int]]:
    """The generations of each bucket, oldest first (folder names only)."""
    out: dict[int, list[int]] = {}
    for folder in list_folders(spark, f"{path}/of=*/bucket=*/generation=*"):
        of, bucket, generation = map(int, _FOLDER.search(folder).groups())
        if of != n:
            raise ValueError(f"{path} has {of} buckets, not {n}")
        out.setdefault(bucket, []).append(generation)
    return {b: sorted(g) for b, g in out.items()}


def read(spark: SparkSession, path: str, schema: T.StructType, before: int | None = None, buckets: Sequence[int] | None = None,
         n: int = BUCKETS) -> DataFrame:
    """The rows of the table, or of some buckets, as they were before a generation."""
    found = {b: [g for g in gens if before is None or g < before] for b, gens in generations(spark, path, n).items() if buckets is None or b in set(buckets)}
    folders = [f"{path}/of={n}/bucket={b}/generation={gens[-1]}" for b, gens in sorted(found.items()) if gens]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def touched(df: DataFrame, keys: Sequence[str], n: int = BUCKETS) -> list[int]:
    """The buckets that the rows fall in: at most ``n`` numbers."""
    return sorted(r[0] for r in df.select(bucket_of(keys, n)).distinct().collect())


def write(df: DataFrame, path: str, keys: Sequence[str], generation: int, n: int = BUCKETS) -> None:
    """Write whole buckets as a generation, in place of what an earlier attempt at it left."""
    spark = df.sparkSession
    for b, gens in generations(spark, path, n).items():
        if generation in gens:
            delete_path(spark, f"{path}/of={n}/bucket={b}/generation={generation}")
    (df.withColumns({"bucket": bucket_of(keys, n), "generation": F.lit(generation).cast("bigint")}).hint("rebalance", "bucket")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket", "generation").parquet(f"{path}/of={n}"))


def vacuum(spark: SparkSession, path: str, done: int, n: int = BUCKETS) -> None:
    """Drop what no attempt at generation ``done`` or a later one can read: all but the newest before it, and from it on."""
    for b, gens in generations(spark, path, n).items():
        for g in [g for g in gens if g < done][:-1]:
            delete_path(spark, f"{path}/of={n}/bucket={b}/generation={g}")
