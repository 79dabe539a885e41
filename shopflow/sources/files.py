"""File scans: CSV master data, JSON-lines events, new-file discovery, dated
scans and changed-file gates (A1-A5).

Every scan keeps its provenance from ``_metadata`` (file path / name / block
start / modification time) and an ingest position ``_pos`` =
``(file, block start, row id)``: rows of one file block keep their order in a
task, so ``_pos`` orders rows as they appear in the file.  It is what "first"
and "last" mean for the keyed merges.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopflow.sources import csv_blocks


def scan_csv(spark: SparkSession, path: str | list[str], header: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Read header CSV as all-string columns -> (rows, rejects).

    Each file is read with its own header, unless ``header`` is given; columns
    that only some files have are NULL in the others.  Lines with more fields
    than the header are rejected ("too many fields"); lines with fewer are
    padded with NULL.  The reader's missing-value tokens (empty, NA, NaN, null,
    ...) become NULL.  Column names are normalised (lower-cased, stripped).
    Quoted fields may hold line ends; large files are split all the same
    (``sources.csv_blocks``).
    """
    every = csv_blocks.scan(spark, path, header)
    rejects = every.filter(F.col("_reject").isNotNull()).select("source_file", "_pos", F.col("_raw").alias("raw"), F.col("_reject").alias("reason"))
    return every.filter(F.col("_reject").isNull()).drop("_reject", "_raw"), rejects


def scan_jsonl(spark: SparkSession, path: str, path_glob: str | None = None) -> DataFrame:
    """JSON-lines files as raw text lines: (value, source_file, _pos).

    Blank lines are dropped here; parsing and validation happen in
    ``operators.events.validate_events``.  Line numbers (for reject reports)
    are computed only for rejected rows, see ``line_numbers``.
    """
    # An unreadable file is skipped from where it breaks, the other files
    # go on; incomplete_files() reports it
    reader = spark.read.format("text").option("ignoreCorruptFiles", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    lines = reader.load(path)
    return text_lines(lines)


def text_lines(lines: DataFrame, with_row: bool = True) -> DataFrame:
    """Attach provenance to a text DataFrame.  Streams take ``with_row=False``
    and add the row id per micro-batch (``add_row_id``)."""
    out = lines.select("value", F.col("_metadata.file_name").alias("source_file"),
                       F.col("_metadata.file_path").alias("_file"),
                       F.col("_metadata.file_block_start").alias("_block"),
                       F.col("_metadata.file_size").alias("_size"))
    return add_row_id(out) if with_row else out


def incomplete_files(lines: DataFrame) -> DataFrame:
    """Files of a scan whose lines do not add up to the file's size: the
    reader skipped the rest.  ``lines`` is the full scan, blank lines included.
    Lines may end in LF or CRLF and the last one may lack its end; the size of
    a compressed file says nothing, so such files are not judged.  A file that
    gave no line at all is one that the ledger lacks (``new_files``)."""
    seen = (lines.groupBy("_file", "source_file")
            .agg(F.max("_size").alias("size"), F.count(F.lit(1)).alias("n_lines"),
                 F.sum(F.octet_length("value") + 1).cast("bigint").alias("bytes_read")))
    whole = F.col("size").isin(F.col("bytes_read"), F.col("bytes_read") - 1, F.col("bytes_read") + F.col("n_lines"),
                               F.col("bytes_read") + F.col("n_lines") - 2, F.col("bytes_read") + F.col("n_lines") - 1)
    return (seen.filter(~F.lower("_file").rlike(r"\.(gz|bz2|zst|lz4|snappy|deflate)$") & ~whole)
            .select("source_file", "size", "bytes_read"))


def add_row_id(lines: DataFrame) -> DataFrame:
    """Row id in scan order (unique; increasing within a file block)."""
    return lines.withColumn("_row", F.monotonically_increasing_id())


def line_numbers(lines: DataFrame, picked: DataFrame) -> DataFrame:
    """1-based line number within its file for the rows of ``picked``.

    ``lines`` is the full scan (all lines, blanks included) with ``_file``,
    ``_block``, ``_row``; ``picked`` a subset (e.g. rejects).  Lines before a
    block are counted per (file, block) - one small aggregate row per block -
    and the offset inside the block is ``_row`` minus the block's first row id.
    Only the small per-block table is joined to ``picked``; the full scan is
    never shuffled.
    """
    blocks = lines.groupBy("_file", "_block").agg(F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    from pyspark.sql import Window
    w = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_n").over(w), F.lit(0)))
    return (picked.join(blocks.select("_file", "_block", "_before", "_first"), ["_file", "_block"], "left")
            .withColumn("line", F.col("_before") + F.col("_row") - F.col("_first") + 1)
            .drop("_before", "_first"))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    return spark.createDataFrame([], schema)


def list_files(spark: SparkSession, path_glob: str) -> list[str]:
    """Paths matching a glob, via the cluster's file system (metadata only)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path_glob)
    fs = p.getFileSystem(conf)
    found = fs.globStatus(p)
    return [] if found is None else sorted(str(s.getPath().toString()) for s in found if s.isFile())


def list_folders(spark: SparkSession, path_glob: str) -> list[str]:
    """Folders matching a glob (metadata only)."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path_glob)
    found = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(p)
    return [] if found is None else sorted(str(s.getPath().toString()) for s in found if s.isDirectory())


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of the engine's own tables, if it is there."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def make_folder(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder exists, via the cluster's file system."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def scan_day(spark: SparkSession, folder: str, ds: str, prefix: str = "sessions_") -> DataFrame:
    """Raw lines of the files of one day: ``{prefix}{yyyymmdd}_*.json``; such a
    name may also be a folder that Spark wrote.

    ``ds`` is ``YYYY-MM-DD`` or ``YYYYMMDD``.  No matching file -> an empty
    frame with the scan's columns (not an error).
    """
    day = re.sub(r"-", "", ds)
    pattern = f"{folder.rstrip('/')}/{prefix}{day}_*.json"
    if not list_files(spark, pattern) and not list_folders(spark, pattern):
        schema = T.StructType([T.StructField("value", T.StringType()),
                               T.StructField("source_file", T.StringType()),
                               T.StructField("_file", T.StringType()),
                               T.StructField("_block", T.LongType()),
                               T.StructField("_size", T.LongType()),
                               T.StructField("_row", T.LongType(), False)])
        return empty_like(spark, schema)
    return text_lines(spark.read.format("text").load(pattern))


def file_listing(spark: SparkSession, path: str, path_glob: str | None = None) -> DataFrame:
    """(file_name, file_path, modified) of the files under ``path``.

    Read through the binary-file source with the content column pruned, so the
    listing is distributed and no file body is read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if path_glob:
        reader = reader.option("pathGlobFilter", path_glob)
    df = reader.load(path)
    return df.select(F.element_at(F.split("path", "/"), -1).alias("file_name"),
                     F.col("path").alias("file_path"),
                     F.col("modificationTime").alias("modified"))


def new_files(listing: DataFrame, ledger: DataFrame) -> DataFrame:
    """Files not yet in the ledger, by name (D2/H3: anti-join)."""
    return listing.join(ledger.select("file_name"), "file_name", "left_anti")


def changed_files(listing: DataFrame, marks: DataFrame, key: str = "file_name") -> DataFrame:
    """Files whose modification time is newer than the stored mark (A5).

    ``marks``: (key, modified) of the last successful load; a file with
    no mark counts as changed.  Missing files simply do not appear.
    """
    m = marks.select(key, F.col("modified").alias("_mark"))
    return (listing.join(m, key, "left")
            .filter(F.col("_mark").isNull() | (F.col("modified") > F.col("_mark")))
            .drop("_mark"))
