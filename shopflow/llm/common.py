"""Helpers shared by the operators: tables, scratch folders, word spans and 64-bit fingerprints of Arrow text batches."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.session import work_path

#: Words are runs of anything but blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Rows in an Arrow batch; texts are long, so a batch holds a few megabytes.
BATCH_ROWS = 512

#: Characters of a text that a fit reads at most, so that a sample of rows is bounded in bytes as well.
FIT_CHARS = 20_000

_rng = np.random.default_rng(20240601)
#: A random 64-bit value for each byte, and the same with A-Z read as a-z.
BYTE_KEYS = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
LOWER_KEYS = BYTE_KEYS.copy()
LOWER_KEYS[65:91] = BYTE_KEYS[97:123]
#: Odd multipliers of the words of a shingle, by place; the last keeps short sequences apart.
PLACE_KEYS = _rng.integers(1, 2**63, 9, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
POWER = np.uint64(6364136223846793007)
#: Longer pieces are fingerprinted by BLAKE2: a polynomial modulo 2^64 maps some long strings to one value whatever its keys.
LONG_PIECE = 64
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True


def tune(spark: SparkSession) -> None:
    """Small Arrow batches: a batch of long texts must fit beside the JVM heap."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, and survives the loss of an executor."""
    spark = df.sparkSession
    path = work_path(spark, "llm", name, fresh=True)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._saved_path = path
    return out


def drop_saved(*frames: DataFrame) -> None:
    """Delete tables made by saved() that nothing reads any more."""
    for df in frames:
        spark = df.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(df._saved_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function of one batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows and (out := fn(b)) is not None:
                yield out
    return df.mapInArrow(run, schema)


def item_blocks(items: DataFrame, item_col: str, text_col: str, size: int) -> DataFrame:
    """(block, at, item_id, text): the items in blocks of at most `size` characters, or one item."""
    rows = items.select(F.col(item_col).alias("item_id"), F.coalesce(text_col, F.lit("")).alias("text"))

    def run(batches):
        block, at, held = TaskContext.get().partitionId() << 32, 0, 0
        for b in batches:
            blocks, places = [], []
            for n in (len(x) for x in b.column("text").to_pylist()):
                if held + n > size and at:
                    block, at, held = block + 1, 0, 0
                blocks.append(block)
                places.append(at)
                at, held = at + 1, held + n
            yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(places, pa.int64()), b.column("item_id"), b.column("text")], ["block", "at", "item_id", "text"])
    return saved(rows.mapInArrow(run, f"block long, at long, item_id {rows.schema['item_id'].dataType.simpleString()}, text string"), "item_blocks")


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column as Python strings; null becomes empty."""
    return [x or "" for x in batch.column(name).to_pylist()]


def utf8(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column end to end, and each row's offsets; null becomes empty."""
    col = pc.fill_null(col.cast(pa.string()), "")
    offsets = np.frombuffer(col.buffers()[1], np.int32, len(col) + 1, col.offset * 4).astype(np.int64)
    data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, breaks: np.ndarray = IS_SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word, in order.  breaks: which bytes are outside words."""
    inside = ~breaks[data]
    first, last = inside.copy(), inside.copy()
    if len(data):
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = offsets[1:] > offsets[:-1]
        at, end = offsets[:-1][full], offsets[1:][full] - 1
        first[at], last[end] = inside[at], inside[end]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(offsets, start, side="right") - 1


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray, keys: np.ndarray = LOWER_KEYS,
                step: int = 1 << 21) -> np.ndarray:
    """A 64-bit fingerprint of each word, in pieces of about `step` bytes whatever the length of a text."""
    out = np.zeros(len(start), np.uint64)
    long = np.flatnonzero(end - start > LONG_PIECE)
    if len(long):
        short, lower = np.flatnonzero(end - start <= LONG_PIECE), keys[65] == keys[97]
        out[short] = word_hashes(data, start[short], end[short], keys, step)
        for j, a, b in zip(long.tolist(), start[long].tolist(), end[long].tolist(), strict=True):
            piece = data[a:b].tobytes()
            out[j] = int.from_bytes(hashlib.blake2b(piece.lower() if lower else piece, digest_size=8).digest(), "little")
        return out
    i = 0
    while i < len(start):
        j = max(i + 1, int(np.searchsorted(end, start[i] + step)))
        lens = end[i:j] - start[i:j]
        begin = np.cumsum(lens) - lens
        place = np.arange(int(lens.sum())) - np.repeat(begin, lens)
        power = np.full(int(lens.max()), POWER)
        power[0] = 1
        value = keys[data[place + np.repeat(start[i:j], lens)]] * np.cumprod(power)[place]
        out[i:j] = mixed(np.add.reduceat(value, begin) + lens.astype(np.uint64))
        i = j
    return out


def shingles(hashes: np.ndarray, rows: np.ndarray, n_rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and fingerprint of each distinct k-word shingle, by row, then fingerprint; fewer words make one shingle."""
    value = np.zeros(max(0, len(hashes) - k + 1), np.uint64)
    for p in range(k if len(value) else 0):
        value += hashes[p:len(hashes) - k + 1 + p] * PLACE_KEYS[p]
    whole = rows[:len(value)] == rows[k - 1:] if len(value) else np.zeros(0, bool)
    value, at = mixed(value[whole]), rows[:len(whole)][whole]
    n_words = np.bincount(rows, minlength=n_rows)
    first = np.cumsum(n_words) - n_words
    for n in range(1, k):
        short = np.flatnonzero(n_words == n)
        if len(short):
            s = PLACE_KEYS[8] * np.full(len(short), n, np.uint64)
            for p in range(n):
                s += hashes[first[short] + p] * PLACE_KEYS[p]
            value, at = np.concatenate([value, mixed(s)]), np.concatenate([at, short])
    order = np.lexsort((value, at))
    value, at = value[order], at[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (at[1:] != at[:-1])
    return at[new], value[new]


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from values end to end."""
    ends = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=ends[1:])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values, kind))


def components(edges: DataFrame, name: str = "components") -> DataFrame:
    """(node, label) of every node of the links (a, b): label is the least node that links reach.

    Alternates the large-star and small-star steps, each a grouped minimum with partial aggregation followed by a
    join; every round is written to the shared folder.  The number of rounds is logarithmic in the size of a component.
    """
    both = lambda e: e.select("a", "b").unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    now = saved(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    while True:
        # large star: neighbours above a node go to the least node of its neighbourhood
        pairs = both(now)
        least = pairs.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = pairs.join(least, "a").filter("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        # small star: neighbours below a node, and the node itself, go to the least of them
        lower = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(lower, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")) \
            .unionAll(lower.select("a", F.col("m").alias("b"))).distinct()
        after = saved(small, name)
        same = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if same == after.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first():
            break
        drop_saved(now)
        now = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("label")) \
        .unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
