"""CSV files read block by block, with line ends inside quoted fields (A1).

A reader that meets a block in the middle of a file cannot see whether the block begins inside a quoted field.  So the
scan has two passes.  The first one reads the lines of each block and finds what state the block ends in, outside or
inside quotes, for either state that it may begin in.  These little maps, one row a block, are composed along each file,
which proves the state that every block begins in.  The second pass then cuts the lines of each block into records from
there; a record that runs on into the next blocks leaves one fragment in each, and the fragments of a record are put
together by file and the block it began in.

Both passes are scans of splittable text, so a file of any size is read by many tasks.  What moves is one row a block
and the records across block borders.  Lines pass through Python in Arrow batches; only those with a quote are looked at.

A quote opens a field only as its first character, and a doubled quote inside a quoted field is a quote.  Lines end in
LF or CRLF.  The header is the first line of a file.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from shopflow.functions.columns import csv_null
from shopflow.session import work_path

_QUOTED = r'"(?:[^"]++|"")*+"[^,]*+'
_FIELD = rf'(?:{_QUOTED}|[^,"][^,]*+|)'
#: A line, begun outside quotes, that ends outside them.
CLOSED = re.compile(rf"{_FIELD}(?:,{_FIELD})*+\Z", re.DOTALL)

LINE = "value string, source_file string, _file string, _block long, _row long"


def csv_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The lines of the files with their place; a CR stays at the end of its line."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_row"))


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a line that begins inside or outside quotes ends inside them."""
    if '"' not in line:
        return inside
    return CLOSED.match('"' + line if inside else line) is None


def _by_block(batches: Iterator[pa.RecordBatch], columns: list[str]) -> Iterator[tuple[tuple[str, int], Iterator[tuple]]]:
    """The rows of each (file, block) of a task, which come one after the other."""
    rows = (row for b in batches for row in zip(*(b.column(c).to_pylist() for c in ("_file", "_block", *columns)), strict=True))
    return groupby(rows, itemgetter(0, 1))


def block_maps(lines: DataFrame) -> DataFrame:
    """(_file, _block, after_outside, after_inside, head, n_lines) of each block: the state after it, by the state
    before it, and its first line."""
    def run(batches):
        for (file, block), rows in _by_block(batches, ["value"]):
            outside, inside, head, n = False, True, None, 0
            for _, _, line in rows:
                head, n = line if head is None else head, n + 1
                if '"' in line:
                    same = outside == inside
                    outside = ends_inside(line, outside)
                    inside = outside if same else ends_inside(line, inside)
            yield pa.RecordBatch.from_pylist([{"_file": file, "_block": block, "after_outside": outside, "after_inside": inside, "head": head, "n_lines": n}],
                                             pa.schema([("_file", pa.string()), ("_block", pa.int64()), ("after_outside", pa.bool_()), ("after_inside", pa.bool_()),
                                                        ("head", pa.string()), ("n_lines", pa.int64())]))
    return lines.select("_file", "_block", "value").mapInArrow(
        run, "_file string, _block long, after_outside boolean, after_inside boolean, head string, n_lines long")


def inside_blocks(maps: DataFrame) -> DataFrame:
    """(_file, _block) of the blocks that begin inside quotes: the maps composed along each file."""
    each = F.sort_array(F.collect_list(F.struct("_block", "after_outside", "after_inside"))).alias("maps")
    composed = F.expr("""aggregate(maps, named_struct('inside', false, 'found', cast(array() as array<bigint>)), (a, m) -> named_struct(
        'inside', if(a.inside, m.after_inside, m.after_outside), 'found', if(a.inside, concat(a.found, array(m._block)), a.found))).found""")
    return maps.groupBy("_file").agg(each).select("_file", F.explode(composed).alias("_block"))


def records(lines: DataFrame, inside: DataFrame) -> DataFrame:
    """(record, source_file, _file, _block, _row): the records of the files in their places, headers left out."""
    def run(batches):
        out: list[dict] = []
        schema = pa.schema([("record", pa.string()), ("part", pa.string()), ("source_file", pa.string()), ("_file", pa.string()), ("_block", pa.int64()), ("_row", pa.int64())])

        def emit(part: str, held: list[str], first: tuple) -> None:
            file, block, _, name, row, _ = first
            out.append({"record": "\n".join(held), "part": part, "source_file": name, "_file": file, "_block": block, "_row": row})

        for (_, block), rows in _by_block(batches, ["value", "source_file", "_row", "inside"]):
            state, held, first, part = None, [], None, "record"
            for n, r in enumerate(rows):
                if state is None:
                    state = bool(r[5])
                    part = "head" if state else "record"
                if n == 0 and block == 0:
                    continue  # the header
                first = r if not held else first
                held.append(r[2])
                state = ends_inside(r[2], state)
                if not state:
                    emit(part, held, first)
                    held, part = [], "record"
                    if len(out) >= 512:
                        yield pa.RecordBatch.from_pylist(out, schema)
                        out.clear()
            if held:
                emit("tail" if part == "record" else "head", held, first)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema)

    known = lines.join(inside.withColumn("inside", F.lit(True)), ["_file", "_block"], "left") \
        .select("_file", "_block", "value", "source_file", "_row", "inside").sortWithinPartitions("_file", "_block", "_row")
    cut = known.mapInArrow(run, "record string, part string, source_file string, _file string, _block long, _row long")
    pieces = cut.filter("part <> 'record'").withColumn("_chain", F.sum(F.when(F.col("part") == "tail", 1).otherwise(0)).over(
        Window.partitionBy("_file").orderBy("_block", "_row").rowsBetween(Window.unboundedPreceding, 0)))
    joined = pieces.groupBy("_file", "source_file", "_chain").agg(F.sort_array(F.collect_list(F.struct("_block", "_row", "record"))).alias("p")) \
        .select(F.array_join(F.col("p.record"), "\n").alias("record"), "source_file", "_file", F.col("p")[0]["_block"].alias("_block"), F.col("p")[0]["_row"].alias("_row"))
    whole = cut.filter("part = 'record'").select("record", "source_file", "_file", "_block", "_row").unionByName(joined)
    return whole.withColumn("record", F.regexp_replace("record", r"\r\z", "")).filter(F.trim("record") != "")


def names_of(header: str) -> list[str]:
    """Normalised column names of a header line."""
    return [h.lower().strip() for h in next(csv.reader([header.rstrip("\r").lstrip("\ufeff")]), [])]


def parsed(rows: DataFrame, heads: list[tuple[int, list[str]]]) -> DataFrame:
    """Records with the number of their header in ``_head``, as columns of all headers, with ``source_file``, ``_pos``
    and, for records of more fields than their header, ``_reject`` and ``_raw``.

    A record is parsed once, into as many columns as the widest header has, and one more for a surplus field.
    """
    width = max(len(names) for _, names in heads) + 1
    fields = F.from_csv("record", ", ".join(f"_c{i} string" for i in range(width)),
                        {"escape": '"', "nullValue": "\u0000", "emptyValue": "", "multiLine": "true", "mode": "PERMISSIVE"})
    t = rows.withColumn("_f", fields)

    def chosen(by_head: dict[int, Column]) -> Column:
        out = None
        for head, value in by_head.items():
            out = F.when(F.col("_head") == head, value) if out is None else out.when(F.col("_head") == head, value)
        return out

    field = lambda i: F.col("_f")[f"_c{i}"]
    order = list(dict.fromkeys(n for _, names in heads for n in names))
    columns = [csv_null(chosen({h: field(names.index(n)) for h, names in heads if n in names})).alias(n) for n in order]
    surplus = chosen({h: field(len(names)).isNotNull() for h, names in heads})
    raw = chosen({h: F.to_json(F.struct(*[csv_null(field(i)).alias(n) for i, n in enumerate(names)])) for h, names in heads})
    place = F.struct(F.col("_file").alias("file"), F.col("_block").alias("block"), F.col("_row").alias("row"))
    return t.select(*columns, "source_file", place.alias("_pos"), F.when(surplus, "too many fields").alias("_reject"), F.when(surplus, raw).alias("_raw"))


def scan(spark: SparkSession, path: str | list[str], header: list[str] | None = None) -> DataFrame:
    """All records of header CSV files (see ``parsed``); each is read with its own header, unless ``header`` is given."""
    lines = csv_lines(spark, path)
    stored = work_path(spark, "csv_blocks", fresh=True)
    block_maps(lines).write.parquet(f"{stored}/maps")
    maps = spark.read.parquet(f"{stored}/maps")
    inside_blocks(maps).write.parquet(f"{stored}/inside")
    rows = records(lines, spark.read.parquet(f"{stored}/inside"))
    first = maps.filter((F.col("_block") == 0) & F.col("head").isNotNull()).select("_file", "head")
    texts = [r["head"] for r in first.select("head").distinct().orderBy("head").collect()] if header is None else []
    heads = [(0, [h.lower().strip() for h in header])] if header is not None else list(enumerate(map(names_of, texts)))
    if not heads:
        raise FileNotFoundError(f"no CSV file with a header under {path}")
    if len(heads) == 1:
        return parsed(rows.withColumn("_head", F.lit(0)), heads)
    numbers = spark.createDataFrame([(t, i) for i, t in enumerate(texts)], "head string, _head int")
    return parsed(rows.join(first.join(numbers, "head").select("_file", "_head"), "_file"), heads)
