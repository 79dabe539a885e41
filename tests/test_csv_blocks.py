"""CSV files cut into many blocks: the same rows as one task reads, whatever the quoted fields hold."""

import random

import pytest
from pyspark.sql import functions as F

from shopflow.sources import csv_blocks, files


def one_task(spark, path, names):
    """Spark's own multi-line reader, one task a file."""
    schema = ", ".join(f"{n} string" for n in [*names, "surplus"])
    df = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').option("nullValue", "\u0000").option("emptyValue", "").csv(path)
    return df.filter("surplus is null").drop("surplus")


def write(path, rows, end="\n"):
    def field(v):
        return '"' + v.replace('"', '""') + '"' if any(c in v for c in ',"\n\r') else v
    with open(path, "w", newline="") as f:
        f.write("".join(",".join(map(field, r)) + end for r in rows))


def random_rows(seed, n):
    r = random.Random(seed)
    text = lambda: "".join(r.choice(["a", "b", ",", '"', "\n", "é", " x ", "\n\n", '""', "word "]) for _ in range(r.randrange(1, 12))).strip() or "z"
    return [(f"k{i}", text() if r.random() < 0.6 else f"plain {i}", text() if r.random() < 0.3 else "y") for i in range(n)]


@pytest.fixture()
def small_blocks(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700b")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_many_blocks_equal_one_task(spark, tmp_dir, small_blocks, end):
    rows = random_rows(1, 400)
    rows[50] = ("k50", "long\n" * 700, "over many blocks")
    rows[51] = ("k51", '"' * 900, "quotes only")
    write(f"{tmp_dir}/a.csv", [("id", "note", "other"), *rows], end)
    lines = csv_blocks.csv_lines(spark, tmp_dir)
    assert lines.rdd.getNumPartitions() > 15
    got, rejects = files.scan_csv(spark, tmp_dir)
    want = one_task(spark, tmp_dir, ["id", "note", "other"])
    assert rejects.count() == 0
    collected = sorted(tuple(r) for r in got.select("id", "note", "other").collect())
    assert collected == sorted(tuple(r) for r in want.collect()) and len(collected) == 400
    by_place = [r["id"] for r in got.orderBy("_pos").select("id").collect()]
    assert by_place == [r[0] for r in rows]


def test_blocks_inside_quotes_are_found(spark, tmp_dir, small_blocks):
    write(f"{tmp_dir}/a.csv", [("id", "note"), ("a", "x\n" * 2000), ("b", "y")])
    maps = csv_blocks.block_maps(csv_blocks.csv_lines(spark, tmp_dir))
    inside = {r["_block"] for r in csv_blocks.inside_blocks(maps).collect()}
    blocks = sorted(r["_block"] for r in maps.collect())
    assert len(blocks) >= 5 and inside == set(blocks[1:])
    got, _ = files.scan_csv(spark, tmp_dir)
    assert sorted((r["id"], len(r["note"])) for r in got.collect()) == [("a", 4000), ("b", 1)]


def test_headers_surplus_blanks_and_short_lines(spark, tmp_dir, small_blocks):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("Id, Name\n1,one\n\n2\n3,three,surplus\n" + "".join(f"{i},n{i}\n" for i in range(10, 300)))
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("name,id,extra\nn,9,NA\n5' pipe \"x\",8,e")
    with open(f"{tmp_dir}/empty.csv", "w") as f:
        f.write("")
    got, rejects = files.scan_csv(spark, tmp_dir)
    rows = {r["id"]: (r["name"], r["extra"]) for r in got.collect()}
    assert rows["1"] == ("one", None) and rows["2"] == (None, None) and rows["9"] == ("n", None) and rows["8"] == ("5' pipe \"x\"", "e") and len(rows) == 294
    assert [(r["source_file"], r["raw"]) for r in rejects.collect()] == [("a.csv", '{"id":"3","name":"three"}')]


@pytest.mark.parametrize("line,outside,inside", [
    ("a,b", False, True), ('a,"b', True, False), ('a,"b"', False, False), ('"a ""b"" c"', False, False), ('x"', False, False), ('"', True, False), ('a,5" pipe', False, False),
    ('","', False, True), ('""', False, True), ('",""', True, False), ("", False, True)])
def test_states_of_a_line(line, outside, inside):
    assert (csv_blocks.ends_inside(line, False), csv_blocks.ends_inside(line, True)) == (outside, inside)
