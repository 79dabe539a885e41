"""Mixing sources to target weights: tokens per source, repetition rates, then whole copies and one hash-seeded draw.

A source's target is its weighted share of the mix, at most `ceiling` times its own size; what it can't take is shared
out again by weight.  Its rate is target / size.  Every document is taken floor(rate) times, and once more if a hash of
its doc_id, its text, its source and, among rows that agree in all, its number, read as a number in [0, 1), is below the fraction;
so reruns agree, and rows without id or of one id are drawn one by one.

Scale.  Sizes are summed per source with partial aggregation; sources are ranked by a range partitioning, not in one
task; the levels of the shares are found by a few aggregates over the table of sources.  Rows that share id, text and source are
found by counting fingerprints; only they are shuffled, in slices, to be numbered.

Defined cases.  Null or blank text has size 0.  A null source is a source of its own, ranked last.  A source of size 0
has target 0, and its documents are not taken.  Which of several equal rows is taken is open where other columns differ.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from .common import drop_saved, saved

SEED = "mix-1"
#: Slices in which rows that share id, text and source are numbered.
SLICES = 64


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (5, 2, 1), budget: float = 1.5, ceiling: float = 2.0) -> DataFrame:
    """(source, source_size, target) of each source, from rows (source, size)."""
    src = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    placed = saved(src.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id())
                   .withColumn("place", F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last())) - 1), "mix_sources")
    before, starts = 0, []
    for r in sorted(placed.groupBy("part").count().collect()):
        starts.append((r["part"], before))
        before += r["count"]
    starts = sized.sparkSession.createDataFrame(starts or [(0, 0)], "part int, start long")
    ranked = saved(placed.join(F.broadcast(starts), "part").select(
        "source", "source_size",
        F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("start") + F.col("place")) % len(weights) + 1).cast("int")).alias("weight")), "mix_weights")
    cap = F.col("source_size") * F.lit(float(ceiling))
    total = float(budget) * (ranked.agg(F.sum("source_size")).first()[0] or 0)
    level, n_full = 0.0, -1
    while True:  # the level only rises, and a source that is full stays so
        full = cap < F.col("weight") * level
        r = ranked.agg(F.sum(F.when(full, cap).otherwise(0.0)), F.sum(F.when(full, 0.0).otherwise(F.col("weight"))), F.count(F.when(full, 1))).first()
        if r[2] == n_full or not r[1]:
            break
        n_full, level = r[2], (total - r[0]) / r[1]
    drop_saved(placed)
    share = F.col("weight") * F.lit(level)
    return ranked.select("source", "source_size", F.when(cap < share, cap).otherwise(share).alias("target"))


def numbered(docs: DataFrame, keys: list[str]) -> DataFrame:
    """docs with the long column __nth: 0, 1, ... among the rows that agree in all keys.

    Slices and places follow a row number given at the scan, so that every evaluation of docs deals them alike.
    """
    docs = docs.withColumn("__at", F.monotonically_increasing_id())
    again = docs.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
    again = saved(again.select(*[F.col(c).alias(f"__of_{c}") for c in keys], F.lit(True).alias("__again")), "mix_again")
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in keys])
    rows = docs.join(again, same, "left").drop(*[f"__of_{c}" for c in keys])
    single = rows.filter("__again is null").withColumn("__nth", F.lit(0).cast("long"))
    many = rows.filter("__again").withColumn("__slice", F.pmod("__at", F.lit(SLICES)).cast("int"))
    before = many.groupBy(*keys, "__slice").agg(F.count("*").alias("__n"))
    before = before.withColumn("__before", F.coalesce(F.sum("__n").over(Window.partitionBy(*keys).orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    before = before.select(*[F.col(c).alias(f"__of_{c}") for c in keys], F.col("__slice").alias("__of_slice"), "__before")
    place = F.row_number().over(Window.partitionBy(*keys, "__slice").orderBy("__at"))
    many = many.withColumn("__place", place).join(before, same & (F.col("__slice") == F.col("__of_slice"))) \
        .withColumn("__nth", F.col("__before") + F.col("__place") - 1)
    single = single.drop("__again", "__at")
    return single.unionByName(many.select(*single.columns))


def with_copies(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs with a struct column __mix: size, source_size, target, copies, taken."""
    sized = saved(docs.select("source", word_count("text").alias("size")).groupBy("source").agg(F.sum("size").alias("size")), "mix_sizes")
    targets = source_targets(sized, **options).select(F.struct("*").alias("__source"))
    rows = numbered(docs.withColumns({"__id": F.col(id_col).cast("string"), "__digest": F.md5(F.coalesce("text", F.lit("")).cast("binary"))}), ["__id", "__digest", "source"])
    rate = F.when(F.col("__source.source_size") > 0, F.col("__source.target") / F.col("__source.source_size")).otherwise(0.0)
    key = F.concat_ws(":", F.lit(SEED), F.coalesce("__id", F.lit("null")), F.col("__digest"), F.col("__nth").cast("string"), F.coalesce("source", F.lit("null")))
    draw = F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / F.lit(float(16 ** 13))
    out = rows.withColumn("__size", word_count("text")).join(targets, F.col("source").eqNullSafe(F.col("__source.source")), "left") \
        .withColumn("__copies", (F.floor(rate) + (draw < rate - F.floor(rate)).cast("long")).cast("long"))
    return out.withColumn("__mix", F.struct(
        F.col("__size").alias("size"), F.col("__source.source_size").alias("source_size"), F.col("__source.target").alias("target"),
        F.col("__copies").alias("copies"), (F.col("__copies") * F.col("__size")).alias("taken"))).drop("__source", "__size", "__copies", "__id", "__digest", "__nth")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, numbered by __copy from 1."""
    return with_copies(docs, **options).filter("__mix.copies > 0") \
        .withColumn("__copy", F.explode(F.expr("sequence(1L, __mix.copies)"))).drop("__mix")


#: The targets in closed form: with sources by how soon they are full, the level is the highest that filling a prefix of them gives.
MIX_SQL = f"""
with d as (select doc_id, source, md5(coalesce(text, '')) as digest, row_number() over (partition by doc_id, md5(coalesce(text, '')), source) - 1 as nth, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::bigint as size from documents),
s as (select source, sum(size)::bigint as source_size from d group by source),
w as (select *, [5.0, 2.0, 1.0][((row_number() over (order by source nulls last) - 1) % 3 + 1)::int]::double as weight from s),
o as (select *, sum(2.0::double * source_size) over f - 2.0::double * source_size as caps, sum(weight) over () - sum(weight) over f + weight as open,
             1.5::double * (sum(source_size) over ())::double as total
      from w window f as (order by source_size / weight, source rows unbounded preceding)),
l as (select coalesce(max((total - caps) / open), 0) as level from o),
t as (select source, source_size, least(2.0::double * source_size, weight * level) as target from o, l),
r as (select d.doc_id, d.size, t.source_size, t.target, case when t.source_size > 0 then t.target / t.source_size else 0 end as rate,
             ('0x' || substr(md5('{SEED}:' || coalesce(d.doc_id::varchar, 'null') || ':' || digest || ':' || nth::varchar || ':' || coalesce(d.source, 'null')), 1, 13))::bigint::double / {16 ** 13}.0::double as draw
      from d join t on d.source is not distinct from t.source)
select doc_id, size, source_size, target, ((floor(rate) + (draw < rate - floor(rate))::int) * size)::bigint as taken from r
"""
