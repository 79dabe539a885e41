"""Keyed merges: last-wins, first-wins, upsert, additive.

Spark has no insertion order, so "first" and "last" always take an explicit
order: a column, a list of columns, or a struct whose fields are compared
left to right (e.g. ``(batch_id, partition, offset)`` of delivery, or
``(file, block start, row id)`` of a file scan).  The order must be total
within a key; ties are resolved arbitrarily.

Skew: every dedupe is a ``groupBy`` with ``max_by`` / ``min_by``, so Spark
aggregates partially before the shuffle and a key holding a third of all rows
ships one row per map task, not its whole group.  The ``row_number`` window
form ranks within slices of a key first, so that a hot key is spread as well.

No operator chooses a join strategy: which side is broadcast is left to the
optimizer, which re-plans by measured sizes (AQE).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slices of a key that the window form ranks one by one.
WINDOW_SLICES = 64

Order = str | Column | Sequence[str | Column]


def order_key(order: Order) -> Column:
    """One comparable Column from an order spec (struct compares field-wise)."""
    if isinstance(order, Column):
        return order
    if isinstance(order, str):
        return F.col(order)
    cols = [F.col(c) if isinstance(c, str) else c for c in order]
    return cols[0] if len(cols) == 1 else F.struct(*[c.alias(f"_{i}") for i, c in enumerate(cols)])


def _pick(df: DataFrame, keys: Sequence[str], order: Order, pick) -> DataFrame:
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    row = F.struct(*[F.col(c) for c in rest])
    agg = df.groupBy(*keys).agg(pick(row, order_key(order)).alias("_row"))
    return agg.select(*keys, *[F.col("_row")[c].alias(c) for c in rest])


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Order, method: str = "agg") -> DataFrame:
    """Keep the last row per key (largest ``order``), as a replacing table does.

    ``method="agg"`` (default): ``groupBy(keys).agg(max_by(struct(*), order))``,
    partial + final aggregation.  ``method="window"``: ``row_number()`` within
    slices of a key (by a hash of the order), then over the slices' winners.
    """
    if method == "window":
        out = df.withColumn("_slice", F.pmod(F.xxhash64(order_key(order)), F.lit(WINDOW_SLICES)))
        for part in ([*keys, "_slice"], list(keys)):
            w = Window.partitionBy(*part).orderBy(order_key(order).desc())
            out = out.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
        return out.drop("_slice")
    return _pick(df, keys, order, F.max_by)


def first_by_key(df: DataFrame, keys: Sequence[str], order: Order) -> DataFrame:
    """Keep the first row per key (smallest ``order``)."""
    return _pick(df, keys, order, F.min_by)


VERSION = "_version"


def upsert(target: DataFrame, source: DataFrame, pk: str | Sequence[str], order: Order | None = None,
           version: int | None = None) -> DataFrame:
    """Insert new keys, update existing ones: ``INSERT .. ON CONFLICT DO UPDATE``.

    Only the columns present in ``source`` are updated; target columns absent
    from it keep their values (NULL for new rows).  Several source rows with
    one key: the last by ``order`` wins (default: no order -> the rows must be
    unique per key).

    One full outer join of the target and the deduplicated batch: each is read
    once.

    ``version``: when the target has a ``_version`` column, inserted and
    updated rows get this merge version (untouched rows keep theirs), so an
    export can follow changes (``sources.cursor.scan_changes``) instead of
    ids only.
    """
    keys = [pk] if isinstance(pk, str) else list(pk)
    src = latest_by_key(source, keys, order) if order is not None else source
    order_cols = [order] if isinstance(order, str) else \
        [c for c in (order or []) if isinstance(c, str)] if not isinstance(order, Column) else []
    src = src.drop(*[c for c in order_cols if c not in target.columns])
    if version is not None and VERSION in target.columns:
        src = src.withColumn(VERSION, F.lit(version).cast(target.schema[VERSION].dataType))
    missing = [c for c in src.columns if c not in target.columns]
    if missing:
        raise ValueError(f"source columns not in target: {missing}")
    supplied = [c for c in src.columns if c not in keys]
    s = src.select(*keys, *[F.col(c).alias(f"_s_{c}") for c in supplied], F.lit(True).alias("_s_hit"))

    out = []
    for c in target.columns:
        if c in supplied:
            out.append(F.when(F.col("_s_hit"), F.col(f"_s_{c}")).otherwise(F.col(c))
                       .cast(target.schema[c].dataType).alias(c))
        else:
            out.append(F.col(c))
    return target.join(s, keys, "full_outer").select(*out)


def insert_if_absent(target_keys: DataFrame, source: DataFrame, keys: Sequence[str],
                     order: Order | None = None) -> DataFrame:
    """Rows of ``source`` whose key is not stored yet (a unique index that
    skips duplicates): first by ``order`` wins inside the batch, stored rows
    win over the batch.

    ``target_keys`` needs only the key columns (pruned from the store).
    """
    keys = list(keys)
    batch = first_by_key(source, keys, order) if order is not None else source.dropDuplicates(keys)
    return batch.join(target_keys.select(*keys), keys, "left_anti")


def merge_additive(target: DataFrame | None, delta: DataFrame, keys: Sequence[str],
                   measures: Sequence[str], attrs: Sequence[str] = (), version: str | None = None,
                   drop_zero: bool = True) -> DataFrame:
    """Sum measures per key over stored rows and new delta rows.

    ``attrs`` (non-key text such as a product name) keep the value of the row
    with the largest ``version`` (or the largest value without one).  Keys
    whose measures are all zero are dropped, as a summing table does.
    """
    keys, measures, attrs = list(keys), list(measures), list(attrs)
    both = delta if target is None else target.unionByName(delta, allowMissingColumns=True)
    aggs = [F.sum(m).cast(delta.schema[m].dataType).alias(m) for m in measures]
    for a in attrs:
        aggs.append((F.max_by(a, version) if version else F.max(a)).alias(a))
    out = both.groupBy(*keys).agg(*aggs)
    if drop_zero:
        nz = None
        for m in measures:
            cond = F.coalesce(F.col(m) != 0, F.lit(False))
            nz = cond if nz is None else nz | cond
        out = out.filter(nz)
    return out


SIGN = "_sign"


def signed_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What a batch of new rows changes, as signed rows: the stored row of each
    of their keys with ``_sign`` -1, the new one with 1.  Both sides have one
    row per key; rows that stay as they are cancel out and are left out."""
    keys = list(keys)
    rest = [c for c in new.columns if c not in keys]
    before = old.select(*keys, F.struct(*rest).alias("_old"), F.lit(True).alias("_had"))
    both = new.select(*keys, F.struct(*rest).alias("_new")).join(before, keys, "left")
    sides = F.array(F.struct(F.col("_new").alias("row"), F.lit(1).alias(SIGN)), F.struct(F.col("_old").alias("row"), F.lit(-1).alias(SIGN)))
    signed = F.when(F.col("_had") & F.col("_old").eqNullSafe(F.col("_new")), F.slice(sides, 1, 0)) \
        .when(F.col("_had"), sides).otherwise(F.slice(sides, 1, 1))
    return both.select(*keys, F.explode(signed).alias("_s")).select(*keys, "_s.row.*", f"_s.{SIGN}")


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct (partial aggregation before the shuffle)."""
    return df.distinct()
