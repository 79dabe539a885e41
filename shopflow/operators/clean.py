"""Cleaning of the master tables (users, products, orders) -> (rows, rejects).

Input: all-string columns (from ``sources.files.scan_csv`` or any string
frame) plus an optional ingest position ``_pos``.  Output rows are typed per
``schemas.MASTER_SCHEMAS`` restricted to the expected columns present; every
dropped row goes to ``rejects`` with its reason instead of vanishing.

Rules (one pass, no per-row Python):

* all-NULL rows and rows with a NULL key are dropped (C2, C3);
* users: email trimmed + lower-cased, NULL email rejected (the source turns a
  NULL into the text 'nan' and keeps it; we do not); signup date parsed with
  coercion to NULL; device mapped, unknown -> NULL (row kept); loyalty tier
  mapped, unknown -> rejected;
* products: price / inventory / popularity parsed with coercion to NULL;
  category mapped, unknown -> rejected;
* orders: ``timestamp`` renamed ``created_at`` (C5); created_at parsed, total
  parsed; status and payment method mapped; any of the three NULL -> rejected;
* full-row duplicates collapse to one row (E10), keeping the last position.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopflow.functions.columns import email_clean, enum_map, number_text, parse_timestamp
from shopflow.schemas import (CATEGORIES, DEVICES, EXPECTED_COLUMNS, LOYALTY_TIERS, MASTER_SCHEMAS,
                              ORDER_STATUSES, PAYMENT_METHODS, PRIMARY_KEYS)

_TYPED = {
    "users": {"email": lambda c: email_clean(c), "signup_date": lambda c: parse_timestamp(c),
              "device": lambda c: enum_map(c, DEVICES), "loyalty_tier": lambda c: enum_map(c, LOYALTY_TIERS)},
    "products": {"price": lambda c: number_text(c, "decimal(10,2)"),
                 "inventory": lambda c: number_text(c, "int"),
                 "popularity_score": lambda c: number_text(c, "double"),
                 "category": lambda c: enum_map(c, CATEGORIES)},
    "orders": {"created_at": lambda c: parse_timestamp(c), "total": lambda c: number_text(c, "decimal(10,2)"),
               "status": lambda c: enum_map(c, ORDER_STATUSES),
               "payment_method": lambda c: enum_map(c, PAYMENT_METHODS)},
}
_REQUIRED = {"users": ["email", "loyalty_tier"], "products": ["category"],
             "orders": ["created_at", "status", "payment_method"]}


def normalise_header(df: DataFrame) -> DataFrame:
    """Lower-case and strip column names."""
    return df.toDF(*[c if c.startswith("_") else c.lower().strip() for c in df.columns])


def check_table(df: DataFrame, table: str) -> DataFrame:
    """All rows of one master table, typed, with ``reason`` (NULL: good) and, for bad ones, ``raw``.  Rows that the scan
    has rejected (``_reject``, ``_raw``) keep its reason."""
    df = normalise_header(df)
    if table == "orders" and "timestamp" in df.columns and "created_at" not in df.columns:
        df = df.withColumnRenamed("timestamp", "created_at")
    data_cols = [c for c in df.columns if not c.startswith("_") and c != "source_file"]
    meta = [c for c in df.columns if c not in data_cols and c not in ("_reject", "_raw")]
    scan = [F.col(c) if c in df.columns else F.lit(None).cast("string").alias(c) for c in ("_reject", "_raw")]
    pk = PRIMARY_KEYS[table]
    schema = MASTER_SCHEMAS[table]

    all_null = F.coalesce(*[F.col(c) for c in data_cols]).isNull() if data_cols else F.lit(True)
    typed = []
    for c in data_cols:
        fn = _TYPED[table].get(c)
        expr = fn(F.col(c)) if fn else F.col(c)
        if c in schema.fieldNames():
            expr = expr.cast(schema[c].dataType)
        typed.append(expr.alias(c))
    t = df.select(*typed, *[F.col(m) for m in meta], *scan, all_null.alias("_all_null"))

    checks: list[tuple[Column, str | Column]] = [(F.col("_reject").isNotNull(), F.col("_reject")), (F.col("_all_null"), "all fields empty")]
    if pk in data_cols:
        checks.append((F.col(pk).isNull(), f"missing {pk}"))
    for c in _REQUIRED[table]:
        if c in data_cols:
            checks.append((F.col(c).isNull(), f"invalid or missing {c}"))
    reason = None
    for cond, msg in checks:
        msg = F.lit(msg) if isinstance(msg, str) else msg
        reason = F.when(cond, msg) if reason is None else reason.when(cond, msg)
    # The row sequence is non-deterministic: filters on ``reason`` then stay
    # above this projection instead of being pushed below it, where they would
    # re-evaluate every parse of the row (see ``operators.events``).
    t = t.withColumn("reason", reason).withColumn("_seq", F.monotonically_increasing_id())
    raw = F.when(F.col("reason").isNotNull(), F.coalesce("_raw", F.to_json(F.struct(*data_cols)))).alias("raw")
    expected = [c for c in EXPECTED_COLUMNS[table] if c in data_cols]
    return t.filter(F.col("_seq") >= 0).select(*expected, *meta, "reason", raw)


def clean_table(df: DataFrame, table: str) -> tuple[DataFrame, DataFrame]:
    """Clean one master table -> (typed rows, rejects(reason, ...))."""
    t = check_table(df, table)
    expected = [c for c in EXPECTED_COLUMNS[table] if c in t.columns]
    good = t.filter(F.col("reason").isNull())
    if "_pos" in good.columns:
        rows = good.groupBy(*expected).agg(F.max("_pos").alias("_pos"))
    else:
        rows = good.select(*expected).distinct()
    meta = [c for c in t.columns if c not in (*expected, "_pos", "reason", "raw")]
    rejects = t.filter(F.col("reason").isNotNull()).select(*meta, "reason", "raw", *(["_pos"] if "_pos" in t.columns else []))
    return rows, rejects


def referential_check(orders: DataFrame, users: DataFrame, fk: str = "user_id") -> tuple[DataFrame, DataFrame]:
    """Orders whose user exists (or is NULL) vs orphans (quarantined).

    Both are joins against the user keys only (column-pruned); Catalyst
    broadcasts the key side when its size allows.
    """
    keys = users.select(F.col("user_id").alias(fk)).distinct()
    known = orders.join(keys, fk, "left_semi")
    kept = known.unionByName(orders.filter(F.col(fk).isNull()))
    orphans = orders.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")
    return kept, orphans


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys occurring more than once (e.g. e-mail addresses)."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            .filter(F.col("n") > 1))


_DOMAINS = {"users": {"loyalty_tier": LOYALTY_TIERS, "device": DEVICES}, "products": {"category": CATEGORIES},
            "orders": {"status": ORDER_STATUSES, "payment_method": PAYMENT_METHODS}}


def findings(df: DataFrame, table: str) -> DataFrame:
    """What breaks the declared constraints of a raw table, counted:
    (table_name, column_name, finding, n).  Domains are those of the enums,
    keys must be there and unique."""
    pk = PRIMARY_KEYS[table]
    checks = [(pk, "missing", F.col(pk).isNull())]
    checks += [(c, "missing", F.col(c).isNull()) for c in _REQUIRED[table] if c in df.columns]
    checks += [(c, "outside domain", F.col(c).isNotNull() & ~F.lower(F.trim(c)).isin(*known))
               for c, known in _DOMAINS[table].items() if c in df.columns]
    counted = df.agg(*[F.count_if(cond).alias(f"_{i}") for i, (_, _, cond) in enumerate(checks)])
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(what).alias("finding"), F.col(f"_{i}").alias("n"))
                               for i, (c, what, _) in enumerate(checks)]))
    repeated = duplicate_keys(df, pk).agg(F.count(F.lit(1)).alias("n")).select(F.lit(pk).alias("column_name"), F.lit("repeated").alias("finding"), "n")
    return (counted.select(each.alias("f")).select("f.*").unionByName(repeated).filter("n > 0")
            .select(F.lit(table).alias("table_name"), "column_name", "finding", "n"))
