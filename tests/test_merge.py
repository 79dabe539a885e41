"""Keyed merges: last-wins, first-wins, upsert, additive."""

from hypothesis import given, settings, strategies as st

from shopflow.operators import merge


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_latest_by_key_both_forms(spark):
    df = spark.createDataFrame([("a", 1, "x"), ("a", 3, "z"), ("a", 2, "y"), ("b", 1, "q")], "k string, pos int, v string")
    for method in ("agg", "window"):
        out = merge.latest_by_key(df, ["k"], "pos", method=method)
        assert rows(out, "k", "v") == [("a", "z"), ("b", "q")]


def test_first_by_key_struct_order(spark):
    df = spark.createDataFrame([("a", "f2", 0, "x"), ("a", "f1", 9, "y"), ("a", "f1", 3, "z")],
                               "k string, file string, row int, v string")
    out = merge.first_by_key(df, ["k"], ["file", "row"])
    assert rows(out, "k", "v") == [("a", "z")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 5), st.integers(0, 1000)), min_size=1, max_size=40, unique_by=lambda t: t[1]))
def test_latest_by_key_invariant_under_repartitioning(spark, data):
    df = spark.createDataFrame(data, "k int, pos int")
    a = rows(merge.latest_by_key(df.withColumn("v", df.pos * 2), ["k"], "pos"), "k", "v")
    b = rows(merge.latest_by_key(df.repartition(3).withColumn("v", df.pos * 2), ["k"], "pos"), "k", "v")
    expect = sorted({k: max(p for kk, p in data if kk == k) * 2 for k, _ in data}.items())
    assert a == b == expect


def test_upsert_updates_supplied_columns_only(spark):
    target = spark.createDataFrame([("p1", "old", 1.0, "Home"), ("p2", "keep", 2.0, "Beauty")],
                                   "product_id string, name string, price double, category string")
    source = spark.createDataFrame([("p1", 9.0, 1), ("p1", 10.0, 2), ("p3", 3.0, 1)],
                                   "product_id string, price double, pos int")
    out = merge.upsert(target, source, "product_id", order="pos")
    assert rows(out, "product_id", "name", "price", "category") == [
        ("p1", "old", 10.0, "Home"), ("p2", "keep", 2.0, "Beauty"), ("p3", None, 3.0, None)]


def test_insert_if_absent_first_wins_and_skips_stored(spark):
    stored = spark.createDataFrame([("t1", "s1")], "ts string, session string")
    batch = spark.createDataFrame([("t1", "s1", "dup", 0), ("t2", "s1", "first", 1), ("t2", "s1", "second", 2),
                                   ("t2", "s2", "other", 3)], "ts string, session string, v string, pos int")
    out = merge.insert_if_absent(stored, batch, ["ts", "session"], "pos")
    assert rows(out, "ts", "session", "v") == [("t2", "s1", "first"), ("t2", "s2", "other")]


def test_merge_additive_split_equals_whole(spark):
    d1 = spark.createDataFrame([("2025-01-01", 1, 0), ("2025-01-02", 2, 1)], "d string, a long, b long")
    d2 = spark.createDataFrame([("2025-01-01", 3, 4), ("2025-01-03", 0, 0)], "d string, a long, b long")
    first = merge.merge_additive(None, d1, ["d"], ["a", "b"])
    both = merge.merge_additive(first, d2, ["d"], ["a", "b"])
    whole = merge.merge_additive(None, d1.unionByName(d2), ["d"], ["a", "b"])
    assert rows(both, "d", "a", "b") == rows(whole, "d", "a", "b") == [("2025-01-01", 4, 4), ("2025-01-02", 2, 1)]
