"""Property tests: the Column casts against Python's own int() / float() /
bool rules (the source system's semantics), and cursor scans."""

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from shopflow.functions import columns as fc

ALPHABET = "0123456789 +-.eEx\t"


def py_int(s):
    if "_" in s:  # underscores are rejected on purpose (documented divergence)
        return None
    try:
        v = int(s)
    except ValueError:
        return None
    return v if -2 ** 31 <= v < 2 ** 31 else None


def py_float(s):
    if "_" in s:
        return None
    try:
        return float(s)
    except ValueError:
        return None


@settings(max_examples=3, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=8), min_size=20, max_size=120))
def test_int_and_float_text_match_python(spark, strings):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(strings)], "i int, s string")
    got = {r["i"]: (r["a"], r["b"]) for r in
           df.select("i", fc.int_text("s").alias("a"), fc.float_text("s").alias("b")).collect()}
    for i, s in enumerate(strings):
        assert got[i][0] == py_int(s), (s, got[i][0])
        assert got[i][1] == py_float(s), (s, got[i][1])


def test_bool_text_and_blank(spark):
    vals = ["true", " YES ", "y", "1", "false", "No", "n", "0", "1.0", "maybe", "", None, " NaN ", "none", "  "]
    df = spark.createDataFrame([(v,) for v in vals], "s string")
    got = [(r["b"], r["z"]) for r in df.select(fc.bool_text("s").alias("b"), fc.is_blank("s").alias("z")).collect()]
    assert [g[0] for g in got] == [True, True, True, True, False, False, False, False, None, None, None, None,
                                   None, None, None]
    assert [g[1] for g in got] == [False] * 10 + [True, True, True, True, False]


def test_scan_since_orders_numerically(spark):
    from shopflow.sources.cursor import scan_since
    df = spark.createDataFrame([("u9",), ("u10",), ("u2",), ("ux",)], "user_id string")
    assert sorted(r["user_id"] for r in scan_since(df, "user_id", 5).collect()) == ["u10", "u9"]
    assert scan_since(df, "user_id", None).count() == 3  # a key without a number is in cursor_rejects


def test_cursor_table_round_trip(spark, tmp_dir):
    from shopflow.sinks import state
    from shopflow.sources.cursor import scan_since
    path = f"{tmp_dir}/cursors"
    df = spark.createDataFrame([(f"o{i}",) for i in range(1, 13)], "order_id string")
    first = scan_since(df.filter(F.col("order_id").isin("o1", "o2", "o3")), "order_id",
                       state.read_cursor(spark, path, "orders"))
    assert first.count() == 3
    state.advance_cursor(spark, path, "orders", first, "id_num")
    second = scan_since(df, "order_id", state.read_cursor(spark, path, "orders"))
    assert sorted(r["id_num"] for r in second.collect()) == list(range(4, 13))
