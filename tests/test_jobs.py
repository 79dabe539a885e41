"""Replays, late products, partitioned versions, odd CSV files, broken files: what must not change or get lost."""

import json
import os
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from conftest import SF
from shopflow.operators import clean
from shopflow.plans import load, registry
from shopflow.schemas import MASTER_SCHEMAS
from shopflow.sinks import keyed, state, tables
from shopflow.sources import driver_tables as dt
from shopflow.sources import files
from shopflow.sources.cursor import cursor_rejects, scan_since
from shopflow.streaming import drivers

KEYS = ["event_type", "event_date", "timestamp", "session_id"]


def _line(session, second, order="o1"):
    return json.dumps({"timestamp": f"2025-01-02T10:00:{second:02d}Z", "user_id": "u1", "event_type": "order_complete", "device": "mobile",
                       "session_id": session, "order_id": order})


def _batch(spark, lines):
    return spark.createDataFrame([(v, f, f"file:/x/{f}", 0, None) for v, f in lines],
                                 "value string, source_file string, _file string, _block long, _size long").coalesce(1)


def test_every_batch_run_twice_leaves_the_same_store_rejects_and_ledger(spark, tmp_dir):
    batches = [[(_line("s1", 1), "a.json"), ("{bad", "a.json"), ("", "a.json"), ("nothing valid", "b.json")],
               [(_line("s1", 1, "again"), "c.json"), (_line("s2", 2), "c.json")]]

    def run(root, times):
        for i, lines in enumerate(batches):
            for _ in range(times):
                drivers.ingest_batch(spark, _batch(spark, lines), i, f"{root}/store", f"{root}/ledger", KEYS)
        store = sorted((r["session_id"], r["event_data"]["order_id"], r["batch_id"]) for r in spark.read.parquet(f"{root}/store").collect())
        rejects = sorted((r["source_file"], r["line"], r["reason"]) for r in spark.read.parquet(f"{root}/store_rejects").collect())
        ledger = sorted((r["file_name"], r["records_inserted"]) for r in state.read_ledger(spark, f"{root}/ledger").collect())
        return store, rejects, ledger

    once, twice = run(f"{tmp_dir}/1", 1), run(f"{tmp_dir}/2", 2)
    assert once == twice
    assert once == ([("s1", "o1", 0), ("s2", "o1", 1)], [("a.json", 2, "Invalid JSON"), ("b.json", 1, "Invalid JSON")],
                    [("a.json", 1), ("b.json", 0), ("c.json", 1)])


def test_late_product_rename_and_no_attributes(spark, tmp_dir):
    schema = "product_id string, name string, category string, price decimal(10,2)"
    table = {"now": [("p1", "old", "Home", Decimal(2)), ("p3", None, None, None)]}
    products = lambda: spark.createDataFrame(table["now"], schema)

    def carts(rows):
        df = spark.createDataFrame(rows, "product_id string, quantity int")
        df.coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
        stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/in")
        drivers.run(lambda: drivers.top_products_stream(spark, stream, products, f"{tmp_dir}/out", f"{tmp_dir}/ckpt"))

    carts([("p1", 1), ("p2", 5), ("p3", 7)])
    carts([("p2", 1)])  # still unknown
    table["now"] = [("p1", "new", "Home", Decimal(2)), ("p2", "late", None, Decimal(3)), ("p3", None, None, None)]
    carts([("p1", 1)])
    got = sorted(tuple(r) for r in drivers.read_top_products(spark, f"{tmp_dir}/out", products()).select(
        "product_id", "product_name", "category", "total_quantity", "add_to_cart_count", "estimated_revenue").collect())
    assert got == [("p1", "new", "Home", 2, 2, 4.0), ("p2", "late", "Unknown", 6, 2, 18.0), ("p3", None, "Unknown", 7, 1, 0.0)]


def test_replayed_batch_that_becomes_empty_drops_its_old_rows(spark, tmp_dir):
    """A product arrives between two attempts at a batch: its carts are counted once, and pend no more."""
    schema = "product_id string, name string, category string, price decimal(10,2)"
    table = {"now": []}
    products = lambda: spark.createDataFrame(table["now"], schema)
    batches = [spark.createDataFrame(rows, "product_id string, quantity int") for rows in ([("p1", 3)], [("p1", 4), ("p2", 1)], [("p2", 2)])]
    out = f"{tmp_dir}/out"
    drivers.top_products_batch(batches[0], 0, products, out)
    table["now"] = [("p1", "one", "Home", Decimal(2))]
    drivers.top_products_batch(batches[0], 0, products, out)  # the first attempt was not committed
    for i in (1, 1, 2):
        drivers.top_products_batch(batches[i], i, products, out)
    got = sorted(tuple(r) for r in drivers.read_top_products(spark, out).select("product_id", "total_quantity", "add_to_cart_count").collect())
    assert got == [("p1", 7, 2)]
    pending = [(r["product_id"], r["total_quantity"]) for r in spark.read.parquet(f"{out}_pending").filter("batch_id = 2").collect()]
    assert pending == [("p2", 3)]


def test_empty_rewrite_with_outer_partitions(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "p string, v int")
    drivers.write_batch(df, f"{tmp_dir}/t", 0, ("p",))
    drivers.write_batch(df, f"{tmp_dir}/t", 1, ("p",))
    drivers.write_batch(df.filter("p = 'a'"), f"{tmp_dir}/t", 0, ("p",))
    drivers.write_batch(df.limit(0), f"{tmp_dir}/t", 1, ("p",))
    assert [(r["p"], r["v"], r["batch_id"]) for r in spark.read.parquet(f"{tmp_dir}/t").collect()] == [("a", 1, 0)]


def test_signed_reports_follow_updates_and_replays(spark, tmp_dir):
    """Orders change status, day and user over batches, each batch run twice; the report is that of the last rows."""
    schema = "order_id string, user_id string, created_at timestamp, total decimal(10,2), status string, _v int"
    ts = lambda day: datetime(2025, 1, day)
    row = lambda o, u, day, total, status, v=0: (o, u, ts(day), Decimal(total), status, v)
    batches = [[row("o1", "u1", 1, 10, "completed"), row("o2", "u1", 1, 5, "completed"), row("o3", "u2", 2, 7, None)],
               [row("o1", "u1", 1, 12, "completed"), row("o3", "u2", 2, 7, "completed", 0), row("o3", "u2", 2, 9, "completed", 1)],
               [row("o2", "u3", 2, 5, "completed"), row("o1", "u1", 1, 12, None), row("o4", None, 3, 1, "completed")],
               [row("o4", None, 3, 1, "completed")]]
    want = [[(1, 2, 15.0, 1)], [(1, 2, 17.0, 1), (2, 1, 9.0, 1)], [(2, 2, 14.0, 2), (3, 1, 1.0, 0)], [(2, 2, 14.0, 2), (3, 1, 1.0, 0)]]
    for i, rows in enumerate(batches):
        for _ in range(2):
            drivers.signed_batch(spark.createDataFrame(rows, schema), i, ["order_id"], ["_v"], drivers.SALES_SIGNED, f"{tmp_dir}/s", buckets=4)
        got = sorted((r["report_date"].day, r["order_count"], r["total_revenue"], r["purchasing_users"]) for r in drivers.read_sales_signed(spark, f"{tmp_dir}/s").collect())
        assert got == want[i]
    assert spark.read.parquet(f"{tmp_dir}/s/sums").filter("batch_id = 3").count() == 0  # nothing changed, no delta


def test_load_job_rewrites_only_the_buckets_hit(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    head = "product_id,name,price,category\n"

    def put(name, rows):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write(head + "".join(f"p{i},n{i},{v}.00,Home\n" for i, v in rows))
    args = (f"{tmp_dir}/in", "products", f"{tmp_dir}/t", f"{tmp_dir}/m", f"{tmp_dir}/r")
    put("a.csv", [(i, 1) for i in range(400)])
    load.load_table(spark, *args, buckets=16)
    first = keyed.generations(spark, f"{tmp_dir}/t", 16)
    assert len(first) == 16 and all(g == [1] for g in first.values())
    put("b.csv", [(3, 2), (5, 2), (1000, 2)])
    load.load_table(spark, *args, buckets=16)
    hit = set(keyed.touched(spark.createDataFrame([("p3",), ("p5",), ("p1000",)], "product_id string"), ["product_id"], 16))
    assert {b for b, g in keyed.generations(spark, f"{tmp_dir}/t", 16).items() if g[-1] == 2} == hit and len(hit) <= 3
    got = {r["product_id"]: int(r["price"]) for r in load.read_table(spark, "products", f"{tmp_dir}/t", f"{tmp_dir}/m", 16).collect()}
    assert got == {f"p{i}": 2 if i in (3, 5) else 1 for i in range(400)} | {"p1000": 2}
    loads = sorted(tuple(r) for r in spark.read.parquet(f"{tmp_dir}/m_loads").collect())
    assert loads == [(1, 400, 0, 16), (2, 3, 0, len(hit))]
    with pytest.raises(ValueError):
        keyed.read(spark, f"{tmp_dir}/t", MASTER_SCHEMAS["products"], n=8)


def test_load_that_died_is_not_read_and_leaves_nothing_behind(spark, tmp_dir, monkeypatch):
    os.makedirs(f"{tmp_dir}/in")
    args = (f"{tmp_dir}/in", "products", f"{tmp_dir}/t", f"{tmp_dir}/m", f"{tmp_dir}/r")

    def put(name, ids):
        with open(f"{tmp_dir}/in/{name}", "w") as f:
            f.write("product_id,name,price,category\n" + "".join(f"p{i},{name},1.00,Home\n" for i in ids))
    read = lambda: {r["product_id"]: r["name"] for r in load.read_table(spark, "products", f"{tmp_dir}/t", f"{tmp_dir}/m").collect()}
    put("a.csv", range(50))
    load.load_table(spark, *args)
    put("b.csv", range(0, 50, 10))
    with monkeypatch.context() as m:
        m.setattr(load, "append", lambda *a: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            load.load_table(spark, *args)
    assert set(read().values()) == {"a.csv"}
    os.remove(f"{tmp_dir}/in/b.csv")
    put("c.csv", [49])
    load.load_table(spark, *args)
    assert read() == {f"p{i}": "c.csv" if i == 49 else "a.csv" for i in range(50)}


def test_partitioned_versions_commit(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    for n in range(2):
        df = spark.createDataFrame([(n, "x"), (n + 10, "y")], "v int, p string")
        assert tables.write_version(df, path, partition_by=["p"]) == n
    assert tables.versions(spark, path) == [0, 1]
    assert sorted(r["v"] for r in tables.read_version(spark, path).collect()) == [1, 11]


def test_each_csv_file_has_its_own_header_and_quoted_line_ends(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write('Name, Price\n"two\nlines",1\nsays ""hi"",2\n')
    with open(f"{tmp_dir}/b.csv", "w") as f:
        f.write("price,name,note\n3,swapped,n\n4,long,n,surplus\n5\n")
    rows, rejects = files.scan_csv(spark, tmp_dir)
    assert sorted((str(r["name"]), r["price"], r["note"]) for r in rows.collect()) == [
        ("None", "5", None), ('says ""hi""', "2", None), ("swapped", "3", "n"), ("two\nlines", "1", None)]
    assert [(r["source_file"], r["reason"]) for r in rejects.collect()] == [("b.csv", "too many fields")]


def test_files_cut_short_are_reported(spark, tmp_dir):
    for name, body in (("whole.json", "a\n\nbb\n"), ("open.json", "a\nbb"), ("crlf.json", "a\r\nbb\r\n")):
        with open(f"{tmp_dir}/{name}", "w", newline="") as f:
            f.write(body)
    lines = files.scan_jsonl(spark, tmp_dir)
    assert files.incomplete_files(lines).count() == 0
    cut = lines.filter("not (source_file = 'whole.json' and value = 'bb')")
    assert [tuple(r) for r in files.incomplete_files(cut).collect()] == [("whole.json", 6, 3)]


def test_keys_without_a_number_are_rejected_on_every_run(spark):
    df = spark.createDataFrame([("u9",), ("u10",), ("ux",), (None,)], "user_id string")
    for last in (None, 9):
        assert "ux" not in [r["user_id"] for r in scan_since(df, "user_id", last).collect()]
    assert sorted((str(r["user_id"]), r["reason"]) for r in cursor_rejects(df, "user_id").collect()) == [("None", "missing key"), ("ux", "key without a number")]


def test_cursor_takes_the_largest_value(spark, tmp_dir):
    for v in (7, 9, 8):
        state.advance_cursor(spark, f"{tmp_dir}/c", "x", spark.createDataFrame([(v,)], "v long"), "v")
    assert spark.range(1).select(state.read_cursor(spark, f"{tmp_dir}/c", "x").alias("v")).first()["v"] == 9


def test_load_job_takes_changed_files_once(spark, tmp_dir):
    def put(name, text):
        with open(f"{tmp_dir}/{name}", "w") as f:
            f.write(text)
    os.makedirs(f"{tmp_dir}/in")
    args = (f"{tmp_dir}/in", "products", f"{tmp_dir}/t", f"{tmp_dir}/m", f"{tmp_dir}/r")
    assert load.load_table(spark, *args) == []
    put("in/a.csv", "product_id,name,price,category\np1,one,1.00,home\np2,two,2.00,Nowhere\n")
    assert len(load.load_table(spark, *args)) == 1 and load.load_table(spark, *args) == []
    put("in/b.csv", "category,product_id,price\nBeauty,p1,3.00\nHome,p1,4.00\n")
    assert len(load.load_table(spark, *args)) == 1
    got = [(r["product_id"], r["name"], float(r["price"]), r["category"]) for r in load.read_table(spark, "products", f"{tmp_dir}/t", f"{tmp_dir}/m").collect()]
    assert got == [("p1", "one", 4.0, "Home")]
    assert [r["reason"] for r in spark.read.parquet(f"{tmp_dir}/r").collect()] == ["invalid or missing category"]


def test_later_position_wins_in_one_load(spark, tmp_dir):
    with open(f"{tmp_dir}/a.csv", "w") as f:
        f.write("product_id,name,price,category\n" + "".join(f"p1,n{i},{i}.00,Home\n" for i in range(50)))
    from shopflow.operators import clean, merge
    rows, _ = clean.clean_table(files.scan_csv(spark, tmp_dir)[0], "products")
    assert merge.latest_by_key(rows, ["product_id"], "_pos").first()["name"] == "n49"


def test_unreadable_time_is_rejected_not_landed(spark):
    from shopflow.plans import landing
    value = b"\x00\x00\x00\x00\x09" + json.dumps({"timestamp": "bad", "user_id": "u", "session_id": "s", "event_type": "order_complete",
                                                  "device": "mobile", "event_data": {"order_id": "o"}}).encode()
    m = spark.createDataFrame([("k", bytearray(value), 0, 0, 0)], "key string, value binary, batch_id long, partition int, offset long")
    rows, rejects = landing.decode_events(m, "order_complete")
    assert rows.count() == 0 and [r["reason"] for r in rejects.collect()] == ["timestamp does not parse"]


@pytest.mark.parametrize("n", [1, 2])
def test_redelivered_events_count_once(spark, tmp_dir, n):
    ev = spark.createDataFrame([("2025-01-01 10:00:00", "u", "s", "add_to_cart", None), ("2025-01-01 11:00:00", "u", "s", "order_complete", None)],
                               "timestamp string, user_id string, session_id string, event_type string, url_path string").withColumn(
        "timestamp", F.col("timestamp").cast("timestamp"))
    for _ in range(n):
        ev.write.mode("append").parquet(f"{tmp_dir}/in")
        stream = spark.readStream.schema(ev.schema).parquet(f"{tmp_dir}/in")
        drivers.run(lambda s=stream: drivers.funnel_exact_stream(spark, s, f"{tmp_dir}/store", f"{tmp_dir}/report", f"{tmp_dir}/ckpt"))
    got = drivers.read_exact_report(spark, f"{tmp_dir}/report").collect()
    assert [(r["add_to_cart_events"], r["purchases"]) for r in got] == [(1, 1)]


def test_lines_with_nan_or_repeated_keys_are_read(spark):
    from shopflow.operators.events import validate_events
    base = _line("s1", 1)
    lines = [base[:-1] + ', "fulfillment_speed": NaN}', base[:-1] + ', "order_id": "last"}', base[:-1] + ', "x": NaN', base[:-1] + ', "note": "is NaN, x"}']
    valid, rejects = validate_events(_batch(spark, [(v, "a.json") for v in lines]).withColumn("_row", F.lit(0)), with_line_numbers=False)
    assert sorted((r["event_data"]["order_id"], r["event_data"]["fulfillment_speed"]) for r in valid.collect()) == [("last", None), ("o1", None), ("o1", None)]
    assert [r["reason"] for r in rejects.collect()] == ["Invalid JSON"]


@pytest.fixture()
def dealt(spark, tmp_dir, monkeypatch):
    """The smallest tables in three files each; queries work under tmp_dir/work."""
    for name in ("orders", "events", "customer", "nation"):
        spark.read.parquet(f"{SF['0.001']}/{name}.parquet").repartition(3).write.parquet(f"{tmp_dir}/{name}.parquet")
    monkeypatch.setattr(registry, "work_path", lambda *_, **__: f"{tmp_dir}/work")
    return tmp_dir


def test_load_query_loads_every_order_from_several_files(spark, dealt):
    rows, _ = clean.clean_table(dt.raw_orders(spark, dealt), "orders")
    want = {}
    for r in clean.referential_check(rows, dt.users(spark, dealt))[0].collect():
        k = int(r["order_id"][1:])
        want[r["order_id"]] = Decimal("2.50") if k % 12 == 0 else Decimal("1.25") if k % 4 == 0 else r["total"]
    got = registry.QUERIES["load_orders_job"](spark, dealt).collect()
    assert any(int(k[1:]) % 2 for k in want) and any(int(k[1:]) % 12 == 0 for k in want)
    assert len(got) == len(want) and {r["order_id"]: r["total"] for r in got} == want
    for drop in ("1", "2/0", "2/1"):
        assert files.file_listing(spark, f"{dealt}/work/in/{drop}", "*.csv").count() > 1


def test_ledger_query_reads_several_files_a_drop(spark, dealt):
    got = registry.QUERIES["ledger_rows"](spark, dealt).first()
    assert got["records_inserted"] > 0 and got["empty_files"] == 1
    assert files.file_listing(spark, f"{dealt}/work/in/day=bad", "*.txt").count() > 1


def test_files_of_a_stream_follow_its_rows(spark, tmp_dir, monkeypatch):
    """a part of a stream is as many files as its rows ask for, and a micro-batch takes whole parts."""
    monkeypatch.setattr(registry, "FILE_ROWS", 100, raising=False)
    stream = registry._streamed(spark, spark.range(1000), tmp_dir, 2)
    written = [r["n"] for r in spark.read.parquet(f"{tmp_dir}/in").groupBy(F.input_file_name()).agg(F.count("*").alias("n")).collect()]
    assert len(written) == 10 and sum(written) == 1000 and max(written) < 200
    q = drivers.run(lambda: stream.writeStream.format("parquet").option("path", f"{tmp_dir}/out").option("checkpointLocation", f"{tmp_dir}/ckpt")
                    .trigger(availableNow=True).start())
    assert [p["numInputRows"] for p in q.recentProgress if p["numInputRows"]] == [1000]
    assert spark.read.parquet(f"{tmp_dir}/out").count() == 1000
