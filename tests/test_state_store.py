"""Aggregates in the state store, distinct sketches, bucketed logs: restarts, bounds, plans."""

import os
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from shopflow.plans import reports
from shopflow.schemas import TABLE_TOPICS
from shopflow.operators import envelope
from shopflow.sinks.topics import publish
from shopflow.sources.cursor import scan_clustered, write_clustered
from shopflow.streaming import drivers

EVENT = "event_type string, user_id string, timestamp timestamp, url_path string"


def events(day, n=12):
    kinds = ["product_search", "page_view", "add_to_cart", "checkout_start", "order_complete"]
    return [(kinds[i % (2 + day % 4)], f"u{i}", datetime(2025, 1, 1) + timedelta(days=day, minutes=i), "/product/1") for i in range(n)]


def test_state_is_bounded_and_recovered(spark, tmp_dir):
    """A file a day; the stream is stopped and restarted twice, and days behind the watermark leave the state."""
    seen = []

    def run(days):
        for day in days:
            spark.createDataFrame(events(day), EVENT).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/in")
            for f in os.listdir(f"{tmp_dir}/in"):
                if f.endswith(".parquet") and f not in seen:
                    seen.append(f)
                    os.utime(f"{tmp_dir}/in/{f}", (1_700_000_000 + 60 * day,) * 2)
        stream = spark.readStream.schema(EVENT).option("maxFilesPerTrigger", 1).parquet(f"{tmp_dir}/in")
        return drivers.run(lambda: drivers.funnel_state_stream(spark, stream, f"{tmp_dir}/out", f"{tmp_dir}/ckpt", watermark="2 days"))

    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    for part in (range(0, 4), range(4, 8), range(8, 12)):
        q = run(part)
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before
    state = q.recentProgress[-1]["stateOperators"][0]
    assert 1 <= state["numRowsTotal"] <= 4 and any(k.startswith("rocksdb") for k in state["customMetrics"])
    assert any(f.endswith(".changelog") for _, _, files in os.walk(f"{tmp_dir}/ckpt/state") for f in files)
    got = sorted(tuple(r) for r in drivers.read_funnel_state(spark, f"{tmp_dir}/out").collect())
    want = reports.behavior_funnel_daily(spark.read.schema(EVENT).parquet(f"{tmp_dir}/in"))
    assert got == sorted(tuple(r) for r in want.collect()) and len(got) == 12


def test_sketches_unite_over_batches_and_days(spark, tmp_dir):
    rows = spark.range(20_000).select(F.concat(F.lit("u"), (F.col("id") % 7000).cast("string")).alias("user_id"), F.lit("completed").alias("status"),
                                      F.date_add(F.lit("2025-01-01").cast("date"), (F.col("id") % 3).cast("int")).cast("timestamp").alias("created_at"))
    for i in range(3):
        drivers.write_batch(reports.user_sketches(rows.filter(F.pmod(F.xxhash64("user_id"), F.lit(3)) != i)), f"{tmp_dir}/s", i)
    sketches = spark.read.parquet(f"{tmp_dir}/s")
    exact = {r[0]: r[1] for r in rows.groupBy(F.to_date("created_at")).agg(F.count_distinct("user_id")).collect()}
    got = {r["report_date"]: r["estimated_users"] for r in reports.users_from_sketches(sketches, "report_date").collect()}
    assert got.keys() == exact.keys() and all(abs(got[d] - exact[d]) <= 3 * reports.SKETCH_ERROR * exact[d] for d in exact)
    whole = reports.users_from_sketches(sketches).first()[0]
    assert abs(whole - 7000) <= 3 * reports.SKETCH_ERROR * 7000


def test_bucketed_log_is_read_without_a_shuffle(spark, tmp_dir):
    """Last wins over batches, a batch that runs again replaces itself, and the plan of a read has no Exchange."""
    schema = "order_id string, user_id string, created_at timestamp, total decimal(10,2), status string, payment_method string"
    for i in range(3):
        df = spark.createDataFrame([(f"o{k}", f"u{i}", None, None, None, None) for k in range(i * 20, 60)], schema)
        publish(envelope.encode(df, "order_id", 3, columns=df.columns), TABLE_TOPICS["orders"], root=f"{tmp_dir}/t", batch_id=i)
    log = f"{tmp_dir}/log"
    start = lambda: drivers.land_bucketed_stream(spark, TABLE_TOPICS["orders"], "orders", log, f"{tmp_dir}/ckpt", f"{tmp_dir}/t")
    drivers.run(start)
    drivers.run(start)
    df = drivers.read_bucketed_landing(spark, "orders", log)
    assert "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted((r["order_id"], r["user_id"]) for r in df.collect()) == sorted((f"o{k}", f"u{k // 20}") for k in range(60))
    commits = f"{tmp_dir}/ckpt/commits"
    for f in [f for f in os.listdir(commits) if f.strip(".").split(".")[0] == "0"]:
        os.remove(f"{commits}/{f}")  # the batch was written, but not committed
    drivers.run(start)
    assert spark.read.parquet(log).count() == 120 and drivers.read_bucketed_landing(spark, "orders", log).count() == 60


def test_cursor_scan_skips_row_groups(spark, tmp_dir):
    """Clustered storage: the scan reads the files of the range only; spread by key, it reads every row."""
    rows = spark.range(40_000).select(F.concat(F.lit("o"), "id").alias("order_id"), F.lit("x").alias("v"))
    write_clustered(rows, "order_id", f"{tmp_dir}/clustered")
    rows.withColumn("id_num", F.substring("order_id", 2, 9).cast("long")).repartition(4, "order_id").write.parquet(f"{tmp_dir}/spread")
    read = {}
    for name in ("clustered", "spread"):
        df = scan_clustered(spark, f"{tmp_dir}/{name}", 38_999)
        plan = df._jdf.queryExecution().executedPlan()
        assert sum(1 for _ in df.collect()) == 1000
        read[name] = plan.collectLeaves().head().metrics().apply("numOutputRows").value()
    assert read["spread"] == 40_000 and read["clustered"] <= 20_000


def test_avro_schemas_of_the_event_topics(spark):
    """They parse, and say of every declared field its type and whether it may be null."""
    import json

    from shopflow.schemas import CART_ITEM_RULES, EVENT_RULES, EVENT_TOPICS, avro_schema
    kinds = {"str": "string", "int": "int", "float": "double", "bool": "boolean"}
    nullable = set()
    for event_type in EVENT_TOPICS:
        parsed = spark._jvm.org.apache.avro.Schema.Parser().parse(json.dumps(avro_schema(event_type)))
        assert parsed.getFullName() == "behavior.events." + event_type.title().replace("_", "")
        fields = {f.name(): f.schema() for f in parsed.getFields()}
        assert list(fields) == ["timestamp", "user_id", "session_id", "event_type", "device", "event_data"]
        data = {f.name(): f.schema() for f in fields["event_data"].getFields()}
        assert list(data) == [n for n, *_ in EVENT_RULES[event_type]]
        for name, kind, _, _ in EVENT_RULES[event_type]:
            if kind == "items":
                item = {f.name(): f.schema().getType().getName() for f in data[name].getElementType().getFields()}
                assert item == {n: kinds[k] for n, k, _, _ in CART_ITEM_RULES}
                continue
            types = [t.getType().getName() for t in data[name].getTypes()] if data[name].isUnion() else [data[name].getType().getName()]
            assert types[-1] == kinds[kind] and types[:-1] in ([], ["null"])
            if len(types) == 2:
                nullable.add((event_type, name))
    assert nullable == {("product_search", "clicked_position"), ("add_to_cart", "cart_total_items"), ("remove_from_cart", "cart_total_items"),
                        ("checkout_start", "shipping_method"), ("payment_attempt", "error_code"), ("order_complete", "fulfillment_speed")}
