"""Named queries over the driver's tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads whole tables (through ``sources.driver_tables``) and runs
one of the engine's operators or reports on them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopflow.functions import columns as fc
from shopflow.operators import clean, envelope, merge
from shopflow.operators import events as ev_ops
from shopflow.plans import landing, load, reports
from shopflow.schemas import EVENT_TOPICS, EVENT_TYPES, FUNNEL_COUNTS, MASTER_SCHEMAS, PRIMARY_KEYS, TABLE_TOPICS, payload_type
from shopflow.session import work_path
from shopflow.sinks import state, tables
from shopflow.sinks.topics import publish
from shopflow.sources import driver_tables as dt
from shopflow.sources import files
from shopflow.sources.cursor import cursor_rejects, scan_clustered, scan_since, write_clustered
from shopflow.sources.topics import topic_source
from shopflow.streaming import drivers

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn
    return register


@query("sales_daily")
def q_sales_daily(spark, d):
    return reports.sales_daily(dt.orders(spark, d))


@query("top_products")
def q_top_products(spark, d):
    return reports.top_products(dt.cart_events(spark, d), dt.products(spark, d))


@query("top_products_top10")
def q_top_products_top10(spark, d):
    return reports.top_products_top(dt.cart_events(spark, d), dt.products(spark, d), 10)


@query("behavior_funnel_daily")
def q_funnel(spark, d):
    return reports.behavior_funnel_daily(dt.behavior_events(spark, d))


@query("loyalty_segments")
def q_loyalty(spark, d):
    return reports.loyalty_segments(dt.users(spark, d))


@query("device_usage")
def q_device(spark, d):
    return reports.device_usage(dt.behavior_events(spark, d))


# -- keyed merges -------------------------------------------------------------


@query("latest_by_key")
def q_latest_by_key(spark, d):
    """Last delivered version of every cart line (session, line number)."""
    cart = dt.cart_events(spark, d)
    return merge.latest_by_key(cart, ["session_id", "cart_total_items"], "_pos").drop("_pos")


@query("latest_by_key_window")
def q_latest_by_key_window(spark, d):
    """B7, row_number form (for comparison with the aggregate form)."""
    cart = dt.cart_events(spark, d)
    return merge.latest_by_key(cart, ["session_id", "cart_total_items"], "_pos",
                               method="window").drop("_pos")


def price_feed(spark, d):
    """Product updates derived from line items: last quoted line price and
    quantity per product, in line-item order."""
    li = dt.read(spark, d, "lineitem")
    return li.select(dt.prefixed("p", "l_partkey").alias("product_id"),
                     F.col("l_extendedprice").cast("decimal(10,2)").alias("price"),
                     F.col("l_quantity").cast("int").alias("inventory"),
                     F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                              "l_extendedprice").alias("_pos"))


@query("upsert")
def q_upsert(spark, d):
    """B1: upsert the price feed (price, inventory only) into products."""
    feed = price_feed(spark, d)
    return merge.upsert(dt.products(spark, d), feed.select("product_id", "price", "inventory", "_pos")
                        .transform(lambda f: merge.latest_by_key(f, ["product_id"], "_pos")).drop("_pos"),
                        "product_id")


@query("insert_if_absent")
def q_insert_if_absent(spark, d):
    """B2: re-delivered cart events; stored = returned lines (flag R);
    first row per (timestamp, session_id) wins, stored keys are skipped."""
    batch = dt.cart_events(spark, d)
    stored = dt.cart_events(spark, d, where=F.col("l_returnflag") == "R").select("timestamp", "session_id")
    return merge.insert_if_absent(stored, batch, ["timestamp", "session_id"], "_pos").drop("_pos")


@query("merge_additive")
def q_merge_additive(spark, d):
    """Funnel as delta rows of five branches, from one scan, merged by
    summing per day (the summing-table form), then the dashboard rates."""
    deltas = reports.funnel_deltas(dt.behavior_events(spark, d))
    merged = merge.merge_additive(None, deltas, ["report_date"], FUNNEL_COUNTS)
    return reports.funnel_from_deltas(merged)


@query("distinct_users_incremental")
def q_distinct_users_incremental(spark, d):
    """Daily sales built batch by batch (one batch per order priority):
    counts and revenue are summed per (day, batch), then per day; purchasing
    users come from the union of distinct (day, user) pairs, never from summed
    per-batch distincts."""
    batch = F.coalesce("o_orderpriority", F.lit("none")).alias("batch")
    done = dt.orders(spark, d, extra=[batch]).filter(F.col("status") == "completed")
    per_user = (done.groupBy(F.to_date("created_at").alias("report_date"), "batch", "user_id")
                .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total").alias("total_revenue")))
    pairs = per_user.groupBy("report_date", "user_id").agg(F.sum("order_count").alias("order_count"),
                                                           F.sum("total_revenue").alias("total_revenue"))
    return pairs.groupBy("report_date").agg(
        F.sum("order_count").cast("bigint").alias("order_count"), F.sum("total_revenue").cast("double").alias("total_revenue"),
        F.count("user_id").alias("purchasing_users"))


@query("full_row_distinct")
def q_full_row_distinct(spark, d):
    """Full-row distinct of orders delivered twice."""
    o = dt.orders(spark, d)
    return merge.distinct_rows(o.unionByName(o))


# -- cleaning master data -----------------------------------------------------


_RAW = {"users": dt.raw_users, "products": dt.raw_products, "orders": dt.raw_orders}


def _cleaned(spark, d, table):
    return clean.clean_table(_RAW[table](spark, d), table)


def _reject_counts(rejects):
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("clean_users")
def q_clean_users(spark, d):
    """Users cleaned from their raw string form."""
    return _cleaned(spark, d, "users")[0]


@query("clean_products")
def q_clean_products(spark, d):
    return _cleaned(spark, d, "products")[0]


@query("clean_orders")
def q_clean_orders(spark, d):
    return _cleaned(spark, d, "orders")[0]


@query("clean_rejects")
def q_clean_rejects(spark, d):
    """Reject reasons of the three tables, counted."""
    out = None
    for t in ("users", "products", "orders"):
        r = _reject_counts(_cleaned(spark, d, t)[1]).select(F.lit(t).alias("table_name"), "reason", "n")
        out = r if out is None else out.unionByName(r)
    return out


@query("referential_check")
def q_referential_check(spark, d):
    """Cleaned orders whose user is not among the cleaned users."""
    orders = _cleaned(spark, d, "orders")[0]
    users = _cleaned(spark, d, "users")[0]
    return clean.referential_check(orders, users)[1].select("order_id", "user_id")


@query("scan_csv_clean_orders")
def q_scan_csv_clean_orders(spark, d):
    """A1 end to end: raw orders written as CSV files, scanned back with the
    CSV scan (header normalised, missing-value tokens), cleaned."""
    out = work_path(spark, "csv", "orders", fresh=True)
    dt.raw_orders(spark, d).write.mode("overwrite").option("header", True).csv(out)
    rows, long_lines = files.scan_csv(spark, out)
    return clean.clean_table(rows, "orders")[0].drop("_pos")


# -- session events --------------------------------------------------------------


def _validated(spark, d):
    return ev_ops.validate_events(dt.raw_event_lines(spark, d), with_line_numbers=False)


@query("validate_events")
def q_validate_events(spark, d):
    """Raw JSON lines validated; valid events flattened."""
    return ev_ops.flatten(_validated(spark, d)[0])


@query("validate_events_rejects")
def q_validate_events_rejects(spark, d):
    """Reject reasons counted."""
    return _validated(spark, d)[1].groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("route_by_type_counts")
def q_route_by_type_counts(spark, d):
    """Events delivered twice, stored first-wins per (type,
    timestamp, session), routed by type; rows stored per type and source file."""
    lines = dt.raw_event_lines(spark, d)
    again = lines.withColumn("_block", F.col("_block") + 1)  # the same lines once more, later in their files
    valid = ev_ops.validate_events(lines.unionByName(again), with_line_numbers=False)[0]
    stored = merge.first_by_key(valid.withColumn("source_file", F.col("ingestion.source_file")).drop("ingestion"),
                                ["event_type", "timestamp", "session_id"], ev_ops.event_order())
    return stored.groupBy("event_type", "source_file").agg(F.count(F.lit(1)).alias("records_inserted"))


@query("validate_more_events")
def q_validate_more_events(spark, d):
    """remove_from_cart, wishlist_add, payment_attempt and
    review_submit lines built from the orders, with their failure modes."""
    return ev_ops.flatten(ev_ops.validate_events(dt.raw_more_event_lines(spark, d), with_line_numbers=False)[0])


@query("validate_more_rejects")
def q_validate_more_rejects(spark, d):
    _, rejects = ev_ops.validate_events(dt.raw_more_event_lines(spark, d), with_line_numbers=False)
    return rejects.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def _event_messages(valid, event_type):
    """Validated events of one type in the shape of its topic's messages."""
    names = [f.name for f in payload_type(event_type).fields]
    msg = valid.filter(F.col("event_type") == event_type).select(
        "timestamp", "user_id", "session_id", "event_type", "device",
        F.struct(*[F.col(f"event_data.{n}").alias(n) for n in names]).alias("event_data"))
    return envelope.encode(msg.withColumn("_k", F.concat_ws(":", "session_id", "timestamp")), "_k",
                           1 + EVENT_TYPES.index(event_type), columns=msg.columns)


def _all_valid(spark, d):
    """Valid events of all ten types, validated once and stored."""
    out = None
    for lines in (dt.raw_event_lines(spark, d), dt.raw_cart_view_lines(spark, d), dt.raw_more_event_lines(spark, d)):
        valid = ev_ops.validate_events(lines, with_line_numbers=False)[0].drop("_seq", "ingestion")
        out = valid if out is None else out.unionByName(valid)
    path = work_path(spark, "valid", fresh=True)
    out.write.partitionBy("event_type").parquet(path)
    return spark.read.schema(out.schema).parquet(path)


@query("publish_events_by_type")
def q_publish_events_by_type(spark, d):
    """Every valid event published to the topic of its type; what the
    topics hold, per topic and schema id."""
    root = work_path(spark, "events", fresh=True)
    valid = _all_valid(spark, d)
    out = None
    for event_type, topic in EVENT_TOPICS.items():
        publish(_event_messages(valid, event_type), topic, root=root)
        got = topic_source(spark, topic, root=root).groupBy("topic", envelope.schema_id(F.col("value")).alias("schema_id")) \
            .agg(F.count(F.lit(1)).alias("n"))
        out = got if out is None else out.unionByName(got)
    return out


@query("land_events")
def q_land_events(spark, d):
    """The ten event topics landed (cart views without their
    items), last delivery per user, session and second; rows per type, and a
    check sum of their times."""
    valid = _all_valid(spark, d)
    out = None
    for event_type in EVENT_TOPICS:
        msg = _event_messages(valid, event_type).select("key", "value", F.lit(0).cast("bigint").alias("batch_id"), F.lit(0).alias("partition"),
                                                        F.monotonically_increasing_id().alias("offset"))
        got = landing.land_events(msg, event_type).groupBy("event_type").agg(
            F.count(F.lit(1)).alias("n"), F.sum(F.unix_timestamp("timestamp") % 1000).cast("bigint").alias("time_sum"))
        out = got if out is None else out.unionByName(got)
    return out


@query("land_rejects")
def q_land_rejects(spark, d):
    """Order events published with broken copies among them (bad magic
    byte, cut header, no object, a time that does not parse); what was rejected, by reason."""
    ev = dt.behavior_events(spark, d).filter(F.col("event_type") == "order_complete")
    msg = ev.select(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"), "user_id", "session_id", "event_type", "device",
                    F.struct("order_id", F.lit("fast").alias("fulfillment_speed")).alias("event_data"), "_pos")
    k = F.col("_pos") % 5
    msg = msg.withColumn("timestamp", F.when(k == 4, F.lit("not a time")).otherwise(F.col("timestamp"))).withColumn("_k", F.col("_pos"))
    good = envelope.encode(msg, "_k", 9, columns=[c for c in msg.columns if c not in ("_k", "_pos")])
    k = F.col("key").cast("bigint") % 5
    body = F.substring(F.col("value"), 6, 1 << 30)
    broken = good.withColumn("value", F.when(k == 1, F.concat(F.unhex(F.lit("0100000009")), body))
                             .when(k == 2, F.substring(F.col("value"), 1, 3))
                             .when(k == 3, F.concat(F.substring(F.col("value"), 1, 5), F.lit("[1]").cast("binary"))).otherwise(F.col("value")))
    sent = broken.select("key", "value", F.lit(0).cast("bigint").alias("batch_id"), F.lit(0).alias("partition"), F.lit(0).cast("bigint").alias("offset"))
    rows, rejects = landing.decode_events(sent, "order_complete")
    landed = rows.select(F.lit("landed").alias("reason"))
    return rejects.select("reason").unionByName(landed).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


# -- messages, cursors, landing ------------------------------------------------------


ORDER_SCHEMA_ID = 3


@query("envelope_roundtrip")
def q_envelope_roundtrip(spark, d):
    """Orders encoded as enveloped JSON messages and decoded back."""
    msgs = envelope.encode(dt.orders(spark, d), "order_id", ORDER_SCHEMA_ID)
    rows, _ = landing.decode_master(msgs.select("key", "value", F.lit(0).cast("bigint").alias("batch_id"),
                                                F.lit(0).alias("partition"),
                                                F.lit(0).cast("bigint").alias("offset")), "orders")
    return rows.drop("batch_id", "partition", "offset")


@query("publish_json_orders")
def q_publish_json_orders(spark, d):
    """Message key, schema id and JSON payload of every order."""
    msgs = envelope.encode(dt.orders(spark, d), "order_id", ORDER_SCHEMA_ID)
    return msgs.select("key", envelope.schema_id(F.col("value")).alias("schema_id"),
                       envelope.payload_text(F.col("value")).alias("payload"))


@query("scan_since_numeric_suffix")
def q_scan_since_numeric(spark, d):
    """Orders after a stored cursor, compared numerically (o10 > o9).
    The cursor stands for a previous export: floor of the mean order number,
    evaluated as a scalar subquery inside the scan's job."""
    o = dt.orders(spark, d)
    cursor = o.agg(F.floor(F.avg(fc.id_number("order_id")))).scalar()
    return scan_since(o, "order_id", cursor)


@query("cursor_rejects")
def q_cursor_rejects(spark, d):
    """Order ids without a number, and missing ones, are in no export
    but in the rejects."""
    o = dt.orders(spark, d)
    num = fc.id_number("order_id")
    odd = o.withColumn("order_id", F.when(num % 5 == 0, F.concat(F.lit("ox"), num.cast("string"))).when(num % 7 == 0, F.lit(None)).otherwise(F.col("order_id")))
    rejected = cursor_rejects(odd, "order_id").select("reason")
    exported = scan_since(odd, "order_id", None).select(F.lit("exported").alias("reason"))
    return rejected.unionByName(exported).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query("scan_clustered")
def q_scan_clustered(spark, d):
    """The orders stored clustered on their number in two exports,
    scanned after the middle one."""
    path, o = work_path(spark, "clustered", fresh=True), dt.orders(spark, d)
    early = F.col("created_at") < F.lit("1998-01-01").cast("timestamp")
    for part in (early, ~early):
        write_clustered(o.filter(part), "order_id", path)
    last = o.agg(F.floor(F.avg(fc.id_number("order_id")))).first()[0]
    return scan_clustered(spark, path, last)


@query("scan_since_position")
def q_scan_since_position(spark, d):
    """Events after the position cursor left by the export of the first
    half of the month."""
    ev = dt.behavior_events(spark, d)
    cursor = ev.filter(F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")).agg(F.max("_pos")).scalar()
    return scan_since(ev, "_pos", cursor, numeric_suffix=False).drop("id_num")


@query("land_orders_latest")
def q_land_orders_latest(spark, d):
    """Orders published twice to a file-backed topic (full export,
    then the completed orders re-published with an upper-cased payment
    method); the landing table keeps the last delivery per order."""
    root = work_path(spark, "topics", fresh=True)
    o = dt.orders(spark, d)
    publish(envelope.encode(o, "order_id", ORDER_SCHEMA_ID), "postgres.orders", root=root, batch_id=0)
    upd = o.filter(F.col("status") == "completed").withColumn("payment_method", F.upper("payment_method"))
    publish(envelope.encode(upd, "order_id", ORDER_SCHEMA_ID), "postgres.orders", root=root, batch_id=1)
    return landing.land_master(topic_source(spark, "postgres.orders", root=root), "orders")


@query("json_field_extract")
def q_json_field_extract(spark, d):
    """One typed parse of the JSON props per row."""
    ev = dt.read(spark, d, "events")
    p = F.from_json("props", "k INT")
    return ev.select("event_id", p["k"].alias("k"))


@query("iso_text")
def q_iso_text(spark, d):
    """ISO text of timestamps (fraction only when non-zero)."""
    ev = dt.behavior_events(spark, d)
    o = dt.orders(spark, d)
    return (ev.select(F.col("_pos").alias("id"), fc.iso_text("timestamp").alias("iso"))
            .unionByName(o.select(F.col("order_id").alias("id"), fc.iso_text("created_at").alias("iso"))
                         .withColumn("id", fc.id_number("id") * -1)))


@query("parse_timestamp")
def q_parse_timestamp(spark, d):
    """Best-effort timestamp parse of the raw order time strings."""
    raw = dt.raw_orders(spark, d)
    return raw.select("order_id", fc.parse_timestamp("timestamp").alias("created_at"))


@query("cast_rules")
def q_cast_rules(spark, d):
    """Blank test, int / float / bool text casts on strings built
    from the event columns."""
    ev = dt.read(spark, d, "events").select("event_id", "value",
                                            F.get_json_object("props", "$.k").cast("int").alias("k"))
    k = F.col("k").cast("string")
    s_int = (F.when(F.col("k") % 4 == 0, F.concat(F.lit(" "), k, F.lit(" ")))
             .when(F.col("k") % 4 == 1, F.concat(k, F.lit(".5")))
             .when(F.col("k") % 4 == 2, F.concat(F.lit("+"), k)).otherwise(F.concat(F.lit("x"), k)))
    s_bool = fc.lookup({0: "yes", 1: "N", 2: " true ", 3: "0", 4: "maybe", 5: "1.0"}, F.col("k") % 6)
    s_blank = fc.lookup({1: "", 2: " NaN ", 3: "  ", 4: "x"}, F.col("k") % 5)
    return ev.select("event_id",
                     fc.int_text(s_int).alias("as_int"),
                     fc.float_text(F.col("value").cast("string")).alias("as_float"),
                     fc.bool_text(s_bool).alias("as_bool"),
                     fc.is_blank(s_blank).alias("is_blank"))


@query("anti_join_ledger")
def q_anti_join_ledger(spark, d):
    """Session files not yet in the ledger (the ledger holds the
    files of the first half of the month)."""
    lines = dt.raw_event_lines(spark, d)
    listing = lines.select(F.col("source_file").alias("file_name")).distinct()
    ledger = listing.filter(F.col("file_name") < "sessions_20240115")
    return files.new_files(listing, ledger)


# -- streaming (file-backed, availableNow) -----------------------------------------------


def _write_session_files(lines, folder):
    """Session files (one folder per day) as a feed would drop them."""
    (lines.withColumn("day", F.regexp_extract("source_file", r"sessions_(\d{8})_", 1))
     .select("value", "day").write.mode("append").partitionBy("day").text(folder))


@query("file_stream_new_only")
def q_file_stream_new_only(spark, d):
    """Session files arrive in two drops (first half of
    the month, then the rest); each availableNow run reads only the new files,
    validates them and stores events first-wins; result = rows stored per
    type, from the store written by the stream."""
    root = work_path(spark, "sessions", fresh=True)
    folder, store, ledger, ckpt = (f"{root}/in", f"{root}/store", f"{root}/ledger", f"{root}/ckpt")
    lines = dt.raw_event_lines(spark, d)
    early = F.col("source_file") < "sessions_20240115"
    _write_session_files(lines.filter(early), folder)
    drivers.run(lambda: drivers.ingest_sessions(spark, folder, store, ledger, ckpt, glob="*.txt"))
    _write_session_files(lines.filter(~early), folder)
    drivers.run(lambda: drivers.ingest_sessions(spark, folder, store, ledger, ckpt, glob="*.txt"))
    return drivers.read_store(spark, store).groupBy("event_type").agg(F.count(F.lit(1)).alias("stored"))


@query("scan_jsonl_events")
def q_scan_jsonl_events(spark, d):
    """Session files scanned as JSON lines and validated; valid lines
    per type, and rejected ones by reason."""
    folder = work_path(spark, "jsonl", fresh=True)
    _write_session_files(dt.raw_event_lines(spark, d), folder)
    valid, rejects = ev_ops.validate_events(files.scan_jsonl(spark, folder, "*.txt"), with_line_numbers=False)
    return valid.groupBy(F.lit("valid").alias("outcome"), F.col("event_type").alias("what")).agg(F.count(F.lit(1)).alias("n")) \
        .unionByName(rejects.groupBy(F.lit("rejected").alias("outcome"), F.col("reason").alias("what")).agg(F.count(F.lit(1)).alias("n")))


@query("scan_day_lines")
def q_scan_day_lines(spark, d):
    """A4: the files of each day of the month, scanned day by day, and of a day
    that has none."""
    folder = work_path(spark, "days", fresh=True)
    lines = dt.raw_event_lines(spark, d)
    day = F.regexp_extract("source_file", r"sessions_(\d{8})_", 1)
    lines.select("value", F.concat(day, F.lit("_feed.json")).alias("sessions")).write.partitionBy("sessions").text(folder)
    days = sorted(r[0] for r in lines.select(day).distinct().collect())  # a few dozen
    out = None
    for day in [*days, "19700101"]:
        got = files.scan_day(spark, folder, day, prefix="sessions=").agg(F.count(F.lit(1)).alias("n_lines")).select(F.lit(day).alias("day"), "n_lines")
        out = got if out is None else out.unionByName(got)
    return out


@query("incomplete_files")
def q_incomplete_files(spark, d):
    """Session files, some of which a reader gave up before their last
    line; how many files there are and how many are reported."""
    folder = work_path(spark, "cut", fresh=True)
    lines = dt.raw_event_lines(spark, d)
    lines.withColumn("day", F.regexp_extract("source_file", r"sessions_(\d{8})_", 1)).select("value", "day").repartition("day").write.partitionBy("day").text(folder)
    read = files.scan_jsonl(spark, folder, "*.txt")
    day = F.regexp_extract("_file", r"day=(\d{8})", 1).cast("int")
    last = read.groupBy("_file").agg(F.max("_row").alias("_last"))
    cut = read.join(last, "_file").filter((day % 3 != 0) | (F.col("_row") < F.col("_last"))).drop("_last")
    report = files.incomplete_files(cut).agg(F.count(F.lit(1)).alias("n_incomplete"))
    return read.agg(F.count_distinct("_file").alias("n_files")).crossJoin(report)


@query("declared_tables")
def q_declared_tables(spark, d):
    """The three master tables declared, loaded, reset to empty and loaded
    again; rows after each step."""
    root, out = work_path(spark, "declared", fresh=True), None
    for name, df in (("users", dt.users(spark, d)), ("products", dt.products(spark, d)), ("orders", dt.orders(spark, d))):
        path = f"{root}/{name}"
        rows = df.select(*MASTER_SCHEMAS[name].fieldNames())
        tables.reset_table(spark, path, MASTER_SCHEMAS[name])
        tables.write_version(rows, path)
        tables.reset_table(spark, path, MASTER_SCHEMAS[name])
        tables.write_version(rows, path)
        for version, step in enumerate(("declared", "loaded", "reset", "reloaded")):
            n = tables.read_version(spark, path, MASTER_SCHEMAS[name], version).agg(F.count(F.lit(1)).alias("n"))
            got = n.select(F.lit(name).alias("table_name"), F.lit(step).alias("step"), "n")
            out = got if out is None else out.unionByName(got)
    return out


@query("ledger_rows")
def q_ledger_rows(spark, d):
    """The ledger that the ingest stream leaves: one row per file read,
    files without a valid row included.  Spark writes a drop as several files,
    which share the id of the write; a drop is empty if none of its files has a
    valid row."""
    root = work_path(spark, "ledger", fresh=True)
    lines = dt.raw_event_lines(spark, d)
    _write_session_files(lines, f"{root}/in")
    (lines.select(F.concat(F.lit("bad "), "value").alias("value")).write.text(f"{root}/in/day=bad"))
    drivers.run(lambda: drivers.ingest_sessions(spark, f"{root}/in", f"{root}/store", f"{root}/ledger", f"{root}/ckpt", glob="*.txt"))
    led = state.read_ledger(spark, f"{root}/ledger").groupBy(F.regexp_extract("file_name", r"^part-\d+-(.{36})", 1).alias("drop")).agg(
        F.sum("records_inserted").alias("records_inserted"))
    return led.agg(F.sum("records_inserted").cast("bigint").alias("records_inserted"), F.count_if(F.col("records_inserted") == 0).alias("empty_files"))


@query("delivery_results")
def q_delivery_results(spark, d):
    """What became of the lines of all micro-batches of an ingest, each
    event delivered twice."""
    root = work_path(spark, "deliveries", fresh=True)
    lines = dt.raw_event_lines(spark, d)
    _write_session_files(lines, f"{root}/in")
    _write_session_files(lines, f"{root}/in")
    drivers.run(lambda: drivers.ingest_sessions(spark, f"{root}/in", f"{root}/store", f"{root}/ledger", f"{root}/ckpt", glob="*.txt",
                                                max_files_per_trigger=40))
    return drivers.read_deliveries(spark, f"{root}/store").groupBy("outcome").agg(F.sum("n").cast("bigint").alias("n"))


@query("stream_dedupe")
def q_stream_dedupe(spark, d):
    """K6: events delivered twice; the stream keeps the first of each key, its
    state bounded by a watermark."""
    root = work_path(spark, "dedupe", fresh=True)
    ev = dt.behavior_events(spark, d)
    ev.unionByName(ev).repartition(4, "_pos").write.parquet(f"{root}/in")
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(f"{root}/in")
    once = drivers.dedupe_stream(stream, ["event_type", "user_id", "session_id", "timestamp"], event_time="timestamp", watermark="60 days")
    drivers.run(lambda: once.writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/ckpt")
                .trigger(availableNow=True).start())
    return spark.read.schema(ev.schema).parquet(f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("land_events_stream")
def q_land_events_stream(spark, d):
    """The valid events of all ten types published to their topics
    in three deliveries, landed by one stream over the topics into a log each,
    read last-wins per (user, session, second)."""
    root = work_path(spark, "landing", fresh=True)
    topics, logs = f"{root}/topics", f"{root}/logs"
    valid = _all_valid(spark, d)
    day = F.dayofmonth("timestamp")
    for i, part in enumerate([day < 11, (day >= 11) & (day < 21), day >= 21]):
        for event_type, topic in EVENT_TOPICS.items():
            publish(_event_messages(valid.filter(part), event_type), topic, root=topics, batch_id=i)
    drivers.run(lambda: drivers.land_topics_stream(spark, {t: ("event", e) for e, t in EVENT_TOPICS.items()}, logs, f"{root}/ckpt", topics,
                                                   max_files_per_trigger=60))
    out = None
    for event_type in EVENT_TOPICS:
        more = ["device", "url_path", "duration_sec", "http_status"] if event_type == "page_view" else []
        got = drivers.read_landing(spark, f"{logs}/{event_type}", drivers.EVENT_KEYS).select("event_type", *drivers.EVENT_KEYS, *more)
        out = got if out is None else out.unionByName(got, allowMissingColumns=True)
    return out


@query("landing_bucketed")
def q_landing_bucketed(spark, d):
    """Orders published twice, changed the second time, landed by a
    stream into a log bucketed by the key; the last delivery of each key is
    read without a shuffle."""
    root = work_path(spark, "bucketed", fresh=True)
    topics, topic, log = f"{root}/topics", TABLE_TOPICS["orders"], f"{root}/log"
    o = dt.orders(spark, d)
    for i, df in enumerate((o, o.withColumn("total", F.lit(None).cast("decimal(10,2)")).filter(fc.id_number("order_id") % 3 == 0))):
        publish(envelope.encode(df, "order_id", 3, columns=df.columns), topic, root=topics, batch_id=i)
    drivers.run(lambda: drivers.land_bucketed_stream(spark, topic, "orders", log, f"{root}/ckpt", topics, max_files_per_trigger=4))
    return drivers.read_bucketed_landing(spark, "orders", log)


@query("land_tables_stream")
def q_land_tables_stream(spark, d):
    """Users, products and orders published twice, changed the second
    time, and landed by one stream over the three topics; the last delivery of
    each key."""
    root = work_path(spark, "landing_tables", fresh=True)
    topics, logs = f"{root}/topics", f"{root}/logs"
    tables_ = {"users": dt.users(spark, d), "products": dt.products(spark, d), "orders": dt.orders(spark, d)}
    change = {"users": {"device": F.lit("tablet")}, "products": {"inventory": F.col("inventory") + 1}, "orders": {"payment_method": F.lit("paypal")}}
    for i in range(2):
        for schema, (name, df) in enumerate(tables_.items(), 1):
            df = df.withColumns(change[name]).filter(fc.id_number(PRIMARY_KEYS[name]) % 2 == 0) if i else df
            publish(envelope.encode(df, PRIMARY_KEYS[name], schema, columns=df.columns), TABLE_TOPICS[name], root=topics, batch_id=i)
    n_files = sum(len(files.list_files(spark, f"{topics}/{topic}/*.parquet")) for topic in TABLE_TOPICS.values())
    drivers.run(lambda: drivers.land_topics_stream(spark, {t: ("master", n) for n, t in TABLE_TOPICS.items()}, logs, f"{root}/ckpt", topics,
                                                   max_files_per_trigger=max(4, -(-n_files // 4))))  # a few micro-batches, whatever the size
    value = {"users": F.col("device"), "products": F.col("inventory").cast("string"), "orders": F.col("payment_method")}
    out = None
    for name, key in PRIMARY_KEYS.items():
        got = drivers.read_landing(spark, f"{logs}/{name}", [key]).select(F.lit(name).alias("table_name"), F.col(key).alias("row_key"), value[name].alias("landed_value"))
        out = got if out is None else out.unionByName(got)
    return out


#: Rows that one file of a stream holds, about.
FILE_ROWS = 250_000


def _streamed(spark, df, root, n, *by):
    """The rows as files of a stream, in n parts of which it takes two per
    micro-batch.  A part is one file, or as many as its rows ask for."""
    pieces = max(1, -(-df.count() // (n * FILE_ROWS)))
    (df.repartition(n * pieces, *by) if by else df.repartition(n * pieces)).write.mode("append").parquet(f"{root}/in")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2 * pieces).parquet(f"{root}/in")


@query("additive_report_stream")
def q_additive_report_stream(spark, d):
    """The funnel as a summing table fed by a stream of event files
    in several micro-batches; the dashboard sums the deltas."""
    root = work_path(spark, "funnel", fresh=True)
    stream = _streamed(spark, dt.behavior_events(spark, d), root, 8, F.to_date("timestamp"))
    drivers.run(lambda: drivers.funnel_stream(spark, stream, f"{root}/deltas", f"{root}/ckpt"))
    return drivers.read_funnel(spark, f"{root}/deltas")


@query("sales_stream")
def q_sales_stream(spark, d):
    """K4/Q2: daily sales fed by a stream of order files; users who buy in
    several micro-batches of a day count once."""
    root = work_path(spark, "sales", fresh=True)
    stream = _streamed(spark, dt.orders(spark, d), root, 6, "order_id")
    drivers.run(lambda: drivers.sales_stream(spark, stream, f"{root}/deltas", f"{root}/ckpt"))
    return drivers.read_sales(spark, f"{root}/deltas")


@query("loyalty_stream")
def q_loyalty_stream(spark, d):
    """K4: loyalty segments fed by a stream of user files."""
    root = work_path(spark, "loyalty", fresh=True)
    stream = _streamed(spark, dt.users(spark, d), root, 6, "user_id")
    drivers.run(lambda: drivers.loyalty_stream(spark, stream, f"{root}/deltas", f"{root}/ckpt"))
    return drivers.read_loyalty(spark, f"{root}/deltas")


@query("funnel_state_stream")
def q_funnel_state_stream(spark, d):
    """K4/K6/K7: the funnel kept in the state store; the stream is stopped
    midway and goes on from its checkpoint with the files that came since."""
    root = work_path(spark, "funnel_state", fresh=True)
    ev = dt.behavior_events(spark, d).drop("_pos")
    for part in (F.dayofmonth("timestamp") % 2 == 0, F.dayofmonth("timestamp") % 2 == 1):
        stream = _streamed(spark, ev.filter(part), root, 3)
        drivers.run(lambda s=stream: drivers.funnel_state_stream(spark, s, f"{root}/days", f"{root}/ckpt"))
    return drivers.read_funnel_state(spark, f"{root}/days")


@query("distinct_users_sketch")
def q_distinct_users_sketch(spark, d):
    """Purchasing users per day from sketches that a stream left in several
    micro-batches, beside the exact count: within three standard errors."""
    root = work_path(spark, "sketches", fresh=True)
    stream = _streamed(spark, dt.orders(spark, d), root, 6, "order_id")
    drivers.run(lambda: drivers.user_sketch_stream(stream, f"{root}/deltas", f"{root}/ckpt"))
    exact = reports.count_pairs(drivers.read_deltas(spark, f"{root}/deltas", "pairs").distinct())
    estimate = reports.users_from_sketches(drivers.read_deltas(spark, f"{root}/deltas", "sketches"), "report_date")
    off = F.abs(F.col("estimated_users") - F.col("purchasing_users"))
    return exact.join(estimate, "report_date").select("report_date", "purchasing_users",
                                                      (off <= 3 * reports.SKETCH_ERROR * F.col("purchasing_users")).alias("within_bound"))


def _redelivered(spark, root, deliveries, n, start):
    """Deliveries one after the other, each as files of a stream that goes on
    from its checkpoint."""
    for i, rows in enumerate(deliveries):
        stream = _streamed(spark, rows.withColumn("_delivery", F.lit(i)), root, n)
        drivers.run(lambda s=stream: start(s))


@query("sales_signed")
def q_sales_signed(spark, d):
    """Daily sales of orders that are delivered again with another
    status, total, day or user, and partly once more as they were; every
    delivery takes several micro-batches."""
    root = work_path(spark, "sales_signed", fresh=True)
    o, num = dt.orders(spark, d), fc.id_number("order_id")
    changed = o.filter(num % 3 == 0).withColumns({
        "status": F.when(F.col("status").isNull(), "completed"),
        "total": (F.col("total") + 1).cast("decimal(10,2)"),
        "created_at": F.when(num % 5 == 0, F.col("created_at") + F.expr("INTERVAL 1 DAY")).otherwise(F.col("created_at")),
        "user_id": F.when(num % 7 == 0, "u1").otherwise(F.col("user_id"))})
    _redelivered(spark, root, [o, changed, o.filter(num % 6 == 0)], 4,
                 lambda s: drivers.sales_signed_stream(s, ["_delivery"], f"{root}/deltas", f"{root}/ckpt"))
    return drivers.read_sales_signed(spark, f"{root}/deltas")


@query("loyalty_signed")
def q_loyalty_signed(spark, d):
    """Loyalty segments of users who change tier or move, some of them
    back again."""
    root = work_path(spark, "loyalty_signed", fresh=True)
    u, num = dt.users(spark, d), fc.id_number("user_id")
    tier = F.col("loyalty_tier")
    changed = u.filter(num % 4 == 0).withColumns({
        "loyalty_tier": F.when(tier == "Gold", "Bronze").when(tier == "Bronze", "Silver").when(tier == "Silver", "Gold"),
        "location": F.when(num % 5 == 0, "MOVED").otherwise(F.col("location"))})
    _redelivered(spark, root, [u, changed, u.filter(num % 8 == 0)], 4,
                 lambda s: drivers.loyalty_signed_stream(s, ["_delivery"], f"{root}/deltas", f"{root}/ckpt"))
    return drivers.read_loyalty_signed(spark, f"{root}/deltas")


@query("device_stream")
def q_device_stream(spark, d):
    """K4/H2: the device report's branches fed by a stream of event files."""
    root = work_path(spark, "device", fresh=True)
    stream = _streamed(spark, dt.behavior_events(spark, d), root, 6, "_pos")
    drivers.run(lambda: drivers.device_stream(spark, stream, f"{root}/deltas", f"{root}/ckpt", full=True))
    return drivers.read_device(spark, f"{root}/deltas")


@query("report_backfill")
def q_report_backfill(spark, d):
    """The sales report table declared empty, then built from all
    history as its next version, partitioned by year."""
    path = f"{work_path(spark, 'backfill', fresh=True)}/sales_daily"
    year = F.year("report_date").alias("year")
    report = reports.sales_daily(dt.orders(spark, d)).select("*", year)
    tables.reset_table(spark, path, report.schema)
    tables.write_version(report, path, partition_by=["year"])
    return tables.read_version(spark, path, report.schema).drop("year")


@query("stream_static_top_products")
def q_stream_static_top_products(spark, d):
    """Cart events streamed in micro-batches, each joined with the product
    table as it is then.  At first a third of the products is unknown and some
    carry an old name; some have no attributes at all.  The carts of unknown
    products wait until the table knows them."""
    root = work_path(spark, "topprod", fresh=True)
    num = fc.id_number("product_id")
    bare = num % 11 == 0
    now = dt.products(spark, d)
    now = now.withColumns({c: F.when(~bare, F.col(c)) for c in ("name", "price", "category")})
    now.write.parquet(f"{root}/products_1")
    now.filter(num % 3 != 0).withColumn("name", F.when(num % 5 == 0, F.lit("old name")).otherwise(F.col("name"))) \
        .write.parquet(f"{root}/products_0")
    cart = dt.cart_events(spark, d).drop("_pos")
    for version, part in enumerate((F.col("cart_total_items") <= 3, F.col("cart_total_items") > 3)):
        stream = _streamed(spark, cart.filter(part), root, 3)
        drivers.run(lambda v=version, s=stream: drivers.top_products_stream(
            spark, s, lambda: spark.read.parquet(f"{root}/products_{v}"), f"{root}/deltas", f"{root}/ckpt"))
    return drivers.read_top_products(spark, f"{root}/deltas", spark.read.parquet(f"{root}/products_1"))


@query("exact_report_stream")
def q_exact_report_stream(spark, d):
    """K7/B10 exact mode: event files arrive in an order unrelated to time
    (every micro-batch holds events of many days, i.e. late data), and every
    event is delivered twice, in different batches; each batch recomputes only
    the days it touched from the last deliveries in the store."""
    root = work_path(spark, "exact", fresh=True)
    ev = dt.behavior_events(spark, d)
    for i in range(2):
        stream = _streamed(spark, ev, root, 4, "_pos")
        drivers.run(lambda s=stream: drivers.funnel_exact_stream(spark, s, f"{root}/store", f"{root}/report", f"{root}/ckpt"))
    return drivers.read_exact_report(spark, f"{root}/report")


@query("top_products_exact")
def q_top_products_exact(spark, d):
    """R2/Q1: top products over last-wins cart rows: every line delivered
    twice, the second time with another quantity."""
    cart = dt.cart_events(spark, d)
    first = cart.withColumn("quantity", F.col("quantity") + 1).withColumn("_batch", F.lit(0))
    both = first.unionByName(cart.withColumn("_batch", F.lit(1)))
    last = merge.latest_by_key(both, ["session_id", "cart_total_items"], ["_batch", "_pos"])
    return reports.top_products(last, dt.products(spark, d))


@query("device_usage_full")
def q_device_usage_full(spark, d):
    """R5 report table with checkout starts and payment attempts counted
    (the source leaves both at 0)."""
    return reports.device_usage_table(dt.behavior_events(spark, d), full=True)


@query("duplicate_key_report")
def q_duplicate_key_report(spark, d):
    """Keys delivered more than once (cart lines before last-wins)."""
    cart = dt.cart_events(spark, d).withColumn(
        "line_key", F.concat_ws("#", "session_id", F.col("cart_total_items").cast("string")))
    return clean.duplicate_keys(cart, "line_key")


@query("message_schema_check")
def q_message_schema_check(spark, d):
    """Rows that would violate the message schema before publishing, for
    the three tables: users without e-mail, products without a name, orders
    without an id."""
    raw = clean.normalise_header(dt.raw_users(spark, d))
    users = envelope.missing_required(raw.select("user_id", "name", "email"), "users")
    p = dt.products(spark, d).withColumn("name", F.when(F.col("inventory") % 9 != 0, F.col("name")))
    products = envelope.missing_required(p, "products")
    o = dt.orders(spark, d).withColumn("row", F.col("order_id")) \
        .withColumn("order_id", F.when(fc.id_number("order_id") % 8 != 0, F.col("order_id")))
    orders = envelope.missing_required(o, "orders")
    return (users.select(F.lit("users").alias("table_name"), F.col("user_id").alias("row"), "reason")
            .unionByName(products.select(F.lit("products").alias("table_name"), F.col("product_id").alias("row"), "reason"))
            .unionByName(orders.select(F.lit("orders").alias("table_name"), "row", "reason")))


@query("domain_findings")
def q_domain_findings(spark, d):
    """Values outside their domain, missing keys and keys that repeat, in
    the raw tables; counted per table, column and finding."""
    out = None
    for table in ("users", "products", "orders"):
        f = clean.findings(clean.normalise_header(_RAW[table](spark, d)), table)
        out = f if out is None else out.unionByName(f)
    return out


@query("run_summary")
def q_run_summary(spark, d):
    """Per source file, lines stored and rejected, from one validation."""
    checked = ev_ops.check_lines(dt.raw_event_lines(spark, d))
    outcome = F.when(F.col("reason").isNull(), F.lit("stored")).otherwise(F.lit("rejected"))
    return checked.groupBy("source_file", outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("publish_since_cursor")
def q_publish_since_cursor(spark, d):
    """Two exports of the orders table to a file topic, each
    publishing ids above the stored cursor and then advancing it (after the
    sink committed, by what the topic holds).  The first export sees the orders
    placed before 1998, the second the whole table; as in the source system, a
    late order with a lower id than the cursor is never published.  Result:
    what the topic holds, with the export that delivered it."""
    root = work_path(spark, "export", fresh=True)
    topics, cursors, topic = f"{root}/topics", f"{root}/cursors", TABLE_TOPICS["orders"]
    o = dt.orders(spark, d)
    snapshots = [o.filter(F.col("created_at") < F.lit("1998-01-01").cast("timestamp")), o]
    for batch_id, table in enumerate(snapshots):
        todo = scan_since(table, "order_id", state.read_cursor(spark, cursors, "orders"))
        publish(envelope.encode(todo, "order_id", ORDER_SCHEMA_ID, columns=o.columns), topic, root=topics, batch_id=batch_id)
        sent = topic_source(spark, topic, root=topics).filter(F.col("batch_id") == batch_id)
        state.advance_cursor(spark, cursors, "orders", sent.select(fc.id_number("key").alias("id_num")), "id_num")
    rows, _ = landing.decode_master(topic_source(spark, topic, root=topics), "orders")
    return rows.select("order_id", "batch_id")


@query("load_orders_job")
def q_load_orders_job(spark, d):
    """The CSV load job run three times.  The first drop
    has every order.  The second has changed rows, keys twice, orphans, a
    surplus column, an all-blank row and rows without key; its folders are read
    in the order of their names, so the later change of a key wins.  The third
    run finds no changed file."""
    root = work_path(spark, "load", fresh=True)
    num = fc.id_number("order_id")
    raw = dt.raw_orders(spark, d)
    users = dt.users(spark, d)
    raw.write.option("header", True).csv(f"{root}/in/1")
    load.load_table(spark, f"{root}/in", "orders", f"{root}/orders", f"{root}/marks", f"{root}/rejects", users=users)
    extra = F.lit("surplus").alias("note")
    second = raw.filter(num % 4 == 0).withColumn("total", F.lit("1.25")).select("*", extra)
    again = raw.filter(num % 12 == 0).withColumn("total", F.lit("2.50")).select("*", extra)
    orphan = raw.filter(num % 10 == 0).withColumn("order_id", F.concat(F.lit("o9"), num.cast("string"))).withColumn("user_id", F.lit("u-none")).select("*", extra)
    blank = raw.limit(1).select(*[F.lit(None).cast("string").alias(c) for c in raw.columns], F.lit(None).cast("string").alias("note"))
    keyless = raw.filter(num % 14 == 0).withColumn("order_id", F.lit(None).cast("string")).select("*", extra)
    for o, part in enumerate((second, again, orphan, blank, keyless)):
        part.write.option("header", True).csv(f"{root}/in/2/{o}")
    for _ in range(2):
        load.load_table(spark, f"{root}/in", "orders", f"{root}/orders", f"{root}/marks", f"{root}/rejects", users=users)
    return load.read_table(spark, "orders", f"{root}/orders", f"{root}/marks")


@query("export_changes")
def q_export_changes(spark, d):
    """Q5 fix: products stored at merge version 0, the price feed upserted
    as version 1; the change export after version 0 returns exactly the
    inserted or updated products, whatever their ids."""
    from shopflow.sources.cursor import scan_changes
    target = dt.products(spark, d).withColumn("_version", F.lit(0).cast("bigint"))
    feed = price_feed(spark, d).select("product_id", "price", "_pos")
    merged = merge.upsert(target, feed, "product_id", order="_pos", version=1)
    return scan_changes(merged, 0).select("product_id", "price", "_version")


@query("cart_items_clean")
def q_cart_items_clean(spark, d):
    """cart_view events with nested item arrays validated per element
    (any bad item rejects the event, defaults filled), items exploded."""
    valid, _ = ev_ops.validate_events(dt.raw_cart_view_lines(spark, d), with_line_numbers=False)
    return valid.select("session_id", F.posexplode("event_data.cart_items").alias("item_pos", "item")).select(
        "session_id", "item_pos", "item.product_id", "item.price", "item.quantity")
