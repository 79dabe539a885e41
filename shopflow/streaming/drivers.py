"""Structured Streaming drivers.

Every driver is a ``readStream`` -> ``foreachBatch`` query with a checkpoint
in the shared folder, run with ``trigger(availableNow=True)`` for scheduled
catch-up runs or a processing-time trigger for continuous service.

Exactly-once effects without a table format: each micro-batch writes its own
``batch_id=<n>`` partition with dynamic partition overwrite, so a batch that
is replayed after a failure replaces its own output instead of adding to it.
Landing tables are append logs read with last-wins (``read_landing``), the
way a replacing table merges parts; additive reports are delta logs summed at
read time.  Batches are bounded by ``maxFilesPerTrigger``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from shopflow.operators import events as ev_ops
from shopflow.operators.merge import insert_if_absent, latest_by_key, signed_changes
from shopflow.plans import landing, reports
from shopflow.schemas import DEVICE_COUNTS, FUNNEL_COUNTS, LANDING_MASTER, PRIMARY_KEYS
from shopflow.sinks import keyed, state
from shopflow.sinks.tables import read_appended
from shopflow.sources.files import add_row_id, delete_path, incomplete_files, list_folders, make_folder, path_exists, text_lines
from shopflow.sources.topics import topic_source

#: Files that one micro-batch takes, unless the caller says otherwise: the
#: first catch-up run must not take a whole backlog as one batch.
FILES_PER_TRIGGER = 1000


def write_batch(df: DataFrame, path: str, batch_id: int, partition_by: tuple[str, ...] = ()) -> None:
    """Idempotent batch write: (re)places all that the batch wrote before.

    ``partition_by`` columns come outermost, so readers prune them before they
    meet the batches; rows are regrouped by them first (in pieces that AQE
    sizes), so a batch writes few files per partition.  An overwrite replaces
    only partitions that have rows again, so a batch that was begun before (its
    mark is there) first drops what it left.
    """
    spark = df.sparkSession
    begun = f"{path}/_begun/{batch_id}"
    if path_exists(spark, begun):
        for folder in list_folders(spark, "/".join([path, *(f"{c}=*" for c in partition_by), f"batch_id={batch_id}"])):
            delete_path(spark, folder)
    else:
        make_folder(spark, begun)
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    (df.withColumn("batch_id", F.lit(batch_id).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition_by, "batch_id").parquet(path))


def _started(stream: DataFrame, handle, checkpoint: str, available_now: bool) -> StreamingQuery:
    w = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    return w.start()


def delivery_log(query: StreamingQuery) -> list[dict]:
    """Per micro-batch of a running query, how many rows came in and how long
    it took (from its last progress reports; ``read_deliveries`` has them all)."""
    return [{"batch_id": p["batchId"], "rows": p["numInputRows"],
             "duration_ms": p.get("durationMs", {}).get("triggerExecution")}
            for p in query.recentProgress]


def _delivery(batch: dict[str, DataFrame]) -> DataFrame:
    """(outcome, n), the rows of each outcome of one batch."""
    out = None
    for outcome, df in batch.items():
        n = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(outcome).alias("outcome"), "n")
        out = n if out is None else out.unionAll(n)
    return out


def read_deliveries(spark: SparkSession, store: str) -> DataFrame:
    """(batch_id, outcome, n) of every micro-batch of an ingest."""
    return spark.read.parquet(f"{store}_deliveries").select("batch_id", "outcome", "n")


def run(query_builder: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Start a query and wait for it (availableNow queries stop by themselves)."""
    q = query_builder()
    q.awaitTermination()
    return q


# -- A3/K5/B2/B3/B4: session files -> event store --------------------------------------

def session_file_stream(spark: SparkSession, folder: str, glob: str = "*.json",
                        max_files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    """New session files only: the file source remembers processed files in
    its checkpoint (a changed file under a known name is not re-read)."""
    r = (spark.readStream.format("text").option("pathGlobFilter", glob).option("ignoreCorruptFiles", "true")
         .option("maxFilesPerTrigger", max_files_per_trigger))
    return text_lines(r.load(folder), with_row=False)


def ingest_sessions(spark: SparkSession, folder: str, store: str, ledger: str, checkpoint: str,
                    glob: str = "*.json", max_files_per_trigger: int = FILES_PER_TRIGGER,
                    available_now: bool = True) -> StreamingQuery:
    """Validate new session files and store their events, first row wins per
    (event_type, timestamp, session_id) against everything already stored.

    The store is partitioned by ``event_type`` (B3), ``event_date`` and ``batch_id``; the
    ledger gets one row per file with the rows stored from it (B4), by batch as well.
    Rejects go to ``<store>_rejects`` with file and line; files that could not be read to
    their end are skipped from there on and listed in ``<store>_incomplete`` (N2).
    ``<store>_deliveries`` counts the outcomes of each batch (N5).
    """
    # event_date is derived from timestamp, so adding it to the key changes
    # nothing semantically; as a partition column it lets each batch read only
    # the stored days it touches instead of every stored key.
    keys = ["event_type", "event_date", "timestamp", "session_id"]

    def handle(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(spark, batch, batch_id, store, ledger, keys)

    return _started(session_file_stream(spark, folder, glob, max_files_per_trigger), handle, checkpoint, available_now)


def ingest_batch(spark: SparkSession, batch: DataFrame, batch_id: int, store: str, ledger: str, keys: list[str]) -> None:
    """One micro-batch of ``ingest_sessions``; running it again replaces its own output."""
    # read the files of the micro-batch once (several actions follow); the
    # batch is bounded by maxFilesPerTrigger, but its files may be large, so
    # what is kept lies on disk, and of valid lines without their text
    lines = add_row_id(batch).persist(StorageLevel.DISK_ONLY)
    checked = ev_ops.check_lines(lines).withColumn("value", F.when(F.col("reason").isNotNull(), F.col("value"))) \
        .persist(StorageLevel.DISK_ONLY)  # validated once, split twice
    valid, rejects = ev_ops.split_checked(checked, lines)
    valid = valid.drop("_seq").withColumn("event_date", F.to_date("timestamp"))
    schema = T.StructType(valid.schema.fields + [T.StructField("batch_id", T.LongType())])
    # rows of this batch id itself are being replaced, not deduplicated against
    stored = read_appended(spark, store, schema).filter(F.col("batch_id") != batch_id).select(*keys)
    # only the stored days that the batch touches
    stored = stored.join(valid.select("event_date").distinct(), "event_date", "left_semi")
    new = insert_if_absent(stored, valid, keys, ev_ops.event_order()).persist(StorageLevel.DISK_ONLY)
    write_batch(new, store, batch_id, ("event_type", "event_date"))
    write_batch(rejects.drop("_seq"), f"{store}_rejects", batch_id)
    write_batch(incomplete_files(lines), f"{store}_incomplete", batch_id)
    outcomes = {"read": lines, "valid": valid, "stored": new, "rejected": rejects}
    write_batch(_delivery(outcomes), f"{store}_deliveries", batch_id)
    write_batch(state.ledger_rows(lines, new.select("ingestion.source_file")), ledger, batch_id)
    for df in (new, checked, lines):
        df.unpersist()


def read_store(spark: SparkSession, store: str) -> DataFrame:
    return spark.read.parquet(store)


# -- K1/K2/B9: topic -> landing log ---------------------------------------------------

def land_stream(spark: SparkSession, topic: str, kind: str, log: str, checkpoint: str, root: str | None,
                name: str, max_files_per_trigger: int = FILES_PER_TRIGGER,
                available_now: bool = True, backend: str = "files", servers: str | None = None) -> StreamingQuery:
    """Decode every micro-batch of a topic into a landing log: ``kind`` is
    ``"master"`` (``name`` = users / products / orders) or ``"event"``
    (``name`` = the event type).  Rejected messages go to ``<log>_rejects``."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows, rejects = landing.decode_master(batch, name) if kind == "master" else landing.decode_events(batch, name)
        write_batch(rows.withColumnRenamed("batch_id", "delivery_batch"), log, batch_id)
        write_batch(rejects.withColumnRenamed("batch_id", "delivery_batch"), f"{log}_rejects", batch_id)

    src = topic_source(spark, topic, backend=backend, root=root, stream=True, servers=servers,
                       max_files_per_trigger=max_files_per_trigger)
    return _started(src, handle, checkpoint, available_now)


def land_topics_stream(spark: SparkSession, topics: dict[str, tuple[str, str]], logs: str, checkpoint: str, root: str | None,
                       max_files_per_trigger: int = FILES_PER_TRIGGER, available_now: bool = True, backend: str = "files",
                       servers: str | None = None) -> StreamingQuery:
    """One stream over many topics, each landed in its own log ``<logs>/<name>``
    (see ``land_stream``).  ``topics``: topic -> (kind, name).  A micro-batch is
    read once; only the logs of topics that it has messages of are written."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        for topic in sorted(r["topic"] for r in batch.select("topic").distinct().collect()):  # of the given few
            kind, name = topics[topic]
            messages = batch.filter(F.col("topic") == topic)
            rows, rejects = landing.decode_master(messages, name) if kind == "master" else landing.decode_events(messages, name)
            write_batch(rows.withColumnRenamed("batch_id", "delivery_batch"), f"{logs}/{name}", batch_id)
            write_batch(rejects.withColumnRenamed("batch_id", "delivery_batch"), f"{logs}/{name}_rejects", batch_id)
        batch.unpersist()

    src = topic_source(spark, sorted(topics), backend=backend, root=root, stream=True, servers=servers, max_files_per_trigger=max_files_per_trigger)
    return _started(src, handle, checkpoint, available_now)


def read_landing(spark: SparkSession, log: str, keys: list[str]) -> DataFrame:
    """Last delivered row per key over the landing log (read-time merge)."""
    df = spark.read.parquet(log)
    order = F.struct("delivery_batch", "partition", "offset")
    body = df.withColumn("_d", order).drop("batch_id", "delivery_batch", "partition", "offset")
    return latest_by_key(body, keys, "_d").drop("_d")


#: Buckets of a bucketed landing log.
LOG_BUCKETS = 16


def bucketed_log(spark: SparkSession, path: str, schema: T.StructType, keys: list[str], buckets: int = LOG_BUCKETS) -> str:
    """The name of the table over a log in key buckets, declared if this session
    has not; its partitions are the batches."""
    name = "log_" + hashlib.md5(path.encode()).hexdigest()[:16]
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    by = ", ".join(f"`{k}`" for k in keys)
    make_folder(spark, path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, batch_id BIGINT) USING parquet PARTITIONED BY (batch_id) "
              f"CLUSTERED BY ({by}) INTO {buckets} BUCKETS LOCATION '{path}'")
    spark.catalog.recoverPartitions(name)
    return name


def _log_schema(table: str) -> T.StructType:
    return T.StructType([*LANDING_MASTER[table].fields, T.StructField("delivery_batch", T.LongType()), T.StructField("partition", T.IntegerType()),
                         T.StructField("offset", T.LongType())])


def land_bucketed_stream(spark: SparkSession, topic: str, table: str, log: str, checkpoint: str, root: str | None,
                         max_files_per_trigger: int = FILES_PER_TRIGGER, available_now: bool = True, buckets: int = LOG_BUCKETS) -> StreamingQuery:
    """As ``land_stream`` for a table topic, into a log bucketed by its key: what
    a batch shuffles once when it is written, no read shuffles again."""
    schema, keys = _log_schema(table), [PRIMARY_KEYS[table]]

    def handle(batch: DataFrame, batch_id: int) -> None:
        rows, rejects = landing.decode_master(batch, table)
        name = bucketed_log(spark, log, schema, keys, buckets)
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (batch_id = {batch_id})")
        delete_path(spark, f"{log}/batch_id={batch_id}")  # of an earlier attempt
        (rows.withColumnRenamed("batch_id", "delivery_batch").select(*schema.fieldNames(), F.lit(batch_id).cast("bigint").alias("batch_id"))
         .repartition(buckets, *keys).write.mode("append").insertInto(name))
        write_batch(rejects.withColumnRenamed("batch_id", "delivery_batch"), f"{log}_rejects", batch_id)

    return _started(topic_source(spark, topic, root=root, stream=True, max_files_per_trigger=max_files_per_trigger), handle, checkpoint, available_now)


def read_bucketed_landing(spark: SparkSession, table: str, log: str, buckets: int = LOG_BUCKETS) -> DataFrame:
    """Last delivered row per key; the buckets are already apart."""
    keys = [PRIMARY_KEYS[table]]
    df = spark.table(bucketed_log(spark, log, _log_schema(table), keys, buckets))
    body = df.withColumn("_d", F.struct("delivery_batch", "partition", "offset")).drop("batch_id", "delivery_batch", "partition", "offset")
    return latest_by_key(body, keys, "_d").drop("_d")


EVENT_KEYS = ["user_id", "session_id", "timestamp"]


# -- K4/B8/B10: additive reports ---------------------------------------------------------

def delta_stream(rows: DataFrame, parts: dict[str, Callable[[DataFrame], DataFrame]], path: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Additive reports: each micro-batch writes, per part, its own delta rows
    to ``<path>/<part>``; the dashboards sum them (``read_deltas``)."""

    def handle(batch: DataFrame, batch_id: int) -> None:
        if len(parts) > 1:
            batch = batch.persist()
        for name, delta in parts.items():
            write_batch(delta(batch), f"{path}/{name}", batch_id)
        batch.unpersist()

    return _started(rows, handle, checkpoint, available_now)


def read_deltas(spark: SparkSession, path: str, part: str = "sums") -> DataFrame:
    return spark.read.parquet(f"{path}/{part}").drop("batch_id")


def funnel_stream(spark: SparkSession, events: DataFrame, deltas: str, checkpoint: str,
                  available_now: bool = True) -> StreamingQuery:
    """Funnel report as a summing table: each micro-batch appends its delta
    rows (five branches, as the source's views do) from one pass."""
    return delta_stream(events, {"sums": reports.funnel_deltas}, deltas, checkpoint, available_now)


def sales_stream(spark: SparkSession, orders: DataFrame, deltas: str, checkpoint: str,
                 available_now: bool = True) -> StreamingQuery:
    """Daily sales: counts and revenue add up; purchasing users are kept as
    (day, user) pairs and counted when read, never summed (Q2)."""
    parts = {"sums": reports.sales_deltas, "pairs": reports.sales_daily_pairs}
    return delta_stream(orders, parts, deltas, checkpoint, available_now)


def read_sales(spark: SparkSession, deltas: str) -> DataFrame:
    return reports.sales_from_parts(read_deltas(spark, deltas), read_deltas(spark, deltas, "pairs"))


def loyalty_stream(spark: SparkSession, users: DataFrame, deltas: str, checkpoint: str,
                   available_now: bool = True) -> StreamingQuery:
    parts = {"sums": lambda batch: reports.loyalty_segments(batch, ordered=False)}
    return delta_stream(users, parts, deltas, checkpoint, available_now)


def read_loyalty(spark: SparkSession, deltas: str) -> DataFrame:
    return read_deltas(spark, deltas).groupBy("location", "loyalty_tier").agg(F.sum("user_count").cast("bigint").alias("user_count"))


def device_stream(spark: SparkSession, events: DataFrame, deltas: str, checkpoint: str, full: bool = False,
                  available_now: bool = True) -> StreamingQuery:
    parts = {"sums": lambda batch: reports.device_usage_table(batch, full)}
    return delta_stream(events, parts, deltas, checkpoint, available_now)


def read_device(spark: SparkSession, deltas: str) -> DataFrame:
    return read_deltas(spark, deltas).groupBy("device").agg(*[F.sum(c).cast("bigint").alias(c) for c in DEVICE_COUNTS])


def read_funnel(spark: SparkSession, deltas: str) -> DataFrame:
    d = read_deltas(spark, deltas)
    keep = d.filter(F.greatest(*[F.col(c) for c in FUNNEL_COUNTS]) > 0)
    return reports.funnel_from_deltas(keep)


# -- K4/K6/K7: aggregates kept in the state store ---------------------------------------------

#: Settings of a stateful query: RocksDB holds the state on disk, and a batch checkpoints only what it changed.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
               "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true"}


@contextmanager
def state_store(spark: SparkSession):
    """The settings above for queries that are started inside; they keep them."""
    before = {k: spark.conf.get(k, None) for k in STATE_STORE}
    for k, v in STATE_STORE.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def funnel_state_stream(spark: SparkSession, events: DataFrame, out: str, checkpoint: str, watermark: str = "60 days",
                        available_now: bool = True) -> StreamingQuery:
    """The daily funnel as a stateful aggregation: the running counts of each
    day live in the state store, a micro-batch writes those of the days that it
    touched, and no stored row is read again.  Days that the watermark has
    passed leave the state; events later than that are dropped, so it has to
    cover how late events come."""
    days = reports.funnel_counts(events.withWatermark("timestamp", watermark), F.window("timestamp", "1 day").alias("_day")) \
        .select(F.to_date("_day.start").alias("report_date"), *FUNNEL_COUNTS)
    w = (days.writeStream.outputMode("update").foreachBatch(lambda batch, batch_id: write_batch(batch, out, batch_id))
         .option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="30 seconds")
    with state_store(spark):
        return w.start()


def read_funnel_state(spark: SparkSession, out: str) -> DataFrame:
    """The last counts of each day, and the rates."""
    last = latest_by_key(spark.read.parquet(out), ["report_date"], "batch_id").drop("batch_id")
    return reports.with_funnel_rates(last.filter(F.greatest(*FUNNEL_COUNTS) > 0))


# -- E4: mergeable sketches of distinct users ----------------------------------------------------

def user_sketch_stream(orders: DataFrame, deltas: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Per micro-batch, a sketch of each day's purchasing users beside the exact
    (day, user) pairs: sketches of a fixed size unite over batches, or over days
    for a week, without the users."""
    return delta_stream(orders, {"sketches": reports.user_sketches, "pairs": reports.sales_daily_pairs}, deltas, checkpoint, available_now)


# -- B10/K4: reports under updates ---------------------------------------------------------

def signed_batch(batch: DataFrame, batch_id: int, keys: list[str], order: list[str], parts: dict[str, Callable[[DataFrame], DataFrame]],
                 path: str, buckets: int = keyed.BUCKETS) -> None:
    """One micro-batch of ``signed_stream``; running it again replaces its own output.

    The stored row of a key that comes again counts negative, the new one
    positive, so the deltas of a changed row add up to its change.  Only the
    buckets of the batch's keys are read and rewritten.
    """
    spark = batch.sparkSession
    new = latest_by_key(batch, keys, order).select(*[c for c in batch.columns if c not in order or c in keys]).persist()
    hit = keyed.touched(new, keys, buckets)
    old = keyed.read(spark, f"{path}/rows", new.schema, before=batch_id, buckets=hit, n=buckets)
    signed = signed_changes(old, new, keys).persist()
    for name, delta in parts.items():
        write_batch(delta(signed), f"{path}/{name}", batch_id)
    keyed.write(old.join(new.select(*keys), keys, "left_anti").unionByName(new), f"{path}/rows", keys, batch_id, buckets)
    keyed.vacuum(spark, f"{path}/rows", batch_id, buckets)
    signed.unpersist()
    new.unpersist()


def signed_stream(rows: DataFrame, keys: list[str], order: list[str], parts: dict[str, Callable[[DataFrame], DataFrame]], path: str,
                  checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Summing reports over rows that are delivered again with other values:
    the last delivery of a key counts (within a micro-batch the last by
    ``order``).  Each part sums the rows' ``_sign`` instead of counting them."""
    return _started(rows, lambda batch, batch_id: signed_batch(batch, batch_id, keys, order, parts, path), checkpoint, available_now)


SALES_SIGNED = {"sums": reports.sales_signed_deltas, "pairs": reports.sales_signed_pairs}
LOYALTY_SIGNED = {"sums": reports.loyalty_signed_deltas}


def sales_signed_stream(orders: DataFrame, order: list[str], path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Daily sales of orders whose status, day, user or total may change."""
    return signed_stream(orders, ["order_id"], order, SALES_SIGNED, path, checkpoint, available_now)


def read_sales_signed(spark: SparkSession, path: str) -> DataFrame:
    return reports.sales_from_signed(read_deltas(spark, path), read_deltas(spark, path, "pairs"))


def loyalty_signed_stream(users: DataFrame, order: list[str], path: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Loyalty segments of users who move or change tier."""
    return signed_stream(users, ["user_id"], order, LOYALTY_SIGNED, path, checkpoint, available_now)


def read_loyalty_signed(spark: SparkSession, path: str) -> DataFrame:
    return reports.loyalty_from_signed(read_deltas(spark, path))


# -- D5: stream-static join -------------------------------------------------------------

PENDING = T.StructType([T.StructField("product_id", T.StringType()), T.StructField("total_quantity", T.LongType()),
                        T.StructField("add_to_cart_count", T.LongType()), T.StructField("batch_id", T.LongType())])


def top_products_batch(batch: DataFrame, batch_id: int, products: Callable[[], DataFrame], deltas: str) -> None:
    """One micro-batch of ``top_products_stream``; running it again replaces
    its own output, also where a product that was waited for has come since."""
    before = read_appended(batch.sparkSession, f"{deltas}_pending", PENDING).filter(F.col("batch_id") == batch_id - 1)
    totals = (batch.groupBy("product_id")
              .agg(F.sum("quantity").cast("bigint").alias("total_quantity"),
                   F.count(F.lit(1)).alias("add_to_cart_count"))
              .unionByName(before.drop("batch_id"))
              .groupBy("product_id").agg(F.sum("total_quantity").alias("total_quantity"),
                                         F.sum("add_to_cart_count").alias("add_to_cart_count")))
    p = products().select("product_id", "name", "category", "price", F.lit(True).alias("_known"))
    joined = totals.join(p, "product_id", "left").persist()
    out = joined.filter("_known").select(
        "product_id", F.col("name").alias("product_name"),
        F.coalesce("category", F.lit("Unknown")).alias("category"), "total_quantity", "add_to_cart_count",
        (F.col("total_quantity").cast("decimal(20,0)") * F.coalesce("price", F.lit(0)))
        .alias("estimated_revenue"))
    write_batch(out, deltas, batch_id)
    write_batch(joined.filter(F.col("_known").isNull()).select("product_id", "total_quantity", "add_to_cart_count"),
                f"{deltas}_pending", batch_id)
    joined.unpersist()


def top_products_stream(spark: SparkSession, carts: DataFrame, products: Callable[[], DataFrame], deltas: str,
                        checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """Per micro-batch: carts aggregated per product, together with what
    earlier batches left pending, joined with the product table as it is when
    the batch runs (``products()`` is called per batch), appended as
    summing-table deltas.  Carts whose product is not known yet are the
    batch's pending rows (``<deltas>_pending``), taken up by the next batch.
    A known product may have no attributes at all: the match is marked, not
    guessed from them."""
    return _started(carts, lambda batch, batch_id: top_products_batch(batch, batch_id, products, deltas), checkpoint, available_now)


def read_top_products(spark: SparkSession, deltas: str, products: DataFrame | None = None) -> DataFrame:
    """Summed per (category, product), as the summing table is keyed; the name
    is that of the last batch, or the current one where ``products`` is given."""
    d = spark.read.parquet(deltas)
    out = (d.groupBy("product_id", "category")
           .agg(F.max_by("product_name", "batch_id").alias("product_name"),
                F.sum("total_quantity").cast("bigint").alias("total_quantity"),
                F.sum("add_to_cart_count").cast("bigint").alias("add_to_cart_count"),
                F.sum("estimated_revenue").cast("double").alias("estimated_revenue")))
    if products is not None:
        now = products.select("product_id", F.col("name").alias("_name"), F.lit(True).alias("_known"))
        out = out.join(now, "product_id", "left").withColumn(
            "product_name", F.when(F.col("_known"), F.col("_name")).otherwise(F.col("product_name"))).drop("_name", "_known")
    return out


# -- K6: stateful first-wins dedupe ---------------------------------------------------------

def dedupe_stream(stream: DataFrame, keys: list[str], event_time: str | None = None,
                  watermark: str | None = None) -> DataFrame:
    """First row per key in a stream.  With a watermark, state is bounded
    (``dropDuplicatesWithinWatermark``); without one the state keeps every
    key forever - prefer ``insert_if_absent`` against the store then."""
    if watermark and event_time:
        return stream.withWatermark(event_time, watermark).dropDuplicatesWithinWatermark(keys)
    return stream.dropDuplicates(keys)


# -- K7/B10 exact: recompute touched dates ------------------------------------------------

def exact_stream(spark: SparkSession, rows: DataFrame, report_of: Callable[[DataFrame], DataFrame], keys: list[str],
                 store: str, report: str, checkpoint: str, available_now: bool = True) -> StreamingQuery:
    """A per-day report maintained exactly: late and re-delivered rows are
    handled, unlike summing deltas.

    Per micro-batch: the rows are appended to a store partitioned by day
    (idempotently, per batch id); the days the batch touches are recomputed
    from the whole store, where the last delivery of each key counts, and only
    those report partitions are overwritten (dynamic partition overwrite).
    """

    def handle(batch: DataFrame, batch_id: int) -> None:
        day = batch.withColumn("event_date", F.to_date("timestamp")).persist()
        write_batch(day, store, batch_id, ("event_date",))
        touched = day.select("event_date").distinct()
        hist = spark.read.parquet(store).join(touched, "event_date", "left_semi")
        last = latest_by_key(hist, keys, ["batch_id", *(["_pos"] if "_pos" in hist.columns else [])])
        out = report_of(last)
        (out.withColumn("day", F.col("report_date")).write.mode("overwrite")
         .option("partitionOverwriteMode", "dynamic").partitionBy("day").parquet(report))
        day.unpersist()

    return _started(rows, handle, checkpoint, available_now)


def funnel_exact_stream(spark: SparkSession, events: DataFrame, store: str, report: str, checkpoint: str,
                        available_now: bool = True) -> StreamingQuery:
    """Exact funnel: one event per (type, user, session, time)."""
    return exact_stream(spark, events, lambda e: reports.behavior_funnel_daily(e, ordered=False),
                        ["event_type", "user_id", "session_id", "timestamp"], store, report, checkpoint, available_now)


def read_exact_report(spark: SparkSession, report: str) -> DataFrame:
    return spark.read.parquet(report).drop("day")
