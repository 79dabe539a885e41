"""Streaming drivers: new files only, reruns and replays change nothing."""

import json
import os

from pyspark.sql import functions as F

from shopflow.streaming import drivers


def line(ts, session, et="order_complete", **payload):
    d = {"timestamp": ts, "user_id": "u1", "event_type": et, "device": "mobile", "session_id": session}
    d.update(payload)
    return json.dumps(d)


def write(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as fh:
        fh.write("\n".join(lines) + "\n")


def stored(spark, store):
    return sorted((r["event_type"], r["session_id"], r["event_data"]["order_id"])
                  for r in spark.read.parquet(store).collect())


def test_ingest_new_files_only(spark, tmp_dir):
    src, store, ledger, ckpt = (f"{tmp_dir}/in", f"{tmp_dir}/store", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt")
    write(src, "sessions_20250102_a.json", [line("2025-01-02T10:00:00Z", "s1", order_id="o1"),
                                             line("2025-01-02T10:00:00Z", "s1", order_id="o1-dup"),
                                             "{bad"])
    run = lambda: drivers.run(lambda: drivers.ingest_sessions(spark, src, store, ledger, ckpt))
    run()
    assert stored(spark, store) == [("order_complete", "s1", "o1")]  # first row wins
    run()  # rerun: nothing new
    assert stored(spark, store) == [("order_complete", "s1", "o1")]
    write(src, "sessions_20250102_a.json", [line("2025-01-02T11:00:00Z", "s9", order_id="changed")])
    write(src, "sessions_20250103_b.json", [line("2025-01-02T10:00:00Z", "s1", order_id="again"),
                                             line("2025-01-03T10:00:00Z", "s2", order_id="o2")])
    run()  # only the new file; its duplicate of a stored key is skipped; the changed old file is ignored
    assert stored(spark, store) == [("order_complete", "s1", "o1"), ("order_complete", "s2", "o2")]
    from shopflow.sinks.state import read_ledger
    led = sorted((r["file_name"], r["records_inserted"]) for r in read_ledger(spark, ledger).collect())
    assert led == [("sessions_20250102_a.json", 1), ("sessions_20250103_b.json", 1)]
    rej = spark.read.parquet(f"{store}_rejects").collect()
    assert [(r["source_file"], r["line"], r["reason"]) for r in rej] == [("sessions_20250102_a.json", 3, "Invalid JSON")]


def test_ingest_keeps_its_batch_on_disk(spark, tmp_dir, monkeypatch):
    """Files of any size may be in a batch: nothing of it is kept in executors' memory, and only rejects keep their line."""
    src, store = f"{tmp_dir}/in", f"{tmp_dir}/store"
    write(src, "sessions_20250102_a.json", [line("2025-01-02T10:00:00Z", "s1", order_id="o1"), "{bad"])
    spark.catalog.clearCache()
    levels, plain = [], drivers.write_batch

    def noted(*args, **kw):
        plain(*args, **kw)
        levels.extend(rdd.getStorageLevel() for rdd in spark.sparkContext._jsc.getPersistentRDDs().values())

    monkeypatch.setattr(drivers, "write_batch", noted)
    drivers.run(lambda: drivers.ingest_sessions(spark, src, store, f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt"))
    assert len(levels) >= 3 and all(x.useDisk() and not x.useMemory() for x in levels)
    assert [r["raw"] for r in spark.read.parquet(f"{store}_rejects").collect()] == ["{bad"]


def test_write_batch_replay_is_idempotent(spark, tmp_dir):
    path = f"{tmp_dir}/deltas"
    df = spark.createDataFrame([("2025-01-01", 2)], "report_date string, n long")
    drivers.write_batch(df, path, 0)
    drivers.write_batch(df, path, 1)
    drivers.write_batch(df, path, 1)  # replay of batch 1 after a failure
    assert spark.read.parquet(path).agg(F.sum("n")).first()[0] == 4


def test_delivery_log(spark, tmp_dir):
    src, store, ledger, ckpt = (f"{tmp_dir}/in", f"{tmp_dir}/store", f"{tmp_dir}/ledger", f"{tmp_dir}/ckpt")
    write(src, "a.json", [line("2025-01-02T10:00:00Z", "s1", order_id="o1")])
    q = drivers.run(lambda: drivers.ingest_sessions(spark, src, store, ledger, ckpt))
    log = drivers.delivery_log(q)
    assert sum(r["rows"] for r in log) == 1


def test_dedupe_stream_with_watermark(spark, tmp_dir):
    df = (spark.createDataFrame([("s1", "2025-01-01 10:00:00", 1), ("s1", "2025-01-01 10:00:00", 2),
                                 ("s2", "2025-01-01 10:00:01", 3)], "session_id string, ts string, v int")
          .withColumn("ts", F.col("ts").cast("timestamp")))
    df.write.parquet(f"{tmp_dir}/src")
    stream = spark.readStream.schema(df.schema).parquet(f"{tmp_dir}/src")
    out = drivers.dedupe_stream(stream, ["session_id", "ts"], event_time="ts", watermark="1 hour")
    q = (out.writeStream.format("memory").queryName("dedupe_wm").outputMode("append")
         .option("checkpointLocation", f"{tmp_dir}/ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert sorted(r["session_id"] for r in spark.table("dedupe_wm").collect()) == ["s1", "s2"]
