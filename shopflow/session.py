"""Session settings the engine relies on, and the shared work folder."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import SparkSession

# Settings every shopflow job assumes: UTC everywhere, ANSI casts
# (we use try_* where bad input is expected), AQE for runtime re-planning and
# skew splitting, dynamic partition overwrite for touched-key recomputes.
PINNED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # Repeated keys of a JSON object: the last one counts, as in the source system.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # A generated method over 8000 bytes of bytecode is never JIT-compiled by
    # the JVM; past that size whole-stage codegen falls back to per-operator
    # code, which compiles (large rule sets such as event validation).
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def pin_conf(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings shopflow needs to an existing session."""
    for key, value in PINNED_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(master: str | None = None, app: str = "shopflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with shopflow's settings.

    On a cluster leave ``master`` unset so spark-submit decides.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in PINNED_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    return pin_conf(spark)


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """Root of the shared folder for checkpoints and written tables.

    Read from ``spark.checkpoint.dir`` (the cluster names it).  Only a local
    session without the setting gets one of its own, as in tests; a cluster
    session without it is a configuration error, since a machine-local folder
    would not survive the loss of an executor.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        if not _is_local(spark):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: shopflow needs a shared folder "
                "for stream checkpoints and written tables")
        import tempfile  # one JVM, one machine: tests only
        root = tempfile.mkdtemp(prefix="shopflow-")
        spark.conf.set("spark.checkpoint.dir", root)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(os.path.join(root, "rdd"))
    return root.rstrip("/")


def work_path(spark: SparkSession, *parts: str, fresh: bool = False) -> str:
    """A path below the shared folder; ``fresh`` gives a new one of this run,
    for intermediate tables, which goes when the application ends."""
    root = f"{shared_dir(spark)}/shopflow"
    if not fresh:
        return "/".join([root, *parts])
    run = f"{root}/run-{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(run)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.mkdirs(path):
        fs.deleteOnExit(path)
    return "/".join([run, *parts, uuid.uuid4().hex[:12]])
