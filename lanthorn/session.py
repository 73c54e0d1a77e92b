"""Session helpers: one place for the settings every job relies on."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "lanthorn") -> SparkSession:
    """Create (or reuse) a session with ANSI on, UTC, AQE and no UI."""
    master = master or os.environ.get("LANTHORN_MASTER", "local[8]")
    parts = shuffle_partitions or int(os.environ.get("LANTHORN_SHUFFLE_PARTITIONS", "8"))
    spark = (
        SparkSession.builder.master(master).appName(app_name)
        .config("spark.sql.shuffle.partitions", str(parts))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("LANTHORN_DRIVER_MEMORY", "16g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.execution.arrow.maxRecordsPerBatch", "4096")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder named by ``spark.checkpoint.dir``.

    On a cluster the folder must be set by whoever runs the job (a shared
    file system or object store).  Only a local master gets a scratch
    folder of its own when the setting is missing, as in tests.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="lanthorn-ckpt-", dir="/tmp")
    spark.conf.set("spark.checkpoint.dir", folder)
    sc.setCheckpointDir(folder)
    return folder


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark)
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def max_broadcast_bytes(spark: SparkSession) -> int:
    """The size bound a side must stay under to be broadcast."""
    raw = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    raw = str(raw).strip().lower()
    mult = 1
    for suffix, m in (("kb", 1 << 10), ("mb", 1 << 20), ("gb", 1 << 30), ("k", 1 << 10),
                      ("m", 1 << 20), ("g", 1 << 30), ("b", 1)):
        if raw.endswith(suffix):
            raw, mult = raw[: -len(suffix)], m
            break
    value = int(float(raw) * mult)
    return value if value > 0 else 10 << 20


def small_side(df: DataFrame) -> DataFrame:
    """``df`` with a broadcast hint if its size, checked here, stays under the session's bound.

    The size is the checked row count times the row width that the schema
    implies (strings and arrays taken at 64 bytes).  A larger side comes
    back as it is and is joined by shuffling.
    """
    def width(kind) -> int:
        return {"boolean": 1, "byte": 1, "short": 2, "integer": 4, "float": 4, "date": 4}.get(
            kind.typeName(), 8 if kind.typeName() in ("long", "double", "timestamp") else 64)

    row = 16 + sum(width(f.dataType) for f in df.schema.fields)
    bound = max(max_broadcast_bytes(df.sparkSession) // row, 1)
    return F.broadcast(df) if df.limit(bound + 1).count() <= bound else df


def spread(df: DataFrame) -> DataFrame:
    """Spread a frame read as few partitions over the cluster's task slots.

    A file stored as one row group is scanned by one task; CPU-heavy
    per-row work after it (tokenising, HTML parsing) would then run on one
    core.  When the frame has fewer partitions than the default
    parallelism it is repartitioned round robin (deterministic on retry:
    Spark sorts before a round-robin exchange).  A frame already split
    across the cluster, as any large table is, is returned unchanged.

    Call it on a frame straight off a scan (filters and projections are
    fine): counting the partitions of a plan that holds a shuffle would
    run that shuffle's stages first.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < slots:
        return df.repartition(slots)
    return df
