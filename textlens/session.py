"""Session helpers: builder defaults for tests/bench and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession


def get_spark(master: str | None = None, shuffle_partitions: int | None = None, app: str = "textlens") -> SparkSession:
    """A session with AQE on and the UI off. On a cluster, pass ``master=None``."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # AQE broadcasts a join side only when its measured shuffle output is below this
        .config("spark.sql.adaptive.autoBroadcastJoinThreshold", "64MB")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("TEXTLENS_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect sessions have no SparkContext
        return None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster the setting names a shared file system and is only read here;
    a missing one is an error, because executors would each write to their own
    disk. Only a local session without it (tests) gets a fresh scratch folder.
    """
    sc = _context(spark)
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc is not None:
        d = sc.getCheckpointDir()
    if not d:
        if sc is None or not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="textlens-ckpt-")
    if sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def saved(df, name: str):
    """``df`` as a table in the shared folder: computed once, and it outlives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/textlens-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Bytes of an Arrow batch. A task holds some ten times as much: both processes have the batch, and its words as numbers.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches by bytes as well as by rows, unless the session already does."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(name, None) in (None, str(2**63 - 1), str(2**31 - 1)):
        spark.conf.set(name, str(BATCH_BYTES))
