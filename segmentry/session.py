"""Session settings and the shared folders a job may write to."""

from __future__ import annotations

import math
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators rely on. Everything else is left to the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Split hot join keys even when that costs one more exchange afterwards.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Checkpoints are dropped when the tables that read them are gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}

# Text and vector columns grow when they are unpacked for a shuffle.
UNPACKED_FACTOR = 4
BYTES_PER_TASK = 128 * 1024 * 1024


def build_session(app_name: str = "segmentry", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings above; ``conf`` keys use ``__`` in place of dots."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A machine-local folder is used only in local
    mode, where driver and executors are one process.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not _is_local(spark):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    local = tempfile.mkdtemp(prefix="segmentry-")
    spark.sparkContext.setCheckpointDir(local)
    return local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return f"{shared_dir(spark)}/segmentry-{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder with its lineage cut, so lost executors cost no recomputation."""
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Like ``checkpointed``, but the planner knows the size of what it reads. In loops that join a table with itself,
    estimates carried through checkpoints double in length with every round.
    """
    path = scratch_path(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Raises the number of shuffle partitions to suit the stored size of the inputs; never lowers it.

    Adaptive execution merges partitions that turn out small but cannot split all of them, so the
    starting number has to grow with the data. Only file lengths are read.
    """
    jvm_path, conf = spark._jvm.org.apache.hadoop.fs.Path, spark._jsc.hadoopConfiguration()
    stored = 0
    for path in map(jvm_path, paths):
        fs = path.getFileSystem(conf)
        stored += fs.getContentSummary(path).getLength() if fs.exists(path) else 0
    wanted = math.ceil(stored * UNPACKED_FACTOR / BYTES_PER_TASK)
    now = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if wanted > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    return max(wanted, now)


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over at least as many tasks as there are cores, for work that is heavy per row.

    A table of few files or very large row groups would otherwise leave most cores idle. Tables with
    enough splits pass unchanged; the count comes from the scan's plan, nothing is read.
    """
    wanted = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= 4 * wanted else df.repartition(wanted, key)
