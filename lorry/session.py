"""Spark session and shared-folder helpers."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import weakref
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lorry") -> SparkSession:
    """A local session for tests and the bench (UI off, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and written intermediates.

    It is the folder that ``spark.checkpoint.dir`` names (on a cluster a shared
    file system).  Only in local mode, where driver and executors are one
    process, a scratch folder is made if nothing is configured; elsewhere that
    is an error, as every executor would write to a disk of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(configured)
        return configured
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError(f"spark.checkpoint.dir is not set: on {master} intermediates need a folder that all executors share")
    path = tempfile.mkdtemp(prefix="lorry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


#: what a batch of rows on its way to a Python worker may take, unless the session says otherwise
ARROW_BYTES = "4m"


def small_batches(spark: SparkSession) -> None:
    """Lets batches to Python workers end by bytes as well as by rows.  Spark's
    own limit (64 MB) stands several times in a worker and once more in the
    JVM of every task; a session that sets one keeps its own."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, ARROW_BYTES)


@contextlib.contextmanager
def smaller_partitions(spark: SparkSession, times: int) -> Iterator[None]:
    """While it lasts, adaptive execution aims at shuffle partitions smaller by
    that factor: for a write whose rows grow behind the shuffle."""
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    was = spark.conf.get(key)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(was)
    spark.conf.set(key, str(max(size // times, 1 << 20)))
    try:
        yield
    finally:
        spark.conf.set(key, was)


#: folders that :func:`stage` has written, by session
_STAGED: weakref.WeakKeyDictionary[SparkSession, list[str]] = weakref.WeakKeyDictionary()


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the shared checkpoint folder and
    read it back.

    Used where one intermediate feeds several branches of a plan (the
    carrier contract's stop table, the numbering tags): Spark would
    otherwise recompute it per branch, and a branch that recomputes
    nondeterministic tags could see different values.  The write is a
    lineage cut that survives executor loss.  :func:`release` removes what a
    session has written.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/lorry-stage/{label}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").option("compression", "zstd").parquet(path)
    _STAGED.setdefault(spark, []).append(path)
    return spark.read.parquet(path)


def release(spark: SparkSession) -> int:
    """Delete the intermediates that this session has staged so far; their
    number.  Call it when the results that read them are written: a DataFrame
    that still reads one fails afterwards."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    paths = _STAGED.pop(spark, [])
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)
    return len(paths)
