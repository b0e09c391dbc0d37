"""Session construction and shared storage locations.

Cluster jobs get their session from the platform; ``build_session`` is for
tests, the bench and local runs. Shared state (checkpoints, stream sinks,
lineage cuts) always lives under the folder the cluster names in
``spark.checkpoint.dir``; a local one is created only when that is unset.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
#: Partitions that a batch shuffle starts with; adaptive execution merges small ones, but never cuts a large one.
SHUFFLE_PARTITIONS = 600
#: Whether a query that ends removes its shuffle files; else they stay until the driver collects garbage.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(
    master: str | None = None,
    *,
    shuffle_partitions: int | None = None,
    app_name: str = "retail_spark",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Local/test session with the settings every job assumes (UTC, AQE)."""
    master = master or f"local[{os.environ.get('BENCH_CPUS', '8')}]"
    cores = _cores_of(master)
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or max(cores, 1)))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "16g"))
        .config("spark.sql.streaming.stateStore.providerClass",
                "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    )
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_shared_dir(spark)
    return spark


def _cores_of(master: str) -> int:
    if master.startswith("local[") and master.endswith("]"):
        inner = master[6:-1]
        return os.cpu_count() or 1 if inner == "*" else int(inner)
    return os.cpu_count() or 1


def ensure_shared_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder; create a local one only if unset."""
    current = spark.conf.get(CHECKPOINT_CONF, None)
    if not current:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{CHECKPOINT_CONF} must name a folder that all executors share")
        current = tempfile.mkdtemp(prefix="retail-spark-shared-")
        spark.conf.set(CHECKPOINT_CONF, current)
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(current)
    return current


def ensure_fine_shuffles(spark: SparkSession) -> None:
    """Let shuffles start with at least ``SHUFFLE_PARTITIONS`` partitions, so that a task's memory doesn't grow with the table."""
    least = max(SHUFFLE_PARTITIONS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    if int(spark.conf.get(INITIAL_PARTITIONS, None) or 0) < least:
        spark.conf.set(INITIAL_PARTITIONS, str(least))


def shared_path(spark: SparkSession, *parts: str, unique: bool = False) -> str:
    """A path under the shared folder; ``unique`` appends a fresh run id."""
    base = ensure_shared_dir(spark).rstrip("/")
    tail = "/".join(p.strip("/") for p in parts if p)
    if unique:
        tail = f"{tail}/{uuid.uuid4().hex}" if tail else uuid.uuid4().hex
    return f"{base}/{tail}" if tail else base


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes and checkpoints of DataFrames made inside remove their shuffle files as they end. Run none of them twice."""
    before = spark.conf.get(FREE_SHUFFLES, None)
    spark.conf.set(FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.unset(FREE_SHUFFLES) if before is None else spark.conf.set(FREE_SHUFFLES, before)


def stash(df: DataFrame, path: str, *, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` to ``path`` and read it back: columns in files take a fraction of the same rows in a shuffle or checkpoint."""
    spark = df.sparkSession
    with freed_shuffles(spark):
        writer = df.select("*").write.option("compression", "zstd")
        (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a folder that this run wrote under the shared folder."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
