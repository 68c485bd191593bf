"""Session settings and the shared folder for cut lineage."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame, SparkSession

# Settings the plans count on. All are run-time SQL settings, safe to set on a
# session somebody else built.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed sort-merge join even if the stage after it must shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Hash instead of sort where adaptive execution has seen that every partition is small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Lines placed by (order, salt) may join on (order, product, salt) where they are.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # The JVM never compiles a longer method, so a stage of wide rows is not fused into one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}

# Starting size of shuffles, before adaptive execution merges what turns out small.
SHUFFLE_PARTITION_BYTES = 512 * 1024 * 1024


def shuffle_partitions(input_bytes: int, least: int) -> int:
    """Partitions to start a shuffle of this much data with, ``least`` or more."""
    return max(least, -(-input_bytes // SHUFFLE_PARTITION_BYTES))


def tune(spark: SparkSession, input_bytes: int | None = None) -> SparkSession:
    """Apply ``PLAN_SETTINGS``; with ``input_bytes`` also size the first shuffle."""
    for key, value in PLAN_SETTINGS.items():
        spark.conf.set(key, value)
    if input_bytes is not None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum",
            str(shuffle_partitions(input_bytes, least)),
        )
    return spark


def build_session(app: str = "marketide", master: str | None = None, **conf: str) -> SparkSession:
    """A tuned session; ``conf`` keys use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    # What was materialised goes when no plan refers to it any more.
    builder = builder.config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a folder of this machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor reaches")
    folder = tempfile.mkdtemp(prefix="marketide-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def materialise(df: DataFrame) -> DataFrame:
    """Compute ``df`` once into the shared folder and go on from there.

    Meant for day-grain and model-grain tables that several later plans read:
    without it each of them would repeat the joins over the order lines.
    """
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this session's own on whatever file system it is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
