"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings that may be changed on a running session.
RUNTIME = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A split skewed join may cost one more shuffle; one overfull task costs more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the library counts on."""
    for key, value in RUNTIME.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Session for tests and the bench on one machine."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tidewright")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"file://{tempfile.mkdtemp(prefix='tidewright-')}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return prepare(spark)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names.

    Where it is unset, a session whose tasks all run in the driver's process (``local``, as in tests) gets a temporary
    folder. On a cluster that would be a different folder on each machine, so there it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        named = tempfile.mkdtemp(prefix="tidewright-")
        spark.sparkContext.setCheckpointDir(named)
        named = spark.sparkContext.getCheckpointDir()
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared folder."""
    return f"{scratch_root(spark)}/tidewright/{name}-{uuid.uuid4().hex}"


def landed(df: DataFrame, name: str) -> DataFrame:
    """The same rows, written once under the shared scratch folder and read back: that ends their lineage, and outlives
    lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# At the end of a query Spark removes what its shuffles wrote; off by default, as a frame that runs again then shuffles again.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write rows to a new parquet folder. The shuffles are the write's own, so their files go with it, not when the driver
    next collects garbage; hashes and numbers as text take about half the room in zstd."""
    conf = df.sparkSession.conf
    before = conf.get(_CLEANUP, None)
    conf.set(_CLEANUP, "true")
    try:
        df.write.partitionBy(*partition_by).option("compression", "zstd").parquet(path)
    finally:
        if before is None:
            conf.unset(_CLEANUP)
        else:
            conf.set(_CLEANUP, before)


def hadoop_path(spark: SparkSession, path: str):
    """A path and its file system, for listing, renaming and removing files from the driver."""
    made = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return made, made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
