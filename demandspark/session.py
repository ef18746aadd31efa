"""Session settings and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", app: str = "demandspark", **extra: str) -> SparkSession:
    """Session for tests and benchmarks; a cluster supplies its own."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named by ``spark.checkpoint.dir``; only a local session may get its own.

    Checkpoints must outlive an executor, so a machine-local folder on a cluster is refused.
    """
    context = spark.sparkContext
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(shared)
        return
    if context.getCheckpointDir() is not None:
        return
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="demandspark-checkpoint-")
    context.setCheckpointDir(folder)
    _remove_at_end(spark, folder)


def shared_path(spark: SparkSession, kind: str, keep: bool = False) -> str:
    """A new path in the shared checkpoint folder, removed when the driver ends unless it is to be kept."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/{kind}-{uuid.uuid4().hex}"
    if not keep:
        _remove_at_end(spark, folder)
    return f"{folder}/data"


def _remove_at_end(spark: SparkSession, folder: str) -> None:
    """Hadoop removes the folder when the driver's JVM ends; it must exist to be noted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)


def staged(df: DataFrame) -> DataFrame:
    """Write a table that several passes read to the shared folder and read it back.

    Unlike cached blocks it outlives executors, and later passes read only the columns they need.
    """
    path = shared_path(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Partition by key into a fixed number of tasks, which adaptive execution does not merge."""
    spark = df.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return df.repartition(tasks, *keys)
