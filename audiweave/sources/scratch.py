"""The shared folder in which intermediate tables are written."""

from __future__ import annotations

import contextlib
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """That of ``spark.checkpoint.dir``, or of the context. Where both are unset,
    a run within one process (tests) makes one; on a cluster this is a ValueError,
    since a folder of one machine isn't shared."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.sparkContext.setCheckpointDir(at)
    return at.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: what uses it several times, or draws on the order of its partitions, sees one table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def small_batches(spark: SparkSession, most: int = 8 << 20):
    """Within it, batches sent to Python have ``most`` bytes at most, or one row; the session's bound is put back after it."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(most))
    try:
        yield
    finally:
        spark.conf.set(name, before)
