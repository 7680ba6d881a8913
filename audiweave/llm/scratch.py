"""Intermediate tables that outlive a lost executor: Parquet files in the shared folder."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from audiweave.sources.scratch import shared_folder as folder

#: Bytes of one batch sent to Python while a table is written: texts can be long.
BATCH_BYTES = 4 << 20
_BOUND = "spark.sql.execution.arrow.maxBytesPerBatch"
#: Spark deletes the shuffle files of a query when it ends; else they stay until the driver happens to collect its garbage.
_FREE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def keep(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and read it back, which cuts its lineage and frees the
    shuffle files of the step. A greater bound of the session on batches is
    lowered meanwhile; both settings are put back."""
    spark = df.sparkSession
    path = f"{folder(spark)}/{name}-{uuid.uuid4().hex}"
    before = {setting: spark.conf.get(setting) for setting in (_BOUND, _FREE)}
    if not 0 < int(before[_BOUND].rstrip("b")) <= BATCH_BYTES:
        spark.conf.set(_BOUND, str(BATCH_BYTES))
    spark.conf.set(_FREE, "true")
    try:
        df.write.parquet(path)
    finally:
        for setting, value in before.items():
            spark.conf.set(setting, value)
    return spark.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Delete the files of a table made by ``keep``."""
    spark = df.sparkSession
    files = df.inputFiles()
    if not files:
        return
    path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
