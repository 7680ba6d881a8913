"""Streams that replace polling."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.window import Window

from audiweave.operators.windows import latest_per
from audiweave.sources.buckets import EntityTable
from audiweave.sources.scratch import written
from audiweave.sources.tables import Warehouse


def stream_landing(spark: SparkSession, folder: str, schema: str, target: str, checkpoint: str) -> StreamingQuery:
    """O1: every CSV of a folder reaches the table once, over restarts too."""
    source = spark.readStream.schema(schema).option("header", True).csv(folder)
    return source.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(target)


def stream_segments(visits: DataFrame, segments: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """O2: stored segment of each visit, else the classifier's, which is marked soft."""
    known = visits.join(segments.select("user_id", "site", F.col("cluster").alias("_known")), ["user_id", "site"], "left")
    scored = model.transform(known).withColumn("_soft", F.col("prediction").cast("int")) if model else known.withColumn("_soft", F.lit(None).cast("int"))
    return scored.select(*visits.columns, F.coalesce("_known", "_soft").alias("cluster"), F.col("_known").isNull().alias("soft"))


def stream_seen(ev: DataFrame, warehouse: Warehouse, dataset: str, table: str, checkpoint: str) -> StreamingQuery:
    """O3: each (user, site, day) of a stream of views once in a table, over restarts and events of any lateness.

    The table is partitioned by day, and a batch is held against the stored rows
    of its own days only; ``daily_visitors`` counts the table.
    """

    def add(batch: DataFrame, _: int) -> None:
        seen = written(batch.select("user_id", "site", F.to_date("ts").alias("day")).distinct(), "seen")
        warehouse.append_once(seen, dataset, table, ["user_id", "site", "day"], by="day")

    return ev.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_visitors(ev: DataFrame, warehouse: Warehouse, dataset: str, table: str, checkpoint: str, delay: str = "2 days") -> StreamingQuery:
    """O3 in one streaming plan: the first view of each (user, site, day), day as of UTC, in a table by day.

    What was seen is the state of the stream, not a table that is read. Days that
    ended ``delay`` before the latest event leave the state, so it holds a few
    days of visitors however long the stream runs. Events for a day that left are
    dropped; ``late_rows`` counts them. Exactly once over restarts.
    """
    days = ev.withWatermark("ts", delay).select("user_id", "site", F.window("ts", "1 day").alias("w")).dropDuplicates(["user_id", "site", "w"])
    out = days.select("user_id", "site", F.date_from_unix_date(F.floor(F.unix_seconds("w.start") / 86400).cast("int")).alias("day"))
    writer = out.writeStream.format("parquet").partitionBy("day").option("path", warehouse.path(dataset, table))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def late_rows(query: StreamingQuery) -> int:
    """Rows that a stream dropped since its start, for they came after the watermark had passed them."""
    return sum(int(s["numRowsDroppedByWatermark"]) for p in query.recentProgress for s in p["stateOperators"])


def daily_visitors(seen: DataFrame, n_days: int = 30, first=None, last=None) -> DataFrame:
    """O3: visitors of each site and day, exactly, and those of them who were there in the ``n_days`` before.

    With ``first`` and ``last`` only these days are counted, and of a table by day only they and the ``n_days`` before are read."""
    day = F.col("day")
    if first is not None:
        seen = seen.where(day >= F.date_sub(F.lit(first).cast("date"), n_days))
    if last is not None:
        seen = seen.where(day <= F.lit(last).cast("date"))
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    own = Window.partitionBy("user_id", "site").orderBy("_d").rangeBetween(-n_days, -1)
    flagged = seen.select("user_id", "site", "day").distinct().withColumn("_d", number).withColumn("returning", F.count("*").over(own) > 0)
    flagged = flagged if first is None else flagged.where(day >= F.lit(first).cast("date"))
    return flagged.groupBy("day", "site").agg(F.count("*").alias("visitors"), F.count_if("returning").alias("returning_visitors"))


def _stream_name(spark: SparkSession, checkpoint: str) -> str:
    """A name that lives as long as a checkpoint does."""
    at = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/stream-name")
    files = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(at):
        out = files.create(at, False)
        out.writeBytes(uuid.uuid4().hex)
        out.close()
    source = files.open(at)
    try:
        return source.readLine()
    finally:
        source.close()


def stream_changes(pred: DataFrame, warehouse: Warehouse, dataset: str, table: str, checkpoint: str, buckets: int = 64) -> StreamingQuery:
    """Predictions that differ from the latest segment of (user, site) are added to a change log, batch by batch.

    The latest segments are a table of their own, in hashed buckets: a batch reads
    and rewrites the buckets of its users, never the log, so its cost doesn't
    grow with history. A batch writes its part of the log, then the latest rows;
    run again after a failure it finds its own rows there and writes the same part.
    """
    latest = EntityTable(warehouse, dataset, f"{table}_latest", ("user_id", "site"), buckets)
    name = _stream_name(warehouse.spark, checkpoint)

    def add(batch: DataFrame, number: int) -> None:
        own = f"{name}-{number}"
        changed, numbers = latest.put_changed(latest_per(batch, ["user_id", "site"], [F.desc("ts"), F.asc("cluster")]), "cluster", own)
        log = changed.withColumn("batch", F.lit(own)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        log.partitionBy("batch").parquet(warehouse.path(dataset, table))
        latest.store_latest(changed, numbers, own)

    return pred.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stream_sessions(ev: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """Events of each session of a user; works on batches too."""
    source = ev.withWatermark("ts", "1 day") if ev.isStreaming else ev
    out = source.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("events"))
    return out.select("user_id", F.col("w.start").alias("session_start"), "events")


def replay(ev: DataFrame, warehouse: Warehouse, run: str, publish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Events between the first and last time that failed runs had in hand (``Warehouse.log_failed``) go to an
    idempotent sink again. Windows may overlap; each event goes once."""
    windows = warehouse.failed_windows(run)
    lost = ev.join(windows, (F.col("ts") >= F.col("start")) & (F.col("ts") <= F.col("end")), "left_semi")
    return publish(lost)
