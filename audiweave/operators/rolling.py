"""Per-user features over a moving window, merged from stored parts of days.

A part holds what a user did on a day: counts and sums, first and last times, and
sketches of distinct sessions and views. Parts of a window merge by sums, least
and greatest values and unions, so a new end date reads the events of one new day.
"""

from __future__ import annotations

import datetime
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audiweave.functions.text import local_hour_zone
from audiweave.functions.time import micros
from audiweave.operators.features import client_visits, continent_visits, os_visits, referrer_visits, view
from audiweave.sources.tables import Warehouse

#: Sketches have 2^SKETCH entries: distinct numbers are within 2 % in two of three cases, and exact while there are few.
SKETCH = 12


def _counts() -> list[Column]:
    return [F.count("*").alias("events"), *referrer_visits(), *client_visits(), *continent_visits(), *os_visits()]


def daily_parts(ev: DataFrame) -> DataFrame:
    """One row per user and day of ``ts``: mergeable parts of G1-G5, G7, G8 and C26, in one aggregate."""
    hour = local_hour_zone(F.col("ts"), F.col("continent"))
    counted = (F.col("completion") != 0) & (F.col("value") != 0)
    return ev.groupBy("user_id", F.to_date("ts").alias("day")).agg(
        *_counts(), F.sum(hour).alias("hours"), F.count(hour).alias("timed"),
        F.sum(F.when(counted, F.col("completion"))).alias("completion"), F.sum(F.when(counted, F.col("value"))).alias("dwell"), F.count_if(counted).alias("engaged"),
        F.min(micros("ts")).alias("first_us"), F.max(micros("ts")).alias("last_us"),
        F.hll_sketch_agg("session_id", SKETCH).alias("session_sketch"), F.hll_sketch_agg(view(), SKETCH).alias("view_sketch"),
    )


_SUMS = ("events", "hours", "timed", "completion", "dwell", "engaged")


def merge_parts(parts: DataFrame, end, lookback: int) -> DataFrame:
    """G11 of the ``lookback`` days up to ``end``, both counted: visits, means, recency and frequency as of the end of
    that day, and estimates of distinct sessions and views."""
    last = F.lit(end).cast("date")
    own = parts.where(F.col("day").between(F.date_sub(last, lookback), last))
    visits = [c for c in parts.columns if c.startswith("visits_")]
    merged = own.groupBy("user_id").agg(
        *(F.sum(c).alias(c) for c in (*_SUMS, *visits)), F.min("first_us").alias("first_us"), F.max("last_us").alias("last_us"),
        *(F.hll_sketch_estimate(F.hll_union_agg(f"{c}_sketch")).alias(f"{c}s") for c in ("session", "view")),
    )
    day, now = 86_400_000_000, F.unix_micros(F.date_add(last, 1).cast("timestamp"))
    span = F.floor((now - F.col("first_us")) / day)
    return merged.select(
        "user_id", "events", "sessions", "views", *visits, F.try_divide("hours", "timed").alias("mean_hour"),
        F.try_divide("completion", "engaged").alias("mean_completion"), F.try_divide("dwell", "engaged").alias("mean_dwell"),
        F.floor((now - F.col("last_us")) / day).alias("recency"), F.when(span >= 28, F.col("sessions") * 28 / span).alias("frequency"),
    )


@dataclass(frozen=True)
class RollingFeatures:
    """A16 with G11: parts of days in a table by day, and the days that were built."""

    warehouse: Warehouse
    dataset: str
    table: str

    def built(self) -> set[datetime.date]:
        if not self.warehouse.exists(self.dataset, f"{self.table}_days"):
            return set()
        return {r[0] for r in self.warehouse.read(self.dataset, f"{self.table}_days").distinct().collect()}

    def features(self, ev: DataFrame, end: str, lookback: int) -> DataFrame:
        """The window's features. Only days whose parts aren't stored are read from ``ev``; a day that a failed run
        began is built again in place. A day counts as complete once it was built."""
        last = datetime.date.fromisoformat(end)
        days = [last - datetime.timedelta(days=k) for k in range(lookback + 1)]
        if missing := sorted(set(days) - self.built()):
            kind = ev.schema["ts"].dataType
            first, after = F.lit(missing[0]).cast(kind), F.lit(missing[-1] + datetime.timedelta(days=1)).cast(kind)
            own = ev.where((F.col("ts") >= first) & (F.col("ts") < after) & F.to_date("ts").isin(missing))
            parts = daily_parts(own).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("day")
            parts.parquet(self.warehouse.path(self.dataset, self.table))
            made = self.warehouse.spark.createDataFrame([(d,) for d in missing], "day date")
            self.warehouse.write(made, self.dataset, f"{self.table}_days")
        return merge_parts(self.warehouse.read(self.dataset, self.table), end, lookback)
