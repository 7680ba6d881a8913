"""Incremental loads: upserts, change tracking, registries and work lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from audiweave.operators.windows import latest_per
from audiweave.sources.scratch import written


def existing_for(existing: DataFrame, new: DataFrame, entity: str) -> DataFrame:
    """B2: stored rows of the entities that new rows touch."""
    return existing.join(new.select(entity).distinct(), entity, "left_semi")


def delete_entities(existing: DataFrame, ids: DataFrame, entity: str) -> DataFrame:
    """What stays; rows of a null entity do."""
    return existing.join(ids.select(entity).distinct(), entity, "left_anti")


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once, with their number."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def assert_unique(df: DataFrame, keys: list[str]) -> None:
    """ValueError where a key stands twice, null keys included; an empty table passes."""
    if not repeated_keys(df, keys).isEmpty():
        raise ValueError(f"keys {keys} are not unique")


def fill_int_nulls(df: DataFrame) -> DataFrame:
    """Null becomes 0 in integer columns."""
    whole = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    return df.fillna(0, [f.name for f in df.schema if isinstance(f.dataType, whole)])


def _as_text(col: Column, kind: T.DataType) -> Column:
    return col.cast("string") if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)) else col


def upsert(existing: DataFrame, new: DataFrame, entity: str, keys: list[str], now, dated: str = "last_updated_date", int_null_zero: bool = False) -> DataFrame:
    """B1: all rows of the entities in ``new``, merged on ``keys``.

    A new value that is null keeps the old one. Where any value changes, the
    date is ``now``, else the old date. Repeated keys in ``new`` are the
    caller's error (see ``assert_unique``); in ``existing`` they are kept.
    """
    old = existing_for(existing, new, entity).withColumn("_old", F.lit(True))
    values = [c for c in new.columns if c not in keys and c != dated]
    fresh = new.select(*keys, *(F.col(c).alias(f"_new_{c}") for c in values))
    both = old.join(fresh, keys, "full")
    kinds = {f.name: f.dataType for f in existing.schema}
    same = F.lit(True)
    merged = {}
    for c in values:
        merged[c] = F.coalesce(F.col(f"_new_{c}"), F.col(c)) if c in kinds else F.col(f"_new_{c}")
        if c in kinds:
            same = same & _as_text(merged[c], kinds[c]).eqNullSafe(_as_text(F.col(c), kinds[c]))
    out = both.select(
        *keys, *(merged[c].alias(c) for c in values), *(c for c in existing.columns if c not in (*keys, *values, dated)),
        F.when(same, F.col(dated)).otherwise(F.lit(now).cast(existing.schema[dated].dataType)).alias(dated),
    )
    return fill_int_nulls(out) if int_null_zero else out


def watermarks(df: DataFrame, created: str, updated: str, key: str) -> DataFrame:
    """Newest times and the range of ids."""
    return df.agg(F.max(created).alias("created_max"), F.max(updated).alias("updated_max"), F.min(key).alias("id_min"), F.max(key).alias("id_max"))


def later_of(a: DataFrame, b: DataFrame) -> DataFrame:
    """B6 over two tenants: the later mark of each."""
    return a.union(b).agg(*(F.max(c).alias(c) for c in a.columns))


def slice_windows(marks: DataFrame, start: str, end: str, hours: int) -> DataFrame:
    """(from, to) of fixed steps from one second before the mark; the last is cut at the end."""
    first = F.col(start) - F.expr("interval 1 second")
    step = F.expr(f"interval {hours} hours")
    out = marks.select(F.explode(F.sequence(first, F.col(end), step)).alias("from"), F.col(end).alias("_end"))
    return out.select("from", F.least(F.col("from") + step, F.col("_end")).alias("to")).where("from < to")


def keep_last(df: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """The first row of each key in the given order; equal rows fall to one, a null key is a key."""
    return latest_per(df, [key], order)


def rebuild(old: DataFrame, new: DataFrame, key: str, dated: str) -> DataFrame:
    """Old and new rows, the newest of each key; columns of either."""
    both = old.withColumn("_batch", F.lit(0)).unionByName(new.withColumn("_batch", F.lit(1)), allowMissingColumns=True)
    return latest_per(both, [key], [F.desc("_batch"), F.desc_nulls_last(dated)]).drop("_batch")


def split_by_membership(df: DataFrame, key: str, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows of members, and the others with those of a null key."""
    ids = members.select(key).distinct()
    return df.join(ids, key, "left_semi"), df.join(ids, key, "left_anti")


def refresh_registry(registry: DataFrame, df: DataFrame, dataset: str, table: str, now) -> DataFrame:
    """One row per column of a table. Columns that went are flagged, all
    rows get the update date, new columns are added; other tables' rows stay."""
    spark = registry.sparkSession
    mine = (F.col("dataset") == dataset) & (F.col("table") == table)
    there = spark.createDataFrame([(c,) for c in df.columns], "column string").withColumn("_in", F.lit(True))
    at = F.lit(now).cast("timestamp")
    merged = registry.where(mine).join(there, "column", "full").select(
        F.lit(dataset).alias("dataset"), F.lit(table).alias("table"), "column",
        F.coalesce("create_date", at).alias("create_date"), at.alias("update_date"), F.col("_in").isNull().alias("deleted"),
    )
    return registry.where(~mine).select(*merged.columns).unionByName(merged)


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Missing columns as null, in the order of the schema."""
    return df.select(*(F.col(f.name).cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema))


def schema_matches(df: DataFrame, expected: T.StructType) -> bool:
    """Every expected column is there with its type."""
    own = {f.name: f.dataType for f in df.schema}
    return all(own.get(f.name) == f.dataType for f in expected)


#: What stands for no value in free text.
PLACEHOLDERS = ("", " ", ".", "-", ",", "..", "...", "--", "/", "?", "???", "TEST", "TEst", "Test", "test", "x", "xx", "xxx", "xx", "NULL", "none", "None", "NONE", "xxxx")


def drop_placeholders(df: DataFrame, name: str, values: tuple[str, ...] | list[str] = PLACEHOLDERS) -> DataFrame:
    """Rows whose text is literally one of ``values`` go; null stays."""
    return df.where(~F.coalesce(F.col(name).isin(*values), F.lit(False)))


def track_history(prev: DataFrame, rows: DataFrame, key: str, value: str, placeholders: tuple[str, ...] | list[str] = PLACEHOLDERS) -> DataFrame:
    """New and changed keys with their history.

    The newest valid value of a key counts; first and last times are over all
    its rows. A known key whose value changed keeps its creation date, and the
    value is added to its history. Unchanged keys aren't returned.
    """
    spans = rows.groupBy(key).agg(F.min("created_at").alias("created_at"), F.max("updated_at").alias("updated_at"))
    valid = drop_placeholders(rows.where(F.col(value).isNotNull()), value, placeholders)
    newest = latest_per(valid, [key], [F.desc("updated_at"), F.desc("created_at"), F.asc(value)]).select(key, value)
    now = newest.join(spans, key)
    old = prev.select(key, F.col(value).alias("_value"), F.col("created_at").alias("_created"), F.col("history").alias("_history"))
    both = now.join(old, key, "left").where(F.col("_history").isNull() | ~F.col(value).eqNullSafe(F.col("_value")))
    return both.select(key, value, F.coalesce("_created", "created_at").alias("created_at"), "updated_at", F.concat_ws(",", "_history", value).alias("history"))


def tables_to_check(log: DataFrame, since) -> DataFrame:
    """Tables with a successful run after a date."""
    return log.where((F.to_date("at") > F.lit(since).cast("date")) & F.endswith("message", F.lit("successfully."))).select("table").distinct()


def log_digest(log: DataFrame) -> DataFrame:
    """Successful and failed tables and named entities by log file."""
    good = F.endswith("message", F.lit("successfully."))
    return log.groupBy("file").agg(
        F.count_distinct(F.when(good, F.col("table"))).alias("successful"), F.count_distinct(F.when(~good, F.col("table"))).alias("failed"),
        F.sum(F.size(F.filter(F.split("entities", ","), lambda x: x != ""))).alias("entities"),
    )


class Checkpoint:
    """A date is pending until its run succeeds, then committed. State is a small table (job, committed, pending)."""

    def __init__(self, warehouse, dataset: str = "runs", table: str = "checkpoints"):
        self.at, self.names = warehouse, (dataset, table)

    def _state(self) -> DataFrame:
        if self.at.exists(*self.names):
            return self.at.read(*self.names)
        return self.at.spark.createDataFrame([], "job string, committed string, pending string")

    def get(self, job: str) -> tuple[str | None, str | None]:
        row = self._state().where(F.col("job") == job).first()
        return (row["committed"], row["pending"]) if row else (None, None)

    def _put(self, job: str, committed: str | None, pending: str | None) -> None:
        state = self._state()
        row = self.at.spark.createDataFrame([(job, committed, pending)], state.schema)
        self.at.write(state.where(F.col("job") != job).union(row), *self.names, mode="overwrite")

    def begin(self, job: str, date: str) -> None:
        self._put(job, self.get(job)[0], date)

    def commit(self, job: str) -> None:
        self._put(job, self.get(job)[1], None)

    def rollback(self, job: str) -> None:
        self._put(job, self.get(job)[0], None)


def append_changed(latest: DataFrame, pred: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Predictions that differ from the latest stored value, or have none."""
    old = latest.select(*keys, F.col(value).alias("_old"), F.lit(True).alias("_there"))
    both = pred.join(old, keys, "left")
    return both.where(F.col("_there").isNull() | ~F.col(value).eqNullSafe(F.col("_old"))).drop("_old", "_there")


def extend_names(known: DataFrame, names: DataFrame, name: str, clean) -> DataFrame:
    """Names that aren't known yet, with their clean form."""
    return names.select(name).distinct().join(known.select(name), name, "left_anti").withColumn("clean", clean(F.col(name)))


def chunk_groups(df: DataFrame, key: str, n: int) -> DataFrame:
    """Chunk number of each whole group: groups in key order fill chunks of about ``n`` rows.

    Sums run within ranges of keys and over the totals of the ranges, so no
    task holds all groups. Groups are written with their ranges once, since a
    plan that is run twice may deal them otherwise. Rows of a null key are the
    first group.
    """
    sizes = df.groupBy(key).agg(F.count("*").alias("rows"))
    dealt = written(sizes.repartitionByRange(key).withColumn("_p", F.spark_partition_id()), "ranges")
    within = Window.partitionBy("_p").orderBy(key)
    before = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    totals = dealt.groupBy("_p").agg(F.sum("rows").alias("_t")).withColumn("_skip", F.coalesce(F.sum("_t").over(before), F.lit(0)))
    summed = dealt.withColumn("_own", F.sum("rows").over(within)).join(totals, "_p")
    return summed.select(key, "rows", F.floor((F.col("_skip") + F.col("_own") - 1) / n).alias("chunk"))


def usage_by_token(log: DataFrame, tokens: DataFrame) -> DataFrame:
    """Calls of each known token, 0 where there are none; calls of unknown and null tokens are left out."""
    calls = log.groupBy("token").agg(F.count("*").alias("calls"))
    return tokens.join(calls, "token", "left").withColumn("calls", F.coalesce("calls", F.lit(0)))


def since_last(df: DataFrame, stored: DataFrame, at: str) -> DataFrame:
    """Rows past the newest stored time; all rows where none is stored."""
    return df.crossJoin(F.broadcast(stored.agg(F.max(at).alias("_last")))).where(F.col("_last").isNull() | (F.col(at) > F.col("_last"))).drop("_last")


def missing_ids(every: DataFrame, df: DataFrame, key: str) -> DataFrame:
    """Ids without a payload."""
    return every.select(key).distinct().join(df.select(key), key, "left_anti")


def changed_ids(pages: DataFrame, key: str, at: str, since) -> DataFrame:
    """Distinct keys changed since a time; a null time is no change."""
    return pages.where(F.col(at) >= F.lit(since)).select(key).distinct()


def coverage_gap(listing: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Ids on one side only."""
    a, b = listing.select(key).distinct(), loaded.select(key).distinct()
    return a.join(b, key, "left_anti").withColumn("side", F.lit("listed")).union(b.join(a, key, "left_anti").withColumn("side", F.lit("loaded")))
