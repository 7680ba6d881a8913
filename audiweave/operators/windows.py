"""Latest and best rows, ranks, indices and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.sources.scratch import written


def latest_per(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key; ``order`` ends in a tie-break."""
    return top_n_per(df, keys, order, 1)


def top_n_per(df: DataFrame, keys: list[str], order: list[Column], n: int) -> DataFrame:
    """The n first rows of each group in the given order, which decides ties; a null key is a group."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col("_rn") <= n).drop("_rn")


def argmax_per(df: DataFrame, keys: list[str], value: str, score: Column) -> DataFrame:
    """H4: value of the highest score; the first by name of equal ones."""
    best = F.min_by(F.col(value), F.struct(-score, F.col(value)))
    return df.groupBy(*keys).agg(best.alias(value), F.max(score).alias("score"))


def minmax_index(df: DataFrame, keys: list[str], name: str, out: str = "index") -> DataFrame:
    """H6: place between the least and greatest of the group; null where these are equal."""
    low, high = F.col("_low"), F.col("_high")
    both = with_group(df, keys, F.min(name).alias("_low"), F.max(name).alias("_high"))
    return both.withColumn(out, F.try_divide(F.col(name) - low, F.nullif(high - low, F.lit(0.0)))).drop("_low", "_high")


def with_group(df: DataFrame, keys: list[str], *aggregates: Column) -> DataFrame:
    """Aggregates of a row's group beside it. They are worked out first, with partial sums, and joined on: no task
    holds a whole group, and few groups are broadcast. Null keys are a group."""
    names = {k: f"_of_{k}" for k in keys}
    stats = df.groupBy(*keys).agg(*aggregates).withColumnsRenamed(names)
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(own)) for k, own in names.items()))
    return df.join(stats, same).drop(*names.values())


def group_shares(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """H6: sum, least and greatest of the group beside each row."""
    return with_group(df, keys, F.sum(name).alias("group_sum"), F.min(name).alias("group_min"), F.max(name).alias("group_max"))


def rank_position(df: DataFrame, keys: list[str], order: list[Column], out: str = "position") -> DataFrame:
    """H7: place of each row in its group in the given order, for groups of any size; ties get different places, null keys are a group.

    Rows are dealt to ranges of (group, order) by sampled bounds and written once. A row's place is its number among
    its group's rows of its range, after those of the ranges before, which come from counts. Rows alike in all of
    that are told apart by a number, so they too are dealt over ranges.
    """
    made = df.withColumn("_at", F.monotonically_increasing_id())
    dealt = made.repartitionByRange(*(F.asc(k) for k in keys), *order, "_at").withColumn("_range", F.spark_partition_id())
    dealt = written(dealt, "ranges")
    before = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    counts = dealt.groupBy(*keys, "_range").agg(F.count("*").alias("_n"))
    skips = counts.select(*(F.col(k).alias(f"_of_{k}") for k in keys), F.col("_range").alias("_of_range"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_skip"))
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys), F.col("_range") == F.col("_of_range"))
    within = Window.partitionBy("_range", *keys).orderBy(*order, "_at")
    numbered = dealt.withColumn("_rn", F.row_number().over(within)).join(skips, same)
    return numbered.select(*df.columns, (F.col("_skip") + F.col("_rn")).cast("int").alias(out))


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    """The n first rows in the given order."""
    return df.orderBy(*order).limit(n)


def union_all(*dfs: DataFrame) -> DataFrame:
    """All rows of all tables, columns by name; missing ones are null, repeated rows stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def union_distinct(*dfs: DataFrame) -> DataFrame:
    """Distinct rows of all tables, columns by name; nulls are equal here."""
    return union_all(*dfs).distinct()


def minus(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``a`` whose keys aren't in ``b``."""
    return a.join(b.select(*keys).distinct(), keys, "left_anti")


def latest_snapshot(df: DataFrame, date: str, by: list[str] | None = None) -> DataFrame:
    """rows of the newest date, over all or of each group."""
    return _snapshot(df, date, by, F.max)


def baseline_snapshot(df: DataFrame, date: str, by: list[str] | None = None) -> DataFrame:
    """rows of the first date."""
    return _snapshot(df, date, by, F.min)


def _snapshot(df: DataFrame, date: str, by: list[str] | None, pick) -> DataFrame:
    if not by:
        return df.join(F.broadcast(df.agg(pick(date).alias(date))), date, "left_semi")
    return df.join(df.groupBy(*by).agg(pick(date).alias(date)), [*by, date], "left_semi")
