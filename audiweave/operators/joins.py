"""Joins by use; semi and anti joins stand in ``incremental``, snapshots in ``windows``."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.functions.text import coalesce_id


def unify_identities(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """one row per identity of either side; values of ``a`` go first, and an id of ``0`` counts as none."""
    left = a.withColumn(key, coalesce_id(F.col(key), F.lit(None)))
    right = b.withColumn(key, coalesce_id(F.col(key), F.lit(None)))
    shared = [c for c in a.columns if c in b.columns and c != key]
    right = right.withColumnsRenamed({c: f"_b_{c}" for c in shared})
    out = left.join(right, key, "full")
    return out.withColumns({c: F.coalesce(c, f"_b_{c}") for c in shared}).drop(*(f"_b_{c}" for c in shared))


def members(df: DataFrame, ids: DataFrame, key: str, inside: bool = True) -> DataFrame:
    """rows whose key is in ``ids``, or with ``inside`` = False is not. A null key is in none; rows are never multiplied."""
    return df.join(ids.select(key).distinct(), key, "left_semi" if inside else "left_anti")


def with_dimensions(fact: DataFrame, *dims: tuple[DataFrame, str]) -> DataFrame:
    """F8: left joins of (dimension, key); the planner broadcasts small ones."""
    return reduce(lambda df, d: df.join(d[0], d[1], "left"), dims, fact)


def join_either(a: DataFrame, b: DataFrame, k1: str, k2: str, target: str) -> DataFrame:
    """rows of ``a`` with rows of ``b`` whose ``k1`` or ``k2`` equals ``target``: two equi joins, each pair once."""
    first = a.join(b, a[target] == b[k1])
    second = a.join(b, (a[target] == b[k2]) & ~F.coalesce(b[k1] == b[k2], F.lit(False)))
    return first.union(second)


def replace_by_lookup(df: DataFrame, lut: DataFrame, name: str, key: str, value: str) -> DataFrame:
    """the value of a lookup in place of its key; what isn't in it, or has a null there, stays. A repeated key multiplies rows."""
    out = df.join(lut.select(F.col(key).alias(name), F.col(value).alias("_to")), name, "left")
    return out.withColumn(name, F.coalesce("_to", name)).drop("_to")


def mask_by_list(df: DataFrame, allowed: DataFrame, key: str, name: str) -> DataFrame:
    """``name`` only where ``key`` is on the list, else null."""
    marks = allowed.select(key).distinct().withColumn("_in", F.lit(True))
    return df.join(marks, key, "left").withColumn(name, F.when(F.col("_in"), F.col(name))).drop("_in")


def attribute_stack(base: DataFrame, *parts: DataFrame, key: str = "user_id") -> DataFrame:
    """attributes of other tables beside the base; missing ones are null, repeated keys multiply rows."""
    return reduce(lambda df, p: df.join(p, key, "left"), parts, base)


def join_keys(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """inner join on several keys; null keys meet nothing."""
    return a.join(b, keys)


def small(df: DataFrame, most: int = 100_000) -> DataFrame:
    """``df``, marked for broadcast after its rows were counted up to ``most`` + 1; ValueError where it has more."""
    n = df.limit(most + 1).count()
    if n > most:
        raise ValueError(f"a table that is held against all rows of another has more than {most} rows")
    return F.broadcast(df)
