"""Connected components by alternating stars, as DataFrame joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import drop, keep


def _twice(rows: DataFrame, *columns: str) -> DataFrame:
    """(u, v) of the first two and of the last two columns. A union would plan all that ``rows`` is made of twice,
    and each star twice again; the driver keeps these plans."""
    return rows.select(F.stack(F.lit(2), *columns).alias("u", "v"))


def _with_least(pairs: DataFrame) -> DataFrame:
    """Adds ``m``, the least of ``u`` and its ``v``."""
    least = pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return pairs.join(least, "u")


def _large_star(edges: DataFrame) -> DataFrame:
    """Every larger neighbour of a node is tied to the node's least neighbour."""
    both = _twice(edges, "u", "v", "v", "u")
    return _with_least(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every smaller neighbour of a node, and the node, is tied to the least."""
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    tied = _with_least(down)
    return _twice(tied, "v", "m", "u", "m").where("u <> v").distinct()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, label) for every node of an undirected graph.

    ``edges`` has two bigint columns u, v; loops and repeats may occur, and
    rows with a null are ignored. The label is the least node reachable. Each
    round is written to shared storage, so a lost executor costs one round.
    An empty graph gives an empty result.
    """
    now = keep(edges.where("u <> v").select("u", "v").distinct(), "cc")
    before = None
    for _ in range(most_rounds):
        sums = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if not sums[0] or sums == before:
            break
        before = sums
        after = keep(_small_star(_large_star(now)), "cc")
        drop(now)
        now = after
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    tied = now.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return tied.union(tied.select(F.col("label").alias("node"), "label").distinct())
