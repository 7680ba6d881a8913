"""Audience counts from bitmaps: users are numbered, every facet value has a bitmap of them, a selection is AND and OR.

A count by the values of a facet under a selection reads bitmaps, 4 kB for 32,768
users and value, and no user rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.operators.audience import active_facets
from audiweave.operators.incremental import assert_unique
from audiweave.sources.scratch import written


def number_users(users: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, n): distinct keys numbered 1, 2, 3 ... without gaps. Keys are numbered within partitions, which come after
    each other by their counts; the driver gets one count a partition. A null key has no number."""
    own = users.select(key).where(F.col(key).isNotNull()).distinct().withColumn("_at", F.monotonically_increasing_id())
    dealt = written(own, "numbers").withColumns({"_part": F.shiftright("_at", 33).cast("long"), "_in": F.col("_at").bitwiseAND((1 << 33) - 1)})
    before, skips = 1, []
    for r in sorted(dealt.groupBy("_part").agg(F.count("*").alias("n")).collect()):
        skips.append((r["_part"], before))
        before += r["n"]
    skips = users.sparkSession.createDataFrame(skips, "_part long, _skip long")
    return dealt.join(F.broadcast(skips), "_part").select(key, (F.col("_skip") + F.col("_in")).alias("n"))


def facet_index(aud: DataFrame, facets: list[str], arrays: tuple[str, ...] = (), key: str = "user_id") -> DataFrame:
    """(facet, value, bucket, bits): the users of every facet value, values as text; the facet ``*`` holds all.

    ``aud`` has a row per user (ValueError else). ``arrays`` name array columns, whose entries are values each. Null
    values are in none."""
    assert_unique(aud, [key])
    numbered = aud.join(number_users(aud, key), key)
    one = lambda f, v: F.struct(F.lit(f).alias("facet"), v.cast("string").alias("value"))
    cells = [F.array(one("*", F.lit("*")), *(one(f, F.col(f)) for f in facets if f not in arrays))]
    entries = lambda f: F.transform(f, lambda v: one(f, v))
    cells += [F.coalesce(entries(f), F.array().cast("array<struct<facet:string,value:string>>")) for f in facets if f in arrays]
    rows = numbered.select("n", F.explode(F.concat(*cells)).alias("c")).select("n", "c.*").where("value is not null")
    place = F.bitmap_bucket_number("n").alias("bucket")
    return rows.groupBy("facet", "value", place).agg(F.bitmap_construct_agg(F.bitmap_bit_position("n")).alias("bits"))


def select_bits(index: DataFrame, chosen: dict[str, list], arrays: tuple[str, ...] = ()) -> DataFrame:
    """(bucket, bits) of the users that ``audience.select_audience`` keeps: OR over the values of a facet, AND over
    facets and over the values of array facets."""
    terms = []
    for f, values in active_facets({k: v for k, v in chosen.items() if k not in arrays}).items():
        terms.append((f, list(values)))
    terms += [(f, [v]) for f in arrays if chosen.get(f) and "all" not in chosen[f] for v in dict.fromkeys(chosen[f])]
    if not terms:
        return index.where("facet = '*'").select("bucket", "bits")
    number = F.lit(None).cast("int")
    for k, (f, values) in enumerate(terms):
        number = F.when((F.col("facet") == f) & F.col("value").isin([str(v) for v in values]), k).otherwise(number)
    either = index.withColumn("term", number).where("term is not null").groupBy("term", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    both = either.groupBy("bucket").agg(F.count("*").alias("terms"), F.bitmap_and_agg("bits").alias("bits"))
    return both.where(F.col("terms") == len(terms)).select("bucket", "bits")


def count_users(selected: DataFrame) -> DataFrame:
    """(users,) of a selection; 0 where nobody is left."""
    return selected.agg(F.coalesce(F.sum(F.bitmap_count("bits")), F.lit(0)).alias("users"))


def facet_counts(index: DataFrame, selected: DataFrame) -> DataFrame:
    """(facet, value, users): users of every facet value within a selection; values without any are left out."""
    both = index.where("facet <> '*'").join(selected.withColumnRenamed("bits", "_sel"), "bucket")
    pairs = both.select("facet", "value", "bucket", F.explode(F.array("bits", "_sel")).alias("bits"))
    common = pairs.groupBy("facet", "value", "bucket").agg(F.bitmap_and_agg("bits").alias("bits"))
    return common.groupBy("facet", "value").agg(F.sum(F.bitmap_count("bits")).alias("users")).where("users > 0")


def certainty_levels(aud: DataFrame) -> DataFrame:
    """N3 as a facet: ``certainty`` is the least whole percent p from which ``by_certainty`` keeps the row, 0 to 100; known
    rows are 0, a row that none keeps is null."""
    levels = F.array(*(F.when(F.col("prob_index") >= 1 - p / 100, p) for p in range(101)))
    return aud.withColumn("certainty", F.when(F.col("known") == 1, 0).otherwise(F.array_min(F.filter(levels, lambda p: p.isNotNull()))))
