"""Benchmark decontamination by winnowing, in DataFrame expressions only.

Of each ``window - gram + 1`` consecutive word ``gram``s of a text the least
hash is kept as a fingerprint. Two texts that share ``window`` words share all
the grams of one such stretch, so its least, so a fingerprint: every shared
window is found. Fingerprints are joined, and each meeting is extended along
its diagonal word by word, which settles the matter exactly. Items with fewer
words than a window are one window of their own; for these, fingerprints of
their own length are taken too.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import keep

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Words before and after A-Z are lower-cased: all but signs and white space of ASCII. Ranges
#: of what a word holds are matched in half the time of ranges of what it doesn't.
WORD = r"[0-9a-z\x{80}-\x{10FFFF}]+"
WORD_ANY_CASE = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"


def words_of(text: Column) -> Column:
    """Words of a text whose letters A-Z are lower-cased; others stay."""
    plain = F.octet_length(text) == F.char_length(text)
    folded = F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
    return F.coalesce(F.regexp_extract_all(folded, F.lit(WORD), F.lit(0)), F.array().cast("array<string>"))


def gram_hashes(hashes: str, n: int) -> Column:
    """Hash of every ``n`` consecutive entries, empty for fewer entries."""
    size = F.size(hashes)
    made = F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.xxhash64(F.slice(hashes, i, n)))
    return F.when(size >= n, made).otherwise(F.array().cast("array<bigint>"))


def winnow(grams: str, n: int) -> Column:
    """Distinct least hashes of every ``n`` consecutive grams."""
    size = F.size(grams)
    least = F.transform(F.sequence(F.lit(1), size - (n - 1)), lambda i: F.array_min(F.slice(grams, i, n)))
    return F.when(size >= n, F.array_distinct(least)).otherwise(F.array().cast("array<bigint>"))


def gram_size(window: int) -> int:
    return (window + 1) // 2


def fingerprints(df: DataFrame, windows: list[int]) -> DataFrame:
    """Rows of ``df`` (with array ``h`` of word hashes, which is dropped), once for each fingerprint: ``size``, ``fp``."""
    out = None
    for n in windows:
        k = gram_size(n)
        part = df.withColumn("g", gram_hashes("h", k)).withColumn("fps", winnow("g", n - k + 1))
        part = part.select(*(c for c in df.columns if c != "h"), F.lit(n).alias("size"), F.explode_outer("fps").alias("fp"))
        out = part if out is None else out.union(part)
    # a filter before the rows are made would be pushed into the lambdas above and compute their inputs at every step
    return out.where("fp is not null")


def _runs(doc: str, item: str, d: Column, n: Column) -> Column:
    """Runs (s, e) of at least ``n`` equal words where word p of the text stands against word p - d of the item."""
    first = F.greatest(d, F.lit(0))
    last = F.least(F.size(doc), d + F.size(item))
    start = F.struct(first.alias("from"), F.array().cast("array<struct<s:int,e:int>>").alias("out"))

    def close(acc: Column, p: Column) -> Column:
        span = F.struct(acc["from"].alias("s"), p.alias("e"))
        return F.when(p - acc["from"] >= n, F.array_append(acc["out"], span)).otherwise(acc["out"])

    def step(acc: Column, p: Column) -> Column:
        same = F.get(doc, p) == F.get(item, p - d)
        return F.struct(F.when(same, acc["from"]).otherwise(p + 1).alias("from"), F.when(same, acc["out"]).otherwise(close(acc, p)).alias("out"))

    return F.aggregate(F.sequence(first, last - 1), start, step, lambda acc: close(acc, last))


def extend(pairs: DataFrame) -> DataFrame:
    """Rows (s, e added) for all stretches of array ``w`` that hold windows of the item ``iw`` (of ``size`` words).

    The grams that both have give the diagonals on which the item can stand
    in the text; on each, runs of equal words are walked to their ends.
    """
    n = F.col("size")
    k = F.floor((n + 1) / 2).cast("int")

    def grams(words: str) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(words) - k + 1), lambda i: F.xxhash64(F.slice(words, i, k)))

    out = pairs.withColumns({"dg": grams("w"), "ig": grams("iw")})
    out = out.withColumn("both", F.array_intersect("dg", "ig"))
    # the test of its size keeps the optimiser from computing ``both`` anew for every gram
    standing = F.filter(F.transform("dg", lambda g, p: F.when(F.array_contains("both", g), F.struct(p.alias("p"), g.alias("g")))), lambda x: x.isNotNull())
    out = out.withColumn("at", F.when(F.size("both") > 0, standing))

    def diagonals(x: Column) -> Column:
        every = F.transform("ig", lambda g, q: F.when(g == x["g"], x["p"] - q))
        return F.filter(every, lambda d: d.isNotNull())

    out = out.withColumn("ds", F.array_distinct(F.flatten(F.transform("at", diagonals))))
    runs = F.explode_outer(F.flatten(F.transform("ds", lambda d: _runs("w", "iw", d, n))))
    return out.select(*(c for c in pairs.columns if c not in ("w", "iw")), runs.alias("run")).where("run is not null").select("*", "run.*").drop("run")


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 13) -> DataFrame:
    """Benchmark windows in documents.

    Takes doc_id and text of ``docs``, item_id and text of ``benchmark``; other
    columns are ignored. Returns a row per row of ``docs``: doc_id, n_words,
    n_hit (words inside any occurrence of an item's window), n_items,
    items_sha256, contaminated (n_hit > 0 and 20 * n_hit >= n_words), and
    ``t``, a hash of the text that with doc_id names the row. Null and empty
    texts have no words and are never hit; so are all where the benchmark is
    empty. Repeated rows get equal results. Items of a null item_id hit words
    but aren't counted or listed; rows of one item_id count as one item.
    """
    key = ["doc_id", "t"]
    texts = docs.select("doc_id", F.xxhash64("text").alias("t"), "text")
    items = benchmark.select("item_id", words_of(F.col("text")).alias("iw")).where("size(iw) > 0").distinct()
    items = keep(items.withColumns({"ik": F.xxhash64("item_id", "iw"), "size": F.least(F.size("iw"), F.lit(window))}), "items")
    sizes = sorted(r[0] for r in items.select("size").distinct().collect())
    if not sizes:
        found = keep(texts.limit(0).select(*key, F.lit(0).alias("n_hit"), F.lit(0).alias("n_items"), F.lit("").alias("items")), "found")
    else:
        hashed = lambda df, w: df.withColumn("h", F.transform(w, lambda x: F.xxhash64(x)))
        of_items = hashed(items, "iw").select("ik", "size", "h").withColumnRenamed("size", "own")
        of_items = keep(fingerprints(of_items, sizes).where("own = size").select("ik", "size", "fp").distinct(), "prints")
        spread = hashed(texts.withColumn("w", words_of(F.col("text"))), "w").select(*key, "h")
        pairs = keep(fingerprints(spread, sizes).join(of_items, ["size", "fp"]).select(*key, "ik").distinct(), "pairs")
        same = texts["doc_id"].eqNullSafe(pairs["doc_id"]) & (texts["t"] == pairs["t"])
        met = texts.join(pairs, same).select(texts["doc_id"], texts["t"], "text", "ik")
        met = keep(met.join(items, "ik").select(*key, "item_id", "size", "iw", words_of(F.col("text")).alias("w")), "met")
        hit = extend(met).select(*key, "item_id", F.struct("s", "e").alias("run"))
        grouped = hit.groupBy(*key).agg(F.collect_set("run").alias("runs"), F.collect_set(F.col("item_id").cast("string")).alias("ids"))
        inside = F.array_distinct(F.flatten(F.transform("runs", lambda x: F.sequence(x["s"], x["e"] - 1))))
        found = keep(grouped.select(*key, F.size(inside).alias("n_hit"), F.size("ids").alias("n_items"), F.array_join(F.array_sort("ids"), ",").alias("items")), "found")
    counted = texts.select(*key, F.coalesce(F.regexp_count("text", F.lit(WORD_ANY_CASE)), F.lit(0)).cast("long").alias("n_words"))
    whole = counted.join(found, counted["doc_id"].eqNullSafe(found["doc_id"]) & (counted["t"] == found["t"]), "left")
    n_hit = F.coalesce(F.col("n_hit").cast("long"), F.lit(0).cast("long"))
    return whole.select(
        counted["doc_id"], "n_words", n_hit.alias("n_hit"), F.coalesce(F.col("n_items").cast("long"), F.lit(0).cast("long")).alias("n_items"),
        F.sha2(F.coalesce("items", F.lit("")), 256).alias("items_sha256"),
        ((n_hit > 0) & (20 * n_hit >= F.col("n_words"))).alias("contaminated"), counted["t"],
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), b AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(list_slice(w, i, i + least(13, len(w)) - 1), ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), dw AS (
  SELECT doc_id, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS g
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bw) WHERE len(w) >= n)
), o AS (SELECT dw.doc_id, dw.n, dw.i, bw.item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.g = bw.g),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, n, i FROM o)) GROUP BY 1),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS items FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM o) GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN k USING (doc_id)
"""


def op5_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return contamination(docs, items).drop("t")
