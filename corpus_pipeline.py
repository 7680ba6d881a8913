"""Corpus pipeline: STAGES in order, each over what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last
return the columns of ``documents``; ``run`` writes each as Parquet and hands
the reread table to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from audiweave.llm.decontaminate import contamination
from audiweave.llm.jaccard_join import jaccard_rows
from audiweave.llm.packing import pack
from audiweave.llm.pii import find_personal_data, redact
from audiweave.llm.quality import ACCEPT, learn, learned_marks, score_quality
from audiweave.llm.scratch import keep


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    name = "score"
    while name in docs.columns:
        name = f"_{name}"
    scored = score_quality(docs, learn(docs, learned_marks(spark, sf_dir)), name)
    return scored.where(F.col(name) >= ACCEPT).drop(name)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents linked by five-word shingles stays: that of the least doc_id (null
    ids last), then of the least text hash. Rows alike in doc_id and text are one; wordless ones are in no group."""
    rows = keep(jaccard_rows(docs, words=5, percent=80).select(F.col("doc_id").alias("id"), F.col("h").alias("t"), "group"), "groups")
    # wordless rows are groups of their own
    own_group = F.coalesce(F.col("group"), F.xxhash64("id", "t"))
    keys = rows.groupBy(own_group.alias("group"), F.col("group").isNull().alias("wordless"), "id", "t").agg(F.count("*").alias("times"))
    first = F.min(F.struct(F.isnull("id").alias("void"), "id", "t", "times")).alias("by")
    stay = keep(keys.groupBy("group", "wordless").agg(first).select("by.id", "by.t", "by.times"), "stay")
    key = "_h"
    while key in docs.columns:
        key = f"_{key}"
    stay = stay.withColumnsRenamed({"id": f"{key}_id", "t": f"{key}_t", "times": f"{key}_times"})
    own = docs.withColumn(key, F.xxhash64("text"))
    same = own["doc_id"].eqNullSafe(stay[f"{key}_id"]) & (own[key] == stay[f"{key}_t"])
    once = own.join(stay.where(F.col(f"{key}_times") == 1), same, "left_semi")
    repeated = own.join(stay.where(F.col(f"{key}_times") > 1), same, "left_semi").dropDuplicates(["doc_id", key])
    return once.union(repeated).drop(key)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go."""
    hit = contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).where("contaminated")
    hit = hit.select(F.col("doc_id").alias("id"), "t").distinct()
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["id"]) & (F.xxhash64(docs["text"]) == hit["t"]), "left_anti")


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by its kind in brackets; n_chars follows the text."""
    clean = redact(find_personal_data(docs)).withColumnsRenamed({f"in_{c}": c for c in ("base", "spans") if c in docs.columns})
    return clean.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their places in sequences."""
    return pack(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: The stages hold trained models and token ids, which SQL can't express; a test works out the rows of every stage in plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = keep(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
