"""Importance resampling towards a target distribution, ranked by regular sampling.

1. Features are runs of words, hashed to buckets by crc32. Counts of both texts
   by bucket are exact sums over all rows; the driver holds one array of gains.
2. A document's weight is the floored mean of the gains that its features pick
   from the array; a Gumbel draw from a hash of its id is added.
3. Parallel sorting by regular sampling: every partition of the scored table is
   a locally sorted run. Rows at regular places of all runs give splitters,
   which deal the rows to segments. A segment merges its pieces and numbers
   them; prefix counts over segments give exact ranks. Only segments that begin
   before the last drawn rank are exchanged.

The order ends with a row's place in its run, so rows alike in all else are
split between segments too, and no value can fill a segment.
"""

from __future__ import annotations

import bisect
import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.llm.scratch import drop, keep
from audiweave.llm.textbytes import LOWER, WORD_OR_SIGN, Words, chunks

#: Samples of all runs that the driver sorts, about.
SAMPLES = 1 << 20
#: Rows of a segment at least, where there are more of them than tasks need.
SEGMENT = 1 << 20
#: Longer words are hashed one by one.
LONG = 128
#: Digits, lower-case letters and bytes of other scripts.
MEMBER = WORD_OR_SIGN == 1


def _crc_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_TABLE = _crc_table()


def crc_states(state: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Each crc state after the bytes raw[start:end]; all spans advance a byte at a time."""
    out, size = state.copy(), end - start
    for i in np.flatnonzero(size > LONG).tolist():
        out[i] = zlib.crc32(raw[start[i] : end[i]].tobytes(), int(out[i]) ^ 0xFFFFFFFF) ^ 0xFFFFFFFF
    order = np.argsort(-np.where(size > LONG, 0, size), kind="stable")
    size, at, now = size[order], start[order], out[order]
    size[size > LONG] = 0
    left = np.searchsorted(-size, -np.arange(1, LONG + 1), side="right")
    for step, n in enumerate(left.tolist()):
        if not n:
            break
        now[:n] = _TABLE[(now[:n] ^ raw[at[:n] + step]) & 255] ^ (now[:n] >> 8)
    out[order] = now
    return out


def feature_buckets(column: pa.Array, grams: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket) of every run of 1 to ``grams`` words joined by a space, and the number of words of each row."""
    words = Words(column, MEMBER, LOWER)
    state = np.full(len(words.start), 0xFFFFFFFF, np.uint32)
    state = crc_states(state, words.raw, words.start, words.end)
    rows, found = [words.doc], [state]
    for n in range(2, grams + 1):
        same = words.doc[: len(words.doc) - n + 1] == words.doc[n - 1 :] if len(words.doc) >= n else np.zeros(0, bool)
        at = np.flatnonzero(same)
        before = found[-1][np.flatnonzero(_whole(words.doc, n - 1)).searchsorted(at)]
        spaced = _TABLE[(before ^ 32) & 255] ^ (before >> 8)
        rows.append(words.doc[at])
        found.append(crc_states(spaced, words.raw, words.start[at + n - 1], words.end[at + n - 1]))
    return np.concatenate(rows), ((np.concatenate(found) ^ np.uint32(0xFFFFFFFF)) % np.uint32(buckets)).astype(np.int64), words.count


def _whole(doc: np.ndarray, n: int) -> np.ndarray:
    """Whether the run of ``n`` words that starts at each word lies in one row."""
    out = np.zeros(len(doc), bool)
    if len(doc) >= n:
        out[: len(doc) - n + 1] = doc[: len(doc) - n + 1] == doc[n - 1 :]
    return out


def _count_rows(grams: int, buckets: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for part in chunks(batch, "text"):
                total += np.bincount(feature_buckets(part.column("text"), grams, buckets)[1], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some, pa.int32()), pa.array(total[some])], names=["bucket", "n"])

    return rows


def bucket_counts(texts: DataFrame, grams: int = 2, buckets: int = 10_000) -> list[int]:
    """Features of all texts by bucket."""
    parts = texts.select("text").mapInArrow(_count_rows(grams, buckets), "bucket int, n long")
    out = [0] * buckets
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: list[int], target: list[int]) -> list[int]:
    """floor(1000 ln((t + 1)(S + b) / ((s + 1)(T + b)))) of every bucket, b their number."""
    S, T, b = float(sum(source)), float(sum(target)), float(len(source))
    return [math.floor(1000 * math.log((t + 1.0) * (S + b) / ((s + 1.0) * (T + b)))) for s, t in zip(source, target, strict=True)]


def gumbel(doc_id: int | None, seed: int) -> int:
    """The draw of a document in thousandths; that of a null id is the draw of the text ``null``."""
    h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def _score_rows(gain: np.ndarray, grams: int, seed: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                row, bucket, n_words = feature_buckets(part.column("text"), grams, len(gain))
                n = np.bincount(row, minlength=part.num_rows)
                total = np.zeros(part.num_rows, np.int64)
                np.add.at(total, row, gain[bucket])
                weight = np.where(n > 0, total // np.maximum(n, 1), 0)
                score = weight + np.array([gumbel(i, seed) for i in part.column("doc_id").to_pylist()], np.int64)
                yield pa.record_batch([part.column("doc_id"), *map(pa.array, (n_words.astype(np.int64), n, weight, score))], names=["doc_id", "n_words", "n_features", "weight", "score"])

    return rows


_KEY = ("score", "void", "doc_id", "weight", "n_features", "at")
_ORDER = (F.desc, F.asc, F.asc, F.asc, F.asc, F.asc)


def _keys(score, doc_id, weight, n_features, at) -> tuple:
    return -score, doc_id is None, doc_id or 0, weight, n_features, at


def splitters(samples: list[tuple[tuple, int]], segments: int) -> list[tuple]:
    """Keys that cut all rows into about equal segments; a sample (key, n) stands for n rows."""
    samples = sorted(samples)
    total, seen, out = sum(n for _, n in samples), 0, []
    for key, n in samples:
        # the sample is the first of its n rows
        if seen * segments >= (len(out) + 1) * total:
            out.append(key)
        seen += n
    return out


def _segment_rows(cuts: list[tuple]):
    first = np.array([c[0] for c in cuts], np.int64)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = -batch.column("score").to_numpy()
            low, high = np.searchsorted(first, score, side="left"), np.searchsorted(first, score, side="right")
            segment = low.astype(np.int64)
            for i in np.flatnonzero(low < high).tolist():  # a cut with this score: compare whole keys
                segment[i] = bisect.bisect_right(cuts, _keys(*(batch.column(c)[i].as_py() for c in ("score", "doc_id", "weight", "n_features", "at"))))
            yield pa.record_batch([*batch.columns, pa.array(segment)], names=[*batch.schema.names, "segment"])

    return rows


def ranked_rows(scored: DataFrame, draw_percent: int, least_words: int) -> DataFrame:
    """``scored`` (doc_id, n_words, n_features, weight, score) with ``rank``: 1, 2, 3 ... over the drawn
    rows by falling score, then doc_id (nulls last); null for the rest."""
    spark = scored.sparkSession
    own = scored.withColumns({"in": F.col("n_words") >= least_words, "void": F.isnull("doc_id")})
    order = [F.desc("in"), *(f(c) for f, c in zip(_ORDER[:-1], _KEY[:-1], strict=True))]
    runs = keep(own.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id()), "runs")
    chosen = runs.where("in")
    run, place = F.shiftright("at", 33), F.col("at").bitwiseAND((1 << 33) - 1)
    sizes = {r["run"]: r["n"] for r in chosen.groupBy(run.alias("run")).agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    drawn = draw_percent * total // 100
    segments = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), total // SEGMENT)
    each = max(1, min(segments, SAMPLES // max(1, len(sizes))))
    steps = spark.createDataFrame([(r, -(-n // each)) for r, n in sizes.items()], "run long, step long")
    sampled = chosen.withColumn("run", run.cast("long")).join(F.broadcast(steps), "run").where(place % F.col("step") == 0)
    sampled = sampled.select("score", "doc_id", "weight", "n_features", "at", "step").collect()
    cuts = splitters([(_keys(*r[:5]), r["step"]) for r in sampled], segments)
    placed = keep(chosen.select(*_KEY).mapInArrow(_segment_rows(cuts), "score long, void boolean, doc_id long, weight long, n_features long, at long, segment long"), "placed")
    counts = {r["segment"]: r["n"] for r in placed.groupBy("segment").agg(F.count("*").alias("n")).collect()}
    before, offsets = 0, []
    for s in sorted(counts):
        if before < drawn:
            offsets.append((s, before))
        before += counts[s]
    offsets = spark.createDataFrame(offsets, "segment long, before long")
    in_segment = Window.partitionBy("segment").orderBy(*(f(c) for f, c in zip(_ORDER, _KEY, strict=True)))
    rank = F.row_number().over(in_segment).cast("long") + F.col("before")
    some = placed.join(F.broadcast(offsets), "segment").withColumn("rank", rank)
    out = ["doc_id", "n_features", "weight", "score"]
    some = some.select(*out, F.when(F.col("rank") <= drawn, F.col("rank")).alias("rank"))
    none = F.lit(None).cast("long").alias("rank")
    late = placed.join(F.broadcast(offsets), "segment", "left_anti").select(*out, none)
    return some.union(late).union(runs.where("not in").select(*out, none))


def resample(docs: DataFrame, target: DataFrame, draw_percent: int = 25, least_words: int = 20, grams: int = 2, buckets: int = 10_000, seed: int = 7) -> DataFrame:
    """Draw documents that look like ``target``.

    Takes doc_id bigint and text of ``docs`` and text of ``target``; other
    columns are ignored. Returns a row per document: doc_id, n_features, weight,
    score, rank. Of the documents with at least ``least_words`` words,
    ``draw_percent`` % are drawn: those of highest score, ties to the smaller
    doc_id (nulls last), then by weight and features; others have a null rank.
    Null and wordless texts have no features, weight 0 and are never drawn. A
    null id draws as the text ``null``. Repeated rows each count and have ranks
    of their own. An empty table gives an empty result; an empty target has
    counts of 0.
    """
    gain = np.array(gains(bucket_counts(docs, grams, buckets), bucket_counts(target, grams, buckets)), np.int64)
    scored = keep(docs.select("doc_id", "text").mapInArrow(_score_rows(gain, grams, seed), "doc_id long, n_words long, n_features long, weight long, score long"), "scored")
    out = ranked_rows(scored, draw_percent, least_words)
    drop(scored)
    return out


def op13_importance_resampling(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
