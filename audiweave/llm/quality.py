"""Quality classifier: random-indexing word vectors and a two-layer network.

Every word or run of signs has a sparse ternary index vector of its own, drawn
from its hash. Words fall in one of ``BUCKETS`` by hash; the context vector of a
bucket is the sum of the index vectors around its words over the whole corpus:
tasks add these up, Spark sums them by bucket, and the driver holds one table of
fixed size. A document is the mean and the root mean square of its words'
vectors, and three counts beside them: the norm of the mean, the logarithm of
its words, and that of the share of distinct ones. The network is fitted in
numpy on a bounded sample of labelled documents, its temperature on a part of
the sample kept back.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.llm.textbytes import U, WORD_OR_SIGN, Words, chunks, mix

BUCKETS, WIDTH, NONZERO, REACH = 1 << 13, 32, 4, 2
HIDDEN, EPOCHS, LEARNED = 24, 40, 20_000
ACCEPT = 0.3
def _tokens(column: pa.Array) -> tuple[np.ndarray, Words]:
    words = Words(column, member=WORD_OR_SIGN)
    return (words.hash % U(BUCKETS)).astype(np.int64), words


def index_vectors(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places, whether positive) of the ``NONZERO`` entries of each word's index vector."""
    drawn = mix(hashes ^ U(0x3C79AC492BA7B653))
    shift = np.arange(NONZERO, dtype=U)
    return ((drawn[:, None] >> shift * U(8)) % U(WIDTH)).astype(np.int64), (drawn[:, None] >> (shift + U(48))) & U(1) > 0


def _context_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(BUCKETS * WIDTH, np.int64)
    seen = np.zeros(BUCKETS, np.int64)
    for batch in batches:
        for part in chunks(batch, "text"):
            bucket, words = _tokens(part.column("text"))
            seen += np.bincount(bucket, minlength=BUCKETS)
            at, plus = index_vectors(words.hash)
            for step in range(1, REACH + 1):
                left = np.flatnonzero(words.doc[step:] == words.doc[:-step])
                for own, other in ((left, left + step), (left + step, left)):
                    for k in range(NONZERO):
                        cell, sign = bucket[own] * WIDTH + at[other, k], plus[other, k]
                        total += np.bincount(cell[sign], minlength=len(total)) - np.bincount(cell[~sign], minlength=len(total))
    some = np.flatnonzero(seen)
    vectors = total.reshape(BUCKETS, WIDTH)[some]
    yield pa.record_batch([pa.array(some), pa.array(seen[some]), *(pa.array(vectors[:, k]) for k in range(WIDTH))], names=["bucket", "n", *(f"v{k}" for k in range(WIDTH))])


def word_vectors(docs: DataFrame) -> np.ndarray:
    """Context vectors of all buckets over all documents, centred, scaled to
    unit spread and weighted down where a bucket is frequent."""
    names = [f"v{k}" for k in range(WIDTH)]
    rows = docs.select("text").mapInArrow(_context_rows, "bucket long, n long, " + ", ".join(f"{v} long" for v in names))
    sums = rows.groupBy("bucket").agg(F.sum("n").alias("n"), *(F.sum(v).alias(v) for v in names)).toArrow()
    n, table = np.zeros(BUCKETS), np.zeros((BUCKETS, WIDTH))
    at = sums["bucket"].to_numpy()
    n[at], table[at] = sums["n"].to_numpy(), np.column_stack([sums[v].to_numpy() for v in names])
    mean = table / np.maximum(n, 1)[:, None]
    share = n / max(n.sum(), 1)
    mean -= share @ mean
    spread = np.sqrt(share @ mean**2)
    mean = np.where(n[:, None] > 0, mean / np.where(spread > 0, spread, 1), 0)
    return (mean * (1e-2 / (1e-2 + share))[:, None]).astype(np.float32)


def pooled(column: pa.Array, table: np.ndarray) -> np.ndarray:
    """A row per text: mean and root mean square of word vectors, norm of the
    mean, and log counts of words and of distinct buckets. Empty texts: zeros."""
    bucket, words = _tokens(column)
    n = words.count
    out = np.zeros((len(n), 2 * WIDTH + 3))
    some = np.flatnonzero(n)
    if len(some):
        own, first = table[bucket], words.first[:-1][some]
        count = n[some][:, None]
        mean = np.add.reduceat(own, first, axis=0) / count
        out[some, :WIDTH] = mean
        out[some, WIDTH : 2 * WIDTH] = np.sqrt(np.add.reduceat(own * own, first, axis=0) / count)
        out[some, 2 * WIDTH] = np.sqrt((mean**2).sum(axis=1))
        out[some, 2 * WIDTH + 1] = np.log1p(n[some])
        pair = np.unique(words.doc * BUCKETS + bucket) // BUCKETS
        out[some, 2 * WIDTH + 2] = np.log1p(np.bincount(pair, minlength=len(n))[some]) - np.log1p(n[some])
    return out


class Network:
    """Two layers over standardised inputs; ``score`` is P(label 1) at the fitted temperature."""

    def __init__(self, x: np.ndarray, y: np.ndarray, seed: int = 5):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = (x.mean(axis=0), x.std(axis=0) + 1e-6) if len(x) else (np.zeros(x.shape[1]), np.ones(x.shape[1]))
        self.w1 = rng.normal(0, x.shape[1] ** -0.5, (x.shape[1], HIDDEN))
        self.b1, self.w2, self.b2, self.temperature = np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1), 1.0
        if len(x):
            fit = rng.random(len(x)) >= 0.15
            self._fit(self._inputs(x[fit]), y[fit], rng)
            self._calibrate(x[~fit], y[~fit])

    def _inputs(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def _fit(self, x: np.ndarray, y: np.ndarray, rng: np.random.Generator) -> None:
        names = ("w1", "b1", "w2", "b2")
        first = {k: np.zeros_like(getattr(self, k)) for k in names}
        second = {k: np.zeros_like(getattr(self, k)) for k in names}
        step = 0
        for epoch in range(EPOCHS):
            order = rng.permutation(len(x))
            for start in range(0, len(x), 128):
                own, want = x[order[start : start + 128]], y[order[start : start + 128]]
                hidden = np.tanh(own @ self.w1 + self.b1)
                error = (1 / (1 + np.exp(-(hidden @ self.w2 + self.b2))) - want) / len(own)
                back = np.outer(error, self.w2) * (1 - hidden**2)
                slopes = {"w1": own.T @ back + 1e-4 * self.w1, "b1": back.sum(axis=0), "w2": hidden.T @ error + 1e-4 * self.w2, "b2": error.sum(keepdims=True)}
                step += 1
                rate = 0.004 * (1 - epoch / EPOCHS)
                for k in names:
                    first[k] = 0.9 * first[k] + 0.1 * slopes[k]
                    second[k] = 0.999 * second[k] + 0.001 * slopes[k] ** 2
                    setattr(self, k, getattr(self, k) - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8))

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(self._inputs(x) @ self.w1 + self.b1) @ self.w2 + self.b2

    def _calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        if len(x):
            z, sign = self.logit(x), 2 * y - 1
            grid = np.exp(np.linspace(np.log(0.3), np.log(8), 80))
            self.temperature = float(grid[int(np.argmin([np.logaddexp(0, -sign * z / t).mean() for t in grid]))])

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x) / self.temperature, -40, 40)))


def _pooled_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in chunks(batch, "text"):
                x = pooled(part.column("text"), shared.value)
                yield pa.record_batch([part.column("doc_id"), part.column("h"), part.column("label"), pa.array(list(x))], names=["doc_id", "h", "label", "x"])

    return rows


def _score_rows(shared, name: str):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, network = shared.value
        for batch in batches:
            for part in chunks(batch, "text"):
                score = network.score(pooled(part.column("text"), table))
                yield pa.record_batch([*part.columns, pa.array(score)], names=[*part.schema.names, name])

    return rows


def learn(docs: DataFrame, labelled: DataFrame, most: int = LEARNED) -> tuple[np.ndarray, Network]:
    """Word vectors over ``docs`` and a network over ``labelled`` (doc_id, label 0 or 1).

    At most ``most`` labelled ids, least by hash, are learned from; of the rows
    of a repeated id that of the least text hash, and of its labels the greatest.
    Without labels the network is left as drawn and scores say nothing.
    """
    spark = docs.sparkSession
    table = word_vectors(docs)
    marks = labelled.where("doc_id is not null and label is not null").groupBy("doc_id").agg(F.max("label").cast("double").alias("label"))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    rows = docs.select("doc_id", F.xxhash64("text").alias("h"), "text").join(F.broadcast(marks), "doc_id").select("doc_id", "h", "label", "text")
    shared = spark.sparkContext.broadcast(table)
    found = rows.mapInArrow(_pooled_rows(shared), "doc_id long, h long, label double, x array<double>")
    # as Arrow columns: rows would be a Python object for every number, memory that the driver doesn't get back
    got = found.groupBy("doc_id").agg(F.min_by(F.struct("label", "x"), "h").alias("of")).select("doc_id", "of.*").toArrow()
    order = np.argsort(got["doc_id"].to_numpy())
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, 2 * WIDTH + 3)[order]
    return table, Network(x, got["label"].to_numpy()[order])


def score_quality(docs: DataFrame, model: tuple[np.ndarray, Network], name: str = "score") -> DataFrame:
    """Adds the score (0 to 1) of every row's whole text; null and empty texts
    get that of a text without words. All columns stay; a column that is called
    ``name`` already becomes ``in_<name>`` (with more ``in_`` where that is there too)."""
    spark = docs.sparkSession
    fresh = f"in_{name}"
    while fresh in docs.columns:
        fresh = f"in_{fresh}"
    docs = docs.withColumnsRenamed({name: fresh})
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return docs.mapInArrow(_score_rows(spark.sparkContext.broadcast(model), name), f"{fields}, `{name}` double")


def fold(modulus: int):
    """The remainder of crc32 of doc_id as text."""
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(modulus))


def learned_marks(spark, sf_dir: str) -> DataFrame:
    """Labels that may be learned from."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return labels.where(fold(5) != 0).select("doc_id", F.col("quality").alias("label"))


def op2_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    scored = score_quality(docs, learn(docs, learned_marks(spark, sf_dir)))
    held_out = F.coalesce(fold(5) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= ACCEPT).cast("int").alias("predicted"))
