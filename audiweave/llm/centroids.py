"""Centroid clustering on exact integers, with an incremental matrix of dot products.

A vector's components become integers. Next to each vector stands its row of
dot products with all centroids, written to shared storage each round. When
centroids move, a row is not computed anew: of each centroid only the components
that changed enter, as dot += sum(change * component), which is exact. The
nearest centroid is the argmin of |c|^2 - 2 dot. Sums of clusters are kept the
same way: only vectors that changed their cluster are added and taken off.

Of each round the driver holds the centroids and their sums (k times the number
of components, exact integers). Vectors are never shuffled, so a common vector
costs no more than others. A round that moves no centroid settles the result,
since all later ones would repeat it.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import drop, keep

#: Integers beyond are held at this bound, so that 64 squared differences fit 64 bits.
LARGEST = 1 << 27
_STATE = "vec_id long, x array<int>, norm long, dots array<long>, cluster int, before int, distance long"


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    n, width = values.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * width), pa.array(np.ascontiguousarray(values).ravel(), kind))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, width)


def nearest(norm: np.ndarray, dots: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(number, squared distance) of the nearest centroid of each vector, the smaller number on ties."""
    apart = norm[:, None] - 2 * dots + (centroids * centroids).sum(axis=1)
    best = apart.argmin(axis=1)
    return best, apart[np.arange(len(best)), best]


def moved_dots(dots: np.ndarray, x: np.ndarray, change: np.ndarray) -> np.ndarray:
    """Dot products after centroids changed by ``change``: only its nonzero components are read."""
    out = dots.copy()
    for c, row in enumerate(change):
        own = np.flatnonzero(row)
        if len(own):
            out[:, c] += x[:, own] @ row[own]
    return out


def _rows(ids: pa.Array, x: pa.Array, norm: np.ndarray, dots: np.ndarray, centroids: np.ndarray, before: np.ndarray) -> pa.RecordBatch:
    cluster, distance = nearest(norm, dots, centroids)
    made = [ids, x, pa.array(norm), _lists(dots, pa.int64()), pa.array(cluster, pa.int32()), pa.array(before, pa.int32()), pa.array(distance)]
    return pa.record_batch(made, names=["vec_id", "x", "norm", "dots", "cluster", "before", "distance"])


def _first(centroids: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), centroids.shape[1])
            yield _rows(batch.column("vec_id"), batch.column("x"), (x * x).sum(axis=1), x @ centroids.T, centroids, np.full(len(x), -1))

    return rows


def _next(centroids: np.ndarray, change: np.ndarray):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, dots = _matrix(batch.column("x"), centroids.shape[1]), _matrix(batch.column("dots"), len(centroids))
            yield _rows(batch.column("vec_id"), batch.column("x"), batch.column("norm").to_numpy(), moved_dots(dots, x, change), centroids, batch.column("cluster").to_numpy())

    return rows


def _sum_rows(k: int, width: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One row for each cluster that this partition adds to or takes from; the last entry counts vectors."""
        total = np.zeros((k, width + 1), np.int64)
        for batch in batches:
            x = np.column_stack([_matrix(batch.column("x"), width), np.ones(batch.num_rows, np.int64)])
            to, off = batch.column("cluster").to_numpy(), batch.column("before").to_numpy()
            for c in range(k):
                total[c] += x[to == c].sum(axis=0) - x[off == c].sum(axis=0)
        some = np.flatnonzero(total.any(axis=1))
        yield pa.record_batch([pa.array(some, pa.int32()), _lists(total[some], pa.int64())], names=["cluster", "sums"])

    return rows


def _changes(state: DataFrame, k: int, width: int) -> list[list[int]]:
    """Exact changes of the sums and counts of all clusters, from vectors that changed theirs."""
    moved = state.where("cluster <> before").select("x", "cluster", "before").mapInArrow(_sum_rows(k, width), "cluster int, sums array<long>")
    parts = moved.select("cluster", F.posexplode("sums").alias("j", "v")).groupBy("cluster", "j").agg(F.sum(F.col("v").cast("decimal(38,0)")).alias("v"))
    out = [[0] * (width + 1) for _ in range(k)]
    for r in parts.collect():
        out[r["cluster"]][r["j"]] = int(r["v"])
    return out


def integer_vectors(vectors: DataFrame, width: int, scale: int) -> DataFrame:
    """(vec_id, x) of the vectors with exactly ``width`` components, all finite; x is floor(scale * component)."""
    given = vectors.select("vec_id", F.col("embedding").cast("array<double>").alias("e"))
    whole = given.where((F.size("e") == width) & F.forall("e", lambda v: F.coalesce(~F.isnan(v) & (F.abs(v) < float("inf")), F.lit(False))))
    held = lambda v: F.greatest(F.least(F.floor(F.least(F.greatest(v, F.lit(-1e15)), F.lit(1e15)) * scale), F.lit(LARGEST)), F.lit(-LARGEST))
    return whole.select("vec_id", F.transform("e", lambda v: held(v).cast("int")).alias("x"))


def cluster_vectors(vectors: DataFrame, k: int = 8, rounds: int = 10, width: int = 64, scale: int = 1024, seed: int = 3) -> DataFrame:
    """Clusters of the integer vectors floor(scale * embedding) after ``rounds`` rounds.

    Takes vec_id bigint and embedding (an array of numbers); other columns are
    ignored. Vectors of another length, or with a null, NaN or infinite
    component, are left out. Centroids start as the k kept vectors whose sha256
    of ``seed:vec_id`` is least (null ids last, equal ids in order of their
    components); fewer vectors make fewer centroids. Each round takes all vectors
    to their nearest centroid (smaller number on ties), then every non-empty
    centroid becomes floor(sum / count). Integers over ``LARGEST`` in size are
    held at that bound. Returns a row per kept vector: vec_id, cluster, distance
    (squared), cluster_inertia, inertia (null where a sum exceeds 64 bits),
    centroid_sha256. Repeated rows each count. No kept vector: no rows.
    """
    spark = vectors.sparkSession
    whole = integer_vectors(vectors, width, scale)
    start = whole.orderBy(F.asc_nulls_last(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)), "x").limit(k).collect()
    if not start:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string")
    centroids = np.array([r["x"] for r in start], np.int64)
    k = len(centroids)
    state = keep(whole.mapInArrow(_first(centroids), _STATE), "vectors")
    sums = [[0] * (width + 1) for _ in range(k)]
    for _ in range(rounds):
        for own, change in zip(sums, _changes(state, k, width), strict=True):
            own[:] = [a + b for a, b in zip(own, change, strict=True)]
        new = np.array([[s // own[-1] for s in own[:-1]] if own[-1] else old for own, old in zip(sums, centroids.tolist(), strict=True)], np.int64)
        if (new == centroids).all():
            break
        after = keep(state.mapInArrow(_next(new, new - centroids), _STATE), "vectors")
        drop(state)
        state, centroids = after, new
    inertia = {r["cluster"]: int(r["s"]) for r in state.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    fits = lambda n: n if n < 1 << 63 else None
    of = [(c, fits(inertia.get(c, 0)), fits(sum(inertia.values())), hashlib.sha256(",".join(map(str, row)).encode()).hexdigest()) for c, row in enumerate(centroids.tolist())]
    named = spark.createDataFrame(of, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return state.select("vec_id", "cluster", "distance").join(F.broadcast(named), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def _oracle(k: int = 8, rounds: int = 10) -> str:
    """The same rounds as SQL: every table is worked out once, in whole numbers."""
    parts = [
        "v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS x FROM embeddings"
        " WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || vec_id)) - 1)::INT AS c, x AS m FROM v ORDER BY sha256('3:' || vec_id) LIMIT {k})",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"a{r} AS MATERIALIZED (SELECT vec_id, any_value(x) AS x, min_by(c, d * 100 + c) AS c, min(d) AS d FROM (SELECT vec_id, x, c,"
            f" list_sum(list_transform(list_zip(x, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT AS d FROM v, c{r}) GROUP BY vec_id)"
        )
        if r < rounds:
            parts.append(
                f"s{r} AS MATERIALIZED (SELECT c, j, sum(y)::HUGEINT AS s, count(*) AS n FROM (SELECT c, unnest(x) AS y, unnest(range(64)) AS j FROM a{r}) GROUP BY c, j)"
            )
            # a quotient cut towards zero is one too large where the sum is negative and doesn't divide
            parts.append(
                f"c{r + 1} AS MATERIALIZED (SELECT c, coalesce(n.m, c{r}.m) AS m FROM c{r} LEFT JOIN (SELECT c,"
                f" list((s // n - CASE WHEN s % n < 0 THEN 1 ELSE 0 END)::BIGINT ORDER BY j) AS m FROM s{r} GROUP BY c) n USING (c))"
            )
    return (
        f"WITH {', '.join(parts)} SELECT vec_id, c AS cluster, d::BIGINT AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,"
        f" (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (c)"
    )


ORACLE = _oracle()


def op12_centroid_clusters(spark, sf_dir: str) -> DataFrame:
    return cluster_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
