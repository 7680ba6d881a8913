"""Segment models over a feature table, and their evaluation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Imputer, OneHotEncoder, QuantileDiscretizer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.operators.joins import small
from audiweave.operators.profile import classifier_change, cosine, drift_behaviour, drift_profile, returning_change
from audiweave.operators.windows import latest_per, top_n_per
from audiweave.sources.scratch import small_batches, written


def fit_imputer(feat: DataFrame, names: list[str]):
    """M1: medians, fitted once and reused by ``transform``."""
    return Imputer(strategy="median", inputCols=names, outputCols=names, relativeError=0.001).fit(feat)


def cut_outliers(df: DataFrame, names: list[str], cutoff: float) -> DataFrame:
    """M2: rows of |z| at ``cutoff`` or over go, column after column; a constant column cuts nothing. Nulls stay.

    What is cut at one column decides the mean of the next, so there is a scan for each column: of that column and
    those before it, whose bounds are plain numbers in one filter. The driver gets two numbers a column."""
    for c in names:
        mean, dev = df.agg(F.avg(c), F.stddev_pop(c)).first()
        if dev:
            df = df.where(F.col(c).isNull() | (F.abs((F.col(c) - mean) / dev) < cutoff))
    return df


def select_features(df: DataFrame, names: list[str], keys: tuple[str, ...] = ("user_id",)) -> DataFrame:
    """M3: in alphabetical order."""
    return df.select(*keys, *sorted(names))


def scaling(df: DataFrame, names: list[str]) -> dict[str, tuple[float, float]]:
    """M4: least and greatest value of each column."""
    row = df.agg(*(f(c).alias(f"{f.__name__}__{c}") for c in names for f in (F.min, F.max))).first()
    return {c: (row[f"min__{c}"], row[f"max__{c}"]) for c in names}


def scale(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """M4: 0 to 1; a constant column is 0."""
    one = lambda c, low, high: (F.col(c) - low) / (high - low) if high is not None and high > low else F.col(c) * 0.0
    return df.withColumns({c: one(c, *limits[c]) for c in limits})


def unscale(df: DataFrame, limits: dict[str, tuple[float, float]]) -> DataFrame:
    """M4, inverse, for centroids."""
    return df.withColumns({c: F.col(c) * (high - low) + low for c, (low, high) in limits.items()})


@dataclass(frozen=True)
class Segments:
    """M5: centroids of one fit, a row per cluster, in the alphabetical order of ``names``."""

    names: tuple[str, ...]
    centers: np.ndarray
    cost: float
    k: int
    seed: int


class _Fits:
    """Lloyd's rounds of many fits at once: all their centroids go to the tasks together, so a round is one scan for all fits."""

    def __init__(self, lines: DataFrame, width: int):
        self.lines, self.width, self.scans = lines, width, 0

    def round(self, centers: list[np.ndarray]) -> tuple[list[np.ndarray], list[float]]:
        """(sums with counts last, by cluster; cost) of each fit at its centroids."""
        self.scans += 1
        kinds = ", ".join(["slot int", *(f"s{j} double" for j in range(self.width + 2))])
        rows = self.lines.mapInArrow(_round_rows(centers), kinds)
        total = rows.groupBy("slot").agg(*(F.sum(f"s{j}").alias(f"s{j}") for j in range(self.width + 2)))
        out = np.zeros((sum(map(len, centers)), self.width + 2))
        with small_batches(self.lines.sparkSession):
            for r in total.collect():
                out[r["slot"]] = r[1:]
        cuts = np.cumsum([len(c) for c in centers])[:-1]
        return [x[:, :-1] for x in np.split(out, cuts)], [float(x[:, -1].sum()) for x in np.split(out, cuts)]


#: Points from which a line is cut between centroids; those of shorter lines are held against all centroids.
LINE = 16
#: Values that are sorted together into lines, points of one row of lines, and rows among which lines of one place are merged.
CHUNK, PIECE, SHARE = 1 << 22, 1 << 17, 20_000_000
_LINE_ROW = "at array<double>, x binary, n binary"


def _doubles(x: np.ndarray, size: np.ndarray) -> pa.Array:
    """Binary values of ``size`` doubles each, which Spark copies as they are."""
    cuts = np.append(0, np.cumsum(size) * 8).astype(np.int32)
    return pa.Array.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(x, dtype=np.float64))])


def _line_rows(shares: int):
    """Rows of points, sorted in chunks, as a row (at, x, n, deal) for each line: distinct values of the last coordinate at one
    place of the others and how often each occurs (empty: once each). Points of places with few are rows without ``at``, of many
    points each. Short lines of a place meet under one of ``shares`` numbers, all else is dealt out."""

    def chunk(p: np.ndarray, share: int, spread: int):
        p = p[:, np.lexsort(p[::-1])]
        first = np.flatnonzero(np.append(True, (p[:, 1:] != p[:, :-1]).any(axis=0)))
        n, p = np.diff(np.append(first, p.shape[1])).astype(np.float64), p[:, first]
        head = np.append(True, (p[:-1, 1:] != p[:-1, :-1]).any(axis=0))
        since = np.flatnonzero(head)
        head |= (np.arange(len(head)) - since[np.cumsum(head) - 1]) % PIECE == 0
        first = np.flatnonzero(head)
        size = np.diff(np.append(first, len(n)))
        few = size < LINE // 4
        loose = np.repeat(few, size)
        if not few.all():
            at = p[:-1, first[~few]].T
            places = pa.ListArray.from_arrays(pa.array(np.arange(len(at) + 1, dtype=np.int32) * at.shape[1]), pa.array(np.ascontiguousarray(at).ravel()))
            own = size[~few]
            more = np.add.reduceat(n, first)[~few] > own
            times = _doubles(n[~loose][np.repeat(more, own)], np.where(more, own, 0))
            deal = np.where(own == PIECE, spread + np.arange(len(own)), share)
            yield pa.record_batch([places, _doubles(p[-1, ~loose], own), times, pa.array(deal)], names=["at", "x", "n", "deal"])
        if loose.any():
            flat, times = p[:, loose].T, n[loose]
            step = max(1, PIECE // len(p))
            for k in range(0, len(times), step):
                one = [pa.array([None], pa.list_(pa.float64())), pa.array([flat[k : k + step].tobytes()]), pa.array([times[k : k + step].tobytes()]), pa.array([spread + k])]
                yield pa.record_batch(one, names=["at", "x", "n", "deal"])

    def rows(batches):
        part, made, held = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            if len(batch):
                held.append(np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]))
            if sum(h.size for h in held) >= CHUNK:
                yield from chunk(np.concatenate(held, axis=1), (part + made) % shares, (part << 40) + (made << 24) + shares)
                made, held = made + 1, []
        if held:
            yield from chunk(np.concatenate(held, axis=1), (part + made) % shares, (part << 40) + (made << 24) + shares)

    return rows


def _merged_rows(batches):
    """Lines of one place, one after the other, made one of ``PIECE`` points or somewhat more, sorted; where a quarter of
    them or more repeat others, equal points are one with their number."""

    def merged(held):
        if len(held) == 1:
            return held[0]
        x = np.concatenate([np.frombuffer(r[1]) for r in held])
        n = np.concatenate([np.frombuffer(r[2]) if r[2] else np.ones(len(r[1]) // 8) for r in held])
        by = np.argsort(x, kind="stable")
        x, n = x[by], n[by]
        first = np.flatnonzero(np.append(True, np.diff(x) != 0))
        if 4 * len(first) <= 3 * len(x):
            x, n = x[first], np.add.reduceat(n, first)
        return held[0][0], x.tobytes(), n.tobytes() if (n > 1).any() else b""

    def batch_of(out):
        return pa.record_batch([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), (pa.list_(pa.float64()), pa.binary(), pa.binary()), strict=True)], names=["at", "x", "n"])

    held, out = [], []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("at", "x", "n")), strict=True):
            if held and (row[0] is None or row[0] != held[0][0] or sum(len(r[1]) for r in held) >= 8 * PIECE):
                out.append(merged(held))
                held = []
            held.append(row)
            if sum(len(r[1]) for r in out[-1:]) >= 8 * PIECE or len(out) >= 1000:
                yield batch_of(out)
                out = []
    if held:
        yield batch_of([*out, merged(held)])


def _lines(df: DataFrame, names: list[str]) -> tuple[DataFrame, DataFrame, list[str]]:
    """(points, lines, order): the rows, ``n`` 1 in each; their points in lines along the column of most values, repeated ones
    with their number; and the columns in the order of a line's coordinates, that one last.

    Rows are sorted where they are, and what is shuffled are lines, not points. Beyond ``SHARE`` rows a place has several lines."""
    spark = df.sparkSession
    points = written(df.na.drop(subset=names).select(*(F.col(c).cast("double").alias(c) for c in names), F.lit(1).alias("n")), "points")
    *many, count = points.agg(*(F.approx_count_distinct(c) for c in names), F.count("*")).first()
    axis = names[max(range(len(names)), key=lambda j: many[j])]
    order = [*(c for c in names if c != axis), axis]
    parts = max(spark.sparkContext.defaultParallelism, count // 500_000)
    rows = points.select(*order).mapInArrow(_line_rows(1 + count // SHARE), f"{_LINE_ROW}, deal long")
    dealt = rows.repartition(parts, "at", "deal").sortWithinPartitions("at", "deal")
    with small_batches(spark):
        return points, written(dealt.select("at", "x", "n").mapInArrow(_merged_rows, _LINE_ROW), "lines"), order


def _cut_lines(at: np.ndarray, every: list[np.ndarray]) -> np.ndarray:
    """(lines, centroids): up to where on each line a centroid of a fit, in order of its last coordinate, is the nearest; -inf where nowhere.

    On a line the squared distances to the centroids of a fit differ by linear functions of x, so each centroid is
    the nearest on one interval at most, whose ends are places where two are equally far."""
    out = []
    for c in every:
        a, g = c[:, -1], (c[:, -1] ** 2)[None] + ((at[:, None, :] - c[None, :, :-1]) ** 2).sum(axis=2)
        step = a[None, :] - a[:, None]
        with np.errstate(divide="ignore", invalid="ignore"):
            meet = (g[:, None, :] - g[:, :, None]) / (2 * step)
        meet = np.where(step > 0, meet, np.where(g[:, :, None] <= g[:, None, :], np.inf, -np.inf))
        later = np.triu(np.ones((len(c), len(c)), dtype=bool), 1)
        upto = np.where(later, meet, np.inf).min(axis=2)
        since = np.where(later, meet, -np.inf).max(axis=1)
        out.append(np.where(since < upto, upto, -np.inf))
    return np.concatenate(out, axis=1)


def _round_rows(centers: list[np.ndarray]):
    """Sums, numbers and costs of the points of every cluster of every fit, one row for each at the end of a partition.
    Centroids have their coordinates in the order of a line's: its place, then the value along it."""

    def rows(batches):
        width = centers[0].shape[1]
        order = [np.argsort(c[:, -1], kind="stable") for c in centers]
        first = np.cumsum([0, *(len(c) for c in centers)])
        place = np.concatenate([i + o for i, o in zip(first[:-1], order, strict=True)])
        ranked = [c[o] for c, o in zip(centers, order, strict=True)]
        every = np.concatenate(ranked)
        heads = np.repeat(first[:-1], np.diff(first))
        ahead = np.arange(len(every)) - 1
        # lines that are cut together: their pairs of centroids of a fit are 8 MB at most, or those of one line
        step = int(np.clip((1 << 20) // max(map(len, centers)) ** 2, 1, 64))
        total = np.zeros((len(every), width + 2))

        def add_lines(at, x, n):
            upto = _cut_lines(at, ranked)
            for y, own, times, bounds in zip(at, x, n, upto, strict=True):
                weighed = own if times is None else times * own
                ranks = np.arange(len(own) + 1.0) if times is None else np.append(0, np.cumsum(times))
                sums = (ranks, np.append(0, np.cumsum(weighed)), np.append(0, np.cumsum(weighed * own)))
                end = np.where(bounds > -np.inf, np.searchsorted(own, bounds, side="right"), 0)
                for i, j in zip(first[:-1], first[1:], strict=True):
                    np.maximum.accumulate(end[i:j], out=end[i:j])
                since = np.where(ahead >= heads, end[ahead], 0)
                count, value, square = (c[end] - c[since] for c in sums)
                total[:, : width - 1] += count[:, None] * y
                total[:, width - 1] += value
                total[:, width] += count
                far = square - 2 * every[:, -1] * value + count * (every[:, -1] ** 2 + ((y - every[:, :-1]) ** 2).sum(axis=1))
                total[:, -1] += np.maximum(far, 0)

        def add_points(points, times):
            norm = (every * every).sum(axis=1)
            for k in range(0, len(points), 1024):
                x, n = points[k : k + 1024], times[k : k + 1024]
                far = norm - 2 * x @ every.T
                slots = np.stack([i + far[:, i:j].argmin(axis=1) for i, j in zip(first[:-1], first[1:], strict=True)], axis=1)
                cost = np.take_along_axis(far, slots, axis=1) + (x * x).sum(axis=1)[:, None]
                own = np.column_stack([x * n[:, None], n])
                for j in range(own.shape[1]):
                    total[:, j] += np.bincount(slots.ravel(), np.repeat(own[:, j], slots.shape[1]), len(every))
                total[:, -1] += np.bincount(slots.ravel(), (np.maximum(cost, 0) * n[:, None]).ravel(), len(every))

        for batch in batches:
            x, n = ([np.frombuffer(v.as_buffer()) for v in batch.column(c)] for c in ("x", "n"))
            at = batch.column("at").to_pylist()
            long = [i for i, y in enumerate(at) if y is not None and len(x[i]) >= LINE]
            for k in range(0, len(long), step):
                own = long[k : k + step]
                add_lines(np.array([at[i] for i in own]).reshape(len(own), width - 1), [x[i] for i in own], [n[i] if len(n[i]) else None for i in own])
            short = [(y, x[i], n[i]) for i, y in enumerate(at) if y is not None and len(x[i]) < LINE]
            if short:
                size = [len(v) for _, v, _ in short]
                places = np.repeat(np.array([y for y, _, _ in short]).reshape(len(short), width - 1), size, axis=0)
                times = np.concatenate([m if len(m) else np.ones(len(v)) for _, v, m in short])
                add_points(np.column_stack([places, np.concatenate([v for _, v, _ in short])]), times)
            for i, y in enumerate(at):
                if y is None:
                    add_points(x[i].reshape(-1, width), n[i])
        out = np.zeros_like(total)
        out[place] = total
        yield pa.record_batch([pa.array(np.arange(len(out), dtype=np.int32)), *map(pa.array, out.T)], names=["slot", *(f"s{j}" for j in range(out.shape[1]))])

    return rows


def _spread(sample: np.ndarray, k: int, seed: int) -> np.ndarray:
    """k-means++ over a sample; the first j rows are the start for j clusters. Fewer distinct points give fewer rows."""
    rng = np.random.default_rng(seed)
    out = [sample[rng.integers(len(sample))]]
    far = ((sample - out[0]) ** 2).sum(axis=1)
    while len(out) < k and far.sum() > 0:
        out.append(sample[rng.choice(len(sample), p=far / far.sum())])
        far = np.minimum(far, ((sample - out[-1]) ** 2).sum(axis=1))
    return np.array(out)


def fit_all(df: DataFrame, names: list[str], ks: list[int], restarts: int = 10, rounds: int = 300, tolerance: float = 1e-4, start: int = 20_000) -> tuple[list[Segments], int]:
    """M5, M6: the fit of least cost for every k in ``ks``, and the scans of the data that all took together.

    All (k, restart) pairs run side by side, a scan for each round of Lloyd's
    algorithm; a fit whose centroids move by no more than ``tolerance`` leaves.
    A round reads points in lines along the column of most values, as binary
    values: where the others take few values, a line is cut between the
    centroids by its running sums, with the same assignment.
    Starts are k-means++ over about ``start`` distinct points of least hash;
    costs are those over all rows. The driver holds all centroids and their
    sums. Rows with a null are left out, an empty cluster keeps its centroid; no
    rows give no fit.
    """
    names = sorted(names)
    points, lines, order = _lines(df, names)
    vector = F.array(*names)
    hashed = F.pmod(F.xxhash64(vector), F.lit(1 << 30))
    share = min(1.0, 1.1 * start / max(1, points.agg(F.approx_count_distinct(vector)).first()[0]))
    sample = points.where(hashed < F.lit(int(share * (1 << 30)))).select(*names).distinct().orderBy(F.xxhash64(vector), *names).limit(start).select(*order).collect()
    if not sample:
        return [], 2
    sample = np.array([tuple(r) for r in sample])
    starts = [_spread(sample, max(ks), seed) for seed in range(restarts)]
    fits = [{"k": k, "seed": seed, "centers": x[:k], "cost": None} for k in ks for seed, x in enumerate(starts)]
    run, live = _Fits(lines, len(names)), fits
    for _ in range(rounds):
        sums, costs = run.round([f["centers"] for f in live])
        after = []
        for f, total, cost in zip(live, sums, costs, strict=True):
            n = total[:, -1:]
            centers = np.where(n > 0, total[:, :-1] / np.maximum(n, 1), f["centers"])
            moved = ((centers - f["centers"]) ** 2).sum(axis=1).max()
            f["cost"] = cost
            if moved > tolerance**2:
                f["centers"] = centers
                after.append(f)
        live = after
        if not live:
            break
    if live:
        for f, cost in zip(live, run.round([f["centers"] for f in live])[1], strict=True):
            f["cost"] = cost
    best = [min((f for f in fits if f["k"] == k), key=lambda f: (f["cost"], f["seed"])) for k in ks]
    back = [order.index(c) for c in names]
    return [Segments(tuple(names), f["centers"][:, back], f["cost"], f["k"], f["seed"]) for f in best], run.scans + 2


def fit_segments(df: DataFrame, names: list[str], k: int, restarts: int = 10) -> Segments:
    """M5: the K-means of least cost over ``restarts`` starts, all fitted in the same scans."""
    return fit_all(df, names, [k], restarts)[0][0]


def centroids(spark, model: Segments) -> DataFrame:
    """M5: one row per cluster."""
    rows = [(k, *map(float, c)) for k, c in enumerate(model.centers)]
    return spark.createDataFrame(rows, "cluster int, " + ", ".join(f"`{c}` double" for c in model.names))


def elbow(df: DataFrame, names: list[str], low: int = 5, high: int = 20, restarts: int = 10) -> int:
    """M6: the k with the greatest ratio of successive drops in cost, each cost the least of ``restarts`` starts."""
    cost = [m.cost for m in fit_all(df, names, list(range(low, high + 1)), restarts)[0]]
    drops = [a - b for a, b in zip(cost, cost[1:], strict=False)]
    ratios = [a / b if b > 0 else 0.0 for a, b in zip(drops, drops[1:], strict=False)]
    return low + 1 + ratios.index(max(ratios)) if ratios else low


def predict_segments(cents: DataFrame, feat: DataFrame, names: list[str]) -> DataFrame:
    """M7: the nearest centroid of each user; the first of equal ones. ``cents`` has a row per cluster."""
    names = sorted(names)
    c = cents.select(F.collect_list(F.struct("cluster", F.array(*names).alias("c"))).alias("_c"))
    own = F.array(*(F.col(n).cast("double") for n in names))
    far = lambda x: F.aggregate(F.zip_with(own, x["c"], lambda p, q: (p - q) * (p - q)), F.lit(0.0), lambda s, v: s + v)
    out = feat.crossJoin(F.broadcast(c)).withColumn("_b", F.array_min(F.transform("_c", lambda x: F.struct(far(x).alias("d"), x["cluster"].alias("cluster")))))
    return out.withColumn("cluster", F.col("_b.cluster")).drop("_c", "_b")


def best_features(preds: list[DataFrame], names: list[str], must: list[str], n: int) -> list[str]:
    """M8: ``must`` and the n most important others, by forests on the segment labels, mean over fits."""
    total = dict.fromkeys(names, 0.0)
    for df in preds:
        own = df.select("cluster", *names)
        buckets, binned = _buckets(own, names)
        rows = _cells(PipelineModel(stages=buckets).transform(own), "cluster", binned, even=False)
        forest = Pipeline(stages=[VectorAssembler(inputCols=binned, outputCol="features"), RandomForestClassifier(labelCol="cluster", weightCol="weight", numTrees=20, seed=0)])
        for c, v in zip(names, forest.fit(rows).stages[-1].featureImportances.toArray(), strict=True):
            total[c] += float(v) / len(preds)
    others = sorted((c for c in names if c not in must), key=lambda c: (-total[c], c))
    return [*must, *others[:n]]


def grid(spark, params: dict[str, list]) -> DataFrame:
    """M9: all combinations of parameter lists."""
    out = spark.range(1).select()
    for name, values in params.items():
        out = out.crossJoin(spark.createDataFrame([(v,) for v in values], [name]))
    return out


def cluster_shares(pred: DataFrame, k: int, date: str = "date") -> DataFrame:
    """Share of each of k clusters on each date, 0 where empty."""
    cells = pred.select(date).distinct().withColumn("cluster", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    counts = pred.groupBy(date, "cluster").agg(F.count("*").alias("n"))
    out = cells.join(counts, [date, "cluster"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return out.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy(date)))


def stability(shares: DataFrame) -> DataFrame:
    """Mean over clusters of the sample variance of their shares."""
    return shares.groupBy("cluster").agg(F.var_samp("share").alias("v")).agg(F.avg("v").alias("temporal_variance"))


def centroid_similarity(cents: DataFrame, names: list[str]) -> DataFrame:
    """(fit, similarity): of every cluster the best cosine in each other fit, after one scaling over all; summed over clusters, mean over fits, per cluster."""
    v = scale(cents, scaling(cents, names)).select("fit", "cluster", F.array(*names).alias("v"))
    other = v.select(F.col("fit").alias("g"), F.col("v").alias("w"))
    best = v.join(other, F.col("fit") != F.col("g")).groupBy("fit", "cluster", "g").agg(F.max(cosine(F.col("v"), F.col("w"))).alias("best"))
    sums = best.groupBy("fit", "g").agg(F.sum("best").alias("s"), F.count("*").alias("k"))
    return sums.groupBy("fit").agg(F.avg(F.col("s") / F.col("k")).alias("similarity"))


def segregation(profile: DataFrame, dim_total: str = "dim_total") -> DataFrame:
    """Mean of weight_ratio - 1, weighted by the squared total; null without any weight."""
    w = F.col(dim_total).cast("double") ** 2
    return profile.groupBy("domain").agg(F.try_divide(F.sum((F.col("weight_ratio") - 1) * w), F.sum(w)).alias("segregation"))


def c_level_score(df: DataFrame, level: str = "C-level-1", none: str = "non-declared") -> DataFrame:
    """By domain, the harmonic mean of the squared share of C-level users in their densest cluster and of the regularised share of users who declare nothing there."""
    cells = df.groupBy("domain", "cluster").agg(F.count_if(F.col("seniority") == level).alias("c"), F.count_if(F.col("seniority") == none).alias("u"))
    total = cells.withColumns({"ct": F.sum("c").over(Window.partitionBy("domain")), "ut": F.sum("u").over(Window.partitionBy("domain"))})
    top = latest_per(total, ["domain"], [F.desc("c"), F.asc("cluster")])
    p, q = F.try_divide("c", "ct"), F.round(F.try_divide("u", "ut"), 4)
    odds = q / (1 - q + 0.001)
    reg = F.greatest(F.pow(q - 0.001, F.lit(0.2)) - F.try_divide(F.lit(1.0), 1 + 0.05 * F.pow(odds, F.lit(-3.0))), F.lit(0.0))
    big = F.when(q >= 0.001, reg).otherwise(0.0)
    out = top.withColumns({"_p": p * p, "_q": big})
    return out.select("domain", F.when(F.col("ct") == 0, 0.0).otherwise(F.try_divide(2 * F.col("_p") * F.col("_q"), F.col("_p") + F.col("_q"))).alias("c_level"))


def ranking(scores: DataFrame) -> DataFrame:
    """Weighted sum of the four scores; null where one is."""
    return scores.withColumn("ranking", 0.4 * F.col("industry") + 0.3 * F.col("jobs") + 0.2 * F.col("c_level") + 0.1 * F.col("seniority"))


def shortlist(models: DataFrame) -> DataFrame:
    """Of each (n_clusters, lookback) the 5 most stable, of these the 3 most similar. A similarity over 0.9999 (a single
    fit, nothing to compare with) is replaced by the mean over all that are stable, itself included."""
    keys = ["n_clusters", "lookback"]
    stable = top_n_per(models, keys, [F.asc("variance"), F.asc("model")], 5)
    mean = stable.agg(F.avg("similarity").alias("_mean"))
    fixed = stable.crossJoin(F.broadcast(mean)).withColumn("similarity", F.when(F.col("similarity") > 0.9999, F.col("_mean")).otherwise(F.col("similarity"))).drop("_mean")
    return top_n_per(fixed, keys, [F.desc("similarity"), F.asc("model")], 3)


def best_model(models: DataFrame, by: str) -> DataFrame:
    """Highest ranking, then least variance, then highest similarity."""
    return latest_per(models, [by], [F.desc("ranking"), F.asc("variance"), F.desc("similarity"), F.asc("model")])


#: Buckets of a number, as many as a forest's bins; rows of one cell that a bootstrap draws one by one.
BINS, COPIES = 32, 64


def _stages(label: str, categories: list[str], numbers: list[str], forest: RandomForestClassifier) -> Pipeline:
    """What is fitted on cells: ``numbers`` are buckets there."""
    index = [StringIndexer(inputCol=c, outputCol=f"{c}_i", handleInvalid="keep") for c in categories]
    one_hot = [OneHotEncoder(inputCols=[f"{c}_i" for c in categories], outputCols=[f"{c}_v" for c in categories])] if categories else []
    inputs = [VectorAssembler(inputCols=[*(f"{c}_v" for c in categories), *numbers], outputCol="raw"), StandardScaler(withMean=True, inputCol="raw", outputCol="features")]
    target = StringIndexer(inputCol=label, outputCol="target", handleInvalid="keep", stringOrderType="alphabetAsc")
    return Pipeline(stages=[target, *index, *one_hot, *inputs, forest.setLabelCol("target").setWeightCol("weight")])


def _buckets(df: DataFrame, numbers: list[str]) -> tuple[list, list[str]]:
    """Stages that put ``numbers`` of more than ``BINS`` values in quantile buckets, and the columns to use then. A
    forest makes as many bins, from a sample; these are of all rows, in two scans."""
    many = df.agg(*(F.approx_count_distinct(c).alias(c) for c in numbers)).first()
    wide = [c for c in numbers if many[c] > BINS]
    stages = [QuantileDiscretizer(numBuckets=BINS, relativeError=0.0001, inputCols=wide, outputCols=[f"{c}_b" for c in wide]).fit(df)] if wide else []
    return stages, [f"{c}_b" if c in wide else c for c in numbers]


def _cells(df: DataFrame, label: str, alike: list[str], even: bool) -> DataFrame:
    """Rows of one label and alike in ``alike`` as ``COPIES`` rows at most, whose ``weight`` is that of all of them
    (with ``even``, every label weighs the same): what a forest sees of its rows, so its passes don't grow with
    them. The files and their order don't depend on the order of the rows."""
    spark, by = df.sparkSession, [label, *alike]
    counts = written(df.groupBy(*by).agg(F.count("*").alias("n")), "counts")
    total = counts.groupBy(label).agg(F.sum("n").alias("_n"))
    total = total.crossJoin(F.broadcast(total.agg((F.sum("_n") / F.count("*")).alias("_m"))))
    copies = F.least("n", F.lit(COPIES))
    # multiples of 2^-20: their sums are exact, so the order in which tasks end decides nothing
    weight = F.round(F.col("n") * (F.col("_m") / F.col("_n") if even else F.lit(1.0)) / copies * (1 << 20)) / (1 << 20)
    rows = counts.join(F.broadcast(total), label).withColumns({"weight": weight, "_k": F.explode(F.sequence(F.lit(1), copies.cast("int")))})
    order = [*by, "_k"]
    return written(rows.repartition(spark.sparkContext.defaultParallelism, *order).sortWithinPartitions(*order).select(*by, "weight"), "cells")


def _fit_forest(df: DataFrame, label: str, categories: list[str], numbers: list[str], **params) -> PipelineModel:
    """Forest of ``params`` on all rows of ``df``, every class weighing the same. Rows of one class and categories in the same
    buckets of ``numbers`` are one cell; the bootstrap draws rows of a cell, in blocks where it has more than ``COPIES``."""
    own = df.select(label, *categories, *numbers)
    buckets, binned = _buckets(own, numbers)
    forest = RandomForestClassifier(numTrees=50, minInstancesPerNode=5, seed=0)._set(**params)
    model = _stages(label, categories, binned, forest).fit(_cells(PipelineModel(stages=buckets).transform(own), label, [*categories, *binned], even=True))
    return PipelineModel(stages=[model.stages[0], *buckets, *model.stages[1:]])


def fit_visit_classifier(visits: DataFrame, label: str = "cluster") -> PipelineModel:
    """Segment of a first visit from local hour, referrer group and system."""
    known = visits.where(F.col(label).isNotNull()).withColumn(label, F.col(label).cast("string"))
    return _fit_forest(known, label, ["referrer_group", "os_group"], ["hour"])


def rf_eval_rows(joined: DataFrame) -> DataFrame:
    """Latest row of users who weren't there in the days before and whose segment is known."""
    return latest_per(joined.where("days_before = 0 and cluster is not null"), ["user_id", "site"], [F.desc("ts"), F.desc("event_id")])


def class_report(pred: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Precision, recall, F1 and support of each class; 0 where nothing was predicted."""
    cells = pred.groupBy(y, yhat).agg(F.count("*").alias("n"))
    side = lambda c, name: cells.groupBy(F.col(c).alias("class")).agg(F.sum("n").alias(name))
    hit = cells.where(F.col(y) == F.col(yhat)).select(F.col(y).alias("class"), F.col("n").alias("hit"))
    out = side(y, "support").join(side(yhat, "predicted"), "class", "full").join(hit, "class", "left").na.fill(0)
    p, r = F.coalesce(F.try_divide("hit", "predicted"), F.lit(0.0)), F.coalesce(F.try_divide("hit", "support"), F.lit(0.0))
    out = out.withColumns({"precision": p, "recall": r})
    return out.select("class", "precision", "recall", F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0)).alias("f1_score"), "support")


def confusion(pred: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """Share of each prediction in its true class, two decimals."""
    cells = pred.groupBy(y, yhat).agg(F.count("*").alias("n"))
    return cells.select(y, yhat, F.round(F.col("n") / F.sum("n").over(Window.partitionBy(y)), 2).alias("share"))


def most_confused(conf: DataFrame, y: str = "y", yhat: str = "yhat") -> DataFrame:
    """The wrong predictions with the largest share, equal ones comma-joined."""
    wrong = conf.where(F.col(y) != F.col(yhat)).withColumn("_top", F.max("share").over(Window.partitionBy(y))).where("share = _top")
    return wrong.groupBy(y).agg(F.concat_ws(",", F.sort_array(F.collect_set(F.col(yhat).cast("string")))).alias("most_fn_to"), F.max("share").alias("share"))


def fit_attribute(feat: DataFrame, target: str, names: list[str]) -> PipelineModel:
    """Complete rows with a known target."""
    return _fit_forest(feat.na.drop(subset=[*names, target]), target, [], names)


#: What a random search draws from. Spark's trees have at most 30 levels, so the deepest is that.
RANGES = {"numTrees": (100, 300, 500), "featureSubsetStrategy": ("auto", "sqrt"), "maxDepth": (10, 20, 30), "minInstancesPerNode": (1, 2, 4), "bootstrap": (True, False)}


def draw_params(ranges: dict[str, tuple], n: int, seed: int) -> list[dict]:
    """N different draws from the ranges; all combinations where there are no more than n."""
    every = reduce(lambda a, name: [{**d, name: v} for d in a for v in ranges[name]], sorted(ranges), [{}])
    order = np.random.default_rng(seed).permutation(len(every))
    return [every[k] for k in order[:n]]


def stratified_parts(df: DataFrame, target: str, keys: list[str], shares: list[float], seed: int) -> DataFrame:
    """Adds ``part``: 0, 1, ... by ``shares`` of the rows of each class, in order of a hash of ``keys``. Cuts are quantiles
    of the hash in a class, so no task holds a whole class, and rows of equal keys stay together."""
    cuts = [sum(shares[: k + 1]) for k in range(len(shares) - 1)]
    hashed = df.withColumn("_u", F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 40)))
    bounds = hashed.groupBy(F.col(target).alias("_class")).agg(F.percentile_approx("_u", [float(c) for c in cuts], 1_000_000).alias("_cuts"))
    joined = hashed.join(F.broadcast(bounds), F.col(target).eqNullSafe(F.col("_class")))
    return joined.withColumn("part", F.size(F.filter("_cuts", lambda c: F.col("_u") > c))).drop("_u", "_class", "_cuts")


def _scores(pred: DataFrame) -> dict[str, float]:
    """Accuracy, and mean recall over the classes that occur."""
    rep = class_report(pred).where("support > 0")
    row = rep.agg((F.sum(F.col("recall") * F.col("support")) / F.sum("support")).alias("a"), F.avg("recall").alias("b")).first()
    return {"accuracy": row["a"], "balanced_accuracy": row["b"]}


def _guess(df: DataFrame, shares: list[tuple], keys: list[str], seed: int) -> DataFrame:
    """Adds ``yhat``: a class drawn by the given shares, from a hash of ``keys``."""
    u = F.pmod(F.xxhash64(*keys, F.lit(seed), F.lit("guess")), F.lit(1 << 40)) / float(1 << 40)
    out, upto = F.lit(shares[-1][0]), 1.0
    for name, share in reversed(shares[:-1]):
        upto = upto - shares[[s[0] for s in shares].index(name) + 1][1]
        out = F.when(u < upto, name).otherwise(out)
    return df.withColumn("yhat", out)


def tune_attribute(
    feat: DataFrame, target: str, names: list[str], keys: list[str], ranges: dict[str, tuple] = RANGES, draws: int = 100, folds: int = 3, test: float = 0.3, seed: int = 42
) -> tuple[PipelineModel, dict]:
    """Random search over forest parameters.

    ``test`` of the complete rows of each class are held out; the rest is cut
    into ``folds`` parts alike. Every draw is scored by its mean accuracy on the
    parts left out of its fits; equal ones go to the first draw. The best is
    fitted on all training rows and scored on the held-out ones only: accuracy,
    balanced accuracy, that of a guess drawn by the training shares of the
    classes, their ratio, and counts of classes and predictions. Splits and guesses
    come from hashes of ``keys``, which rows of one entity share.
    """
    complete = feat.na.drop(subset=[*names, target]).withColumn(target, F.col(target).cast("string"))
    shares = [test, *[(1 - test) / folds] * folds]
    parts = written(stratified_parts(complete, target, keys, shares, seed), "parts")
    train, held = parts.where("part > 0"), parts.where("part = 0")

    def fitted(df: DataFrame, params: dict) -> PipelineModel:
        return _fit_forest(df, target, [], names, **params)

    def predicted(model: PipelineModel, df: DataFrame) -> DataFrame:
        labels = F.array(*map(F.lit, model.stages[0].labels))
        out = model.transform(df.withColumn("weight", F.lit(1.0)))
        return out.select(F.col(target).alias("y"), F.get(labels, F.col("prediction").cast("int")).alias("yhat"))

    tried = []
    for k, params in enumerate(draw_params(ranges, draws, seed)):
        own = [_scores(predicted(fitted(train.where(F.col("part") != f), params), train.where(F.col("part") == f)))["accuracy"] for f in range(1, folds + 1)]
        tried.append((sum(own) / folds, -k, params))
    score, _, params = max(tried, key=lambda t: t[:2])
    model = fitted(train, params)
    pred = written(predicted(model, held), "predicted")
    counts = sorted((r[0], r[1]) for r in train.groupBy(target).count().collect())
    total = sum(n for _, n in counts)
    guess = _scores(_guess(held, [(c, n / total) for c, n in counts], keys, seed).select(F.col(target).alias("y"), "yhat"))["balanced_accuracy"]
    own = _scores(pred)
    tally = lambda c: {r[0]: r[1] for r in pred.groupBy(c).count().collect()}
    return model, own | {"dummy_balanced": guess, "over_dummy": own["balanced_accuracy"] / guess if guess else None, "best": params, "cv_accuracy": score, "classes": tally("y"), "predictions": tally("yhat")}


def attribute_probabilities(model: PipelineModel, feat: DataFrame) -> DataFrame:
    """(user_id, attribute, probability) of every learned attribute."""
    labels = model.stages[0].labels
    return melt_probs(model.transform(feat).select("user_id", vector_to_array("probability").alias("p")), labels)


def melt_probs(df: DataFrame, labels: list[str], name: str = "p") -> DataFrame:
    """An array of probabilities as rows."""
    names = F.array(*map(F.lit, labels))
    rest = [c for c in df.columns if c != name]
    return df.select(*rest, F.posexplode(name).alias("_k", "probability")).where(F.col("_k") < len(labels)).select(*rest, F.get(names, F.col("_k")).alias("attribute"), "probability")


def segment_report(behaviour: tuple[DataFrame, DataFrame], profiles: dict[str, tuple[DataFrame, DataFrame]], returning: tuple[DataFrame, DataFrame], classifier: tuple[DataFrame, DataFrame], names: list[str]) -> DataFrame:
    """One row per domain of the baseline behaviour, each pair being (baseline, day).

    Similarities of cluster sizes and of behaviour over ``names`` (M27), one of the profile of each dimension in
    ``profiles`` (M28, under the dimension's name), the change of returning visitors (G21; domain, returning_pct) and
    those of the classifier's precision, recall and F1 with the baseline's F1 (G20). What a domain lacks is null."""
    out = drift_behaviour(*behaviour, names)
    for dim, (base, day) in profiles.items():
        out = out.join(drift_profile(base, day, dim).withColumnRenamed("similarity", dim), "domain", "left")
    site = lambda df: df.withColumnRenamed("domain", "site")
    change = returning_change(site(returning[1]), site(returning[0])).select(F.col("site").alias("domain"), F.col("change").alias("returning_change"))
    base = classifier[0].groupBy("domain").agg(F.try_divide(F.sum(F.col("f1_score") * F.col("support")), F.sum("support")).alias("base_f1_score"))
    scores = classifier_change(classifier[1], classifier[0]).select("domain", "precision_change", "recall_change", "f1_score_change")
    return out.join(change, "domain", "left").join(scores, "domain", "left").join(base, "domain", "left")


def weak_classes(rep: DataFrame, least: float = 0.3) -> DataFrame:
    """Clusters of each day and domain with rows and an F1 under ``least``, in order; a null F1 is none."""
    weak = rep.where((F.col("f1_score") < least) & (F.col("support") > 0))
    return weak.groupBy("date", "domain").agg(F.array_join(F.sort_array(F.collect_set(F.col("cluster").cast("string"))), ",").alias("weak"))


def period_baseline(rep: DataFrame, start, end, name: str = "f1_score") -> DataFrame:
    """Support-weighted mean of each day of a period, then their mean by domain."""
    own = rep.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    daily = own.groupBy("date", "domain").agg(F.try_divide(F.sum(F.col(name) * F.col("support")), F.sum("support")).alias("v"))
    return daily.groupBy("domain").agg(F.avg("v").alias("baseline"))


def nearest(a: DataFrame, b: DataFrame, cost: Callable[[Column], Column], key: str, most: int = 100_000) -> DataFrame:
    """the row of ``b`` with the least ``cost`` (of a struct of it, beside the columns of ``a``) for each ``key`` of
    ``a``; ties go to the lesser row, a null cost is the last.

    ``b`` has ``most`` rows at most (ValueError beyond) and goes to the rows of ``a`` as one array, so no pair becomes a row."""
    small(b, most)
    every = b.agg(F.collect_list(F.struct(*b.columns)).alias("_every"))
    priced = lambda x: F.struct(F.isnull(cost(x)).alias("void"), cost(x).alias("cost"), x.alias("row"))
    met = a.crossJoin(F.broadcast(every)).withColumn("_best", F.array_min(F.transform("_every", priced))).where("_best is not null")
    out = met.select(*a.columns, *(F.col(f"_best.row.{c}").alias(c) for c in b.columns), F.col("_best.cost").alias("cost"))
    return latest_per(out, [key], [F.asc_nulls_last("cost"), *(F.asc(c) for c in b.columns)])
