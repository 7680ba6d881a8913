"""Fits of many starts at once, and the random search, against plain versions."""

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from audiweave.operators import segments as M


@pytest.fixture(scope="module")
def blobs(spark):
    rng = np.random.default_rng(5)
    at = rng.uniform(0, 1, (6, 3))
    rows = [(k, *map(float, at[k % 6] + rng.normal(0, 0.04, 3))) for k in range(1500)] + [(9000, None, 0.1, 0.2)] + [(9001 + k, 0.5, 0.5, 0.5) for k in range(300)]
    return spark.createDataFrame(rows, "user_id long, b double, a double, c double").persist()


def test_fits_are_no_worse_than_the_library_ones_and_share_scans(spark, blobs):
    ks = list(range(3, 9))
    fits, scans = M.fit_all(blobs, ["b", "a", "c"], ks)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(blobs.na.drop())
    x = np.array(blobs.na.drop().select("a", "b", "c").collect())
    for m in fits:
        theirs = KMeans(k=m.k, seed=0, maxIter=300).fit(vectors).summary.trainingCost
        own = ((x[:, None] - m.centers[None]) ** 2).sum(axis=2).min(axis=1).sum()
        assert m.names == ("a", "b", "c") and len(m.centers) == m.k and np.isclose(own, m.cost) and m.cost <= theirs * 1.0001
    # sixty fits took as many scans as the slowest of them, not their sum
    assert scans < 120
    assert M.centroids(spark, fits[0]).columns == ["cluster", "a", "b", "c"]


def test_the_elbow_is_where_costs_stop_to_fall(blobs):
    assert M.elbow(blobs.where("user_id < 9000"), ["a", "b", "c"], 3, 9, 4) in (5, 6)


def test_few_points_make_few_clusters(spark):
    df = spark.createDataFrame([(1.0,), (1.0,), (2.0,), (None,)], "x double")
    fit = M.fit_segments(df, ["x"], 5)
    assert sorted(fit.centers.ravel().tolist()) == [1.0, 2.0] and fit.cost == 0
    assert M.fit_all(df.limit(0), ["x"], [2]) == ([], 2)


@pytest.fixture(scope="module")
def labelled(spark):
    rng = np.random.default_rng(7)
    rows = [(k, ("low" if x < 0.3 else "mid" if x < 0.9 else "high") if k % 50 else None, float(x + rng.normal(0, 0.05)), float(y)) for k, (x, y) in enumerate(rng.uniform(0, 1, (1200, 2)))]
    return spark.createDataFrame(rows, "user_id long, flag string, x double, y double").persist()


def test_parts_hold_their_share_of_every_class(labelled):
    parts = M.stratified_parts(labelled.where("flag is not null"), "flag", ["user_id"], [0.3, 0.35, 0.35], 1)
    share = parts.groupBy("flag").agg(*(F.avg((F.col("part") == k).cast("double")).alias(f"p{k}") for k in range(3)))
    for r in share.collect():
        assert abs(r.p0 - 0.3) < 0.02 and abs(r.p1 - 0.35) < 0.02
    twice = M.stratified_parts(labelled.union(labelled), "flag", ["user_id"], [0.5, 0.5], 1)
    assert twice.groupBy("user_id").agg(F.count_distinct("part").alias("n")).where("n > 1").isEmpty()


def test_random_search_scores_held_out_rows_only(spark, labelled):
    ranges = {"numTrees": (3, 6), "maxDepth": (2, 5)}
    model, got = M.tune_attribute(labelled, "flag", ["x", "y"], ["user_id"], ranges, draws=2)
    again = M.tune_attribute(labelled, "flag", ["x", "y"], ["user_id"], ranges, draws=2)[1]
    assert got == again and got["best"] in M.draw_params(ranges, 2, 42)
    held = M.stratified_parts(labelled.na.drop(), "flag", ["user_id"], [0.3, *[0.7 / 3] * 3], 42).where("part = 0")
    assert sum(got["classes"].values()) == held.count() == sum(got["predictions"].values())
    labels = model.stages[0].labels
    pairs = [(r.flag, labels[int(r.prediction)]) for r in model.transform(held.withColumn("weight", F.lit(1.0))).collect()]
    recall = {c: np.mean([p == c for y, p in pairs if y == c]) for c in got["classes"]}
    assert np.isclose(got["accuracy"], np.mean([y == p for y, p in pairs])) and np.isclose(got["balanced_accuracy"], np.mean(list(recall.values())))
    assert got["over_dummy"] > 1.5 and 0.2 < got["dummy_balanced"] < 0.5


def test_draws_are_seeded_and_differ():
    a = M.draw_params(M.RANGES, 20, 1)
    assert a == M.draw_params(M.RANGES, 20, 1) != M.draw_params(M.RANGES, 20, 2)
    assert len({tuple(sorted(d.items())) for d in a}) == 20 and len(M.draw_params({"a": (1, 2)}, 9, 0)) == 2


def test_rounds_over_lines_are_those_over_all_points(spark):
    """Repeated points are read once, in lines of one quantity and discount, and give Lloyd's own rounds."""
    rng = np.random.default_rng(11)
    x = np.column_stack([rng.integers(0, 5, 4000) / 4, np.round(rng.random(4000), 3), rng.integers(0, 3, 4000) / 2])
    x = np.concatenate([x, x[:500], rng.random((7, 3))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    points, lines, order = M._lines(df, ["a", "b", "c"])
    assert order == ["a", "c", "b"] and points.agg(F.sum("n")).first()[0] == len(x) and lines.count() < 100
    own = x[:, [0, 2, 1]]
    fits = [rng.random((k, 3)) for k in (1, 3, 8, 20)]
    for _ in range(4):
        sums, costs = M._Fits(lines, 3).round(fits)
        for k, (c, total, cost) in enumerate(zip(fits, sums, costs, strict=True)):
            far = ((own[:, None] - c[None]) ** 2).sum(axis=2)
            at = far.argmin(axis=1)
            plain = np.array([[*own[at == j].sum(axis=0), (at == j).sum()] for j in range(len(c))])
            assert np.allclose(total, plain) and np.isclose(cost, far.min(axis=1).sum())
            fits[k] = np.where(total[:, -1:] > 0, total[:, :-1] / np.maximum(total[:, -1:], 1), c)


def test_lines_are_few_and_whole_for_points_that_hardly_repeat(spark):
    """What a round reads are binary lines of up to ``PIECE`` points, not one for each batch; no point is lost, loose and repeated ones count."""
    x = spark.range(300_000, numPartitions=3).select(F.rand(3).alias("x"))
    one = x.union(x.where("x < 0.5")).union(x.where("x < 0.5"))
    two = x.select("x", F.when(F.col("x") < 0.001, F.rand(4)).otherwise(0.5).alias("y"))
    for df, names in ((x, ["x"]), (one, ["x"]), (two, ["x", "y"])):
        points, lines, order = M._lines(df, names)
        assert dict(lines.dtypes)["x"] == "binary" and lines.count() <= 12
        own = points.select(*order).toPandas().to_numpy()
        for c in (own[:1], own[:5]):
            far = ((own[:, None] - c[None]) ** 2).sum(axis=2)
            at = far.argmin(axis=1)
            sums, costs = M._Fits(lines, len(names)).round([c])
            plain = [[*own[at == j].sum(axis=0), (at == j).sum()] for j in range(len(c))]
            assert np.allclose(sums[0], plain) and np.isclose(costs[0], far.min(axis=1).sum())


def test_forests_read_cells_that_stand_for_all_rows(spark):
    """Rows past ``COPIES`` of a cell add weight and no row; every class weighs the same, whatever the order of rows."""
    few = [("a", 1.0, 0.5)] * 3 + [("b", 2.0, 0.5)] * 1000
    df = spark.createDataFrame(few, "flag string, x double, y double")
    own = [sorted(map(tuple, M._cells(d, "flag", ["x", "y"], even=True).collect())) for d in (df, df.repartition(5))]
    assert own[0] == own[1] and len(own[0]) == 3 + M.COPIES
    weight = {c: sum(r[-1] for r in own[0] if r[0] == c) for c in "ab"}
    assert np.isclose(weight["a"], weight["b"], rtol=1e-4)
    assert sum(r["weight"] for r in M._cells(df, "flag", ["x", "y"], even=False).collect()) == len(few)


def test_a_forest_is_the_same_for_rows_in_another_order_and_learns_all_of_them(labelled):
    known = labelled.where("flag is not null")
    one, two = (M.fit_attribute(d, "flag", ["x", "y"]) for d in (known, known.orderBy(F.xxhash64("user_id")).repartition(3)))
    got = [sorted((r.user_id, r.flag, r.prediction) for r in m.transform(known).collect()) for m in (one, two)]
    assert got[0] == got[1] and np.mean([one.stages[0].labels[int(p)] == y for _, y, p in got[0]]) > 0.85
