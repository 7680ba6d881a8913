"""Queries that once looked at part of their tables, over made tables whose answer shows it."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from audiweave.operators import segments as M
from audiweave.plans import registry


def test_missing_ids_hold_every_order_against_the_customers(spark, tmp_path):
    spark.createDataFrame([(k,) for k in range(1, 7)], "c_custkey long").write.parquet(f"{tmp_path}/customer.parquet")
    orders = [(1, "P", 500000.0), (2, "O", 500000.0), (3, "P", 10.0), (3, "F", 20.0)]
    spark.createDataFrame(orders, "o_custkey long, o_orderstatus string, o_totalprice double").write.parquet(f"{tmp_path}/orders.parquet")
    got = registry.QUERIES["b26_missing_ids"](spark, str(tmp_path))
    assert sorted(r.id for r in got.collect()) == [4, 5, 6]


def test_the_nearest_row_is_found_without_a_row_for_each_pair(spark):
    """A null cost is the nearest of none, ties go to the lesser row, a repeated key keeps its best."""
    a = spark.createDataFrame([(1, 9.0), (2, None), (3, 5.0), (3, 21.0), (4, 15.0)], "k int, x double")
    b = spark.createDataFrame([(10, "p"), (20, "q"), (None, "r"), (20, "a")], "y int, name string")
    out = M.nearest(a, b, lambda r: F.abs(F.col("x") - r["y"]), "k")
    assert out.columns == ["k", "x", "y", "name", "cost"]
    assert {r.k: (r.x, r.y, r.name, r.cost) for r in out.collect()} == {1: (9.0, 10, "p", 1.0), 2: (None, None, "r", None), 3: (21.0, 20, "a", 1.0), 4: (15.0, 10, "p", 5.0)}
    assert M.nearest(a, b.limit(0), lambda r: F.abs(F.col("x") - r["y"]), "k").isEmpty()
    with pytest.raises(ValueError):
        M.nearest(a, b, lambda r: r["y"], "k", most=3)


def test_segments_are_fitted_on_the_rows_that_the_cut_leaves(spark, tmp_path):
    """Three groups, whose means are the centroids, and rows far off in price or quantity, which would be centroids of their own."""
    rng = np.random.default_rng(3)
    near = [(10.0 + 15 * (k % 3) + rng.normal(), 1000.0 * (1 + k % 3) + rng.normal(), 0.01 * (k % 3)) for k in range(600)]
    x = np.array([*near, *((25.0, 500_000.0 + k, 0.01) for k in range(4)), *((2000.0 + k, 2000.0, 0.01) for k in range(4))])
    schema = "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double"
    spark.createDataFrame([(k, 1, *map(float, r)) for k, r in enumerate(x)], schema).write.parquet(f"{tmp_path}/lineitem.parquet")
    for j in range(3):
        x = x[np.abs(x[:, j] - x[:, j].mean()) < 3 * x[:, j].std()]
    assert len(x) == 600
    got = registry.QUERIES["m05_fit_segments"](spark, str(tmp_path)).select("l_quantity", "l_extendedprice", "l_discount").collect()
    means = [x[np.isclose(x[:, 2], 0.01 * j)].mean(axis=0) for j in range(3)]
    assert np.allclose(sorted(map(tuple, got)), means)
