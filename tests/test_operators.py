import json
import os

import pytest
from pyspark.sql import functions as F

from audiweave.functions import text as C
from audiweave.operators import features as G
from audiweave.operators import incremental as B
from audiweave.operators import match as L
from audiweave.operators import profile as P
from audiweave.operators import segments as M
from audiweave.sources import tables as A
from audiweave.streaming import streams as O


@pytest.fixture
def house(spark, tmp_path):
    return A.Warehouse(spark, str(tmp_path / "house"))


def test_upsert_rules(spark):
    old = spark.createDataFrame([(1, 1, "a", 5, "d0"), (1, 2, "b", None, "d0"), (2, 1, "z", 1, "d0")], "e int, k int, s string, n int, last_updated_date string")
    new = spark.createDataFrame([(1, 1, None, 5), (1, 3, "c", None)], "e int, k int, s string, n int")
    got = {(r.e, r.k): (r.s, r.n, r.last_updated_date) for r in B.upsert(old, new, "e", ["e", "k"], "d1").collect()}
    assert got == {(1, 1): ("a", 5, "d0"), (1, 2): ("b", None, "d0"), (1, 3): ("c", None, "d1")}
    zero = B.upsert(old, new, "e", ["e", "k"], "d1", int_null_zero=True).where("k = 3").first()
    assert zero.n == 0
    with pytest.raises(ValueError):
        B.assert_unique(old, ["e"])


def test_upsert_twice_is_once(spark):
    old = spark.createDataFrame([(1, 1, "a", "d0")], "e int, k int, s string, last_updated_date string")
    new = spark.createDataFrame([(1, 1, "b"), (1, 2, "c")], "e int, k int, s string")
    once = B.upsert(old, new, "e", ["e", "k"], "d1")
    assert sorted(map(tuple, B.upsert(once, new, "e", ["e", "k"], "d2").collect())) == sorted(map(tuple, once.collect()))


def test_split_parts_are_disjoint_and_complete(spark):
    df = spark.createDataFrame([(1,), (2,), (None,), (2,)], "k int")
    a, b = B.split_by_membership(df, "k", spark.createDataFrame([(2,), (2,), (None,)], "k int"))
    assert (a.count(), b.count()) == (2, 2)


def test_warehouse(house, spark):
    df = spark.createDataFrame([(1, "x")], "a int, b string")
    assert house.load_if_absent(df, "d", "t") and not house.load_if_absent(df, "d", "t")
    house.write(house.read("d", "t").union(df), "d", "t", "overwrite")
    assert house.read("d", "t").count() == 2
    assert not house.replace_snapshot(df.limit(0), "d", "t") and house.read("d", "t").count() == 2
    assert house.append_once(spark.createDataFrame([(1, "y"), (2, "y")], df.schema), "d", "t", ["a"]).count() == 1
    assert [tuple(r) for r in house.catalog().orderBy("column").collect()] == [("d", "t", "a", "int"), ("d", "t", "b", "string")]
    calls = []
    build = lambda: calls.append(1) or df
    for _ in range(2):
        assert house.cached("c", "f", {"day": "d1"}, build).count() == 1
    assert len(calls) == 1
    house.drop("d", "t")
    assert not house.exists("d", "t")
    house.log_run("d", "t", "loaded successfully.", "2024-01-02")
    assert house.read("runs", "log").count() == 1


def test_checkpoint_dates(house):
    c = B.Checkpoint(house)
    c.begin("j", "d1")
    assert c.get("j") == (None, "d1")
    c.commit("j")
    c.begin("j", "d2")
    c.rollback("j")
    assert c.get("j") == ("d1", None)


def test_landing_readers(spark, tmp_path):
    (tmp_path / "shop__orders_2024.csv").write_text("id,Unnamed: 0\n1,9\n")
    row = A.read_landing_csv(spark, str(tmp_path / "shop__orders_2024.csv"), "id int, `Unnamed: 0` int").first()
    assert row.asDict() == {"id": 1, "dataset": "shop", "table": "orders"}
    (tmp_path / "p1.json").write_text(json.dumps({"parent": 7, "data": [{"x": 1}, {"x": 2}]}))
    (tmp_path / "p2.json").write_text(json.dumps({"parent": 8, "data": []}))
    pages = A.read_json_pages(spark, f"{tmp_path}/p*.json", "parent int, data array<struct<x:int>>")
    assert sorted((r.parent, r.page, r.x) for r in pages.collect()) == [(7, "p1.json", 1), (7, "p1.json", 2)]
    (tmp_path / "a.xml").write_text("<r><v><id>1</id></v><v><id>2</id></v></r>")
    assert A.read_xml_pages(spark, str(tmp_path / "a.xml"), "v", "id int").count() == 2
    (tmp_path / "c.csv").write_text("The-Date,date\nx,2024-01-02\ny,20240103\n")
    got = A.load_csv_set(spark, {"c": str(tmp_path / "c.csv")})["c"]
    assert [(r.the_date, str(r.date)) for r in got.collect()] == [("x", "2024-01-02"), ("y", "2024-01-03")]
    A.export_table(got, str(tmp_path / "out"), "csv")
    assert any(n.endswith(".csv.gz") for n in os.listdir(tmp_path / "out"))
    with pytest.raises(ValueError):
        A.export_table(got, str(tmp_path / "out2"), "xlsx")


def test_jdbc_mirror_is_batched(spark, tmp_path):
    with pytest.raises(Exception, match="(?i)driver"):
        A.mirror_jdbc(spark.range(1), "jdbc:none:x", "t", "append")


def test_traps(spark):
    one = spark.range(1)
    assert one.select(C.local_hour_offset(F.lit(22), F.lit("Asia"))).first()[0] == 27
    assert one.select(C.local_hour_offset(F.lit(22), F.lit("Asia"), wrap=True)).first()[0] == 3
    assert one.select(C.os_group(F.lit("Linux; Android"))).first()[0] == "linux"
    assert one.select(P.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] is None
    flat = spark.createDataFrame([("a", 1.0), ("b", 1.0)], "user_id string, x double")
    assert M.cut_outliers(flat, ["x"], 1.0).count() == 2
    assert M.scale(flat, M.scaling(flat, ["x"])).select("x").distinct().first()[0] == 0
    assert P.health_check(flat.limit(0), "d", "t").count() == 0
    assert P.samples(flat, 1).count() == 2
    same = spark.createDataFrame([("d", 0, None), ("d", 1, "x")], "domain string, cluster int, industry string")
    assert P.profile(same, "industry").first().domain_total == 2


def test_returning_drops_null_clusters_and_zero_groups(spark):
    ev = spark.createDataFrame([("u", "s", "2024-01-01"), ("u", "s", "2024-01-02"), ("v", "s", "2024-01-02"), ("w", "s", "2024-01-02")], "user_id string, site string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    seg = spark.createDataFrame([("u", "s", 1), ("v", "s", 2), ("w", "s", None)], "user_id string, site string, cluster int")
    assert [(r.cluster, r.returning_pct) for r in G.returning_pct(ev, seg, "2024-01-02").collect()] == [(1, 100.0)]
    assert G.returning_pct(ev, seg, "2024-01-02", keep_zero=True).count() == 2


def test_closest_with_threshold_finds_all_near_names(spark):
    a = spark.createDataFrame([("kitten",), ("ab",), ("zzzzzz",)], "name string")
    b = spark.createDataFrame([("sitting",), ("kitten",), ("mitten",), ("b",), ("abcd",)], "name string")
    near = {(r.name, r.entry) for r in L.closest(a, b, 9, 3).collect()}
    full = {(r.name, r.entry) for r in L.closest(a, b, 9).collect() if r.distance <= 3}
    assert {x for x in near if x[1]} == full and ("zzzzzz", None) in near


def test_match_cascade(spark):
    t = spark.createDataFrame([("engineer",), ("software enginer",), ("head of sales team",), ("xq",)], "title string")
    m = spark.createDataFrame([("engineer",), ("software engineer",), ("sales team",)], "master string")
    got = {r.title: (r.master, r.score) for r in L.match_titles(t, m).collect()}
    assert got["engineer"] == ("engineer", 1.0) and got["software enginer"] == ("software engineer", 0.9)
    assert got["head of sales team"][0] == "sales team" and got["xq"][1] < 0.5


def test_streams(spark, house, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text("id,v\n1,2\n")
    for _ in range(2):
        O.stream_landing(spark, str(tmp_path / "in"), "id int, v int", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
    schema = "user_id string, site string, cluster int, ts timestamp"
    for k, cluster in enumerate((1, 1, 2)):
        spark.createDataFrame([("u", "s", cluster)], "user_id string, site string, cluster int").withColumn("ts", F.lit(f"2024-01-0{k + 1}").cast("timestamp")).coalesce(1).write.mode("append").parquet(str(tmp_path / "pred"))
        O.stream_changes(spark.readStream.schema(schema).parquet(str(tmp_path / "pred")), house, "d", "seg", str(tmp_path / "cp2")).awaitTermination()
    assert [r.cluster for r in house.read("d", "seg").orderBy("ts").collect()] == [1, 2]
    visits = spark.createDataFrame([("u", "s"), ("v", "s")], "user_id string, site string")
    assert [(r.user_id, r.cluster, r.soft) for r in O.stream_segments(visits, house.read("d", "seg").where("cluster = 2")).orderBy("user_id").collect()] == [("u", 2, False), ("v", None, True)]
    for _ in range(2):
        O.stream_seen(spark.readStream.schema(schema).parquet(str(tmp_path / "pred")), house, "d", "seen", str(tmp_path / "cp3")).awaitTermination()
    daily = O.daily_visitors(house.read("d", "seen")).orderBy("day").collect()
    assert [(str(r.day), r.visitors, r.returning_visitors) for r in daily] == [("2024-01-01", 1, 0), ("2024-01-02", 1, 1), ("2024-01-03", 1, 1)]
    stored = house.read("d", "seg")
    house.log_failed(stored.where("ts < '2024-01-02'"), "r")
    house.log_failed(stored.where("ts < '1999-01-02'"), "r")
    kept = O.replay(stored, house, "r", lambda df: house.append_once(df, "d", "again", ["user_id", "ts"]))
    assert kept.count() == 1
