"""Nulls, empty tables, repeated rows and ties; operators that SQL can't express against plain versions."""

import pytest
from pyspark.sql import functions as F

from audiweave.functions import text as C
from audiweave.operators import features as G
from audiweave.operators import incremental as B
from audiweave.operators import joins as J
from audiweave.operators import nested as D
from audiweave.operators import profile as P
from audiweave.operators import segments as M
from audiweave.operators import windows as H
from audiweave.sources.scratch import shared_folder


def one(spark, values, make, kind="string"):
    return [r.x for r in spark.createDataFrame([(v,) for v in values], f"v {kind}").select(make(F.col("v")).alias("x")).collect()]


def test_referrers_and_systems(spark):
    refs = ["https://www.microsoft.com/", "https://t.co/x", "https://www.youtube.com/", "https://yandex.ru/q", "https://go.pardot.com/l", "https://mail.example.org/", "", None, "https://a.shop.com/"]
    got = one(spark, refs, lambda c: C.referrer_group(c, F.lit("shop.com")))
    assert got == ["other", "social", "social", "search", "email", "other", "typed", "typed", "own"]
    agents = ["X11; Linux; Android", "Android 9", "Windows NT 10.0", "Windows NT 6.1", "iPhone; AppleWebKit", "Macintosh; AppleWebKit", "iPad AppleWebKit", "windows", "", None]
    assert one(spark, agents, C.os_group) == ["linux", "android", "windows10", "windows_older", "iphone", "macintosh", "apple_other", "other_os", "other_os", "other_os"]


def test_company_names(spark):
    names = ["Smith & Sons Group Ltd.", "Acme S.A.", "Foo Pty Ltd", "Bar GmbH, Co. KG", "Ltd", "Costa Coffee", "", None]
    assert one(spark, names, C.clean_company) == ["smith and sons", "acme", "foo", "bar", "ltd", "costa coffee", "", None]


def test_a_large_dictionary_is_refused(spark):
    with pytest.raises(ValueError, match="more than 5 rows"):
        J.small(spark.range(6), 5)
    assert J.small(spark.range(5), 5).count() == 5


@pytest.mark.parametrize("partitions", [1, 7, 50])
def test_chunks_of_groups(spark, partitions):
    rows = [(k % 40 if k % 41 else None,) for k in range(900)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = {r.k: (r.rows, r.chunk) for r in B.chunk_groups(spark.createDataFrame(rows, "k int"), "k", 100).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    total = 0
    for k in sorted({k for (k,) in rows}, key=lambda k: (k is not None, k or 0)):
        own = sum(x == k for (x,) in rows)
        total += own
        assert got[k] == (own, (total - 1) // 100)
    assert len(got) == 41 and B.chunk_groups(spark.createDataFrame([], "k int"), "k", 5).count() == 0


def test_health_check_of_nulls_constants_and_no_rows(spark):
    df = spark.createDataFrame([(1, 5.0, None, "a"), (2, 5.0, None, None), (30, None, None, "b")], "a int, b double, c double, d string")
    got = {r.column: (round(r.coverage, 2), r.max_z) for r in P.health_check(df, "x", "y").collect()}
    assert got["b"] == (0.67, None) and got["c"] == (0.0, None) and got["d"] == (0.67, None) and got["a"][0] == 1 and abs(got["a"][1] - 1.4140) < 0.01
    assert P.health_check(df.limit(0), "x", "y").count() == 0


def test_text_boxes(spark):
    rows = [(1, None, (7, "x"), (8, "y", "n")), (2, None, None, (9, None, None)), (3, "TABLE", (5, "z"), None), (4, None, None, None)]
    df = spark.createDataFrame(rows, "r int, type string, `10` struct<id:int,answer:string>, `2` struct<id:int,answer:string,note:string>")
    got = D.unpack_textboxes(df, ["r"])
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 7, "x", None), (1, 8, "y", "n"), (2, 9, None, None)] and got.columns == ["r", "option_id", "answer", "note"]
    assert D.unpack_textboxes(df.select("r", "type"), ["r"]).count() == 0


def test_medians(spark):
    rows = [(float(k),) for k in range(101)] + [(None,)] * 7
    df = spark.createDataFrame(rows, "v double")
    filled = M.fit_imputer(df, ["v"]).transform(df).where("v >= 49 and v <= 51").count()
    assert filled in (3 + 7, 2 + 7)


def test_windows_and_features_of_nulls_ties_and_no_rows(spark):
    ev = spark.createDataFrame([("u", "s", 1), ("u", "s", 1), (None, "s", 2), ("v", None, None)], "user_id string, site string, v int")
    assert H.latest_per(ev, ["user_id"], [F.desc("v")]).count() == 3
    assert H.latest_per(ev.limit(0), ["user_id"], [F.desc("v")]).count() == 0
    star = G.star(ev.select("user_id").distinct(), ev.groupBy("user_id").agg(F.count("v").alias("n")))
    assert sorted((r.user_id or "", r.n) for r in star.collect()) == [("", None), ("u", 2), ("v", 0)]
    assert {r.column: r.coverage for r in P.coverage(ev).collect()} == {"user_id": 0.75, "site": 0.75, "v": 0.75} and P.coverage(ev.limit(0)).count() == 0


def test_no_folder_of_one_machine_on_a_cluster(spark, monkeypatch):
    class Conf:
        get = staticmethod(lambda *_: None)

    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Session:
        conf, sparkContext = Conf, Context

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session)
    assert shared_folder(spark)
