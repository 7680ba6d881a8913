"""Tables in buckets, exact row caps, ranks over ranges and streams with bounded state, against plain versions."""

import datetime
import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from audiweave.operators import incremental as B
from audiweave.operators import windows as H
from audiweave.sources import tables as A
from audiweave.sources.buckets import BUCKET, EntityTable
from audiweave.streaming import streams as O


@pytest.fixture
def house(spark, tmp_path):
    return A.Warehouse(spark, str(tmp_path / "house"))


def files_of(table):
    top = table._path()
    return {d: sorted(x for x in os.listdir(f"{top}/{d}") if x.startswith("part")) for d in os.listdir(top) if d.startswith(BUCKET)}


def as_rows(df, *names):
    return sorted((tuple(r) for r in df.select(*names).collect()), key=str)


@pytest.fixture
def stored(spark, house):
    rows = [(e, k, f"s{e}{k}", e * k, "d0") for e in range(60) for k in range(3)] + [(None, 1, "none", 1, "d0")]
    table = EntityTable(house, "d", "t", ("e",), 16)
    table.create(spark.createDataFrame(rows, "e int, k int, s string, n int, last_updated_date string"))
    return table


def test_an_upsert_touches_its_buckets_only(spark, stored):
    old = stored.read().persist()
    new = spark.createDataFrame([(3, 1, None, 3), (3, 9, "new", None), (7, 0, "x", 0), (500, 1, "y", 1)], "e int, k int, s string, n int")
    before, numbers = files_of(stored), stored.touched(new)
    want = B.delete_entities(old, new, "e").unionByName(B.upsert(old, new, "e", ["e", "k"], "d1"))
    names = ["e", "k", "s", "n", "last_updated_date"]
    want = as_rows(want, *names)
    stored.upsert(new, ["e", "k"], "d1")
    after = files_of(stored)
    assert as_rows(stored.read(), *names) == want
    changed = {d for d in {*before, *after} if before.get(d) != after.get(d)}
    assert changed == {f"{BUCKET}={n}" for n in numbers} and len(numbers) <= 3
    some = stored.rows_of(numbers)
    assert "PartitionFilters: [_bucket" in some._jdf.queryExecution().executedPlan().toString()
    assert {os.path.basename(os.path.dirname(r[0])) for r in some.select(F.input_file_name()).distinct().collect()} == changed
    stored.upsert(new, ["e", "k"], "d2")
    assert as_rows(stored.read(), *names) == want
    stored.upsert(new.limit(0), ["e", "k"], "d3")
    assert as_rows(stored.read(), *names) == want


def test_new_columns_and_a_table_that_is_not_there_yet(spark, stored, house):
    stored.upsert(spark.createDataFrame([(5, 0, "q", 1.5)], "e int, k int, s string, extra double"), ["e", "k"], "d1")
    got = {(r.e, r.k): (r.s, r.n, r.extra) for r in stored.read().where("e in (5, 6) and k = 0").collect()}
    assert got == {(5, 0): ("q", 0, 1.5), (6, 0): ("s60", 0, None)}
    fresh = EntityTable(house, "d", "fresh", ("e",), 4)
    fresh.upsert(spark.createDataFrame([(1, 1, "a")], "e int, k int, s string"), ["e", "k"], "d1")
    assert as_rows(fresh.read(), "e", "k", "s", "last_updated_date") == [(1, 1, "a", "d1")]


def test_deletes_may_empty_a_bucket(spark, stored):
    numbers = stored.touched(spark.createDataFrame([(3,)], "e int"))
    inside = [r.e for r in stored.rows_of(numbers).select("e").where("e is not null").distinct().collect()]
    every = stored.read().count()
    stored.delete(spark.createDataFrame([(e,) for e in inside] + [(None,), (999,)], "e int"))
    left = stored.read()
    assert left.count() == every - 3 * len(inside) and left.where(F.col("e").isin(inside)).isEmpty() and left.where("e is null").count() == 1


def test_a_write_that_fails_leaves_the_table(spark, stored, house):
    before, rows = files_of(stored), as_rows(stored.read(), "e", "k", "s")
    numbers = stored.touched(spark.createDataFrame([(3,)], "e int"))
    with pytest.raises(Exception, match="broken"):
        stored.replace(stored.rows_of(numbers).withColumn("s", F.when(F.col("k") < 2, F.col("s")).otherwise(F.raise_error(F.lit("broken")))), numbers)
    assert files_of(stored) == before and as_rows(stored.read(), "e", "k", "s") == rows
    with pytest.raises(Exception, match="broken"):
        house.write(stored.read().withColumn("s", F.raise_error(F.lit("broken"))), "d", "t", "overwrite")
    assert as_rows(stored.read(), "e", "k", "s") == rows


def test_a_batch_of_the_change_log_reads_the_buckets_of_its_users(spark, house, tmp_path):
    schema = "user_id string, site string, cluster int, ts timestamp"
    source, state = str(tmp_path / "pred"), str(tmp_path / "state")
    every, rng = {}, random.Random(1)
    expected = []
    for day in range(4):
        batch = {(f"u{rng.randrange(40)}", "s"): rng.randrange(3) for _ in range(25)}
        rows = [(u, s, c, datetime.datetime(2024, 1, 1 + day)) for (u, s), c in batch.items()] + ([(None, None, 1, datetime.datetime(2024, 1, 1 + day))] if day % 2 else [])
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(source)
        O.stream_changes(spark.readStream.schema(schema).parquet(source), house, "d", "log", state, buckets=8).awaitTermination()
        for u, s, c, ts in rows:
            if every.get((u, s)) != c:
                expected.append((u, s, c, ts))
                every[u, s] = c
    assert as_rows(house.read("d", "log"), "user_id", "site", "cluster", "ts") == sorted(expected, key=str)
    latest = EntityTable(house, "d", "log_latest", ("user_id", "site"), 8)
    assert {(r.user_id, r.site): r.cluster for r in latest.read().collect()} == every
    # the same batch again, after its rows were stored but before the stream noted it
    again = spark.createDataFrame(rows, schema)
    name = latest.read().agg(F.max("_batch")).first()[0]
    name = [r[0] for r in latest.read().select("_batch").distinct().collect() if r[0].endswith("-3")][0]
    changed, _ = latest.put_changed(again, "cluster", name)
    assert as_rows(changed, "user_id", "site", "cluster", "ts") == as_rows(house.read("d", "log").where(F.col("batch") == name), "user_id", "site", "cluster", "ts")


def test_watermarked_visitors_of_sixty_days(spark, house, tmp_path):
    schema, source = "user_id string, site string, ts timestamp", str(tmp_path / "views")
    rng, rows, first = random.Random(2), [], datetime.datetime(2024, 1, 1)
    for part in range(20):
        own = [(f"u{rng.randrange(30)}", "s", first + datetime.timedelta(days=3 * part, minutes=rng.randrange(3 * 1440))) for _ in range(120)]
        rows += own
        late = [("late", "s", first + datetime.timedelta(hours=1))] if part > 5 else []
        spark.createDataFrame(own + late, schema).coalesce(1).write.mode("append").parquet(source)
    for name in os.listdir(source):
        if name.startswith("part"):
            at = min(r.ts for r in spark.read.parquet(f"{source}/{name}").where("user_id <> 'late'").collect())
            os.utime(f"{source}/{name}", (at.timestamp(), at.timestamp()))
    stream = O.stream_visitors(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source), house, "d", "seen", str(tmp_path / "cp"))
    stream.awaitTermination()
    states = [s["numRowsTotal"] for p in stream.recentProgress for s in p["stateOperators"]]
    assert len(states) >= 20 and max(states) <= 30 * 9 and O.late_rows(stream) == 14
    batch = spark.createDataFrame(rows, schema).select("user_id", "site", F.to_date("ts").alias("day"))
    stored = house.read("d", "seen")
    names = ["day", "site", "visitors", "returning_visitors"]
    assert as_rows(O.daily_visitors(stored), *names) == as_rows(O.daily_visitors(batch), *names)
    part = O.daily_visitors(stored, 10, "2024-02-01", "2024-02-05")
    assert as_rows(part, *names) == as_rows(O.daily_visitors(batch, 10).where("day between '2024-02-01' and '2024-02-05'"), *names)


@pytest.mark.parametrize("n", [0, 1, 37, 120, 160, 199, 200, 500])
def test_capped_rows_are_those_of_least_hash(spark, n):
    rows = [(k, "a") for k in range(100)] + [(7, f"b{k}") for k in range(50)] + [(None, "same")] * 50
    got = A.cap_rows(spark.createDataFrame(rows, "k int, s string").repartition(5), n, ["k"], 3)
    assert got.columns == ["k", "s"] and got.count() == min(n, 200)
    h = lambda k: int(hashlib.md5(f"{'\\N' if k is None else k}\x1f3".encode()).hexdigest()[:15], 16)
    want = sorted(h(k) for k, _ in rows)[:n]
    assert sorted(h(r.k) for r in got.collect()) == want
    again = A.cap_rows(spark.createDataFrame(rows[::-1], "k int, s string").repartition(2), n, ["k"], 3)
    assert as_rows(got, "k", "s") == as_rows(again, "k", "s")


def test_ranks_of_one_group_are_dealt_over_ranges(spark):
    rows = [("all", k % 7, k) for k in range(3000)] + [("all", 3, 5)] * 500 + [(None, None, 1), (None, 2, 1), ("x", None, 1)]
    df = spark.createDataFrame(rows, "g string, v int, k int").repartition(6)
    got = H.rank_position(df, ["g"], [F.desc("v"), F.asc("k")])
    own = sorted(((r.g, r.v, r.k, r.position) for r in got.collect()), key=lambda r: (r[0] is not None, r[0] or "", r[3]))
    assert len(own) == len(rows) and [r[3] for r in own if r[0] == "all"] == list(range(1, 3501))
    every = [(r[1], r[2]) for r in own if r[0] == "all"]
    assert every == sorted(every, key=lambda r: (-r[0], r[1])) and [(r[1], r[3]) for r in own if r[0] is None] == [(2, 1), (None, 2)]
    assert H.rank_position(df.limit(0), ["g"], [F.desc("v")]).count() == 0
    sums = {(r.g, r.v, r.k): (r.group_sum, r.group_min, r.group_max) for r in H.group_shares(df, ["g"], "v").where("g is null or g = 'x'").collect()}
    assert sums == {(None, None, 1): (2, 2, 2), (None, 2, 1): (2, 2, 2), ("x", None, 1): (None, None, None)}


def test_cached_features_take_any_key(spark, house):
    made = spark.createDataFrame([(1,)], "a int")
    for key in ({"day": "it's"}, {"day": "d'2"}):
        assert house.cached("c", "f", key, lambda: made).count() == 1
        assert house.cached("c", "f", key, lambda: made.limit(0)).count() == 1
