"""Facet counts from bitmaps and rolling features, against row-wise plain versions."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from audiweave.operators import audience as N
from audiweave.operators import facets as K
from audiweave.operators import features as G
from audiweave.operators import rolling as R
from audiweave.sources.tables import Warehouse


@pytest.fixture(scope="module")
def people(spark):
    rng = random.Random(4)
    pick = lambda *x: rng.choice([*x, None])
    rows = [
        (k, pick("it", "law"), pick("a", "b", "c"), pick("A", "B"), pick("x", "y"), rng.choice([None, [], ["p"], ["p", "q"], ["q", "r", "q"]]), rng.choice([0, 1, None]), pick(0.0, 0.29, 0.3, 0.71, 1.0), rng.choice([0, 1, None]))
        for k in range(70_000)
    ]
    return spark.createDataFrame(rows, "user_id long, industry string, city string, country string, company_country string, tags array<string>, known int, prob_index double, known_job int").persist()


def plain_counts(df, names):
    out = {}
    for c in names:
        own = df.select("user_id", (F.explode_outer("tags") if c == "tags" else F.col(c)).alias("v"))
        out |= {(c, str(r.v)): r.n for r in own.where("v is not null").groupBy("v").agg(F.count_distinct("user_id").alias("n")).collect()}
    return out


def test_bitmap_counts_equal_row_counts(spark, people):
    names = ["industry", "city", "country", "company_country", "tags", "known"]
    index = K.facet_index(K.certainty_levels(people), [*names, "certainty"], ("tags",)).persist()
    numbers = K.number_users(people.union(people)).agg(F.min("n"), F.max("n"), F.count_distinct("n")).first()
    assert tuple(numbers) == (1, 70_000, 70_000)
    for chosen in (
        {}, {"city": ["all"], "industry": ["it"]}, {"industry": ["it", "law"], "country": ["A"], "tags": ["p", "q"]}, {"city": ["b", "c"], "country": ["B"]},
        {"company_country": ["y"], "tags": ["q"]}, {"industry": ["none such"]}, {"known": [1], "tags": ["all"]},
    ):
        want = N.select_audience(people, chosen, ("tags",))
        bits = K.select_bits(index, chosen, ("tags",))
        assert K.count_users(bits).first().users == want.count()
        got = {(r.facet, r.value): r.users for r in K.facet_counts(index, bits).where("facet <> 'certainty'").collect()}
        assert got == plain_counts(want, names)
    for p in (0, 29, 70, 71, 100):
        want = N.by_certainty(people, p / 100).count()
        assert K.count_users(K.select_bits(index, {"certainty": list(range(p + 1))})).first().users == want


def test_index_of_no_rows_and_of_repeated_users(spark, people):
    index = K.facet_index(people.limit(0), ["city"])
    assert index.count() == 0 and K.count_users(K.select_bits(index, {"city": ["a"]})).first().users == 0
    with pytest.raises(ValueError, match="not unique"):
        K.facet_index(people.limit(5).union(people.limit(5)), ["city"])


def test_levels_and_known_flags(spark, people):
    chosen = {"company_city": ["a"], "company_state": ["b"], "company_country": ["c"], "employees": ["1-10"], "revenue": ["all"]}
    assert N.active_facets(chosen) == {"company_city": ["a"], "employees": ["1-10"]}
    rows = [(r.known, r.known_job, r.prob_index) for r in people.collect()]
    sure = [r for r in rows if r[0] == 1 or r[2] is not None and r[2] >= 1 - 0.3]
    assert N.by_certainty(people, 0.3, False).count() == sum(r[0] != 1 for r in sure)
    assert N.by_certainty(people, 0.3, True, False).count() == sum(r[1] != 1 for r in sure)


@pytest.fixture(scope="module")
def views(spark):
    rng, first = random.Random(9), datetime.datetime(2024, 1, 1)
    rows = [
        (k, rng.choice(["u1", "u2", "u3", None]), first + datetime.timedelta(minutes=rng.randrange(20 * 1440)), f"s{rng.randrange(150)}", k // 2, rng.choice(["web", "amp", None]), rng.choice([None, "https://www.google.com/", "https://a.example.net/"]),
         rng.choice([None, "Linux", "Windows NT 10.0"]), rng.choice([None, "Asia", "Africa", "Oceania"]), rng.choice([0.0, 0.5, None]), rng.choice([0.0, 3.0]), "site", rng.choice(["t1", "t2", None]))
        for k in range(2500)
    ]
    return spark.createDataFrame(rows, "event_id long, user_id string, ts timestamp, session_id string, view_id long, client string, referrer string, agent string, continent string, completion double, value double, site string, title string").persist()


def test_rolled_windows_equal_a_full_pass(spark, views, tmp_path):
    at = R.RollingFeatures(Warehouse(spark, str(tmp_path / "house")), "f", "daily")
    for end in ("2024-01-12", "2024-01-13", "2024-01-10"):
        got = {r.user_id: r for r in at.features(views, end, 7).collect()}
        own = views.where(F.to_date("ts").between(F.date_sub(F.lit(end).cast("date"), 7), F.lit(end).cast("date")))
        full = own.groupBy("user_id").agg(F.count("*").alias("events"), *G.referrer_visits(), *G.client_visits(), *G.continent_visits(), *G.os_visits(), G.mean_local_hour(), *G.engagement(), *G.views_sessions()).collect()
        assert len(full) == len(got) == 4
        for r in full:
            for name, want in r.asDict().items():
                have = got[r.user_id][name]
                if name in ("sessions", "views"):
                    assert abs(have - want) <= 0.05 * want
                elif isinstance(want, float):
                    assert abs(have - want) < 1e-9
                else:
                    assert have == want, name
    assert at.built() == {datetime.date(2024, 1, d) for d in range(3, 14)}


def test_a_new_end_date_reads_one_new_day(spark, views, tmp_path):
    at = R.RollingFeatures(Warehouse(spark, str(tmp_path / "house")), "f", "daily")
    at.features(views, "2024-01-12", 5)
    # other days' events would break the run if they were read
    broken = views.withColumn("client", F.when(F.to_date("ts") == "2024-01-13", F.col("client")).otherwise(F.raise_error(F.lit("read"))))
    assert at.features(broken, "2024-01-13", 5).count() == 4
    assert at.features(broken, "2024-01-13", 5).count() == 4
    with pytest.raises(Exception, match="read"):
        at.features(broken, "2024-01-14", 5)


def test_features_in_one_aggregate_each(spark, views):
    out = G.user_features(views, views.where("user_id = 'u1'"), "2024-02-01")
    assert "Expand" not in out._jdf.queryExecution().executedPlan().toString()
    direct = {r.user_id: r for r in views.groupBy("user_id").agg(*G.views_sessions(), *G.recency_frequency("2024-02-01")).collect()}
    for r in out.collect():
        want = direct[r.user_id]
        assert (r.sessions, r.views, r.recency, r.is_lead) == (want.sessions, want.views, want.recency, r.user_id == "u1")
        assert (r.frequency is None) == (want.frequency is None) and (r.frequency is None or abs(r.frequency - want.frequency) < 1e-9)
