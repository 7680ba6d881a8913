"""Names and titles: closest entries, similarity and the cascade against plain versions of the rules."""

import difflib
import random
import re

import pytest
from pyspark.sql import functions as F

from audiweave.functions import text as C
from audiweave.operators import features as G
from audiweave.operators import match as L
from audiweave.plans import matching


def steps(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        last, row[0] = row[0], i + 1
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], min(row[j + 1] + 1, row[j] + 1, last + (x != y))
    return row[-1]


def names(spark, values, name="name"):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")


def plain_closest(a, b, n):
    return {(x, y, d, k + 1) for x in set(a) - {None} for k, (d, y) in enumerate(sorted((steps(x, y), y) for y in set(b) - {None})[:n])}


@pytest.mark.parametrize("short", [4096, 7])
def test_rising_threshold_finds_the_closest_of_all(spark, monkeypatch, short):
    monkeypatch.setattr(L, "SHORT", short)
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("abcé ") for _ in range(rng.randrange(0, 14)))
    b = [word() for _ in range(120)] + ["the quick brown fox jumps", "the quick brown fix jumps over", None, ""]
    a = [word() for _ in range(60)] + [x[:-1] + "z" for x in b[:20] if x] + ["the quick brown fox", "zzzzzzzzzzzzzzzzzzzzzz", "", None, "😀"]
    got = L.closest(names(spark, a), names(spark, b), 3)
    assert {(r["name"], r.entry, r.distance, r["rank"]) for r in got.collect()} == plain_closest(a, b, 3)


def test_closest_of_two_thousand_names_equals_the_product(spark):
    rng = random.Random(12)
    parts = ["north", "south", "steel", "water", "energy", "bank", "media", "group", "works", "labs", "sea", "bio", "data", "city"]
    make = lambda: " ".join(rng.choice(parts) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "s", " ltd", " 2"])
    a, b = names(spark, {make() for _ in range(9000)}).limit(2000), names(spark, {make() for _ in range(12000)}).limit(2000)
    a, b = (df.persist() for df in (a, b))
    got = L.closest(a, b, 2)
    assert "CartesianProduct" not in (plan := got._jdf.queryExecution().toString()) and "NestedLoop" not in plan
    every = a.crossJoin(b.withColumnRenamed("name", "entry")).withColumn("distance", F.levenshtein("name", "entry"))
    want = L._ranked(every, 2)
    assert got.select("name", "entry", "distance").exceptAll(want.select("name", "entry", "distance")).isEmpty() and got.count() == want.count() == 4000


def test_closest_without_entries_or_names(spark):
    assert L.closest(names(spark, ["a"]), names(spark, []), 2).count() == 0 and L.closest(names(spark, [None]), names(spark, ["a"]), 2).count() == 0
    assert [tuple(r) for r in L.closest(names(spark, ["ab", None]), names(spark, []), 2, 1).select("name", "entry").orderBy("name").collect()] == [(None, None), ("ab", None)]


def test_ratio_equals_difflib(spark):
    rng = random.Random(13)
    words = ["engineer", "chief", "data", "sales", "vp", "manager", "head of", "it"]
    text = lambda: "".join(rng.choice("abc d") for _ in range(rng.randrange(0, 24))) if rng.random() < 0.8 else " ".join(rng.choice(words) for _ in range(rng.randrange(1, 5)))
    pairs = [(text(), text()) for _ in range(10_000)] + [("", ""), ("a", ""), ("éé😀", "é😀"), ("same", "same")]
    got = spark.createDataFrame(pairs, "a string, b string").select("a", "b", L.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert all(abs(r.r - difflib.SequenceMatcher(None, r.a, r.b, autojunk=False).ratio()) < 1e-12 for r in got)
    assert spark.range(1).select(L.ratio(F.lit(None).cast("string"), F.lit("a"))).first()[0] is None


def found(a, b):
    return bool(re.search(rf"\b{re.escape(a)}\b", b) or re.search(rf"\b{re.escape(b)}\b", a))


def similarity(title, master):
    if any(found(w, master) and not found(w, title) for w in ("head", "chief", "president", "vp")):
        return 0.0
    return difflib.SequenceMatcher(None, master, title, autojunk=False).ratio()


def plain_cascade(title, masters):
    """The rules one by one; masters in order of their names, of equal scores the first."""
    masters = sorted(masters)
    if title in masters:
        return title, 1.0
    best = max(masters, key=lambda m: similarity(title, m))
    if similarity(title, best) > 0.7:
        return best, 0.9
    held = [m for m in masters if re.search(r"\w", m) and re.search(r"\w", title) and found(m, title)]
    if len(held) == 1:
        return held[0], 0.8
    near = min(masters, key=lambda m: steps(m, title))
    d = steps(near, title)
    if d < 3:
        return near, 0.7 if near in held else 0.6
    own = [(m, 1 / len(held)) for m in held] if len(held) > 1 and near not in held else []
    return max([*own, (near, 1 / d)], key=lambda x: x[1])


def test_title_cascade_equals_the_rules(spark):
    rng = random.Random(2)
    words = ["engineer", "lead", "consultant", "chief", "data", "sales", "manager", "of", "it", "aengineer", "hr", "head", "vp"]
    masters = sorted({" ".join(rng.sample(words, rng.randrange(1, 3))) for _ in range(30)})
    titles = sorted({" ".join(rng.sample(words, rng.randrange(1, 5))) for _ in range(150)} | {"aengineer lead", "engineeer", "xy", "", "sales-lead", "engineering"})
    got = L.match_titles(names(spark, [*titles, None, titles[0]], "title"), names(spark, [*masters, None], "master")).collect()
    assert {r.title: (r.master, round(r.score, 9)) for r in got} == {t: (m, round(s, 9)) for t in titles for m, s in [plain_cascade(t, masters)]} and len(got) == len(titles)


def test_cascade_keeps_the_distance_where_the_nearest_is_held(spark):
    got = L.match_titles(names(spark, ["sales lead it"], "title"), names(spark, ["sales", "lead"], "master")).first()
    assert (got.master, got.score) == ("sales", 0.125)
    row = spark.range(1).select(L.title_similarity(F.lit("engineering"), F.lit("engineering manager")).alias("s")).first()
    assert abs(row.s - 2 * 11 / 30) < 1e-12
    assert L.match_titles(names(spark, ["a"], "title"), names(spark, [], "master")).count() == 0


def test_cascade_over_the_query_tables(spark, sf_dir):
    masters = [r.master for r in matching._masters(spark, sf_dir).collect()]
    got = matching.l07_match_titles(spark, sf_dir).collect()
    assert got and all((r.master, round(r.score, 9)) == (m, round(s, 9)) for r in got for m, s in [plain_cascade(r.title, masters)])


def test_assigned_titles_and_seniority(spark):
    raw = names(spark, ["C.E.O", "Sales-Manager", "contact", "X", None, "sales manager"], "raw")
    short = spark.createDataFrame([("ceo", "chief executive officer")], "short string, long string")
    got = {r.raw: (r.title, r.master, r.score) for r in L.assign_titles(raw, names(spark, ["ceo", "sales manager"], "master"), short, "raw").collect()}
    same = ("sales manager", "sales manager", 1.0)
    assert got == {"C.E.O": ("ceo", "chief executive officer", 1.0), "Sales-Manager": same, "sales manager": same, "contact": ("contact", "other", 1.0)}
    words = spark.createDataFrame([("chief", "top"), ("sales", "middle")], "keyword string, grp string")
    assert {r.master: r.grp for r in L.seniority(names(spark, ["chief", "sales manager", "zz", None], "master"), words, "none").collect()} == {"chief": "top", "sales manager": "middle", "zz": "none", None: "none"}


def test_clean_titles(spark):
    raw = ["R and D manager", "C++/Java dev", "V.P.-Sales", "x", "Professional and technical staff (e.g. Lawyer, Engineer, Architect)", "", None, "The head\tof"]
    got = [r.x for r in names(spark, raw, "v").select(C.clean_title(F.col("v")).alias("x")).collect()]
    assert got == ["r and d manager", "cjava dev", "vp sales", None, "professional", None, None, "the head\tof"]
    assert names(spark, ["The head of it"], "v").select(C.clean_title(F.col("v"), ("the", "of"))).first()[0] == "head it"


def test_hours_systems_and_engagement_of_a_user(spark):
    hour = lambda c, h: spark.range(1).select(C.local_hour_offset(F.lit(h), F.lit(c))).first()[0]
    assert [hour(c, 1) for c in ("North America", "South America", "Europe", "Africa", "Asia", "Oceania")] == [19, 22, 2, 2, 6, 1] and hour("Europe", 23) == 0
    ev = spark.createDataFrame([("u", "Windows NT 6.1; machine", 0.0, 5.0), ("u", "Windows NT 10.0", 0.5, 0.0), ("u", "Macintosh", 1.0, 4.0), ("u", None, None, 3.0)], "user_id string, agent string, completion double, value double")
    r = ev.groupBy("user_id").agg(*G.os_visits(), *G.engagement()).first()
    assert (r.visits_windows10, r.visits_windows_older, r.visits_macintosh, r.visits_linux, r.mean_completion, r.mean_dwell) == (1, 1, 1, 0, 1.0, 4.0)
