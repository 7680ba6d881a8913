"""Queries that match names, titles and identities."""

from __future__ import annotations

from pyspark.sql import functions as F

from audiweave.operators import match as L
from audiweave.operators.segments import nearest
from audiweave.plans.inputs import table
from audiweave.plans.registry import query


@query("SELECT s_suppkey, unnest(['Acme (' || s_name || ')', s_name, 'Acme']) AS candidate FROM supplier")
def l02_expand_parens(spark, sf_dir):
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.concat(F.lit("Acme ("), "s_name", F.lit(")")).alias("name"))
    return L.expand_parens(s, "name").select("s_suppkey", "candidate")


@query("""WITH a AS (SELECT DISTINCT p_name || ' ' || right(p_brand, 1) AS name FROM part WHERE p_partkey % 2 = 1), b AS (SELECT DISTINCT p_name || ' ' || right(p_brand, 1) AS entry FROM part WHERE p_partkey % 2 = 0),
d AS (SELECT name, entry, levenshtein(name, entry) AS distance FROM a, b WHERE levenshtein(name, entry) <= 3), r AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, entry) AS k FROM d)
SELECT a.name, r.entry, CAST(r.distance AS INTEGER) AS distance FROM a LEFT JOIN (SELECT * FROM r WHERE k <= 2) r USING (name)""")
def l03_closest_names(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumn("name", F.concat_ws(" ", "p_name", F.right("p_brand", F.lit(1))))
    return L.closest(p.where("p_partkey % 2 = 1"), p.where("p_partkey % 2 = 0"), 2, 3).select("name", "entry", "distance")


ANY = """WITH a AS (SELECT DISTINCT p_name || ' ' || lower(p_type) AS name FROM part), b AS (SELECT DISTINCT p_brand || ' ' || p_name AS entry FROM part),
r AS (SELECT name, entry, levenshtein(name, entry) AS distance FROM a, b) SELECT name, entry, CAST(distance AS INTEGER) AS distance, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY distance, entry) AS k FROM r) WHERE k <= 3"""


@query(ANY)
def l03_closest_any(spark, sf_dir):
    """L3 without a threshold."""
    p = table(spark, sf_dir, "part")
    names, entries = p.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("name")), p.select(F.concat_ws(" ", "p_brand", "p_name").alias("name"))
    return L.closest(names, entries, 3).select("name", "entry", "distance", "rank")


@query()
def l06_title_similarity(spark, sf_dir):
    """Tests hold the ratio against a plain one on random pairs."""
    p = table(spark, sf_dir, "part")
    a = p.select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("title"), F.concat_ws(" ", F.lower("p_type"), F.lit("head"), F.reverse(F.split("p_name", " "))[0]).alias("master"))
    heads = a.select(F.col("master").alias("title"), F.col("title").alias("master"))
    both = a.union(heads).distinct()
    return both.withColumn("similarity", L.title_similarity(F.col("title"), F.col("master")))


def _titles(spark, sf):
    return table(spark, sf, "part").select(F.concat_ws(" ", "p_name", F.lower("p_type")).alias("title"))


def _masters(spark, sf):
    p = table(spark, sf, "part")
    return p.select(F.concat_ws(" ", F.split("p_name", " ")[0], F.lower("p_type")).alias("master")).union(p.select(F.split("p_name", " ")[1].alias("master"))).distinct()


@query()
def l07_match_titles(spark, sf_dir):
    """A test works out the cascade over these tables in plain Python."""
    return L.match_titles(_titles(spark, sf_dir), _masters(spark, sf_dir))


@query()
def l08_assign_titles(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    short = p.select(F.split("p_name", " ")[1].alias("short"), F.concat(F.split("p_name", " ")[1], F.lit(" maker")).alias("long")).distinct()
    raw = p.select(F.when(F.col("p_size") % 10 == 0, "Contact.").otherwise(F.concat_ws("-", F.upper("p_name"), "p_type")).alias("raw"))
    return L.assign_titles(raw, _masters(spark, sf_dir), short, "raw")


@query()
def l09_seniority(spark, sf_dir):
    masters = _titles(spark, sf_dir).distinct().withColumnRenamed("title", "master")
    p = table(spark, sf_dir, "part")
    words = p.select(F.split("p_name", " ")[0].alias("keyword"), F.col("p_type").alias("grp")).groupBy("keyword").agg(F.min("grp").alias("grp"))
    return L.seniority(masters, words, "other")


@query("""WITH f AS (SELECT user_id, ts, 'u' || CAST(user_id AS VARCHAR) || '@x.org' AS email FROM events), p AS (SELECT c_custkey AS prospect_id, 'u' || CAST(c_custkey AS VARCHAR) || '@x.org' AS email FROM customer)
SELECT user_id, email, CAST(epoch_us(max(ts)) AS BIGINT) AS us, prospect_id FROM f JOIN p USING (email) WHERE ts >= (SELECT max(ts) FROM f) - INTERVAL 1 DAY GROUP BY 1, 2, prospect_id""")
def l10_match_emails(spark, sf_dir):
    mail = lambda c: F.concat(F.lit(" U"), F.col(c).cast("string"), F.lit("@x.org"))
    forms = table(spark, sf_dir, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"), mail("user_id").alias("email"))
    prospects = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("prospect_id"), mail("c_custkey").alias("email"))
    return L.match_emails(forms, prospects).select("user_id", "email", F.unix_micros("ts").alias("us"), "prospect_id")


@query("SELECT DISTINCT p_name AS master FROM part WHERE p_name <> 'red widget' UNION SELECT lower(p_type) FROM part UNION SELECT 'chief tester'")
def l11_master_titles(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return L.master_titles(p.select(F.col("p_name").alias("master")), p.select(F.lower("p_type").alias("long")), ["chief tester"], ["red widget"])


@query("""SELECT keyword, region, term, value, CASE WHEN value >= 5000 THEN 'breakout' ELSE 'rising' END AS growth FROM (SELECT *, row_number() OVER (PARTITION BY keyword, region ORDER BY value DESC, term) AS k FROM
(SELECT c_mktsegment AS keyword, c_nationkey AS region, c_name AS term, c_acctbal AS value FROM customer)) WHERE k <= 20""")
def c32_rising_terms(spark, sf_dir):
    c = table(spark, sf_dir, "customer")
    return L.rising_terms(c.select(F.col("c_mktsegment").alias("keyword"), F.col("c_nationkey").alias("region"), F.col("c_name").alias("term"), F.col("c_acctbal").alias("value")))


@query("""SELECT c_custkey, n_nationkey, round(abs(c_acctbal - n_nationkey * 400), 4) AS cost FROM (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY abs(c_acctbal - n_nationkey * 400), n_nationkey) AS k FROM customer, nation) WHERE k = 1""")
def f10_nearest(spark, sf_dir):
    """Customers to the 25 rows of ``nation``."""
    n = table(spark, sf_dir, "nation").select("n_nationkey")
    out = nearest(table(spark, sf_dir, "customer"), n, lambda x: F.abs(F.col("c_acctbal") - x["n_nationkey"] * 400), "c_custkey")
    return out.select("c_custkey", "n_nationkey", F.round("cost", 4).alias("cost"))
