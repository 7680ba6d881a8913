"""Queries for audience selection and country indicators."""

from __future__ import annotations

from pyspark.sql import functions as F

from audiweave.operators import audience as N
from audiweave.operators import profile as P
from audiweave.operators import windows as H
from audiweave.operators.facets import certainty_levels, facet_counts, facet_index, select_bits
from audiweave.plans.inputs import INDICATORS_SQL, PEOPLE_SQL, indicators, people, table
from audiweave.plans.registry import query

I = f"WITH i AS ({INDICATORS_SQL})"
PPL = f"WITH p AS ({PEOPLE_SQL})"
AUD = f"""{PPL}, s AS (SELECT user_id, domain, industry AS attribute, CAST(user_id % 3 = 0 AS INTEGER) AS known, balance AS probability FROM p WHERE industry IS NOT NULL),
x AS (SELECT *, (CASE WHEN known = 0 THEN probability END - min(CASE WHEN known = 0 THEN probability END) OVER w) / nullif(max(CASE WHEN known = 0 THEN probability END) OVER w - min(CASE WHEN known = 0 THEN probability END) OVER w, 0) AS prob_index FROM s WINDOW w AS (PARTITION BY domain, attribute)),
a AS (SELECT user_id, domain, attribute AS industry, known, probability, prob_index, CASE WHEN user_id % 2 = 0 THEN 'job' || CAST(user_id % 5 AS VARCHAR) END AS job, CASE WHEN user_id % 4 <> 0 THEN 'co' || CAST(user_id % 40 AS VARCHAR) END AS company, country FROM x JOIN p USING (user_id, domain))"""


def _audience(spark, sf):
    p = people(spark, sf)
    scores = p.where("industry is not null").select("user_id", "domain", F.col("industry").alias("attribute"), (F.col("user_id") % 3 == 0).cast("int").alias("known"), F.col("balance").alias("probability"))
    job = p.where("user_id % 2 = 0").select("user_id", F.concat(F.lit("job"), (F.col("user_id") % 5).cast("string")).alias("job"))
    company = p.select("user_id", "country", F.when(F.col("user_id") % 4 != 0, F.concat(F.lit("co"), (F.col("user_id") % 40).cast("string"))).alias("company"))
    return N.audience(scores, job, company)


@query(f"{AUD} SELECT user_id, industry, known, round(prob_index, 4) AS prob_index, job, company FROM a")
def n01_audience(spark, sf_dir):
    return _audience(spark, sf_dir).select("user_id", "industry", "known", F.round("prob_index", 4).alias("prob_index"), "job", "company")


@query(f"{AUD} SELECT user_id FROM a WHERE country IN ('NATION_1', 'NATION_2', 'NATION_3') AND industry IN ('BUILDING', 'MACHINERY') AND company IS NOT NULL")
def n02_select_audience(spark, sf_dir):
    chosen = {"country": ["NATION_1", "NATION_2", "NATION_3"], "continent": ["anything"], "industry": ["BUILDING", "MACHINERY"], "job": ["all"]}
    return N.audience_users(N.select_audience(_audience(spark, sf_dir), chosen).where("company is not null"))


FACETS = ("industry", "job", "company", "country", "known")
_WITHIN = "country IN ('NATION_1', 'NATION_2', 'NATION_3', 'NATION_7') AND (prob_index >= 1 - 0.6 OR known = 1)"


@query(f"{AUD}, f AS (SELECT * FROM a WHERE {_WITHIN}) " + " UNION ALL ".join(f"SELECT '{c}' AS facet, CAST({c} AS VARCHAR) AS value, count(DISTINCT user_id) AS users FROM f WHERE {c} IS NOT NULL GROUP BY 2" for c in FACETS))
def n02_facet_counts(spark, sf_dir):
    """N2, N3, G22 from bitmaps: users of every facet value within a selection of countries and a certainty."""
    index = facet_index(certainty_levels(_audience(spark, sf_dir)), [*FACETS, "certainty"])
    chosen = {"country": ["NATION_1", "NATION_2", "NATION_3", "NATION_7"], "certainty": list(range(61)), "job": ["all"]}
    return facet_counts(index, select_bits(index, chosen)).where("facet <> 'certainty'")


@query(f"{AUD} SELECT user_id, industry FROM a WHERE prob_index >= 1 - 0.3 OR known = 1")
def n03_by_certainty(spark, sf_dir):
    return N.by_certainty(_audience(spark, sf_dir), 0.3).select("user_id", "industry")


@query(f"{AUD} SELECT DISTINCT user_id FROM a WHERE job IS NOT NULL")
def n04_audience_users(spark, sf_dir):
    return N.audience_users(_audience(spark, sf_dir).where("job is not null"))


@query(f"""{AUD} SELECT count(DISTINCT user_id) AS users, count(DISTINCT user_id) FILTER (known = 1) AS known, count(DISTINCT user_id) FILTER (known = 0) AS lookalike, count(DISTINCT user_id) FILTER (industry IS NOT NULL) AS with_industry,
 count(DISTINCT user_id) FILTER (job IS NOT NULL) AS with_job, count(DISTINCT user_id) FILTER (job IS NOT NULL AND industry IS NOT NULL) AS with_both FROM a""")
def g22_audience_counts(spark, sf_dir):
    return P.audience_counts(_audience(spark, sf_dir))


@query("""WITH c AS (SELECT p_type, count(*) AS n FROM part GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY n DESC, p_type) AS r FROM c) SELECT CASE WHEN r <= 4 THEN p_type ELSE 'Others' END AS p_type, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1""")
def g23_top_with_others(spark, sf_dir):
    return P.top_with_others(table(spark, sf_dir, "part"), "p_type", 4)


@query(f"{AUD} SELECT company, count(DISTINCT user_id) AS users, 'x' || company AS note FROM a WHERE company IS NOT NULL GROUP BY company")
def g24_company_table(spark, sf_dir):
    aud = _audience(spark, sf_dir)
    companies = aud.where("company is not null").select("company", F.concat(F.lit("x"), "company").alias("note")).distinct()
    return P.company_table(aud, companies)


@query("SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT c_nationkey FROM customer GROUP BY 1 HAVING count(*) >= 60)")
def g25_drop_small(spark, sf_dir):
    return P.drop_small(table(spark, sf_dir, "customer"), "c_nationkey", 60).select("c_custkey", "c_nationkey")


@query(f"{PPL} SELECT domain, coalesce(max(cluster) + 1, 0) AS n_clusters FROM p GROUP BY 1")
def g26_n_clusters(spark, sf_dir):
    return P.n_clusters(people(spark, sf_dir), ["domain"])


@query("SELECT r_name, string_agg(DISTINCT n_name, ',' ORDER BY n_name) AS children FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def g27_facet_tree(spark, sf_dir):
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return P.facet_tree(n.join(r, n.n_regionkey == r.r_regionkey), "r_name", "n_name").withColumn("children", F.array_join("children", ","))


@query(f"{I} SELECT country, max(year) AS year, arg_max(value, year) AS value FROM i WHERE year <= 1999 GROUP BY 1")
def n05_latest_indicator(spark, sf_dir):
    return N.latest_indicator(indicators(spark, sf_dir), 1999).select("country", "year", "value")


@query(f"""{I}, k AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY (year = 2001) DESC) AS r FROM i WHERE year IN (2001, 2000) AND (length(country) % 2 = 0 OR year = 2000)) SELECT country, year, value FROM k WHERE r = 1""")
def n06_indicator_at(spark, sf_dir):
    return N.indicator_at(indicators(spark, sf_dir).where("length(country) % 2 = 0 or year <> 2001"), 2001, 2000).select("country", "year", "value")


@query(f"{I} SELECT country, CAST(trunc(100 * (trunc(max(value) FILTER (year = 2000)) - trunc(max(value) FILTER (year = 1996))) / trunc(max(value) FILTER (year = 1996))) AS INTEGER) AS growth FROM i GROUP BY 1")
def n07_growth(spark, sf_dir):
    return N.growth(indicators(spark, sf_dir), 1996, 2000).select("country", "growth")


@query(f"{I}, l AS (SELECT country, arg_max(value, year) AS value FROM i GROUP BY 1) SELECT country, value, CAST(row_number() OVER (ORDER BY value DESC, country) AS INTEGER) AS rank FROM l")
def n08_world_rank(spark, sf_dir):
    """N8, H7."""
    return N.world_rank(indicators(spark, sf_dir)).select("country", "value", "rank")


@query(f"""{I}, r AS (SELECT country, year, row_number() OVER (PARTITION BY year ORDER BY value DESC, country) AS rank FROM i), k AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY year DESC) AS n FROM r)
SELECT country, CAST(max(rank) FILTER (n = 1) AS INTEGER) AS rank, CAST(max(rank) FILTER (n = 2) AS INTEGER) AS previous, CAST(max(rank) FILTER (n = 2) - max(rank) FILTER (n = 1) AS INTEGER) AS change FROM k WHERE n <= 2 GROUP BY 1""")
def n09_rank_change(spark, sf_dir):
    ranks = H.rank_position(indicators(spark, sf_dir), ["year"], [F.desc("value"), F.asc("country")], "rank")
    return N.rank_change(ranks)


@query("SELECT p_brand, round(count(*) FILTER (p_size > 20) / count(*), 4) AS completeness, count(*) FILTER (p_size > 20) / count(*) > 0.5 AS publishable FROM part GROUP BY 1")
def n10_completeness(spark, sf_dir):
    facts = table(spark, sf_dir, "part").select("p_brand", F.when(F.col("p_size") > 20, F.col("p_size")).alias("value"))
    return N.completeness(facts, "p_brand").withColumn("completeness", F.round("completeness", 4))


@query(f"""{I}, v AS (SELECT country, max(CASE WHEN year = 1999 THEN CAST(CAST(round(value) AS BIGINT) AS VARCHAR) END) AS a FROM i GROUP BY 1) SELECT country, 'In 1999: ' || coalesce(a, 'v??') || ', later v??.' AS text FROM v""")
def n11_fill_template(spark, sf_dir):
    facts = indicators(spark, sf_dir).select("country", "indicator", "year", F.round("value").cast("long").cast("string").alias("value"))
    template = spark.createDataFrame([(1, "In 1999: {Orders in USD|1999|value}, later {Orders in USD|2050|value}.")], "template_id int, text string")
    return N.fill_template(template, facts).select("country", "text")


@query(f"{I} SELECT country FROM i ORDER BY year DESC, value DESC, country LIMIT 5")
def n12_country_set(spark, sf_dir):
    """N12, I2."""
    return N.country_set(indicators(spark, sf_dir), 5, "Orders in USD")


@query("""SELECT l_shipmode AS pf_code, y AS yr, s AS rt_code, q AS cmd_code, d AS cmd_desc FROM (SELECT 'HS' AS l_shipmode, year(l_shipdate) AS y, l_suppkey AS s, l_partkey % 50 AS q, max(l_returnflag) OVER (PARTITION BY l_partkey % 50, year(l_shipdate)) AS d, max(year(l_shipdate)) OVER (PARTITION BY l_partkey % 50) AS m FROM lineitem) WHERE y > 1996""".replace(", d AS cmd_desc", ""))
def n13_trade_facts(spark, sf_dir):
    """N13, C37."""
    raw = table(spark, sf_dir, "lineitem").select(
        F.lit("HS").alias("pf_code"), F.year("l_shipdate").cast("string").alias("yr"), F.col("l_suppkey").cast("string").alias("rt_code"), F.lit("0").alias("pt_code"),
        (F.col("l_partkey") % 50).cast("string").alias("cmd_code"), F.lit("1").alias("trade_value"), F.col("l_returnflag").alias("cmd_desc"),
    )
    facts, _ = N.trade_tables(raw)
    return N.trade_scope(facts, after=1996).select("pf_code", "yr", "rt_code", "cmd_code")


@query("""SELECT cmd_code, cmd_desc FROM (SELECT l_partkey % 50 AS cmd_code, l_returnflag AS cmd_desc, row_number() OVER (PARTITION BY l_partkey % 50 ORDER BY year(l_shipdate) DESC, l_returnflag DESC) AS k FROM lineitem) WHERE k = 1""")
def n13_trade_codes(spark, sf_dir):
    raw = table(spark, sf_dir, "lineitem").select(
        F.lit("HS").alias("pf_code"), F.year("l_shipdate").alias("yr"), F.lit(0).alias("rt_code"), F.lit(0).alias("pt_code"), (F.col("l_partkey") % 50).alias("cmd_code"), F.lit(1).alias("trade_value"), F.col("l_returnflag").alias("cmd_desc")
    )
    return N.trade_tables(raw)[1]


@query("SELECT country, city, value FROM (SELECT *, row_number() OVER (PARTITION BY country ORDER BY value DESC, city) AS k FROM (SELECT c_nationkey AS country, c_name AS city, c_acctbal AS value FROM customer)) WHERE k <= 3")
def i03_largest_cities(spark, sf_dir):
    return N.largest_cities(table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("country"), F.col("c_name").alias("city"), F.col("c_acctbal").alias("value")))


@query(f"{I} SELECT country, year, value FROM i ORDER BY value DESC, country LIMIT 10")
def i01_top_values(spark, sf_dir):
    """The ten greatest yearly values over all countries."""
    return H.top_n(indicators(spark, sf_dir), [F.desc("value"), F.asc("country")], 10).select("country", "year", "value")
