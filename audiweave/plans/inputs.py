"""The driver's tables seen as page views, segments, facts and payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The same page views in Spark SQL and in DuckDB; only the title's extraction differs.
_VIEWS = """
SELECT event_id, user_id, ts, event_type AS site, {title} AS title, value,
  CASE WHEN event_id % 2 = 0 THEN 'web' ELSE 'amp' END AS client, event_id - event_id % 3 AS view_id,
  CASE event_id % 11 WHEN 0 THEN 'https://www.google.com/search' WHEN 1 THEN 'https://m.facebook.com/x' WHEN 2 THEN NULL WHEN 3 THEN 'https://go.pardot.com/l/1'
    WHEN 4 THEN 'https://news.example.net/' WHEN 5 THEN 'https://' || event_type || '.example.com/' WHEN 6 THEN 'https://www.microsoft.com/' WHEN 7 THEN 'https://t.co/ab1'
    WHEN 8 THEN 'https://yandex.example/q' WHEN 9 THEN 'https://www.youtube.com/watch' ELSE 'https://other.example.org/' END AS referrer,
  CASE event_id % 9 WHEN 0 THEN 'Mozilla (Windows NT 10.0; Win64)' WHEN 1 THEN 'Mozilla (Linux; Android 13)' WHEN 2 THEN 'Mozilla (iPhone; like Mac OS)' WHEN 3 THEN 'Googlebot' WHEN 4 THEN 'Mozilla (X11; Linux)'
    WHEN 5 THEN 'Mozilla (Windows NT 6.1)' WHEN 6 THEN 'Mozilla (Macintosh) AppleWebKit' WHEN 7 THEN 'AppleWebKit (iPad)' ELSE 'Dalvik (Android 9)' END AS agent,
  (event_id % 5) * 0.25E0 AS completion,
  CASE user_id % 7 WHEN 0 THEN 'Europe' WHEN 1 THEN 'Asia' WHEN 2 THEN 'North America' WHEN 3 THEN 'Africa' WHEN 4 THEN 'South America' WHEN 5 THEN 'Oceania' END AS continent
FROM events
"""
VIEWS_SQL = _VIEWS.format(title="regexp_extract(props, '\"k\": *([0-9]+)', 1)")


def views(spark: SparkSession, sf_dir: str) -> DataFrame:
    sql = _VIEWS.format(title="get_json_object(props, '$.k')").replace("FROM events", "FROM {events}")
    return spark.sql(sql, events=table(spark, sf_dir, "events"))


def segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A segment for each (user, site) but every seventh user."""
    pairs = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("site")).distinct()
    return pairs.where("user_id % 7 <> 0").withColumn("cluster", (F.col("user_id") % 4).cast("int"))


SEGMENTS_SQL = "SELECT DISTINCT user_id, event_type AS site, CAST(user_id % 4 AS INTEGER) AS cluster FROM events WHERE user_id % 7 <> 0"


def indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly order value by nation: country, indicator, year, value."""
    o, c, n = (table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    joined = o.join(c, o.o_custkey == c.c_custkey).join(F.broadcast(n), c.c_nationkey == n.n_nationkey)
    out = joined.groupBy(F.col("n_name").alias("country"), F.year("o_orderdate").alias("year")).agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    return out.withColumn("indicator", F.lit("Orders in USD"))


INDICATORS_SQL = """
SELECT n_name AS country, year(o_orderdate) AS year, round(sum(o_totalprice), 2) AS value, 'Orders in USD' AS indicator
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2
"""


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as users of a domain (region) in clusters (nation) with an industry."""
    c, n, r = (table(spark, sf_dir, t) for t in ("customer", "nation", "region"))
    joined = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return joined.select(
        F.col("c_custkey").alias("user_id"), F.col("r_name").alias("domain"), (F.col("n_nationkey") % 5).alias("cluster"),
        F.when(F.col("c_custkey") % 11 != 0, F.col("c_mktsegment")).alias("industry"), F.col("n_name").alias("country"), F.col("c_acctbal").alias("balance"),
    )


PEOPLE_SQL = """
SELECT c_custkey AS user_id, r_name AS domain, n_nationkey % 5 AS cluster, CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS industry,
  n_name AS country, c_acctbal AS balance
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
"""
