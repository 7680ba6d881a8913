"""Queries over page views: features, virality, returning visitors, latest rows."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from audiweave.functions import text as C
from audiweave.functions.time import micros
from audiweave.operators import features as G
from audiweave.operators import windows as H
from audiweave.operators.rolling import RollingFeatures
from audiweave.plans.inputs import SEGMENTS_SQL, VIEWS_SQL, segments, table, views
from audiweave.plans.registry import query
from audiweave.sources.scratch import shared_folder
from audiweave.sources.tables import Warehouse
from audiweave.streaming.streams import stream_sessions

DAY = "2024-01-25"
V = f"WITH v AS ({VIEWS_SQL})"
S = f"""{V}, g AS (SELECT *, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) <= 1800000000 THEN 0 ELSE 1 END AS n FROM v),
s AS (SELECT *, CAST(user_id AS VARCHAR) || '-' || CAST(sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS VARCHAR) AS session_id FROM g)"""
VIR = """, bt AS (SELECT site, title, count(DISTINCT CASE WHEN client = 'web' THEN view_id ELSE event_id END) AS views FROM v GROUP BY 1, 2),
bs AS (SELECT site, count(DISTINCT CASE WHEN client = 'web' THEN view_id ELSE event_id END) / count(DISTINCT title) AS m FROM v GROUP BY 1),
vir AS (SELECT site, title, views, views / m AS virality FROM bt JOIN bs USING (site))"""
DAYS = ", d AS (SELECT DISTINCT user_id, site, CAST(ts AS DATE) AS day FROM v)"


@query(f"""{V}{DAYS}, b AS (SELECT user_id, site, day, (SELECT count(*) FROM d e WHERE e.user_id = d.user_id AND e.site = d.site AND e.day < d.day AND e.day >= d.day - 30) AS days_before FROM d WHERE day = DATE '{DAY}'),
g AS ({SEGMENTS_SQL})
SELECT site, cluster, CAST(day AS VARCHAR) AS day, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN days_before > 0 THEN user_id END) AS returning_users,
  round(100 * count(DISTINCT CASE WHEN days_before > 0 THEN user_id END) / count(DISTINCT user_id), 2) AS returning_pct
FROM b JOIN g USING (user_id, site) GROUP BY 1, 2, 3 HAVING count(DISTINCT CASE WHEN days_before > 0 THEN user_id END) > 0""")
def returning_pct(spark, sf_dir):
    """The flagship."""
    out = G.returning_pct(views(spark, sf_dir), segments(spark, sf_dir), DAY)
    return out.withColumn("day", F.col("day").cast("string"))


@query(f"""{V}{DAYS} SELECT user_id, site, CAST(day AS VARCHAR) AS day, (SELECT count(*) FROM d e WHERE e.user_id = d.user_id AND e.site = d.site AND e.day < d.day AND e.day >= d.day - 7) AS days_before FROM d""")
def f07_days_seen_before(spark, sf_dir):
    return G.days_seen_before(views(spark, sf_dir), 7).withColumn("day", F.col("day").cast("string"))


@query(f"""{V} SELECT user_id, event_id, site FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM v) WHERE k = 1""")
def h01_latest_per_user(spark, sf_dir):
    return H.latest_per(views(spark, sf_dir), ["user_id"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "event_id", "site")


@query(f"""{V} SELECT user_id, site, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id, site ORDER BY ts DESC, event_id DESC) AS k FROM v) WHERE k = 1""")
def h02_latest_per_user_site(spark, sf_dir):
    return H.latest_per(views(spark, sf_dir), ["user_id", "site"], [F.desc("ts"), F.desc("event_id")]).select("user_id", "site", "event_id")


@query(f"""{V} SELECT user_id, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY value DESC, event_id) AS k FROM v) WHERE k = 1""")
def h03_best_per_user(spark, sf_dir):
    return H.latest_per(views(spark, sf_dir), ["user_id"], [F.desc("value"), F.asc("event_id")]).select("user_id", "event_id", "value")


@query(f"""{V}, a AS (SELECT user_id, site, max(value) AS score FROM v GROUP BY 1, 2)
SELECT user_id, site, score FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY score DESC, site) AS k FROM a) WHERE k = 1""")
def h04_argmax_site(spark, sf_dir):
    best = views(spark, sf_dir).groupBy("user_id", "site").agg(F.max("value").alias("score"))
    return H.argmax_per(best, ["user_id"], "site", F.col("score"))


@query(f"""{V} SELECT site, title, views FROM (SELECT *, row_number() OVER (PARTITION BY site ORDER BY views DESC, title) AS k FROM (SELECT site, title, count(*) AS views FROM v GROUP BY 1, 2)) WHERE k <= 5""")
def h05_top_titles_per_site(spark, sf_dir):
    counts = views(spark, sf_dir).groupBy("site", "title").agg(F.count("*").alias("views"))
    return H.top_n_per(counts, ["site"], [F.desc("views"), F.asc("title")], 5)


@query(f"""{V} SELECT event_id, site, round((value - min(value) OVER (PARTITION BY site)) / nullif(max(value) OVER (PARTITION BY site) - min(value) OVER (PARTITION BY site), 0), 4) AS idx FROM v""")
def h06_minmax_index(spark, sf_dir):
    return H.minmax_index(views(spark, sf_dir).select("event_id", "site", "value"), ["site"], "value", "idx").select("event_id", "site", F.round("idx", 4).alias("idx"))


@query(f"""{S} SELECT user_id, count(DISTINCT session_id) AS sessions, count(DISTINCT CASE WHEN client = 'web' THEN view_id ELSE event_id END) AS views FROM s GROUP BY 1""")
def g01_views_sessions(spark, sf_dir):
    return G.sessions(views(spark, sf_dir)).groupBy("user_id").agg(*G.views_sessions())


@query(f"""{V} SELECT user_id, count(*) FILTER (regexp_matches(referrer, 'facebook|linkedin|twitter|t\\.co/|youtube|instagram|reddit|pinterest')) AS visits_social,
 count(*) FILTER (regexp_matches(referrer, 'ask|baidu|bing|duckduckgo|google|yahoo|yandex')) AS visits_search, count(*) FILTER (regexp_matches(referrer, 'Pardot|pardot')) AS visits_email,
 count(*) FILTER (contains(referrer, 'example.net')) AS visits_network, count(*) FILTER (contains(referrer, site)) AS visits_own, count(*) FILTER (referrer IS NULL) AS visits_typed FROM v GROUP BY 1""")
def g02_referrer_visits(spark, sf_dir):
    return views(spark, sf_dir).groupBy("user_id").agg(*G.referrer_visits())


@query(f"""{V} SELECT user_id, count(*) FILTER (client = 'web') AS visits_web, count(*) FILTER (client = 'amp') AS visits_amp FROM v GROUP BY 1""")
def g03_client_visits(spark, sf_dir):
    return views(spark, sf_dir).groupBy("user_id").agg(*G.client_visits())


@query(f"""{V} SELECT site, count(*) FILTER (continent = 'North America') AS visits_north_america, count(*) FILTER (continent = 'South America') AS visits_south_america, count(*) FILTER (continent = 'Europe') AS visits_europe, count(*) FILTER (continent = 'Africa') AS visits_africa,
 count(*) FILTER (continent = 'Asia') AS visits_asia, count(*) FILTER (continent NOT IN ('North America', 'South America', 'Europe', 'Africa', 'Asia')) AS visits_elsewhere FROM v GROUP BY 1""")
def g04_continent_visits(spark, sf_dir):
    return views(spark, sf_dir).groupBy("site").agg(*G.continent_visits())


@query(f"""{V} SELECT user_id, count(*) FILTER (agent LIKE '%Linux%') AS visits_linux, count(*) FILTER (agent LIKE '%Android%') AS visits_android, count(*) FILTER (agent LIKE '%Windows NT 10.0%') AS visits_windows10, count(*) FILTER (agent LIKE '%Windows%' AND agent NOT LIKE '%Windows NT 10.0%') AS visits_windows_older,
 count(*) FILTER (agent LIKE '%iPhone%') AS visits_iphone, count(*) FILTER (agent LIKE '%Macintosh%') AS visits_macintosh, count(*) FILTER (agent LIKE '%AppleWebKit%') AS visits_apple_other FROM v GROUP BY 1""")
def g05_os_visits(spark, sf_dir):
    return views(spark, sf_dir).groupBy("user_id").agg(*G.os_visits())


@query("""SELECT user_id, bool_or(event_type = 'signup') AS is_lead FROM events GROUP BY 1""")
def g06_lead_flag(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return G.lead_flag(ev.select("user_id").distinct(), ev.where("event_type = 'signup'"))


HOUR = """extract('hour' FROM ((ts AT TIME ZONE 'UTC') AT TIME ZONE CASE continent WHEN 'North America' THEN 'US/Central' WHEN 'South America' THEN 'Brazil/West' WHEN 'Europe' THEN 'Europe/Berlin' WHEN 'Africa' THEN 'Europe/Berlin' WHEN 'Asia' THEN 'Asia/Karachi' ELSE 'Etc/UTC' END))"""
FIXED = """CASE continent WHEN 'North America' THEN hour(ts) - 6 WHEN 'South America' THEN hour(ts) - 3 WHEN 'Europe' THEN hour(ts) + 1 WHEN 'Africa' THEN hour(ts) + 1 WHEN 'Asia' THEN hour(ts) + 5 ELSE hour(ts) END"""


@query(f"""{V} SELECT user_id, round(avg(completion), 4) AS mean_completion, round(avg(value), 4) AS mean_dwell FROM v WHERE completion <> 0 AND value <> 0 GROUP BY 1""")
def g08_engagement(spark, sf_dir):
    """Users without any counted view have no row in the SQL, and nulls in the features."""
    out = views(spark, sf_dir).groupBy("user_id").agg(*G.engagement()).where("mean_dwell is not null")
    return out.select("user_id", *(F.round(c, 4).alias(c) for c in ("mean_completion", "mean_dwell")))


@query(f"""{V}{VIR} SELECT site, title, views, round(virality, 4) AS virality FROM vir""")
def g09_virality(spark, sf_dir):
    return G.virality(views(spark, sf_dir)).withColumn("virality", F.round("virality", 4))


@query(f"""{V}{VIR} SELECT user_id, round(avg(virality), 4) AS mean_virality FROM v JOIN vir USING (site, title) GROUP BY 1""")
def g10_user_virality(spark, sf_dir):
    ev = views(spark, sf_dir)
    return G.user_virality(ev, G.virality(ev)).withColumn("mean_virality", F.round("mean_virality", 4))


@query(f"""{S}{VIR}, r AS (SELECT user_id, count(DISTINCT session_id) AS sessions, count(DISTINCT CASE WHEN client = 'web' THEN view_id ELSE event_id END) AS views,
 count(*) FILTER (referrer IS NULL) AS visits_typed, count(*) FILTER (contains(referrer, 'example.net')) AS visits_network, count(*) FILTER (client = 'web') AS visits_web, count(*) FILTER (continent = 'Asia') AS visits_asia, count(*) FILTER (continent = 'South America') AS visits_south_america,
 count(*) FILTER (agent LIKE '%Linux%') AS visits_linux, count(*) FILTER (agent LIKE '%Windows%' AND agent NOT LIKE '%Windows NT 10.0%') AS visits_windows_older, round(avg(completion) FILTER (completion <> 0 AND value <> 0), 4) AS mean_completion,
 round(avg(value) FILTER (completion <> 0 AND value <> 0), 4) AS mean_dwell, round(avg({HOUR}), 4) AS mean_hour, CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - max(epoch_us(ts))) / 86400000000) AS BIGINT) AS recency, bool_or(site = 'signup') AS is_lead FROM s GROUP BY 1)
SELECT r.*, round(m, 4) AS mean_virality FROM r LEFT JOIN (SELECT user_id, avg(virality) AS m FROM v JOIN vir USING (site, title) GROUP BY 1) USING (user_id)""")
def g11_user_features(spark, sf_dir):
    """G11 with G1-G10, C26, F2: one pass, then two joins."""
    ev = G.sessions(views(spark, sf_dir))
    out = G.user_features(ev, ev.where("site = 'signup'"), "2024-02-01")
    means = (F.round(c, 4).alias(c) for c in ("mean_completion", "mean_dwell", "mean_hour", "mean_virality"))
    visits = ("visits_typed", "visits_network", "visits_web", "visits_asia", "visits_south_america", "visits_linux", "visits_windows_older")
    return out.select("user_id", "sessions", "views", *visits, F.col("recency").cast("long").alias("recency"), "is_lead", *means)


ROLLING = [("2024-01-15", 9), ("2024-01-16", 9)]


@query(f"""{S}, w AS (SELECT * FROM s WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-16' - 9 AND DATE '2024-01-16')
SELECT user_id, count(*) AS events, count(DISTINCT session_id) AS sessions, count(DISTINCT CASE WHEN client = 'web' THEN view_id ELSE event_id END) AS views, count(*) FILTER (client = 'web') AS visits_web, count(*) FILTER (continent = 'Africa') AS visits_africa,
 round(avg(completion) FILTER (completion <> 0 AND value <> 0), 4) AS mean_completion, round(avg({HOUR}), 4) AS mean_hour, CAST(floor((epoch_us(TIMESTAMP '2024-01-17') - max(epoch_us(ts))) / 86400000000) AS BIGINT) AS recency FROM w GROUP BY 1""")
def g11_rolling_features(spark, sf_dir):
    """The window of one day, then that of the next, which reads one new day. Few sessions a user, so sketches are exact."""
    at = RollingFeatures(Warehouse(spark, f"{shared_folder(spark)}/house-{uuid.uuid4().hex}"), "features", "daily")
    ev = G.sessions(views(spark, sf_dir))
    for end, lookback in ROLLING:
        out = at.features(ev, end, lookback)
    means = (F.round(c, 4).alias(c) for c in ("mean_completion", "mean_hour"))
    return out.select("user_id", "events", "sessions", "views", "visits_web", "visits_africa", *means, F.col("recency").cast("long").alias("recency"))


@query(f"""{S}, r AS (SELECT user_id, min(epoch_us(ts)) AS a, max(epoch_us(ts)) AS b, count(DISTINCT session_id) AS n FROM s GROUP BY 1)
SELECT user_id, CAST(floor((epoch_us(TIMESTAMP '2024-02-01') - b) / 86400000000) AS BIGINT) AS recency,
 CASE WHEN floor((epoch_us(TIMESTAMP '2024-02-01') - a) / 86400000000) >= 28 THEN round(n * 28 / floor((epoch_us(TIMESTAMP '2024-02-01') - a) / 86400000000), 4) END AS frequency FROM r""")
def c26_recency_frequency(spark, sf_dir):
    recency, frequency = G.recency_frequency("2024-02-01")
    return G.sessions(views(spark, sf_dir)).groupBy("user_id").agg(recency, frequency).select("user_id", F.col("recency").cast("long").alias("recency"), F.round("frequency", 4).alias("frequency"))


@query(f"""{V}, t AS (SELECT site, count(DISTINCT user_id) AS total FROM v GROUP BY 1), p AS (SELECT site, count(DISTINCT user_id) AS part FROM v WHERE value > 50 GROUP BY 1)
SELECT site, total, part, round(100 * part / total, 2) AS rate FROM t JOIN p USING (site)""")
def f01_rate(spark, sf_dir):
    ev = views(spark, sf_dir)
    count = lambda df, n: df.groupBy("site").agg(F.count_distinct("user_id").alias(n))
    return G.rate(count(ev, "total"), count(ev.where("value > 50"), "part"), ["site"])


@query(f"""{V}, g AS ({SEGMENTS_SQL}), a AS (SELECT user_id, site, max(ts) AS m FROM v GROUP BY 1, 2)
SELECT user_id, site, cluster, CAST(epoch_us(m) AS BIGINT) AS last_us FROM g JOIN a USING (user_id, site) WHERE m >= TIMESTAMP '2024-01-20'""")
def f14_last_activity(spark, sf_dir):
    out = G.last_activity(segments(spark, sf_dir), views(spark, sf_dir), "2024-01-20")
    return out.select("user_id", "site", "cluster", micros("last_activity").alias("last_us"))


@query(f"""{V}, c AS (SELECT user_id, ts, event_id, title AS company FROM v WHERE title IS NOT NULL AND title <> ''), k AS (SELECT company FROM c GROUP BY 1 ORDER BY count(DISTINCT user_id) DESC, company LIMIT 20),
l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, company) AS k FROM c) WHERE k = 1)
SELECT user_id, coalesce(k.company, 'Unknown') AS company FROM l LEFT JOIN k USING (company)""")
def g15_company_of_user(spark, sf_dir):
    cb = views(spark, sf_dir).withColumn("company", F.nullif("title", F.lit("")))
    return G.company_of_user(cb, 20)


@query(f"""{V} SELECT event_id, site, CASE WHEN referrer IS NULL THEN 'typed' WHEN regexp_matches(referrer, 'facebook|linkedin|twitter|t\\.co/|youtube|instagram|reddit|pinterest') THEN 'social' WHEN regexp_matches(referrer, 'ask|baidu|bing|duckduckgo|google|yahoo|yandex') THEN 'search'
 WHEN contains(referrer, 'example.net') THEN 'network' WHEN contains(referrer, site) THEN 'own' WHEN regexp_matches(referrer, 'Pardot|pardot') THEN 'email' ELSE 'other' END AS grp FROM v""")
def c22_referrer_group(spark, sf_dir):
    return views(spark, sf_dir).select("event_id", "site", C.referrer_group(F.col("referrer"), F.col("site")).alias("grp"))


@query(f"""{V} SELECT event_id, CASE WHEN agent LIKE '%Linux%' THEN 'linux' WHEN agent LIKE '%Android%' THEN 'android' WHEN agent LIKE '%Windows NT 10.0%' THEN 'windows10' WHEN agent LIKE '%Windows%' THEN 'windows_older'
 WHEN agent LIKE '%iPhone%' THEN 'iphone' WHEN agent LIKE '%Macintosh%' THEN 'macintosh' WHEN agent LIKE '%AppleWebKit%' THEN 'apple_other' ELSE 'other_os' END AS os FROM v""")
def c23_os_group(spark, sf_dir):
    return views(spark, sf_dir).select("event_id", C.os_group(F.col("agent")).alias("os"))


@query(f"""{V}, h AS (SELECT event_id, {FIXED} AS h FROM v) SELECT event_id, CAST(CASE WHEN h < 0 THEN h + 24 WHEN h = 24 THEN 0 ELSE h END AS INTEGER) AS hour FROM h""")
def c24_local_hour_offset(spark, sf_dir):
    return views(spark, sf_dir).select("event_id", C.local_hour_offset(F.hour("ts"), F.col("continent")).cast("int").alias("hour"))


@query(f"""{V} SELECT event_id, CAST({HOUR} AS INTEGER) AS hour FROM v""")
def c25_local_hour_zone(spark, sf_dir):
    return views(spark, sf_dir).select("event_id", C.local_hour_zone(F.col("ts"), F.col("continent")).alias("hour"))


@query(f"""{V} SELECT site, round(avg({HOUR}), 4) AS mean_hour FROM v GROUP BY 1""")
def g07_mean_local_hour(spark, sf_dir):
    return views(spark, sf_dir).groupBy("site").agg(F.round(G.mean_local_hour(), 4).alias("mean_hour"))


@query(f"""{V} SELECT event_id, site FROM v WHERE NOT lower(agent) LIKE '%bot%' AND site IN ('view', 'click')""")
def c17_real_traffic(spark, sf_dir):
    return C.real_traffic(views(spark, sf_dir), ["view", "click"]).select("event_id", "site")


@query(f"""{V} SELECT event_id, title FROM v WHERE title NOT IN ('1', '2', '3')""")
def c18_articles_only(spark, sf_dir):
    return C.articles_only(views(spark, sf_dir), spark.createDataFrame([("1",), ("2",), ("3",)], "title string")).select("event_id", "title")


@query(f"""{V} SELECT event_id, ts, site FROM v WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-10' - 7 AND DATE '2024-01-10'""")
def a08_scan_events(spark, sf_dir):
    from audiweave.sources.tables import scan_events

    ev = views(spark, sf_dir).withColumn("event_date", F.to_date("ts"))
    return scan_events(ev, "2024-01-10", 7).select("event_id", "ts", "site")


@query(f"""{V}, g AS (SELECT user_id, ts, event_id, CASE WHEN epoch_us(ts) - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts, event_id) < 1800000000 THEN 0 ELSE 1 END AS n FROM v),
s AS (SELECT *, sum(n) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM g) SELECT user_id, CAST(epoch_us(min(ts)) AS BIGINT) AS start_us, count(*) AS events FROM s GROUP BY user_id, k""")
def o05_session_windows(spark, sf_dir):
    return stream_sessions(table(spark, sf_dir, "events")).select("user_id", micros("session_start").alias("start_us"), "events")


@query(f"""{V}, u AS (SELECT DISTINCT user_id FROM v), a AS (SELECT user_id, count(*) AS n FROM v WHERE value > 50 GROUP BY 1), b AS (SELECT user_id, max(value) AS top FROM v WHERE client = 'web' GROUP BY 1)
SELECT user_id, n, top FROM u LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id)""")
def f02_star(spark, sf_dir):
    """Aggregates of two sources beside all users; a user without rows in one has nulls."""
    ev = views(spark, sf_dir)
    parts = ev.where("value > 50").groupBy("user_id").agg(F.count("*").alias("n")), ev.where("client = 'web'").groupBy("user_id").agg(F.max("value").alias("top"))
    return G.star(ev.select("user_id").distinct(), *parts)


@query(f"""{V} SELECT user_id, site, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS k FROM v) WHERE k = 1""")
def h08_first_per_user(spark, sf_dir):
    return H.latest_per(views(spark, sf_dir), ["user_id"], [F.asc("ts"), F.asc("event_id")]).select("user_id", "site", "event_id")


@query(f"""{V} SELECT event_id, site, CAST(row_number() OVER (PARTITION BY site ORDER BY value DESC, event_id) AS INTEGER) AS position FROM v""")
def h07_rank_position(spark, sf_dir):
    return H.rank_position(views(spark, sf_dir), ["site"], [F.desc("value"), F.asc("event_id")]).select("event_id", "site", "position")
