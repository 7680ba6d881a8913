"""Queries over segments: profiles, probabilities, drift, scores and models."""

from __future__ import annotations

from pyspark.sql import functions as F

from audiweave.operators import profile as P
from audiweave.operators import segments as M
from audiweave.plans.inputs import PEOPLE_SQL, VIEWS_SQL, people, table, views
from audiweave.plans.registry import query

PPL = f"WITH p AS ({PEOPLE_SQL})"
PROFILE = f"""{PPL}, c AS (SELECT domain, cluster, industry, count(*) AS per_cluster FROM p GROUP BY 1, 2, 3),
t AS (SELECT *, sum(per_cluster) OVER (PARTITION BY domain, cluster) AS cluster_total, sum(per_cluster) OVER (PARTITION BY domain) AS domain_total, sum(per_cluster) OVER (PARTITION BY domain, industry) AS dim_total FROM c)
"""


@query(f"""{PROFILE} SELECT domain, cluster, industry, per_cluster, CAST(cluster_total AS BIGINT) AS cluster_total, CAST(domain_total AS BIGINT) AS domain_total, CAST(dim_total AS BIGINT) AS dim_total, round(per_cluster / cluster_total, 4) AS of_cluster,
 round(per_cluster / dim_total, 4) AS of_dim, round(cluster_total / domain_total, 4) AS cluster_of_domain, round((per_cluster / dim_total) / (cluster_total / domain_total), 4) AS weight_ratio FROM t WHERE industry IS NOT NULL""")
def g13_segment_profile(spark, sf_dir):
    out = P.profile(people(spark, sf_dir), "industry")
    return out.withColumns({c: F.round(c, 4) for c in ("of_cluster", "of_dim", "cluster_of_domain", "weight_ratio")})


@query(f"{PPL} SELECT cluster, count(*) AS size, round(avg(balance), 4) AS balance FROM p GROUP BY 1")
def g14_behaviour_profile(spark, sf_dir):
    return P.behaviour_profile(people(spark, sf_dir), ["balance"]).withColumn("balance", F.round("balance", 4))


@query(f"""{PPL}, n AS (SELECT cluster, industry AS attribute, count(*) AS n FROM p WHERE industry IS NOT NULL AND industry <> 'BUILDING' GROUP BY 1, 2), a AS (SELECT DISTINCT industry AS attribute, 0.1 AS alpha FROM p WHERE industry IS NOT NULL),
g AS (SELECT c.cluster, a.attribute, alpha, coalesce(n.n, 0) AS n FROM (SELECT DISTINCT cluster FROM n) c CROSS JOIN a LEFT JOIN n ON n.cluster = c.cluster AND n.attribute = a.attribute), w AS (SELECT *, n + (sum(n) OVER (PARTITION BY attribute) + alpha) * 0.1 AS w FROM g)
SELECT cluster, attribute, n, round(w / sum(w) OVER (PARTITION BY cluster), 6) AS probability FROM w""")
def m21_attribute_probs(spark, sf_dir):
    p = people(spark, sf_dir).where("industry is not null")
    cells = p.where("industry <> 'BUILDING'").groupBy("cluster", F.col("industry").alias("attribute")).agg(F.count("*").alias("n"))
    alphas = p.select(F.col("industry").alias("attribute"), F.lit(0.1).alias("alpha")).distinct()
    return P.attribute_probs(cells, alphas, 0.1).select("cluster", "attribute", "n", F.round("probability", 6).alias("probability"))


@query(f"""{PPL}, u AS (SELECT cluster, industry FROM p WHERE industry IS NOT NULL UNION ALL SELECT DISTINCT cluster, 'Unknown' FROM p), n AS (SELECT cluster, industry, count(*) AS n FROM u GROUP BY 1, 2)
SELECT cluster, industry, n, round(n / sum(n) OVER (PARTITION BY cluster), 3) AS share FROM n""")
def m25_attr_distribution(spark, sf_dir):
    return P.attr_distribution(people(spark, sf_dir), "industry")


@query(f"{PPL} SELECT user_id, cluster, industry IS NULL AS predicted, CASE WHEN industry IS NULL THEN true ELSE true END AS filled FROM p")
def m26_draw_attribute(spark, sf_dir):
    p = people(spark, sf_dir)
    out = P.draw_attribute(p, P.attr_distribution(p, "industry"), "industry", 7)
    return out.select("user_id", "cluster", "predicted", F.col("industry").isNotNull().alias("filled"))


TWO = f"""{PPL}, b AS (SELECT domain, cluster, count(*) AS size, avg(balance) AS x, avg(user_id) AS y FROM p WHERE user_id % 2 = 0 GROUP BY 1, 2), d AS (SELECT domain, cluster, count(*) AS size, avg(balance) AS x, avg(user_id) AS y FROM p WHERE user_id % 2 = 1 GROUP BY 1, 2)"""


@query(f"""{TWO} SELECT domain, round(list_cosine_similarity(list(b.size::DOUBLE ORDER BY cluster), list(coalesce(d.size, 0)::DOUBLE ORDER BY cluster)), 6) AS size_similarity, round(avg((b.x * d.x + b.y * d.y) / sqrt((b.x * b.x + b.y * b.y) * (d.x * d.x + d.y * d.y))), 6) AS behaviour_similarity FROM b LEFT JOIN d USING (domain, cluster) GROUP BY 1""")
def m27_drift_behaviour(spark, sf_dir):
    p = people(spark, sf_dir)
    own = lambda df: df.groupBy("domain", "cluster").agg(F.count("*").alias("size"), F.avg("balance").alias("x"), F.avg("user_id").alias("y"))
    out = P.drift_behaviour(own(p.where("user_id % 2 = 0")), own(p.where("user_id % 2 = 1")), ["x", "y"])
    return out.select("domain", *(F.round(c, 6).alias(c) for c in ("size_similarity", "behaviour_similarity")))


@query(f"""{PPL}, c AS (SELECT user_id % 2 AS h, domain, cluster, industry, count(*) AS per_cluster FROM p GROUP BY 1, 2, 3, 4),
t AS (SELECT *, CAST(sum(per_cluster) OVER (PARTITION BY h, domain, industry) AS DOUBLE) AS dt, (per_cluster / sum(per_cluster) OVER (PARTITION BY h, domain, industry)) / (sum(per_cluster) OVER (PARTITION BY h, domain, cluster) / sum(per_cluster) OVER (PARTITION BY h, domain)) AS wr FROM c),
b AS (SELECT domain, cluster, industry, per_cluster::DOUBLE AS a1, dt AS a2, wr AS a3 FROM t WHERE h = 0 AND industry IS NOT NULL AND industry <> 'BUILDING'), b2 AS (SELECT * FROM b UNION ALL SELECT DISTINCT domain, cluster, 'unknown', 0.0, 0.0, 0.0 FROM b),
d AS (SELECT domain, cluster, CASE WHEN (domain, cluster, industry) IN (SELECT (domain, cluster, industry) FROM b) THEN industry ELSE 'unknown' END AS industry, sum(per_cluster)::DOUBLE AS d1, sum(dt) AS d2, sum(wr) AS d3 FROM t WHERE h = 1 AND industry IS NOT NULL GROUP BY 1, 2, 3),
j AS (SELECT domain, a1, a2, a3, coalesce(d1, 0) AS d1, coalesce(d2, 0) AS d2, coalesce(d3, 0) AS d3 FROM b2 LEFT JOIN d USING (domain, cluster, industry))
SELECT domain, round(avg((a1 * d1 + a2 * d2 + a3 * d3) / nullif(sqrt((a1 * a1 + a2 * a2 + a3 * a3) * (d1 * d1 + d2 * d2 + d3 * d3)), 0)), 6) AS similarity FROM j GROUP BY 1""")
def m28_drift_profile(spark, sf_dir):
    p = people(spark, sf_dir)
    base = P.profile(p.where("user_id % 2 = 0"), "industry").where("industry <> 'BUILDING'")
    out = P.drift_profile(base, P.profile(p.where("user_id % 2 = 1"), "industry"), "industry")
    return out.withColumn("similarity", F.round("similarity", 6))


@query(f"""{PROFILE} SELECT domain, round(sum(((per_cluster / dim_total) / (cluster_total / domain_total) - 1) * dim_total::DOUBLE ** 2) / sum(dim_total::DOUBLE ** 2), 6) AS segregation FROM t WHERE industry IS NOT NULL GROUP BY 1""")
def m13_segregation(spark, sf_dir):
    return M.segregation(P.profile(people(spark, sf_dir), "industry")).withColumn("segregation", F.round("segregation", 6))


@query(f"""{PPL}, s AS (SELECT domain, cluster, CASE industry WHEN 'BUILDING' THEN 'C-level-1' WHEN 'MACHINERY' THEN 'non-declared' END AS seniority FROM p), c AS (SELECT domain, cluster, count(*) FILTER (seniority = 'C-level-1') AS c, count(*) FILTER (seniority = 'non-declared') AS u FROM s GROUP BY 1, 2),
t AS (SELECT *, sum(c) OVER (PARTITION BY domain) AS ct, sum(u) OVER (PARTITION BY domain) AS ut, row_number() OVER (PARTITION BY domain ORDER BY c DESC, cluster) AS k FROM c), x AS (SELECT domain, ct, c / ct AS p, round(u / ut, 4) AS q FROM t WHERE k = 1),
y AS (SELECT domain, p * p AS p, CASE WHEN q >= 0.001 THEN greatest(pow(q - 0.001, 0.2) - 1 / (1 + 0.05 * pow(q / (1 - q + 0.001), -3)), 0) ELSE 0 END AS q FROM x) SELECT domain, round(2 * p * q / nullif(p + q, 0), 4) AS c_level FROM y""")
def m14_c_level_score(spark, sf_dir):
    p = people(spark, sf_dir).withColumn("seniority", F.when(F.col("industry") == "BUILDING", "C-level-1").when(F.col("industry") == "MACHINERY", "non-declared"))
    return M.c_level_score(p).withColumn("c_level", F.round("c_level", 4))


@query(f"WITH v AS ({VIEWS_SQL}), d AS (SELECT DISTINCT CAST(CAST(ts AS DATE) AS VARCHAR) AS date FROM v), n AS (SELECT CAST(CAST(ts AS DATE) AS VARCHAR) AS date, user_id % 4 AS cluster, count(*) AS n FROM v WHERE user_id % 4 < 3 GROUP BY 1, 2), s AS (SELECT d.date, k AS cluster, coalesce(n, 0) AS n FROM d CROSS JOIN (SELECT unnest([0, 1, 2, 3]) AS k) LEFT JOIN n ON n.date = d.date AND n.cluster = k) SELECT date, cluster, n, round(n / sum(n) OVER (PARTITION BY date), 6) AS share FROM s")
def m10_cluster_shares(spark, sf_dir):
    return _shares(spark, sf_dir).withColumn("share", F.round("share", 6))


def _shares(spark, sf):
    ev = views(spark, sf).where("user_id % 4 < 3").select(F.to_date("ts").cast("string").alias("date"), (F.col("user_id") % 4).cast("int").alias("cluster"))
    return M.cluster_shares(ev, 4)


@query(f"WITH v AS ({VIEWS_SQL}), n AS (SELECT CAST(ts AS DATE) AS date, user_id % 4 AS cluster, count(*) AS n FROM v WHERE user_id % 4 < 3 GROUP BY 1, 2), s AS (SELECT date, cluster, n / sum(n) OVER (PARTITION BY date) AS share FROM n), w AS (SELECT cluster, var_samp(share) AS v FROM s GROUP BY 1 UNION ALL SELECT 3, 0) SELECT round(avg(v), 8) AS temporal_variance FROM w")
def m11_stability(spark, sf_dir):
    return M.stability(_shares(spark, sf_dir)).withColumn("temporal_variance", F.round("temporal_variance", 8))


@query("""WITH c AS (SELECT vec_id % 3 AS fit, label AS cluster, avg(embedding[1]) AS x, avg(embedding[2]) AS y FROM embeddings GROUP BY 1, 2), m AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM c), s AS (SELECT fit, cluster, (x - x0) / (x1 - x0) AS x, (y - y0) / (y1 - y0) AS y FROM c, m),
b AS (SELECT a.fit, a.cluster, o.fit AS g, max((a.x * o.x + a.y * o.y) / nullif(sqrt((a.x * a.x + a.y * a.y) * (o.x * o.x + o.y * o.y)), 0)) AS b FROM s a JOIN s o ON a.fit <> o.fit GROUP BY 1, 2, 3), t AS (SELECT fit, g, sum(b) AS s, count(*) AS k FROM b GROUP BY 1, 2) SELECT fit, round(avg(s / k), 6) AS similarity FROM t GROUP BY 1""")
def m12_centroid_similarity(spark, sf_dir):
    c = table(spark, sf_dir, "embeddings").groupBy((F.col("vec_id") % 3).alias("fit"), F.col("label").alias("cluster")).agg(F.avg(F.get("embedding", F.lit(0))).alias("x"), F.avg(F.get("embedding", F.lit(1))).alias("y"))
    return M.centroid_similarity(c, ["x", "y"]).withColumn("similarity", F.round("similarity", 6))


_MODELS = "SELECT p_partkey AS model, p_size % 3 AS n_clusters, p_size % 2 AS lookback, p_retailprice AS variance, CASE WHEN p_partkey % 7 = 0 THEN 1.0 ELSE CAST(p_size AS DOUBLE) / 100 END AS similarity, round(p_size / 10, 1) AS ranking FROM part"


def _models(spark, sf):
    return spark.sql(_MODELS.replace("FROM part", "FROM {p}"), p=table(spark, sf, "part")).withColumns({"similarity": F.col("similarity").cast("double"), "ranking": F.col("ranking").cast("double")})


@query(f"""WITH m AS ({_MODELS}), a AS (SELECT *, row_number() OVER (PARTITION BY n_clusters, lookback ORDER BY variance, model) AS k FROM m),
f AS (SELECT model, n_clusters, lookback, CASE WHEN similarity > 0.9999 THEN avg(similarity) OVER () ELSE similarity END AS similarity FROM a WHERE k <= 5), b AS (SELECT *, row_number() OVER (PARTITION BY n_clusters, lookback ORDER BY similarity DESC, model) AS j FROM f) SELECT model, n_clusters, lookback FROM b WHERE j <= 3""")
def m16_shortlist(spark, sf_dir):
    """M16, H5."""
    return M.shortlist(_models(spark, sf_dir)).select("model", "n_clusters", "lookback")


@query(f"WITH m AS ({_MODELS}) SELECT n_clusters, model FROM (SELECT *, row_number() OVER (PARTITION BY n_clusters ORDER BY ranking DESC, variance, similarity DESC, model) AS k FROM m) WHERE k = 1")
def i04_best_model(spark, sf_dir):
    return M.best_model(_models(spark, sf_dir), "n_clusters").select("n_clusters", "model")


@query("SELECT c_custkey, round(0.4 * c_acctbal + 0.3 * c_nationkey + 0.2 * c_custkey + 0.1 * c_nationkey, 4) AS ranking FROM customer")
def m15_ranking(spark, sf_dir):
    c = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_acctbal").alias("industry"), F.col("c_nationkey").alias("jobs"), F.col("c_custkey").alias("c_level"), F.col("c_nationkey").alias("seniority"))
    return M.ranking(c).select("c_custkey", F.round("ranking", 4).alias("ranking"))


PRED = "SELECT doc_id, quality AS y, CASE WHEN n_chars > 600 AND lang <> 'fr' THEN 1 ELSE 0 END AS yhat FROM labels JOIN documents USING (doc_id)"


def _pred(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", F.when((F.col("n_chars") > 600) & (F.col("lang") != "fr"), 1).otherwise(0).alias("yhat"))
    return table(spark, sf, "labels").join(d, "doc_id").withColumnRenamed("quality", "y")


@query(f"""WITH p AS ({PRED}), c AS (SELECT unnest([0, 1]) AS class), s AS (SELECT class, (SELECT count(*) FROM p WHERE y = class) AS support, (SELECT count(*) FROM p WHERE yhat = class) AS predicted, (SELECT count(*) FROM p WHERE y = class AND yhat = class) AS hit FROM c)
SELECT class, round(coalesce(hit / nullif(predicted, 0), 0), 4) AS precision, round(coalesce(hit / nullif(support, 0), 0), 4) AS recall, round(coalesce(2 * hit / nullif(predicted + support, 0), 0), 4) AS f1_score, support FROM s WHERE support + predicted > 0""")
def m19_class_report(spark, sf_dir):
    return M.class_report(_pred(spark, sf_dir)).withColumns({c: F.round(c, 4) for c in ("precision", "recall", "f1_score")})


@query(f"WITH p AS ({PRED}), c AS (SELECT y, yhat, count(*) AS n FROM p GROUP BY 1, 2) SELECT y, yhat, round(n / sum(n) OVER (PARTITION BY y), 2) AS share FROM c")
def m20_confusion(spark, sf_dir):
    return M.confusion(_pred(spark, sf_dir))


@query(f"WITH p AS ({PRED}), c AS (SELECT y, yhat, round(count(*) / sum(count(*)) OVER (PARTITION BY y), 2) AS share FROM p GROUP BY 1, 2) SELECT y, CAST(yhat AS VARCHAR) AS most_fn_to, share FROM c WHERE y <> yhat")
def m20_most_confused(spark, sf_dir):
    return M.most_confused(M.confusion(_pred(spark, sf_dir)))


REP = "SELECT CAST(o_orderdate AS DATE) AS date, CAST(o_custkey % 4 AS VARCHAR) AS domain, o_custkey % 9 AS cluster, (o_orderkey % 100) / 100 AS f1_score, (o_orderkey % 10) / 10 AS precision, (o_orderkey % 20) / 20 AS recall, o_orderkey % 7 AS support FROM orders"


def _rep(spark, sf):
    return spark.sql(REP.replace("FROM orders", "FROM {o}").replace("VARCHAR", "STRING"), o=table(spark, sf, "orders"))


_MEAN = "sum({c} * support) / nullif(sum(support), 0)"


@query(f"""WITH r AS ({REP}), w AS (SELECT domain, year(date) >= 1998 AS late, {', '.join(_MEAN.format(c=c) + f' AS {c}' for c in ('precision', 'recall', 'f1_score'))} FROM r GROUP BY 1, 2)
SELECT a.domain, {', '.join(f'round(a.{c}, 6) AS {c}, round(a.{c} - b.{c}, 6) AS {c}_change' for c in ('precision', 'recall', 'f1_score'))} FROM w a JOIN w b USING (domain) WHERE a.late AND NOT b.late""")
def g20_classifier_change(spark, sf_dir):
    r = _rep(spark, sf_dir)
    out = P.classifier_change(r.where("year(date) >= 1998"), r.where("year(date) < 1998"))
    return out.select("domain", *(F.round(c, 6).alias(c) for c in out.columns[1:]))


@query("WITH e AS (SELECT event_type AS site, value, ts >= TIMESTAMP '2024-01-15' AS late FROM events) SELECT site, round(avg(value) FILTER (late), 6) AS now, round(avg(value) FILTER (NOT late), 6) AS before, round(avg(value) FILTER (late) - avg(value) FILTER (NOT late), 6) AS change FROM e GROUP BY 1")
def g21_returning_change(spark, sf_dir):
    ev = views(spark, sf_dir).withColumnRenamed("value", "returning_pct")
    late = F.col("ts") >= F.lit("2024-01-15").cast("timestamp")
    return P.returning_change(ev.where(late), ev.where(~late)).select("site", *(F.round(c, 6).alias(c) for c in ("now", "before", "change")))


@query(f"WITH r AS ({REP}) SELECT CAST(date AS VARCHAR) AS date, domain, array_to_string(list_sort(list_distinct(list(CAST(cluster AS VARCHAR)))), ',') AS weak FROM r WHERE f1_score < 0.3 AND support > 0 GROUP BY 1, 2")
def m30_weak_classes(spark, sf_dir):
    return M.weak_classes(_rep(spark, sf_dir)).withColumn("date", F.col("date").cast("string"))


@query(f"WITH r AS ({REP}), d AS (SELECT date, domain, sum(f1_score * support) / nullif(sum(support), 0) AS v FROM r WHERE date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' GROUP BY 1, 2) SELECT domain, round(avg(v), 6) AS baseline FROM d GROUP BY 1")
def m31_period_baseline(spark, sf_dir):
    return M.period_baseline(_rep(spark, sf_dir), "1996-01-01", "1996-12-31").withColumn("baseline", F.round("baseline", 6))


def _features(spark, sf):
    return table(spark, sf, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("user_id"), "l_quantity", "l_extendedprice", "l_discount")


NAMES = ["l_quantity", "l_extendedprice", "l_discount"]


@query("""WITH a AS (SELECT * FROM lineitem WHERE abs((l_extendedprice - (SELECT avg(l_extendedprice) FROM lineitem)) / (SELECT stddev_pop(l_extendedprice) FROM lineitem)) < 1.5)
SELECT l_orderkey || '-' || l_linenumber AS user_id FROM a WHERE abs((l_quantity - (SELECT avg(l_quantity) FROM a)) / (SELECT stddev_pop(l_quantity) FROM a)) < 1.5""")
def m02_cut_outliers(spark, sf_dir):
    return M.cut_outliers(_features(spark, sf_dir), ["l_extendedprice", "l_quantity"], 1.5).select("user_id")


@query("SELECT l_orderkey || '-' || l_linenumber AS user_id, l_discount, l_quantity FROM lineitem")
def m03_select_features(spark, sf_dir):
    return M.select_features(_features(spark, sf_dir), ["l_quantity", "l_discount"])


@query("SELECT l_orderkey || '-' || l_linenumber AS user_id, round((l_quantity - min(l_quantity) OVER ()) / (max(l_quantity) OVER () - min(l_quantity) OVER ()), 6) AS l_quantity, 0.0::DOUBLE AS flat FROM lineitem")
def m04_scale(spark, sf_dir):
    f = _features(spark, sf_dir).select("user_id", "l_quantity", F.lit(3.0).alias("flat"))
    return M.scale(f, M.scaling(f, ["l_quantity", "flat"])).withColumn("l_quantity", F.round("l_quantity", 6))


@query("""WITH c AS (SELECT label AS cluster, avg(embedding[1]) AS x, avg(embedding[2]) AS y FROM embeddings GROUP BY 1), d AS (SELECT vec_id AS user_id, cluster, (embedding[1] - x) * (embedding[1] - x) + (embedding[2] - y) * (embedding[2] - y) AS d FROM embeddings, c)
SELECT user_id, cluster FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY d, cluster) AS k FROM d) WHERE k = 1""")
def m07_predict_segments(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("user_id"), "label", F.get("embedding", F.lit(0)).cast("double").alias("x"), F.get("embedding", F.lit(1)).cast("double").alias("y"))
    cents = e.groupBy(F.col("label").alias("cluster")).agg(F.avg("x").alias("x"), F.avg("y").alias("y"))
    return M.predict_segments(cents, e.drop("label"), ["x", "y"]).select("user_id", "cluster")


@query()
def m05_fit_segments(spark, sf_dir):
    """M1-M5: imputed, cut, scaled, three segments and their centroids in the columns' own units. Scaling and fit see what the cut leaves."""
    f = _features(spark, sf_dir)
    f = M.cut_outliers(M.fit_imputer(f, NAMES).transform(f), NAMES, 3.0)
    limits = M.scaling(f, NAMES)
    return M.unscale(M.centroids(spark, M.fit_segments(M.scale(f, limits), NAMES, 3)), limits)


@query()
def m06_elbow(spark, sf_dir):
    """M6 at its defaults: k from 5 to 20 by ten starts each."""
    f = _features(spark, sf_dir)
    f = M.scale(f, M.scaling(f, NAMES))
    return f.agg(F.lit(M.elbow(f, NAMES)).alias("k"), F.count("*").alias("n"))


@query()
def m08_best_features(spark, sf_dir):
    f = table(spark, sf_dir, "lineitem").select(*NAMES, F.when(F.col("l_quantity") > 25, 1).otherwise(0).alias("cluster"))
    return f.agg(F.lit(",".join(M.best_features([f], NAMES, ["l_discount"], 1))).alias("names"), F.count("*").alias("n"))


@query("""WITH g AS (SELECT k, lookback FROM (SELECT unnest([5, 6, 7]) AS k), (SELECT unnest([3, 10]) AS lookback)), e AS (SELECT user_id, CAST(ts AS DATE) AS day FROM events)
SELECT k, lookback, CAST(user_id % k AS INTEGER) AS cluster, count(*) AS visits FROM g JOIN e ON day >= DATE '2024-01-30' - CAST(lookback AS INTEGER) GROUP BY 1, 2, 3""")
def m09_grid(spark, sf_dir):
    """M9: visits of every cluster under each number of clusters and look-back of the grid."""
    ev = table(spark, sf_dir, "events").select("user_id", F.to_date("ts").alias("day"))
    runs = M.grid(spark, {"k": [5, 6, 7], "lookback": [3, 10]})
    own = ev.join(F.broadcast(runs), F.col("day") >= F.date_sub(F.lit("2024-01-30").cast("date"), F.col("lookback").cast("int")))
    return own.groupBy("k", "lookback", (F.col("user_id") % F.col("k")).cast("int").alias("cluster")).agg(F.count("*").alias("visits"))


@query()
def m17_visit_classifier(spark, sf_dir):
    """M17 on local hour, referrer group and system (C22, C23, C25). The label is the half of the local day and
    whether a search led to the visit, so that it can be learned; rows are counts of labels by what was predicted."""
    from audiweave.functions import text as C

    ev = views(spark, sf_dir).withColumns({"referrer_group": C.referrer_group(F.col("referrer"), F.col("site")), "os_group": C.os_group(F.col("agent")), "hour": C.local_hour_zone(F.col("ts"), F.col("continent"))})
    ev = ev.withColumn("cluster", F.floor(F.col("hour") / 12).cast("int") * 2 + (F.col("referrer_group") == "search").cast("int"))
    model = M.fit_visit_classifier(ev)
    return model.transform(ev.withColumn("cluster", F.col("cluster").cast("string")).withColumn("weight", F.lit(1.0))).groupBy("cluster", "prediction").agg(F.count("*").alias("n"))


@query(f"WITH v AS ({VIEWS_SQL}), x AS (SELECT *, row_number() OVER (PARTITION BY user_id, site ORDER BY ts DESC, event_id) AS k FROM v WHERE event_id % 3 = 0 AND user_id % 5 > 0) SELECT user_id, site, event_id FROM x WHERE k = 1")
def m18_rf_eval_rows(spark, sf_dir):
    ev = views(spark, sf_dir).withColumns({"days_before": F.col("event_id") % 3, "cluster": F.when(F.col("user_id") % 5 > 0, 1)})
    return M.rf_eval_rows(ev).select("user_id", "site", "event_id")


@query()
def m22_attribute_classifier(spark, sf_dir):
    """Probabilities of the unknown rows."""
    f = table(spark, sf_dir, "lineitem").select(F.concat_ws("-", "l_orderkey", "l_linenumber").alias("user_id"), *NAMES, F.when(F.col("l_linenumber") > 1, F.col("l_returnflag")).alias("flag"))
    model = M.fit_attribute(f, "flag", NAMES)
    unknown = f.where("flag is null").withColumns({"flag": F.lit("?"), "weight": F.lit(1.0)})
    return M.attribute_probabilities(model, unknown).groupBy("attribute").agg(F.avg("probability").alias("p"), F.count("*").alias("n"))


@query()
def m23_tune_attribute(spark, sf_dir):
    """M23 with three folds and small forests: rows are counts of held-out classes and of their predictions."""
    f = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderstatus").alias("flag"), "o_totalprice", F.year("o_orderdate").alias("y"))
    _, got = M.tune_attribute(f, "flag", ["o_totalprice", "y"], ["o_orderkey"], {"numTrees": (3, 5), "maxDepth": (2, 4), "minInstancesPerNode": (1, 4)}, draws=3)
    rows = [(c, n, got["predictions"].get(c, 0), got["balanced_accuracy"], got["over_dummy"]) for c, n in sorted(got["classes"].items())]
    return spark.createDataFrame(rows, "class string, held_out long, predicted long, balanced_accuracy double, over_dummy double")


@query("SELECT vec_id AS user_id, 'a' || CAST(k AS VARCHAR) AS attribute, CAST(embedding[k + 1] AS DOUBLE) AS probability FROM embeddings, (SELECT unnest([0, 1, 2]) AS k)")
def m24_melt_probs(spark, sf_dir):
    e = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("user_id"), F.transform(F.slice("embedding", 1, 3), lambda x: x.cast("double")).alias("p"))
    return M.melt_probs(e, ["a0", "a1", "a2"])


DIMS = {
    "industry": "industry", "wishlist": "CASE WHEN industry IN ('BUILDING', 'MACHINERY') THEN industry END", "job": "CASE WHEN user_id % 3 > 0 THEN concat('job', CAST(user_id % 7 AS {text})) END",
    "seniority": "CASE WHEN balance > 5000 THEN 'C-level' WHEN balance > 1000 THEN 'manager' END",
}


def _drift_sql(dim: str, made: str) -> str:
    """CTEs of M28 for one dimension, the last under its name."""
    return f"""c_{dim} AS (SELECT user_id % 2 AS h, domain, cluster, {made.format(text='VARCHAR')} AS v, count(*) AS n FROM p GROUP BY 1, 2, 3, 4),
t_{dim} AS (SELECT *, CAST(sum(n) OVER (PARTITION BY h, domain, v) AS DOUBLE) AS dt, (n / sum(n) OVER (PARTITION BY h, domain, v)) / (sum(n) OVER (PARTITION BY h, domain, cluster) / sum(n) OVER (PARTITION BY h, domain)) AS wr FROM c_{dim}),
b_{dim} AS (SELECT domain, cluster, v, n::DOUBLE AS a1, dt AS a2, wr AS a3 FROM t_{dim} WHERE h = 0 AND v IS NOT NULL), u_{dim} AS (SELECT * FROM b_{dim} UNION ALL SELECT DISTINCT domain, cluster, 'unknown', 0.0, 0.0, 0.0 FROM b_{dim}),
d_{dim} AS (SELECT domain, cluster, CASE WHEN (domain, cluster, v) IN (SELECT (domain, cluster, v) FROM b_{dim}) THEN v ELSE 'unknown' END AS v, sum(n)::DOUBLE AS d1, sum(dt) AS d2, sum(wr) AS d3 FROM t_{dim} WHERE h = 1 AND v IS NOT NULL GROUP BY 1, 2, 3),
j_{dim} AS (SELECT domain, a1, a2, a3, coalesce(d1, 0) AS d1, coalesce(d2, 0) AS d2, coalesce(d3, 0) AS d3 FROM u_{dim} LEFT JOIN d_{dim} USING (domain, cluster, v)),
{dim}_similarity AS (SELECT domain, round(avg((a1 * d1 + a2 * d2 + a3 * d3) / nullif(sqrt((a1 * a1 + a2 * a2 + a3 * a3) * (d1 * d1 + d2 * d2 + d3 * d3)), 0)), 6) AS {dim} FROM j_{dim} GROUP BY 1)"""


_HALF = "WHERE year(date) {} 1998 GROUP BY 1"
_WEIGHED = ", ".join(f"{_MEAN.format(c=c)} AS {c}" for c in ("precision", "recall", "f1_score"))


@query(f"""{TWO}, {', '.join(_drift_sql(k, v) for k, v in DIMS.items())},
m AS (SELECT domain, round(list_cosine_similarity(list(b.size::DOUBLE ORDER BY cluster), list(coalesce(d.size, 0)::DOUBLE ORDER BY cluster)), 6) AS size_similarity, round(avg((b.x * d.x + b.y * d.y) / sqrt((b.x * b.x + b.y * b.y) * (d.x * d.x + d.y * d.y))), 6) AS behaviour_similarity FROM b LEFT JOIN d USING (domain, cluster) GROUP BY 1),
v AS (SELECT domain, round(avg(balance) FILTER (user_id % 2 = 1) - avg(balance) FILTER (user_id % 2 = 0), 6) AS returning_change FROM p GROUP BY 1), r AS ({REP}), old AS (SELECT 'REGION_' || domain AS domain, {_WEIGHED} FROM r {_HALF.format('<')}), now AS (SELECT 'REGION_' || domain AS domain, {_WEIGHED} FROM r {_HALF.format('>=')}),
k AS (SELECT domain, {', '.join(f'round(now.{c} - old.{c}, 6) AS {c}_change' for c in ('precision', 'recall', 'f1_score'))} FROM now JOIN old USING (domain))
SELECT m.*, {', '.join(DIMS)}, returning_change, precision_change, recall_change, f1_score_change, round(old.f1_score, 6) AS base_f1_score FROM m {' '.join(f'LEFT JOIN {k}_similarity USING (domain)' for k in DIMS)} LEFT JOIN v USING (domain) LEFT JOIN k USING (domain) LEFT JOIN old USING (domain)""")
def m29_segment_report(spark, sf_dir):
    """M29 with its four dimensions (M28), M27, G20 and G21, by domain: even users are the baseline, odd ones the day."""
    p = people(spark, sf_dir).withColumns({k: F.expr(v.format(text="STRING")) for k, v in DIMS.items()})
    own = lambda df: df.groupBy("domain", "cluster").agg(F.count("*").alias("size"), F.avg("balance").alias("x"), F.avg("user_id").alias("y"))
    base, day = p.where("user_id % 2 = 0"), p.where("user_id % 2 = 1")
    r = _rep(spark, sf_dir).withColumn("domain", F.concat(F.lit("REGION_"), "domain"))
    returning = lambda df: df.select("domain", F.col("balance").alias("returning_pct"))
    out = M.segment_report(
        (own(base), own(day)), {k: (P.profile(base, k), P.profile(day, k)) for k in DIMS}, (returning(base), returning(day)),
        (r.where("year(date) < 1998"), r.where("year(date) >= 1998")), ["x", "y"],
    )
    return out.select("domain", *(F.round(c, 6).alias(c) for c in out.columns if c != "domain"))


@query()
def m01_impute(spark, sf_dir):
    """Medians are approximate (0.1 % of the ranks), so there is no SQL; a test holds them against exact ones."""
    f = table(spark, sf_dir, "lineitem").select("l_orderkey", F.when(F.col("l_linenumber") > 1, F.col("l_quantity")).alias("l_quantity"))
    return M.fit_imputer(f, ["l_quantity"]).transform(f)
