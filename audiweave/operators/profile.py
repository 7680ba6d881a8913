"""Segment profiles, table health, probabilities and drift."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window


def profile(df: DataFrame, dim: str, domain: str = "domain") -> DataFrame:
    """Shares of a dimension in clusters. A null value is no group, but counts in cluster and domain totals."""
    cells = df.groupBy(domain, "cluster", dim).agg(F.count("*").alias("per_cluster"))
    whole, of_cluster, of_dim = Window.partitionBy(domain), Window.partitionBy(domain, "cluster"), Window.partitionBy(domain, dim)
    out = cells.withColumns({
        "cluster_total": F.sum("per_cluster").over(of_cluster), "domain_total": F.sum("per_cluster").over(whole), "dim_total": F.sum("per_cluster").over(of_dim),
    }).where(F.col(dim).isNotNull())
    of_value, of_domain = F.col("per_cluster") / F.col("dim_total"), F.col("cluster_total") / F.col("domain_total")
    return out.withColumns({"of_cluster": F.col("per_cluster") / F.col("cluster_total"), "of_dim": of_value, "cluster_of_domain": of_domain, "weight_ratio": of_value / of_domain})


def behaviour_profile(feat: DataFrame, names: list[str]) -> DataFrame:
    """Size and means of features by cluster; nulls don't count in a mean, a null cluster is one."""
    return feat.groupBy("cluster").agg(F.count("*").alias("size"), *(F.avg(c).alias(c) for c in names))


def _stack(wide: DataFrame, names: list[str], fields: list[str]) -> DataFrame:
    rows = F.array(*(F.struct(F.lit(c).alias("column"), *(F.col(f"{f}__{c}").alias(f) for f in fields)) for c in names))
    return wide.select(F.inline(rows))


def coverage(df: DataFrame) -> DataFrame:
    """Share of values that aren't null, by column; no row for an empty table."""
    wide = df.agg(F.count("*").alias("_n"), *(F.try_divide(F.count(c), F.count("*")).alias(f"coverage__{c}") for c in df.columns))
    return _stack(wide.where("_n > 0"), df.columns, ["coverage"])


def samples(df: DataFrame, n: int, seed: int = 0) -> DataFrame:
    """Up to n values of each column, the same in every run."""
    rows = df.orderBy(F.xxhash64(*df.columns, F.lit(seed))).limit(n)
    wide = rows.agg(*(F.array_join(F.sort_array(F.collect_set(F.col(c).cast("string"))), ", ").alias(f"sample__{c}") for c in df.columns))
    return _stack(wide, df.columns, ["sample"])


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def top_z(df: DataFrame, n: int) -> DataFrame:
    """The n rows of each numeric column farthest from its mean, in population deviations. One pass for the moments, one that keeps n per column."""
    names = numeric(df)
    moments = df.agg(*(f(F.col(c)).alias(f"{f.__name__}__{c}") for c in names for f in (F.avg, F.stddev_pop)))
    long = df.select(F.inline(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in names))))
    stats = _stack(moments, names, ["avg", "stddev_pop"])
    scored = long.where("value is not null").join(F.broadcast(stats), "column").withColumn("z", F.try_divide(F.col("value") - F.col("avg"), F.nullif("stddev_pop", F.lit(0.0))))
    own = Window.partitionBy("column").orderBy(F.desc(F.abs("z")), F.desc("value"))
    return scored.where("z is not null").withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= n).select("column", "rank", "value", "z")


def health_check(df: DataFrame, dataset: str, table: str) -> DataFrame:
    """Name, type, coverage and greatest |z| (population deviations) by column, in one aggregate.

    The value farthest from the mean is the least or the greatest one. |z| is
    null for other types, for constant columns and for those of nulls only; an
    empty table has no rows.
    """
    names, kinds = numeric(df), {f.name: f.dataType.simpleString() for f in df.schema}
    made = [F.count("*").alias("_n"), *(F.try_divide(F.count(c), F.count("*")).alias(f"coverage__{c}") for c in df.columns)]
    for c in names:
        own, mean = F.col(c).cast("double"), F.avg(c)
        made.append(F.try_divide(F.greatest(F.max(own) - mean, mean - F.min(own)), F.stddev_pop(c)).alias(f"max_z__{c}"))
    wide = df.agg(*made).withColumns({f"max_z__{c}": F.lit(None).cast("double") for c in df.columns if c not in names}).where("_n > 0")
    kind = F.element_at(F.create_map(*(x for c, k in kinds.items() for x in (F.lit(c), F.lit(k)))), F.col("column"))
    out = _stack(wide, df.columns, ["coverage", "max_z"])
    return out.select(F.lit(dataset).alias("dataset"), F.lit(table).alias("table"), "column", kind.alias("type"), F.round("coverage", 4).alias("coverage"), F.round("max_z", 4).alias("max_z"))


def classifier_change(rep: DataFrame, base: DataFrame) -> DataFrame:
    """Support-weighted precision, recall and F1 by domain, and their change against a baseline."""
    mean = lambda c: F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
    weigh = lambda df, tag: df.groupBy("domain").agg(*(mean(c).alias(f"{c}{tag}") for c in ("precision", "recall", "f1_score")))
    both = weigh(rep, "").join(weigh(base, "_base"), "domain")
    return both.select("domain", *("precision recall f1_score".split()), *((F.col(c) - F.col(f"{c}_base")).alias(f"{c}_change") for c in ("precision", "recall", "f1_score")))


def returning_change(new: DataFrame, base: DataFrame) -> DataFrame:
    """Mean returning share by site, before and now, and its change; sites of one side drop out."""
    mean = lambda df, name: df.groupBy("site").agg(F.avg("returning_pct").alias(name))
    return mean(new, "now").join(mean(base, "before"), "site").withColumn("change", F.col("now") - F.col("before"))


def audience_counts(aud: DataFrame, approximate: bool = False) -> DataFrame:
    """Users in all, known, lookalike, and with industry, job or both."""
    count = F.approx_count_distinct if approximate else F.count_distinct
    of = lambda test, name: count(F.when(test, F.col("user_id"))).alias(name)
    industry, job, known = F.col("industry").isNotNull(), F.col("job").isNotNull(), F.col("known") == 1
    return aud.agg(count("user_id").alias("users"), of(known, "known"), of(~known, "lookalike"), of(industry, "with_industry"), of(job, "with_job"), of(industry & job, "with_both"))


def top_with_others(df: DataFrame, name: str, k: int) -> DataFrame:
    """The k most frequent values, and the others together."""
    counts = df.where(F.col(name).isNotNull()).groupBy(name).agg(F.count("*").alias("n"))
    top = counts.orderBy(F.desc("n"), name).limit(k).select(name, F.lit(True).alias("_top"))
    named = counts.join(F.broadcast(top) if k <= 10_000 else top, name, "left").withColumn(name, F.when(F.col("_top"), F.col(name)).otherwise("Others"))
    return named.groupBy(name).agg(F.sum("n").alias("n"))


def company_table(aud: DataFrame, companies: DataFrame) -> DataFrame:
    """Users of each company beside its attributes; a company without any keeps a row, null ones drop out."""
    users = aud.where("company is not null").groupBy("company").agg(F.count_distinct("user_id").alias("users"))
    return users.join(companies.dropDuplicates(["company"]), "company", "left")


def drop_small(df: DataFrame, name: str, n: int) -> DataFrame:
    """Rows of values that stand n times or more; null values drop out."""
    return df.join(df.groupBy(name).agg(F.count("*").alias("_n")).where(F.col("_n") >= n).select(name), name, "left_semi")


def n_clusters(df: DataFrame, by: list[str]) -> DataFrame:
    """Greatest cluster + 1 by group, 0 where all are null."""
    return df.groupBy(*by).agg(F.coalesce(F.max("cluster") + 1, F.lit(0)).alias("n_clusters"))


def facet_tree(df: DataFrame, parent: str, child: str) -> DataFrame:
    """Sorted distinct children of each parent; arrays are flattened first."""
    flat = df.withColumn(child, F.explode(child)) if isinstance(df.schema[child].dataType, T.ArrayType) else df
    return flat.where(F.col(parent).isNotNull()).groupBy(parent).agg(F.sort_array(F.collect_set(child)).alias("children"))


def attribute_probs(cells: DataFrame, alphas: DataFrame, theta: float) -> DataFrame:
    """Probability of attributes in clusters under a prior: n + (N + alpha) * theta, scaled to 1 in each cluster. Cells of no user count as 0; attributes without an alpha drop out."""
    grid = cells.select("cluster").distinct().crossJoin(F.broadcast(alphas))
    own = grid.join(cells.select("cluster", "attribute", "n"), ["cluster", "attribute"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    total = F.sum("n").over(Window.partitionBy("attribute"))
    raised = own.withColumn("weight", F.col("n") + (total + F.col("alpha")) * theta)
    return raised.select("cluster", "attribute", "n", "weight", (F.col("weight") / F.sum("weight").over(Window.partitionBy("cluster"))).alias("probability"))


def attr_distribution(df: DataFrame, attr: str) -> DataFrame:
    """Share of each attribute in its cluster; every cluster also has one Unknown."""
    unknown = df.select("cluster").distinct().withColumn(attr, F.lit("Unknown"))
    counts = df.where(F.col(attr).isNotNull()).select("cluster", attr).union(unknown).groupBy("cluster", attr).agg(F.count("*").alias("n"))
    return counts.withColumn("share", F.round(F.col("n") / F.sum("n").over(Window.partitionBy("cluster")), 3))


def uniform(seed: int, *keys: str) -> Column:
    """A repeatable draw from [0, 1) for each key."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)


def draw_attribute(df: DataFrame, dist: DataFrame, attr: str, seed: int) -> DataFrame:
    """An unknown attribute is drawn from its cluster's shares; ``predicted`` marks these. Shares are gathered by cluster, which bounds them by the number of attributes."""
    own = Window.partitionBy("cluster").orderBy(attr)
    steps = dist.withColumn("_to", F.sum("n").over(own) / F.sum("n").over(Window.partitionBy("cluster")))
    steps = steps.groupBy("cluster").agg(F.sort_array(F.collect_list(F.struct(F.col("_to").alias("to"), F.col(attr).alias("value")))).alias("_steps"))
    drawn = F.get(F.filter("_steps", lambda s: s["to"] > F.col("_u")), F.lit(0))["value"]
    out = df.join(steps, "cluster", "left").withColumn("_u", uniform(seed, "user_id")).withColumn("predicted", F.col(attr).isNull())
    return out.withColumn(attr, F.coalesce(F.col(attr), drawn)).drop("_u", "_steps")


def cosine(a: Column, b: Column) -> Column:
    """Null for a zero vector."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    return F.try_divide(dot(a, b), F.nullif(F.sqrt(dot(a, a) * dot(b, b)), F.lit(0.0)))


def drift_behaviour(base: DataFrame, day: DataFrame, names: list[str], by: str = "domain") -> DataFrame:
    """Cosine of cluster sizes, and mean cosine of behaviour vectors; a cluster that is missing on the day is zero."""
    zero = lambda c: F.coalesce(F.col(c).cast("double"), F.lit(0.0))
    d = day.withColumnsRenamed({c: f"_d_{c}" for c in ("size", *names)})
    both = base.join(d, [by, "cluster"], "left")
    size = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("cluster", zero(c).alias("v")))), lambda x: x["v"])
    per = cosine(F.array(*map(zero, names)), F.array(*(zero(f"_d_{c}") for c in names)))
    out = both.withColumn("_c", per).groupBy(by).agg(size("size").alias("_a"), size("_d_size").alias("_b"), F.avg("_c").alias("behaviour_similarity"))
    return out.select(by, cosine(F.col("_a"), F.col("_b")).alias("size_similarity"), "behaviour_similarity")


def drift_profile(base: DataFrame, day: DataFrame, dim: str, by: str = "domain") -> DataFrame:
    """Mean cosine of (per_cluster, dim_total, weight_ratio) over (cluster, value) pairs of the baseline and one ``unknown`` per cluster, which takes the day's unseen pairs."""
    values = ["per_cluster", "dim_total", "weight_ratio"]
    keys = [by, "cluster", dim]
    old = base.groupBy(*keys).agg(*(F.avg(c).alias(c) for c in values))
    old = old.unionByName(base.select(by, "cluster").distinct().select(by, "cluster", F.lit("unknown").alias(dim), *(F.lit(0.0).alias(c) for c in values)))
    seen = day.join(old.select(*keys, F.lit(True).alias("_seen")), keys, "left").withColumn(dim, F.when(F.col("_seen"), F.col(dim)).otherwise("unknown"))
    new = seen.groupBy(*keys).agg(*(F.sum(c).cast("double").alias(f"_d_{c}") for c in values))
    both = old.join(new, keys, "left")
    vector = lambda tag: F.array(*(F.coalesce(f"{tag}{c}", F.lit(0.0)) for c in values))
    return both.withColumn("_c", cosine(vector(""), vector("_d_"))).groupBy(by).agg(F.avg("_c").alias("similarity"))
