"""Audience selection and country indicators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.operators.incremental import keep_last, upsert
from audiweave.operators.windows import latest_per, top_n, top_n_per, with_group


def audience(industry: DataFrame, job: DataFrame, company: DataFrame) -> DataFrame:
    """A user's likeliest industry with its index among unknown users, job (and ``known_job`` where given) and company."""
    best = latest_per(industry, ["user_id"], [F.desc("probability"), F.asc("attribute")])
    unknown = F.when(F.col("known") == 0, F.col("probability"))
    low, high = F.col("_low"), F.col("_high")
    index = F.when(F.col("known") == 0, F.try_divide(F.col("probability") - low, F.nullif(high - low, F.lit(0.0))))
    out = with_group(best, ["domain", "attribute"], F.min(unknown).alias("_low"), F.max(unknown).alias("_high"))
    out = out.withColumn("prob_index", index).drop("_low", "_high").withColumnRenamed("attribute", "industry")
    known_job = [c for c in ("known_job",) if c in job.columns]
    return out.join(job.select("user_id", "job", *known_job), "user_id", "left").join(company, "user_id", "left")


#: From the lowest level up: the lowest that is chosen decides.
LEVELS = (("city", "province", "country", "continent"), ("company", "company_type"), ("company_city", "company_state", "company_country"))


def active_facets(chosen: dict[str, list]) -> dict[str, list]:
    """The facets that filter. No values and ``all`` are no filter; of a group of levels only the lowest counts."""
    active = {k: v for k, v in chosen.items() if v and "all" not in v}
    for levels in LEVELS:
        present = [k for k in levels if k in active]
        for k in present[1:]:
            active.pop(k)
    return active


def facets(chosen: dict[str, list]) -> Column:
    """N2 as a predicate: values of a facet are alternatives."""
    return reduce(lambda a, b: a & b, (F.col(k).isin(*v) for k, v in active_facets(chosen).items()), F.lit(True))


def select_audience(aud: DataFrame, chosen: dict[str, list], arrays: tuple[str, ...] = ()) -> DataFrame:
    """N2; ``arrays`` names array columns, which must hold all chosen values."""
    held = {k: v for k, v in chosen.items() if k not in arrays}
    out = aud.where(facets(held))
    for k in arrays:
        if chosen.get(k) and "all" not in chosen[k]:
            out = out.where(F.size(F.array_except(F.array(*map(F.lit, chosen[k])), F.col(k))) == 0)
    return out


def by_certainty(aud: DataFrame, p: float, with_known: bool = True, with_known_jobs: bool = True) -> DataFrame:
    """Rows whose prob_index is 1 - p or more, and known ones. ``with_known`` = False leaves out those of known
    industry, ``with_known_jobs`` = False those whose ``known_job`` is 1. Null on both sides drops out."""
    out = aud.where((F.col("prob_index") >= 1 - p) | (F.col("known") == 1))
    for flag, wanted in (("known", with_known), ("known_job", with_known_jobs)):
        out = out if wanted else out.where(F.coalesce(F.col(flag) != 1, F.lit(True)))
    return out


def audience_users(aud: DataFrame) -> DataFrame:
    """The distinct users of an audience."""
    return aud.select("user_id").distinct()


def latest_indicator(ind: DataFrame, year: int) -> DataFrame:
    """Value of the last year up to ``year``."""
    return ind.where(F.col("year") <= year).groupBy("country", "indicator").agg(F.max("year").alias("year"), F.max_by("value", "year").alias("value"))


def indicator_at(ind: DataFrame, year: int, now: int) -> DataFrame:
    """Value at ``year``, else at ``now``; null where neither is there."""
    every = ind.select("country", "indicator").distinct()
    own = ind.where(F.col("year").isin(year, now)).withColumn("_first", F.col("year") == year)
    best = latest_per(own, ["country", "indicator"], [F.desc("_first")]).drop("_first")
    return every.join(best, ["country", "indicator"], "left")


def growth(ind: DataFrame, y0: int, y1: int) -> DataFrame:
    """Percent from ``y0`` to ``y1``, cut to a whole number; both values are cut to whole numbers first. Null where one is missing or the first is 0."""
    at = lambda y: F.max(F.when(F.col("year") == y, F.col("value"))).cast("long")
    return ind.groupBy("country", "indicator").agg(at(y0).alias("v0"), at(y1).alias("v1")).select("country", "indicator", F.try_divide(100 * (F.col("v1") - F.col("v0")), "v0").cast("int").alias("growth"))


def world_rank(ind: DataFrame) -> DataFrame:
    """Position by latest value, largest first, within an indicator."""
    latest = latest_per(ind, ["country", "indicator"], [F.desc("year")])
    return latest.withColumn("rank", F.row_number().over(Window.partitionBy("indicator").orderBy(F.desc("value"), "country")))


def rank_change(ranks: DataFrame) -> DataFrame:
    """Rank of the last edition, of the one before, and the places won."""
    own = Window.partitionBy("country").orderBy(F.desc("year"))
    two = ranks.withColumn("_n", F.row_number().over(own)).where("_n <= 2")
    at = lambda n: F.max(F.when(F.col("_n") == n, F.col("rank")))
    return two.groupBy("country").agg(at(1).alias("rank"), at(2).alias("previous")).withColumn("change", F.col("previous") - F.col("rank"))


def completeness(facts: DataFrame, by: str) -> DataFrame:
    """Share of facts that have a value, by group, and whether it is over one half. An empty table gives no group."""
    out = facts.groupBy(by).agg((F.count_if(F.col("value").isNotNull()) / F.count("*")).alias("completeness"))
    return out.withColumn("publishable", F.col("completeness") > 0.5)


def fill_template(templates: DataFrame, facts: DataFrame) -> DataFrame:
    """``{indicator|year|value}`` tags of (template_id, text) filled for every country of ``facts`` (country, indicator, year, value as text); a missing one is ``v??``."""
    parts = templates.select("template_id", F.split("text", r"\{[^}]*\}", -1).alias("_gaps"), F.regexp_extract_all("text", F.lit(r"\{([^}]*)\}"), F.lit(1)).alias("_tags"))
    countries = facts.select("country").distinct()
    rows = parts.crossJoin(F.broadcast(countries)).select("template_id", "country", F.posexplode("_gaps").alias("_at", "_gap"), F.col("_tags"))
    tag = F.split(F.get("_tags", F.col("_at")), r"\|")
    rows = rows.select("template_id", "country", "_at", "_gap", F.get(tag, F.lit(0)).alias("indicator"), F.get(tag, F.lit(1)).try_cast("int").alias("year"))
    filled = rows.join(facts, ["country", "indicator", "year"], "left")
    text = F.concat("_gap", F.when(F.col("indicator").isNull(), "").otherwise(F.coalesce("value", F.lit("v??"))))
    one = F.sort_array(F.collect_list(F.struct("_at", text.alias("t"))))
    return filled.groupBy("template_id", "country").agg(F.array_join(F.transform(one, lambda x: x["t"]), "").alias("text"))


def country_set(ind: DataFrame, chosen, indicator: str | None = None) -> DataFrame:
    """A list of countries, ``all``, or the n with the greatest latest value."""
    every = ind.select("country").distinct()
    if chosen == "all":
        return every
    if isinstance(chosen, int):
        return top_n(ind.where(F.col("indicator") == indicator), [F.desc("year"), F.desc("value"), F.asc("country")], chosen).select("country")
    return every.where(F.col("country").isin(*chosen))


def largest_cities(df: DataFrame, n: int = 3) -> DataFrame:
    """The n greatest of each country; ties go to the first name. A null country is a country."""
    return top_n_per(df, ["country"], [F.desc("value"), F.asc("city")], n)


def trade_scope(df: DataFrame, codes=("H5", "EB02", "HS"), after: int = 2010) -> DataFrame:
    """Facts of the given classifications after a year; nulls drop out."""
    return df.where(F.col("pf_code").isin(*codes) & (F.col("yr") > after))


def trade_tables(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Facts as integers, and a code dictionary with the last description of each code."""
    facts = raw.select("pf_code", *(F.col(c).cast("long").alias(c) for c in ("yr", "rt_code", "pt_code", "cmd_code", "trade_value")))
    names = keep_last(raw.select(F.col("cmd_code").cast("long").alias("cmd_code"), "cmd_desc", "yr"), "cmd_code", [F.desc("yr"), F.desc("cmd_desc")])
    return facts, names.select("cmd_code", "cmd_desc")


def economics_upsert(existing: DataFrame, payload: DataFrame, now) -> DataFrame:
    """A nested yearly series as facts, merged on (entity, indicator, year)."""
    new = payload.select("country", F.explode("series").alias("s")).select("country", "s.indicator", "s.year", "s.value")
    return upsert(existing, new, "country", ["country", "indicator", "year"], now)
