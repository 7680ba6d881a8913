"""Per-user behaviour: visits, engagement, virality, returning visitors.

Page views have user_id, ts, event_date, session_id, view_id, event_id, site,
title, client (web or amp), referrer, agent and continent.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.functions.text import MAIL, OFFSETS, SEARCH, SOCIAL, SYSTEMS, _holds_any, local_hour_zone
from audiweave.functions.time import micros
from audiweave.operators.windows import latest_per


def sessions(ev: DataFrame, minutes: int = 30) -> DataFrame:
    """Adds ``session_id``: a gap of more than ``minutes`` starts a new session of a user."""
    own = Window.partitionBy("user_id").orderBy("ts", "event_id")
    new = F.coalesce(micros("ts") - micros(F.lag("ts").over(own)) > minutes * 60_000_000, F.lit(True))
    return ev.withColumn("_new", new.cast("int")).withColumn("session_id", F.concat_ws("-", "user_id", F.sum("_new").over(own))).drop("_new")


def view() -> Column:
    """What counts as one view: the view on the web, the event elsewhere."""
    return F.when(F.col("client") == "web", F.col("view_id")).otherwise(F.col("event_id"))


def views_sessions() -> list[Column]:
    """G1: distinct sessions and views; null ids count nowhere."""
    return [F.count_distinct("session_id").alias("sessions"), F.count_distinct(view()).alias("views")]


def referrer_visits(site: str = "site", network: tuple[str, ...] = ("example.net",)) -> list[Column]:
    """Classes overlap; null is typed. ``network`` names the domains of one's own network."""
    ref = F.col("referrer")
    return [
        F.count_if(_holds_any(ref, SOCIAL)).alias("visits_social"), F.count_if(_holds_any(ref, SEARCH)).alias("visits_search"),
        F.count_if(_holds_any(ref, MAIL)).alias("visits_email"), F.count_if(_holds_any(ref, network)).alias("visits_network"),
        F.count_if(F.contains(ref, F.col(site))).alias("visits_own"), F.count_if(ref.isNull()).alias("visits_typed"),
    ]


def client_visits() -> list[Column]:
    """Visits on the web and on amp pages; a null client counts nowhere."""
    return [F.count_if(F.col("client") == c).alias(f"visits_{c}") for c in ("web", "amp")]


def continent_visits(names=tuple(OFFSETS)) -> list[Column]:
    """A null continent counts nowhere."""
    at = F.col("continent")
    return [*(F.count_if(at == n).alias(f"visits_{n.lower().replace(' ', '_')}") for n in names), F.count_if(~at.isin(*names)).alias("visits_elsewhere")]


def os_visits() -> list[Column]:
    """An agent counts for every system whose mark it holds, in the mark's case; older Windows is any but 10."""
    held = {name: F.contains("agent", F.lit(mark)) for mark, name in SYSTEMS}
    held["windows_older"] = held["windows_older"] & ~held["windows10"]
    return [F.count_if(test).alias(f"visits_{name}") for name, test in held.items()]


def mean_local_hour() -> Column:
    """Mean hour in the zone of the continent, UTC where that is null or unknown; null times don't count."""
    return F.avg(local_hour_zone(F.col("ts"), F.col("continent"))).alias("mean_hour")


def engagement(completion: str = "completion", dwell: str = "value") -> list[Column]:
    """Mean completion and dwell of the views in which neither is 0 or null."""
    counted = (F.col(completion) != 0) & (F.col(dwell) != 0)
    return [F.avg(F.when(counted, F.col(completion))).alias("mean_completion"), F.avg(F.when(counted, F.col(dwell))).alias("mean_dwell")]


def _recency_frequency(asof, sessions: Column) -> list[Column]:
    day = 86_400_000_000
    now, first, last = micros(F.lit(asof).cast("timestamp")), F.min(micros("ts")), F.max(micros("ts"))
    span = F.floor((now - first) / day)
    return [F.floor((now - last) / day).alias("recency"), F.when(span >= 28, sessions * 28 / span).alias("frequency")]


def recency_frequency(asof) -> list[Column]:
    """Whole days since the last event; sessions per 28 days, null where the span is shorter."""
    return _recency_frequency(asof, F.count_distinct("session_id"))


def lead_flag(users: DataFrame, leads: DataFrame) -> DataFrame:
    """Whether a user is among the leads, however often. A null user is none."""
    marks = leads.select("user_id").distinct().withColumn("_lead", F.lit(True))
    return users.join(marks, "user_id", "left").withColumn("is_lead", F.col("_lead").isNotNull()).drop("_lead")


def _distinct_per(ev: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    """Distinct values of each key, nulls not counted: values are made distinct by key and value first, so no row is copied."""
    return ev.select(F.col(key).alias("_key"), value.alias("_v")).where("_v is not null").distinct().groupBy("_key").agg(F.count("*").alias(name))


def _with_distinct(df: DataFrame, ev: DataFrame, key: str, value: Column, name: str) -> DataFrame:
    part = _distinct_per(ev, key, value, name)
    return df.join(part, F.col(key).eqNullSafe(F.col("_key")), "left").drop("_key").withColumn(name, F.coalesce(name, F.lit(0)))


def virality(ev: DataFrame) -> DataFrame:
    """Views of a title on a site against the site's mean views per title."""
    seen = ev.select("site", "title", view().alias("_v")).distinct()
    by_title = seen.groupBy("site", "title").agg(F.count("_v").alias("views"))
    titles = by_title.where("title is not null").groupBy("site").agg(F.count("*").alias("_titles"))
    by_site = titles.join(_distinct_per(ev, "site", view(), "_n").withColumnRenamed("_key", "site"), "site", "left")
    by_site = by_site.select("site", (F.coalesce("_n", F.lit(0)) / F.col("_titles")).alias("mean_views"))
    return by_title.join(by_site, "site").select("site", "title", "views", F.try_divide("views", "mean_views").alias("virality"))


def user_virality(ev: DataFrame, vir: DataFrame) -> DataFrame:
    """Titles of null have no virality. A user's views of a title are one row before the join, so a home page isn't joined by its events."""
    seen = ev.groupBy("user_id", "site", "title").agg(F.count("*").alias("_n")).join(vir.select("site", "title", "virality"), ["site", "title"])
    known = F.col("virality").isNotNull()
    return seen.groupBy("user_id").agg(F.try_divide(F.sum(F.col("virality") * F.col("_n")), F.sum(F.when(known, F.col("_n")))).alias("mean_virality"))


def user_features(ev: DataFrame, leads: DataFrame, asof) -> DataFrame:
    """One row per user: one aggregate over the events, distinct sessions and views beside it, with virality and the lead flag joined."""
    base = ev.groupBy("user_id").agg(
        *referrer_visits(), *client_visits(), *continent_visits(), *os_visits(), mean_local_hour(), *engagement(), *_recency_frequency(asof, F.lit(1.0))
    )
    base = _with_distinct(base, ev, "user_id", F.col("session_id"), "sessions")
    base = _with_distinct(base, ev, "user_id", view(), "views").withColumn("frequency", F.col("frequency") * F.col("sessions"))
    return lead_flag(base, leads).join(user_virality(ev, virality(ev)), "user_id", "left")


def star(users: DataFrame, *parts: DataFrame) -> DataFrame:
    """aggregates of other sources beside the users."""
    for part in parts:
        users = users.join(part, "user_id", "left")
    return users


def days_seen_before(ev: DataFrame, n_days: int = 30) -> DataFrame:
    """(user, site, day) with the number of distinct days of the ``n_days`` before. Days are made distinct first, so a window holds few rows."""
    days = ev.select("user_id", "site", F.to_date("ts").alias("day")).distinct()
    number = F.datediff("day", F.lit("1970-01-01").cast("date"))
    own = Window.partitionBy("user_id", "site").orderBy("_d").rangeBetween(-n_days, -1)
    return days.withColumn("_d", number).withColumn("days_before", F.count("*").over(own)).drop("_d")


def returning_pct(ev: DataFrame, segments: DataFrame, day, n_days: int = 30, keep_zero: bool = False) -> DataFrame:
    """Per (site, cluster, day), users of a day who were there in the days before, in percent of all its users.

    Groups without any returning user drop out unless ``keep_zero``; so do users without a segment.
    """
    day, kind = F.lit(day).cast("date"), ev.schema["ts"].dataType
    # bounds on the bare column reach the scan; one group per user and site tells both days apart
    recent = ev.where((F.col("ts") >= F.date_sub(day, n_days).cast(kind)) & (F.col("ts") < F.date_add(day, 1).cast(kind)))
    today = F.col("ts") >= day.cast(kind)
    seen = recent.groupBy("user_id", "site").agg(F.bool_or(today).alias("today"), F.bool_or(~today).alias("before")).where("today")
    known = seen.join(segments.select("user_id", "site", "cluster").distinct(), ["user_id", "site"]).where("cluster is not null")
    out = known.groupBy("site", "cluster").agg(F.count("*").alias("users"), F.count_if("before").alias("returning_users"))
    out = out if keep_zero else out.where("returning_users > 0")
    return out.select("site", "cluster", day.alias("day"), "users", "returning_users", F.round(100 * F.col("returning_users") / F.col("users"), 2).alias("returning_pct"))


def rate(total: DataFrame, part: DataFrame, keys: list[str]) -> DataFrame:
    """``part`` in percent of ``total``; null keys and groups of one side drop out."""
    return total.join(part, keys).withColumn("rate", F.round(100 * F.col("part") / F.col("total"), 2))


def company_of_user(cb: DataFrame, k: int = 100) -> DataFrame:
    """A user's latest company if it is one of the ``k`` with most users, else Unknown."""
    counts = cb.where("company is not null").groupBy("company").agg(F.count_distinct("user_id").alias("users"))
    top = counts.orderBy(F.desc("users"), "company").limit(k).select("company", F.lit(True).alias("_top"))
    latest = latest_per(cb.where("company is not null"), ["user_id"], [F.desc("ts"), F.asc("company")])
    return latest.join(top, "company", "left").select("user_id", F.when(F.col("_top"), F.col("company")).otherwise("Unknown").alias("company"))


def last_activity(segments: DataFrame, ev: DataFrame, since) -> DataFrame:
    """segments of users whose latest event on the site is recent."""
    last = ev.groupBy("user_id", "site").agg(F.max("ts").alias("last_activity"))
    return segments.join(last, ["user_id", "site"], "left").where(F.col("last_activity") >= F.lit(since).cast("timestamp"))
