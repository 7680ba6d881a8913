"""URL verdicts: host and path rules, else a path-template tree.

Per host, runs of digits become wildcards, and so do the segments below a node
whose next child is likely to be new (slugs): the share of visits to children seen
once estimates that chance, whatever the size of the crawl. Pages of a rule are
the labels. Templates of a host that differ in one segment merge where their
labelled shares of blocked pages are alike by a homogeneity test. A template is
rejected by its blocked share, smoothed towards that of the same template on
all hosts, which is smoothed towards that of all pages. Pages are counted by
(host, shape) before anything else, so a host with many rows costs what its
shapes cost.
"""

from __future__ import annotations

import bisect
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import drop, keep

#: (host, path, verdict); a rule fits its host and all subdomains.
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Chance of a new child from which a segment varies, pages of the prior, and blocked share of a rejected template.
NOVEL, SMOOTH, REJECT = 0.3, 8.0, 0.8
#: Shapes below a node that can show such a chance, at least: all seen once, and f - 2 sqrt(f) >= NOVEL f.
LEAST = math.ceil((2 / (1 - NOVEL)) ** 2)
#: Shapes, and signs in them, of a host whose tree one task walks.
WALKED, WALKED_SIGNS = 100_000, 16 << 20
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    folded = F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 1)
    return F.translate(folded, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), _PARTS, 2)


def rule_of(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for own, start, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):
        fits = ((host == own) | F.endswith(host, F.lit(f".{own}"))) & F.startswith(path, F.lit(start))
        out = F.when(fits, F.struct(F.lit(own + start).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def shape_of(path: Column) -> Column:
    """Segments with runs of digits as ``*``."""
    return F.array_join(F.filter(F.split(F.regexp_replace(path, "[0-9]+", "*"), "/"), lambda x: x != ""), "/")


def host_templates(shapes: list[str], counts: list[int]) -> list[str]:
    """Templates of one host's shapes: a walk down its tree of segments."""
    segments = [x.split("/") for x in shapes]
    out = ["/" + x for x in shapes]
    open_nodes = [(list(range(len(shapes))), 0)]
    while open_nodes:
        rows, level = open_nodes.pop()
        children: dict[str, list[int]] = {}
        for r in rows:
            if len(segments[r]) > level:
                children.setdefault(segments[r][level], []).append(r)
        visits = [sum(counts[r] for r in own) for own in children.values()]
        once = sum(n == 1 for n in visits)
        if once - 2 * math.sqrt(once) >= NOVEL * sum(visits) and once:
            below = [r for own in children.values() for r in own]
            for r in below:
                segments[r][level] = "*"
            groups = [below]
        else:
            groups = list(children.values())
        # a node of fewer shapes can't show a chance, nor can any below it
        open_nodes += [(own, level + 1) for own in groups if len(own) >= LEAST]
    for r, own in enumerate(segments):
        out[r] = "/" + "/".join(own)
    return out


def _tree_rows(table: pa.Table) -> pa.Table:
    table = table.sort_by([("host", "ascending"), ("shape", "ascending")])
    host, shape, n = (table.column(c).to_pylist() for c in ("host", "shape", "n"))
    made, start = [], 0
    while start < len(host):
        end = bisect.bisect_right(host, host[start], start)
        made += host_templates(shape[start:end], n[start:end])
        start = end
    return table.select(["host", "shape", "n", "blocked", "labelled"]).append_column("template", pa.array(made, pa.string()))


def templates(shapes: DataFrame) -> DataFrame:
    """Adds ``template`` to (host, shape, n, blocked, labelled): segments below a
    node become ``*`` where a new child is likely, its chance being f / n of n
    visits to children, f of them to children seen once, less two deviations.
    Hosts of up to ``WALKED`` shapes are walked in one pass, many in a task.
    Others go level by level, for as long as a node has shapes enough to show a
    chance; what is deeper stays as it is."""
    kinds = "host string, shape string, n long, blocked long, labelled long, template string"
    sizes = keep(shapes.groupBy("host").agg(F.count("*").alias("shapes"), F.sum(F.length("shape")).alias("signs")), "hosts")
    large = (F.col("shapes") > WALKED) | (F.col("signs") > WALKED_SIGNS)
    signs = sizes.where(~large).agg(F.sum(F.col("signs") + 20)).first()[0] or 0
    walked = shapes.join(sizes.where(~large).select("host"), "host").withColumn("part", F.pmod(F.xxhash64("host"), F.lit(signs // WALKED_SIGNS + 1)))
    walked = walked.select("host", "shape", "n", "blocked", "labelled", "part").groupBy("part").applyInArrow(_tree_rows, kinds)
    if sizes.where(large).isEmpty():
        return keep(walked, "templates")
    out = shapes.join(F.broadcast(sizes.where(large).select("host")), "host")
    return keep(walked.union(_by_level(out).select(walked.columns)), "templates")


def _by_level(shapes: DataFrame) -> DataFrame:
    """``templates`` of hosts of any number of shapes, a round of joins for each level."""
    out = shapes.withColumns({"segments": F.split("shape", "/"), "template": F.lit("")})
    level = 0
    while True:
        own = F.get("segments", F.lit(level))
        most = out.where(own.isNotNull()).groupBy("host", "template").agg(F.count("*").alias("m")).agg(F.max("m")).first()[0]
        if (most or 0) < LEAST:
            break
        children = out.where(own.isNotNull()).groupBy("host", "template", own.alias("own")).agg(F.sum("n").alias("n"))
        nodes = children.groupBy("host", "template").agg(F.count_if(F.col("n") == 1).alias("f"), F.sum("n").alias("n"))
        nodes = nodes.select(F.col("host").alias("h"), F.col("template").alias("t"), (F.col("f") - 2 * F.sqrt("f") >= NOVEL * F.col("n")).alias("wild"))
        placed = out.join(nodes, (F.col("host") == F.col("h")) & (F.col("template") == F.col("t")), "left")
        step = F.concat("template", F.lit("/"), F.when(F.col("wild"), "*").otherwise(own))
        placed = keep(placed.withColumn("template", F.when(own.isNotNull(), step).otherwise(F.col("template"))).drop("h", "t", "wild"), "levels")
        if level:
            drop(out)
        out, level = placed, level + 1
    rest = F.slice("segments", level + 1, F.greatest(F.size("segments") - level, F.lit(0)))
    return out.withColumn("template", F.array_join(F.concat(F.array("template"), rest), "/")).drop("segments")


def merged(nodes: DataFrame) -> DataFrame:
    """(host, template, branch, blocked, labelled): templates of a host that
    differ in one segment share a branch where their blocked shares are alike.

    The test is a chi-square sum against the pooled share, with five labelled
    pages of each at least; the first segment that passes is taken.
    """
    segments = F.split("template", "/")
    each = nodes.select("host", "template", "blocked", "labelled", F.posexplode(segments).alias("at", "own")).where("own not in ('', '*', '**')")
    each = each.withColumn("branch", F.array_join(F.concat(F.slice(segments, F.lit(1), F.col("at")), F.array(F.lit("*")), F.slice(segments, F.col("at") + 2, F.size(segments))), "/"))
    pool = each.where("labelled >= 5").groupBy("host", "at", "branch").agg(
        F.count("*").alias("m"), F.sum("blocked").alias("b"), F.sum("labelled").alias("l"), F.sum(F.col("blocked") ** 2 / F.col("labelled")).alias("q")
    )
    share = (F.col("b") + 0.5) / (F.col("l") + 1)
    # sum of (b_i - n_i p)^2 / (n_i p (1 - p)) over the members
    chi = (F.col("q") - 2 * share * F.col("b") + share**2 * F.col("l")) / (share * (1 - share))
    alike = pool.where((F.col("m") >= 2) & (chi <= F.col("m") - 1 + 2 * F.sqrt(2 * (F.col("m") - 1)))).select("host", "at", "branch", "b", "l")
    picked = each.where("labelled >= 5").join(alike, ["host", "at", "branch"]).groupBy("host", "template").agg(F.min_by(F.struct("branch", "b", "l"), "at").alias("to"))
    out = nodes.join(picked, ["host", "template"], "left")
    return out.select(
        "host", "template", F.coalesce("to.branch", "template").alias("branch"),
        F.coalesce("to.b", "blocked").alias("blocked"), F.coalesce("to.l", "labelled").alias("labelled"),
    )


def url_verdicts(pages: DataFrame, rules=RULES) -> DataFrame:
    """A row per row of ``pages`` (page_id, url; others ignored): page_id, host,
    path, rule (null where none fits), verdict (``allow`` or ``block``, the
    rule's or else the method's), template, purity. A null url and one without
    ``://`` have an empty host and path and fall in the template of these."""
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    parts = parts.withColumns({"r": rule_of(F.col("host"), F.col("path"), rules), "shape": shape_of(F.col("path"))})
    parts = keep(parts.select("page_id", "host", "path", "r.rule", F.col("r.verdict").alias("ruled"), "shape"), "pages")
    shapes = parts.groupBy("host", "shape").agg(F.count("*").alias("n"), F.count_if(F.col("ruled") == "block").alias("blocked"), F.count("ruled").alias("labelled"))
    shapes = keep(shapes, "shapes")
    placed = templates(shapes)
    nodes = keep(placed.groupBy("host", "template").agg(F.sum("blocked").alias("blocked"), F.sum("labelled").alias("labelled")), "nodes")
    total = nodes.agg(F.sum("blocked").alias("b"), F.sum("labelled").alias("l")).first()
    prior = ((total["b"] or 0) + 1) / ((total["l"] or 0) + 2)
    everywhere = nodes.groupBy("template").agg(((F.sum("blocked") + SMOOTH * prior) / (F.sum("labelled") + SMOOTH)).alias("usual"))
    scored = merged(nodes).join(everywhere, "template")
    purity = (F.col("blocked") + SMOOTH * F.col("usual")) / (F.col("labelled") + SMOOTH)
    scored = scored.select("host", "template", "branch", F.round(purity, 6).alias("purity"))
    verdicts = keep(placed.select("host", "shape", "template").join(scored, ["host", "template"]).select("host", "shape", F.col("branch").alias("template"), "purity"), "verdicts")
    for table in (shapes, placed, nodes):
        drop(table)
    own = F.when(F.col("purity") >= REJECT, "block").otherwise("allow")
    return parts.join(verdicts, ["host", "shape"], "left").select("page_id", "host", "path", "rule", F.coalesce("ruled", own).alias("verdict"), "template", "purity")


def op6_url_filters(spark, sf_dir: str) -> DataFrame:
    return url_verdicts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
