"""Personal data: rule spans, and candidate spans chosen by boosted trees.

Everything over the documents is DataFrame expressions. Base rules give spans
that always count. High-recall generators propose further spans (numbers in any
layout, addresses around "at" signs and words, dotted numbers, key-like tokens),
which overlap freely; those that meet no base span are scored by boosted trees
from their format and context.

The trees learn from a bounded sample of base spans, each rewritten in its own
context. Formats that the base rules miss are positives ("name [at] host [dot]
org", no plus, other separators); look-alikes made of the same characters are
negatives (wrong check digits, versions, dates, handles). Key-like tokens have
no base rule: their positives stand after a word such as "token =", which the
trees don't see, and their negatives are slugs made of the words around spans.
What is in the documents without a base rule firing is never a negative. Scores
are calibrated for each kind on examples held out from the fit; a proposal of at
least ``probability`` is added.

Positions, tests against base spans and redaction run over sorted arrays in
blocks, so a text with tens of thousands of spans takes time in proportion.
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import keep

KINDS = ("email", "ip", "card", "phone")
#: Kinds of spans, in the order of results: those with base rules, then what only the method adds.
ALL_KINDS = (*KINDS, "secret")
_LOCAL = "A-Za-z0-9._%+-"
#: Base patterns, written so that no text makes them backtrack over a run again:
#: a run is entered at its first character (or where the last match ended) and
#: left possessively. They find what the plain patterns of the contract find.
BASE = {
    "email": rf"(?:\G|(?<![{_LOCAL}]))[{_LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_OCTET = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9]|)"
_EDGE = r"\s@<>()\[\]\x22',;:|"
_AT, _DOT = (rf"\x20?[\[({{]\x20?(?i:{x})\x20?[\])}}]\x20?" for x in ("at", "dot"))
_POINT = r"\x20?[\[(]?\.[\])]?\x20?"
#: Generators of proposals: (kind, pattern, what a text must hold to be searched).
PROPOSE = (
    ("email", rf"(?<![^{_EDGE}])[^{_EDGE}]++\x20?@\x20?[^{_EDGE}]*[^{_EDGE}.!?&%$#*]", "@"),
    ("email", rf"(?<![{_LOCAL}])[{_LOCAL}]++(?:{_AT}|@)[A-Za-z0-9-]++(?:(?:\.|{_DOT})[A-Za-z0-9-]++)++", "at"),
    ("email", rf"(?<![{_LOCAL}])[{_LOCAL}]++\x20(?:at|AT)\x20[A-Za-z0-9-]++(?:\x20(?:dot|DOT)\x20[A-Za-z0-9-]++)++", "dot"),
    ("ip", rf"(?<![0-9.])[0-9]++(?:{_POINT}[0-9]++){{2,}}+", "."),
    ("number", r"(?<![0-9])[(+]?[0-9][0-9\x20()./_-]{5,}[0-9]", ""),
    ("number", r"(?<![0-9])[0-9]{9,19}(?![0-9])", ""),
    ("secret", r"(?<![A-Za-z0-9_+/=-])(?=[A-Za-z_+/-]*[0-9])(?=[0-9_+/-]*[A-Za-z])[A-Za-z0-9_+/-]{16,}+={0,2}", "secret"),
)
#: Words that name a credential, before a token.
CREDENTIAL = r"(?i)(?:token|secret|key|passw(?:or)?d|credentials?)[\x20\x22':=]{1,6}$"
_HIT = "array<struct<s:int,e:int,kind:string,hit:string,left:string,right:string>>"
FEATURES = (
    "kind", "length", "digits", "groups", "longest", "shortest", "last", "letters", "spaces", "dots", "hyphens", "slashes", "brackets",
    "at", "at_word", "dot_word", "octets", "luhn", "plus", "joined_left", "joined_right", "after_word", "first", "mixed",
)
#: Items of one block of a fold.
BLOCK = 256


def let(value: Column, then) -> Column:
    """``then(value)`` with ``value`` computed once: what stands inside a lambda is computed anew for every entry."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running(items: Column, zero: Column, made: str, step) -> Column:
    """Array of what ``step(state, item)`` = (state, output) gives, of SQL type ``made``, along an array.

    Outputs are collected in blocks: one growing array would be copied at
    every step, which takes time in the square of its size.
    """
    none = F.array().cast(f"array<{made}>")

    def within(own: Column, state: Column) -> Column:
        def one(acc: Column, item: Column) -> Column:
            after, out = step(acc["state"], item)
            return F.struct(after.alias("state"), F.array_append(acc["out"], out).alias("out"))

        return F.aggregate(own, F.struct(state.alias("state"), none.alias("out")), one)

    def whole(every: Column) -> Column:
        def block(acc: Column, k: Column) -> Column:
            got = within(F.slice(every, k * BLOCK + 1, BLOCK), acc["state"])
            return let(got, lambda g: F.struct(g["state"].alias("state"), F.array_append(acc["out"], g["out"]).alias("out")))

        start = F.struct(zero.alias("state"), F.array().cast(f"array<array<{made}>>").alias("out"))
        blocks = F.sequence(F.lit(0), F.floor((F.size(every) - 1) / BLOCK).cast("int"))
        return F.when(F.size(every) > 0, F.flatten(F.aggregate(blocks, start, block, lambda acc: acc["out"]))).otherwise(none)

    return let(items, whole)


def parts_of(text: Column, pattern: str, guard: Column) -> Column:
    """Gaps and matches of a pattern in turn, a gap first and last; null where ``guard`` isn't true.

    One pass marks the matches; the mark stands in no text (``proposals`` sees to it)."""
    return F.when(guard, F.split(F.regexp_replace(text, F.lit(pattern), F.lit("\x01$0\x01")), "\x01", -1))


def hits_of(kind: str, parts: str) -> tuple[Column, Column]:
    """(ends of all parts, matches): matches with their positions in code points and what stands beside them."""
    p = F.col(parts)
    # a step of its own, since what stands inside a lambda is computed anew for every entry
    ends = running(F.transform(p, F.length), F.lit(0), "int", lambda at, n: (at + n, at + n))

    def hit(i: Column) -> Column:
        own, before, after = F.get(p, 2 * i + 1), F.get(p, 2 * i), F.get(p, 2 * i + 2)
        e = F.get(f"{parts}_ends", 2 * i + 1)
        return F.struct((e - F.length(own)).alias("s"), e.alias("e"), F.lit(kind).alias("kind"), own.alias("hit"), F.right(before, F.lit(24)).alias("left"), F.left(after, F.lit(12)).alias("right"))

    return ends, F.when(F.size(p) > 1, F.transform(F.sequence(F.lit(0), F.floor(F.size(p) / 2).cast("int") - 1), hit)).otherwise(F.array().cast(_HIT))


def digits_of(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(digits: Column) -> Column:
    """True where a string of digits, not empty, passes the Luhn check."""
    back = F.reverse(digits)

    def add(acc: Column, i: Column) -> Column:
        d = F.ascii(F.substring(back, i, F.lit(1))) - 48
        return acc + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    total = F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)
    return F.when(F.length(digits) > 0, total % 10 == 0).otherwise(False)


def _valid(kind: str, hit: Column) -> Column:
    if kind == "ip":
        return hit.rlike(rf"^{_OCTET}\.{_OCTET}\.{_OCTET}\.{_OCTET}$")
    n = F.length(digits_of(hit))
    if kind == "card":
        return n.between(13, 19) & F.when(n.between(13, 19), luhn(digits_of(hit))).otherwise(False)
    if kind == "phone":
        return n.between(9, 15)
    return F.lit(True)


def _holds(kind: str):
    return lambda c: _valid(kind, c["hit"])


def _is(kind: str):
    return lambda c: c["kind"] == kind


def _guards(text: Column, digit: Column) -> dict[str, Column]:
    """What a text must hold to be searched, as cheap tests; ``digit``: it has one."""
    return {
        "email": F.contains(text, F.lit("@")),
        "ip": digit & text.rlike(r"[0-9]\.[0-9]"),
        "card": digit & text.rlike(r"[0-9](?:[\x20-]?[0-9]){12}"),
        "phone": F.contains(text, F.lit("+")),
        "@": F.contains(text, F.lit("@")),
        "at": text.rlike(r"[\[({]\x20?(?i:at)\x20?[\])}]"),
        "dot": F.contains(text, F.lit(" dot ")) | F.contains(text, F.lit(" DOT ")),
        ".": digit & text.rlike(rf"[0-9]{_POINT}[0-9]++{_POINT}[0-9]"),
        "": digit & text.rlike(r"[0-9][0-9\x20()./_-]{5}"),
        "secret": digit & text.rlike(r"(?<![A-Za-z0-9_+/=-])[A-Za-z0-9_+/-]{16}"),
    }


def _features(c: Column) -> Column:
    """Format and context of a proposal. Words that name a credential are no feature."""
    hit, left, right = c["hit"], c["left"], c["right"]
    digits = digits_of(hit)
    groups = F.regexp_extract_all(hit, F.lit("[0-9]+"), F.lit(0))
    n = F.length(digits)
    kind = F.array_position(F.array(F.lit("number"), *map(F.lit, ALL_KINDS)), c["kind"])
    count = lambda p: F.regexp_count(hit, F.lit(p))
    values = {
        "kind": kind,
        "length": F.length(hit),
        "digits": n,
        "groups": F.size(groups),
        "longest": F.array_max(F.transform(groups, F.length)),
        "shortest": F.array_min(F.transform(groups, F.length)),
        "last": F.length(F.try_element_at(groups, F.lit(-1))),
        "letters": count(r"\p{L}"),
        "spaces": count(r"\x20"),
        "dots": count(r"\."),
        "hyphens": count("[-_]"),
        "slashes": count("/"),
        "brackets": count(r"[\[({]"),
        "at": count("@"),
        "at_word": count(rf"{_AT}|\x20(?i:at)\x20"),
        "dot_word": count(rf"{_DOT}|\x20(?i:dot)\x20"),
        "octets": F.forall(groups, lambda g: F.length(g) <= 3) & F.forall(groups, lambda g: (F.length(g) < 3) | (g <= "255")),
        "luhn": F.when(n.between(13, 19), luhn(digits)).otherwise(False),
        "plus": F.startswith(hit, F.lit("+")) | F.endswith(left, F.lit("+")) | F.startswith(hit, F.lit("00")),
        "joined_left": left.rlike(r"[\p{L}\p{N}_]$"),
        "joined_right": right.rlike(r"^[\p{L}\p{N}_]"),
        "after_word": left.rlike(r"\p{L}[\x20:=\x22]+$"),
        "first": F.when(n > 0, F.ascii(digits) - 48).otherwise(-1),
        "mixed": count("[A-Za-z][0-9]"),
    }
    return F.array(*(F.coalesce(values[f].cast("double"), F.lit(-1.0)) for f in FEATURES))


def _met(base: str, more: str) -> Column:
    """For each entry of the sorted array ``more``: whether it meets an entry of
    ``base``. Both are run through in order of position, forth for what starts
    before an entry and back for what starts after."""
    slim = lambda own: lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), F.lit(own).alias("own"))

    def forth(top: Column, c: Column) -> tuple[Column, Column]:
        return F.when(c["own"] == 0, F.greatest(top, c["e"])).otherwise(top), F.when(c["own"] == 1, top > c["s"])

    def back(low: Column, c: Column) -> tuple[Column, Column]:
        return F.when(c["own"] == 0, F.least(low, c["s"])).otherwise(low), F.when(c["own"] == 1, low < c["e"])

    def flags(line: Column) -> Column:
        some = lambda x: F.filter(x, lambda y: y.isNotNull())
        before = some(running(line, F.lit(0), "boolean", forth))
        after = F.reverse(some(running(F.reverse(line), F.lit((1 << 31) - 1), "boolean", back)))
        return F.zip_with(before, after, lambda x, y: x | y)

    return let(F.sort_array(F.concat(F.transform(base, slim(0)), F.transform(more, slim(1)))), flags)


def proposals(docs: DataFrame) -> DataFrame:
    """Adds ``base`` (valid base spans: s, e, kind, hit, left, right) and ``found``
    (proposals that meet no base span, with features ``x``) to documents."""
    text = F.col("_text")
    out = docs.withColumn("_text", F.translate(F.coalesce("text", F.lit("")), "\x01", "\x02"))
    out = out.withColumn("_digit", text.rlike("[0-9]"))
    guards = _guards(text, F.col("_digit"))
    every = [*((k, p, k) for k, p in BASE.items()), *PROPOSE]
    out = out.withColumns({f"_p{k}": parts_of(text, pattern, guards[guard]) for k, (_, pattern, guard) in enumerate(every)})
    made = [hits_of(kind, f"_p{k}") for k, (kind, _, _) in enumerate(every)]
    out = out.withColumns({f"_p{k}_ends": F.when(F.size(f"_p{k}") > 1, ends) for k, (ends, _) in enumerate(made)})
    base = [F.filter(hits, _holds(kind)) for (kind, _, _), (_, hits) in zip(every[: len(BASE)], made, strict=False)]
    out = out.withColumns({"base": F.concat(*base), "_more": F.sort_array(F.concat(*(hits for _, hits in made[len(BASE) :])))})
    out = out.drop("_text", "_digit", *(f"_p{k}{x}" for k in range(len(every)) for x in ("", "_ends")))

    def named(c: Column) -> Column:
        kind = F.when(c["kind"] != "number", c["kind"]).when(F.length(digits_of(c["hit"])) >= 13, "card").otherwise("phone")
        return F.struct(c["s"].alias("s"), c["e"].alias("e"), kind.alias("kind"), c["left"].rlike(CREDENTIAL).alias("named"), _features(c).alias("x"))

    met = F.when((F.size("base") > 0) & (F.size("_more") > 0), _met("base", "_more"))
    out = out.withColumn("_met", met)
    free = F.when(F.col("_met").isNull(), F.col("_more")).otherwise(F.filter(F.arrays_zip("_more", "_met"), lambda z: ~z["_met"])["_more"])
    return out.withColumn("_more", free).withColumn("found", F.when(F.size("_more") > 0, F.transform("_more", named))).drop("_more", "_met")


def rewritten(spans: DataFrame) -> DataFrame:
    """Adds ``v``, an array of (text, s, e, good), to rows of kind, hit, left and right: the
    span in other formats (good) and look-alikes of the same characters, in its own context."""
    d, n, left, right = F.col("_d"), F.col("_n"), F.col("left"), F.col("right")
    digits = digits_of(F.col("hit"))
    own = spans.withColumns({"_d": digits, "_n": F.length(digits), "_local": F.substring_index("hit", "@", 1), "_domain": F.substring_index("hit", "@", -1), "_octets": F.split("hit", r"\.")})
    own = own.withColumns({
        "_a": F.substring(d, n - 9, F.lit(3)), "_b": F.substring(d, n - 6, F.lit(3)), "_c": F.right(d, F.lit(4)), "_country": F.left(d, n - 10),
        "_wrong": F.concat(F.left(d, n - 1), ((F.right(d, F.lit(1)).try_cast("int") + 1) % 10).cast("string")),
        "_year": F.concat(F.lit("20"), F.left(d, F.lit(2))), "_month": F.concat(F.lit("0"), F.left(d, F.lit(1))), "_day": F.concat(F.lit("1"), F.right(d, F.lit(1))),
        "_first": F.substring_index("_domain", ".", 1), "_three": F.array_join(F.slice("_octets", 1, 3), "."),
        "_words": F.array_join(F.regexp_extract_all(F.concat_ws(" ", left, right), F.lit("[A-Za-z]+"), F.lit(0)), "-"),
    })

    def filled(form: str) -> Column:
        """The text of a form whose {names} are columns."""
        parts = re.split(r"\{(\w+)\}", form)
        return F.concat(*(F.col(f"_{x}") if k % 2 else F.lit(x) for k, x in enumerate(parts) if x))

    spelled = lambda c, dot: F.regexp_replace(c, r"\.", dot)
    fours = lambda c, mark: F.regexp_replace(c, "([0-9]{4})(?=[0-9])", f"$1{mark}")
    marks = (".", "/", "_", "  ", " - ")
    tries = {
        "email": (
            [*map(filled, ("{local} [at] {domain}", "{local}(at){domain}", "{local} @ {domain}")), *(F.concat("_local", F.lit(at), spelled("_domain", dot)) for at, dot in ((" [at] ", " [dot] "), ("(at)", "(dot)"), (" at ", " dot "), (" {at} ", "{dot}")))],
            [*map(filled, ("{local} at {domain}", "{local}@{first}", "{local} @ {first}", "{first} dot {local}"))],
        ),
        "phone": (
            [*map(filled, ("({a}) {b}-{c}", "{a}-{b}-{c}", "{a}.{b}.{c}", "{a} {b} {c}", "00{country} {a} {b} {c}", "{country}-{a}-{b}-{c}", "{country} ({a}) {b}-{c}"))],
            [*map(filled, ("{d}", "{year}-{month}-{day}", "{day}/{month}/{year}", "{day}.{month}.{year}", "{year}-{year}-{year}", "1.{a}.{b}.{a}", "{year} {c}", "{d}{d}"))],
        ),
        "card": (
            [*(fours(d, mark) for mark in marks), filled("{d} {d}")],
            [*(fours("_wrong", mark) for mark in (*marks, " ")), *map(filled, ("{wrong}", "{wrong} {wrong}", "{d}{d}"))],
        ),
        "ip": (
            [*(spelled("hit", mark) for mark in ("[.]", "(.)", " . ")), F.concat("_three", F.lit("[.]"), F.get("_octets", F.lit(3)))],
            [F.col("_three"), spelled("_three", "[.]"), F.concat(spelled("_three", "[.]"), F.lit("[.]3"), F.lpad(F.get("_octets", F.lit(3)), 2, "0")), F.concat(spelled("hit", " . "), F.lit(" . 7")), F.concat(spelled("hit", "[.]"), F.lit("[.]9")),
             filled("{day}.{month}.{year}")],
        ),
    }
    slugs = [*map(filled, ("{words}-{c}", "{year}-{month}-{day}-{words}")), F.concat(F.regexp_replace("_words", "-", "_"), F.lit("_"), F.col("_month")), F.concat(F.regexp_replace("_words", "-", "/"), F.lit("/"), F.col("_year"))]
    tried = F.lit(None).cast("array<struct<v:string,good:boolean>>")
    for kind, (good, bad) in tries.items():
        each = [F.struct(v.alias("v"), F.lit(k < len(good)).alias("good")) for k, v in enumerate([*good, *bad, *slugs])]
        tried = F.when(F.col("kind") == kind, F.array(*each)).otherwise(tried)
    at = F.length(left)
    # of two copies in a row the first is meant
    end = lambda c: at + F.when(c["v"] == F.concat(d, F.lit(" "), d), n).otherwise(F.length(c["v"]))
    placed = F.transform("_tried", lambda c: F.struct(F.concat(left, c["v"], right).alias("text"), at.alias("s"), end(c).alias("e"), c["good"].alias("good")))
    # inside a lambda, since code made of so many texts would take longer to compile than to run
    return own.withColumn("_tried", let(F.lit(0), lambda _: tried)).withColumn("v", placed).select(*spans.columns, "v")


def examples(made: DataFrame, most: int) -> DataFrame:
    """(order, kind, x, y) to learn from: proposals over ``most`` rewritten base
    spans at most, and over ``most`` key-like tokens after a word for credentials
    at most (least by hash). ``order`` is one value for all that comes of a span."""
    spans = made.where("size(base) > 0").select("doc_id", F.posexplode("base")).select(F.xxhash64("doc_id", "pos", "col.hit").alias("order"), "col.*")
    sample = keep(spans.orderBy("order", "kind", "s").limit(most), "sample")
    tried = keep(rewritten(sample.repartition("order")).select("order", "v"), "tried").select("order", F.explode("v").alias("v")).select("order", "v.*")
    # written before the rows are made: the optimizer would compute proposals once more to test whether there are any
    found = keep(proposals(tried.withColumnsRenamed({"s": "vs", "e": "ve"})).select("order", "vs", "ve", "good", "found"), "tries")
    found = found.select("order", "vs", "ve", "good", F.explode("found").alias("c"))
    overlap = F.least("ve", "c.e") - F.greatest("vs", "c.s")
    covers = 5 * overlap >= 4 * (F.greatest("ve", "c.e") - F.least("vs", "c.s"))
    found = found.where(overlap > 0).select("order", "c.kind", "c.x", (F.col("good") & covers).alias("y"))
    tokens = made.where("size(found) > 0").select("doc_id", F.posexplode("found")).where("col.kind = 'secret' and col.named")
    tokens = tokens.select(F.xxhash64("doc_id", "pos", F.lit(1)).alias("order"), "col.kind", "col.x", F.lit(True).alias("y"))
    return keep(found.union(tokens.orderBy("order").limit(most)), "examples")


def _tree_sql(node, x: str) -> str:
    if node.subtreeDepth() == 0:
        return repr(float(node.prediction()))
    split = node.split()
    return f"if({x}[{split.featureIndex()}] <= {split.threshold()!r}D, {_tree_sql(node.leftChild(), x)}, {_tree_sql(node.rightChild(), x)})"


def fit_trees(rows: DataFrame, rounds: int, depth: int) -> str | None:
    """A SQL expression of array ``x``: the boosted margin. None where only one class is there to learn from."""
    inputs = VectorAssembler(inputCols=list(FEATURES), outputCol="features")
    sample = keep(rows.select(F.col("y").cast("double").alias("label"), *(F.col("x")[k].alias(f) for k, f in enumerate(FEATURES))).coalesce(2), "fitted")
    if sample.select("label").distinct().count() < 2:
        return None
    model = GBTClassifier(maxIter=rounds, maxDepth=depth, stepSize=0.4, seed=7, cacheNodeIds=False).fit(inputs.transform(sample))
    return " + ".join(f"{w!r}D * {_tree_sql(t._java_obj.rootNode(), 'x')}" for t, w in zip(model.trees, model.treeWeights, strict=True))


def thresholds(scored: DataFrame, least: float) -> dict[str, float]:
    """Margin of each kind at which the calibrated probability reaches ``least``.

    A logistic curve over the margin is fitted to held-out examples, of which
    only counts by bin are gathered. A bin starts with half an example of each
    class at either end, so a kind with few examples stays near one half.
    """
    bins = scored.groupBy("kind", F.round("margin", 1).alias("m")).agg(F.sum(F.col("y").cast("int")).alias("yes"), F.count("*").alias("n")).collect()
    out = {}
    for kind in ALL_KINDS:
        rows = [(r["m"], r["yes"], r["n"]) for r in bins if r["kind"] == kind]
        if not sum(r[1] for r in rows):
            continue
        m, yes, n = np.array([*rows, (-2.0, 0.5, 1), (2.0, 0.5, 1)], dtype=float).T
        slope, shift = 1.0, 0.0
        for _ in range(100):
            p = 1 / (1 + np.exp(-np.clip(slope * m + shift, -30, 30)))
            w = n * p * (1 - p) + 1e-9
            g = yes - n * p
            hess = np.array([[np.sum(w * m * m) + 1e-3, np.sum(w * m)], [np.sum(w * m), np.sum(w) + 1e-3]])
            move = np.linalg.solve(hess, [np.sum(g * m), np.sum(g)])
            slope, shift = slope + np.clip(move[0], -1, 1), shift + np.clip(move[1], -1, 1)
        if slope > 0:
            out[kind] = float((np.log(least / (1 - least)) - shift) / slope)
    return out


def _margin(margin: str) -> Column:
    """The margin of ``x``; inside a lambda, whose expressions aren't compiled (they would be too large)."""
    return F.expr(f"transform(array(x), x -> {margin})[0]")


def _learn(rows: DataFrame, rounds: int, depth: int, probability: float) -> tuple[str | None, dict[str, float]]:
    margin = fit_trees(rows.where("order % 2 = 0"), rounds, depth)
    return margin, thresholds(rows.where("order % 2 <> 0").withColumn("margin", _margin(margin)), probability) if margin else {}


def find_personal_data(docs: DataFrame, most: int = 4_000, rounds: int = 16, depth: int = 4, probability: float = 0.8, keep_text: bool = True) -> DataFrame:
    """Adds ``base`` and ``spans`` (arrays of kind, s, e) to documents.

    All columns of ``docs`` stay (its own ``base`` or ``spans`` as ``in_base``,
    ``in_spans``); it needs doc_id and text. A null or empty text has no spans.
    Repeated rows get the same spans. Added spans may meet each other. ``most``
    bounds the base spans, and the key-like tokens, that are learned from: half
    of them fit the trees, half calibrate. Where the documents have no base span
    nothing is learned and nothing added. Without ``keep_text`` the text isn't
    written along and isn't returned.
    """
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    made = proposals(docs.withColumnsRenamed({c: f"in_{c}" for c in others}))
    made = keep(made if keep_text else made.drop("text"), "proposals")
    margin, limits = _learn(examples(made, most), rounds, depth, probability)
    added = F.array().cast("array<struct<kind:string,s:int,e:int>>")
    slim = lambda c: F.struct(c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"))
    if limits:
        bar = " ".join(f"when c.kind = '{k}' then {v!r}D" for k, v in limits.items())
        chosen = f"filter(coalesce(found, array()), c -> ({margin.replace('x[', 'c.x[')}) >= case {bar} else double('infinity') end)"
        added = F.array_distinct(F.transform(F.expr(chosen), slim))
    base = F.transform("base", slim)
    rank = lambda c: F.struct(F.array_position(F.array(*map(F.lit, ALL_KINDS)), c["kind"]).alias("rank"), c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"))
    spans = F.transform(F.sort_array(F.transform(F.concat(base, added), rank)), slim)
    out = made.withColumns({"spans": spans, "base": base}).drop("found")
    return out.withColumnsRenamed({f"in_{c}": c for c in others if c not in ("base", "spans")})


def measured(docs: DataFrame, most: int = 4_000, rounds: int = 16, depth: int = 4, probability: float = 0.8) -> DataFrame:
    """(kind, n_good, n_taken, n_right) over the held-out examples: rewritten spans, taken proposals, and those taken rightly."""
    rows = examples(keep(proposals(docs.select("doc_id", "text")).drop("text"), "proposals"), most)
    margin, limits = _learn(rows, rounds, depth, probability)
    bar = F.expr("case " + " ".join(f"when kind = '{k}' then {v!r}D" for k, v in limits.items()) + " else double('infinity') end")
    scored = rows.where("order % 2 <> 0").withColumn("taken", _margin(margin) >= bar)
    return scored.groupBy("kind").agg(F.count_if("y").alias("n_good"), F.count_if("taken").alias("n_taken"), F.count_if(F.col("y") & F.col("taken")).alias("n_right"))


def joined(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda c: F.concat_ws(":", c["kind"], c["s"].cast("string"), c["e"].cast("string"))), ",")


#: Code points of a piece of text from which substrings are taken: from the whole, each would be searched for from its start.
PIECE = 1024


def _between(pieces: str, s: Column, e: Column) -> Column:
    first, last = F.floor(s / PIECE).cast("int"), F.floor(F.greatest(e - 1, s) / PIECE).cast("int")
    return F.substring(F.array_join(F.slice(pieces, first + 1, last - first + 1), ""), s - first * PIECE + 1, e - s)


def redact(found: DataFrame) -> DataFrame:
    """Replaces every span of ``text`` by its kind in brackets; spans that meet
    are one, named after the first. Takes and drops ``base`` and ``spans``."""
    ordered = F.sort_array(F.transform("spans", lambda c: F.struct(c["s"].alias("s"), c["e"].alias("e"), c["kind"].alias("kind"))))
    pieces = F.when(F.size("spans") > 0, F.regexp_extract_all("text", F.lit(rf"(?s).{{1,{PIECE}}}"), F.lit(0)))

    def step(at: Column, c: Column) -> tuple[Column, Column]:
        text = F.concat(_between("_pieces", at, c["s"]), F.lit("["), F.upper(c["kind"]), F.lit("]"))
        return F.greatest(at, c["e"]), F.when(c["s"] >= at, text).otherwise("")

    out = found.withColumn("_pieces", pieces).withColumn("_spans", F.when(F.size("spans") > 0, ordered))
    end = F.array_max(F.transform("_spans", lambda c: c["e"]))
    clean = F.concat(F.array_join(running(F.col("_spans"), F.lit(0), "string", step), ""), _between("_pieces", end, F.length("text")))
    return out.withColumn("text", F.when(F.size("_spans") > 0, clean).otherwise(F.col("text"))).drop("base", "spans", "_pieces", "_spans")


def op10_personal_data(spark, sf_dir: str) -> DataFrame:
    found = find_personal_data(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"), keep_text=False)
    counts = [F.size(F.filter("base", _is(k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))
