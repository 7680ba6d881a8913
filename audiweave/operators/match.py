"""Entity and text matching: closest names, title cascade, identities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.functions.text import clean_title, word_found
from audiweave.operators.windows import top_n_per
from audiweave.sources.scratch import written

#: Words that mark seniority; a title without one isn't similar to a master with it.
SENIORITY_WORDS = ("head", "chief", "president", "vp")
#: Clean titles that say nothing.
UNKNOWN_TITLES = ("terte", "contact", "other")
#: Entries of one length that a task holds against a name where their pieces would be too short.
SHORT = 4096


def expand_parens(df: DataFrame, name: str) -> DataFrame:
    """L2: a name with brackets is tried whole, by its inside and by its outside."""
    inside = F.regexp_extract(name, r"\(([^)]*)\)", 1)
    outside = F.trim(F.regexp_replace(name, r"\([^)]*\)", ""))
    return df.withColumn("candidate", F.explode(F.array_distinct(F.filter(F.array(F.trim(name), F.trim(inside), outside), lambda x: x != ""))))


def closest(names: DataFrame, dictionary: DataFrame, n: int, threshold: int | None = None) -> DataFrame:
    """L3: the n dictionary entries nearest to each name by edit distance, in order of distance, then name.

    With a threshold, only entries within it count, and a name with nothing
    near gets a null entry. Without one, the threshold rises (1, 2, 4, ...): all
    entries within it are found, and a name leaves once n of them lie there,
    since no other can be nearer. Both sides may have any size; null names and
    entries drop out, an empty dictionary gives no rows without a threshold.
    """
    a = names.select(F.col("name")).where("name is not null").distinct()
    b = dictionary.select(F.col("name").alias("entry")).where("entry is not null").distinct()
    if threshold is not None:
        return names.select("name").distinct().join(_ranked(_within(a, b, threshold), n), "name", "left")
    b = written(b, "entries")
    longest = max(df.agg(F.max(F.length(c))).first()[0] or 0 for df, c in ((a, "name"), (b, "entry")))
    out, rest, radius = [], written(a, "names"), 1
    while True:
        near = written(_ranked(_within(rest, b, radius), n), "near")
        if radius >= longest:
            out.append(near)
            break
        done = near.groupBy("name").agg(F.count("*").alias("_n")).where(F.col("_n") >= n).select("name")
        out.append(near.join(done, "name", "left_semi"))
        rest = written(rest.join(done, "name", "left_anti"), "names")
        if rest.isEmpty():
            break
        radius *= 2
    found = out[0]
    for part in out[1:]:
        found = found.union(part)
    return found


def _ranked(pairs: DataFrame, n: int) -> DataFrame:
    own = Window.partitionBy("name").orderBy("distance", "entry")
    return pairs.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= n)


def _within(a: DataFrame, b: DataFrame, threshold: int) -> DataFrame:
    """(name, entry, distance) of all pairs within a threshold, by a join on pieces.

    An entry is cut into threshold + 1 equal pieces. Within the distance, some
    piece k stands in the name unchanged, with at most k edits before it and
    threshold - k after it, which bounds its places. Entries whose pieces would
    be shorter than two signs are joined by length alone, dealt over parts.
    """
    parts = threshold + 1
    salts = max(1, b.count() // SHORT)
    cut = lambda size, k: F.floor(size * k / parts).cast("int")
    size = F.length("entry")
    piece = lambda k: F.struct(k.alias("k"), F.substring(F.col("entry"), cut(size, k) + 1, cut(size, k + 1) - cut(size, k)).alias("piece"))
    whole = F.array(F.struct((-1 - F.pmod(F.xxhash64("entry"), F.lit(salts))).cast("int").alias("k"), F.lit("").alias("piece")))
    every = F.sequence(F.lit(0), F.lit(threshold))
    indexed = b.select("entry", size.alias("size"), F.explode(F.when(size < 2 * parts, whole).otherwise(F.transform(every, piece))).alias("p")).select("entry", "size", "p.*")

    length = F.length("name")
    sized = a.withColumn("size", F.explode(F.sequence(F.greatest(length - threshold, F.lit(0)), length + threshold)))
    low = sized.where(F.col("size") < 2 * parts).select("name", "size", F.explode(F.sequence(F.lit(-1), F.lit(-salts))).alias("k"), F.lit("").alias("piece"))
    probes = sized.where(F.col("size") >= 2 * parts).withColumn("k", F.explode(every))
    k, more = F.col("k"), length - F.col("size")
    at, wide = cut(F.col("size"), k), cut(F.col("size"), k + 1) - cut(F.col("size"), k)
    first = F.greatest(at + F.greatest(-k, more - (threshold - k)), F.lit(0))
    last = F.least(at + F.least(k, more + (threshold - k)), length - wide)
    probes = probes.withColumns({"first": first, "last": last, "wide": wide}).where("first <= last").withColumn("at", F.explode(F.sequence("first", "last")))
    probes = probes.select("name", "size", "k", F.substring(F.col("name"), F.col("at") + 1, F.col("wide")).alias("piece")).distinct()
    pairs = probes.union(low).join(indexed, ["size", "k", "piece"]).select("name", "entry").distinct()
    return pairs.withColumn("distance", F.levenshtein("name", "entry", threshold)).where("distance >= 0")


def _longest_block(a: Column, b: Column) -> Column:
    """The longest text that stands in both: (i, k, j) is its place in ``a``, its length and its place in ``b``, the earliest of each. One pass over ``a``: a start that can't beat the longest so far gives way to the next."""
    zero = F.struct(F.lit(0).alias("at"), F.lit(0).alias("i"), F.lit(0).alias("k"))

    def step(s: Column, _: Column) -> Column:
        longer = F.substring(a, s["at"] + 1, s["k"] + 1)
        fits = s["at"] + s["k"] < F.length(a)
        grown = F.struct(s["at"].alias("at"), s["at"].alias("i"), (s["k"] + 1).alias("k"))
        moved = F.struct((s["at"] + 1).alias("at"), s["i"].alias("i"), s["k"].alias("k"))
        return F.when(fits & F.contains(b, longer), grown).when(fits, moved).otherwise(s)

    # every step grows the block or moves the start
    return F.aggregate(F.sequence(F.lit(1), F.greatest(F.length(a), F.lit(1))), zero, step)


def matching_signs(a: Column, b: Column) -> Column:
    """Signs in matching blocks: the longest common block, then those left and right of it on both sides, and so on.

    All open ranges of a level are worked on together; each level takes a block of every range that has one."""
    ranges = F.filter(F.array(F.struct(a.alias("a"), b.alias("b"))), lambda r: (F.length(r["a"]) > 0) & (F.length(r["b"]) > 0))
    zero = F.struct(ranges.alias("open"), F.lit(0).alias("n"))

    def cut(r: Column) -> Column:
        block = _longest_block(r["a"], r["b"])
        return F.struct(r["a"].alias("a"), r["b"].alias("b"), block["i"].alias("i"), block["k"].alias("k"))

    def sides(r: Column) -> Column:
        same = F.substring(r["a"], r["i"] + 1, r["k"])
        j = F.instr(r["b"], same) - 1
        rest = lambda text, at: F.substring(text, at + 1, F.length(text))
        left = F.struct(F.substring(r["a"], F.lit(1), r["i"]).alias("a"), F.substring(r["b"], F.lit(1), j).alias("b"))
        right = F.struct(rest(r["a"], r["i"] + r["k"]).alias("a"), rest(r["b"], j + r["k"]).alias("b"))
        return F.array(left, right)

    def level(s: Column, _: Column) -> Column:
        done = F.filter(F.transform(s["open"], cut), lambda r: r["k"] > 0)
        total = F.aggregate(done, F.lit(0), lambda n, r: n + r["k"])
        left = F.filter(F.flatten(F.transform(done, sides)), lambda r: (F.length(r["a"]) > 0) & (F.length(r["b"]) > 0))
        return F.struct(left.alias("open"), (s["n"] + total).alias("n"))

    levels = F.sequence(F.lit(1), F.greatest(F.least(F.length(a), F.length(b)), F.lit(1)))
    return F.aggregate(levels, zero, level)["n"]


def ratio(a: Column, b: Column) -> Column:
    """Twice the signs in matching blocks over both lengths; 1 for two empty texts, null where one is null."""
    return F.when(F.length(a) + F.length(b) == 0, 1.0).otherwise(2.0 * matching_signs(a, b) / (F.length(a) + F.length(b)))


def title_similarity(title: Column, master: Column) -> Column:
    """Twice the matching blocks over both lengths; 0 where the master names a seniority that the title lacks."""
    lacks = F.lit(False)
    for word in SENIORITY_WORDS:
        lacks = lacks | (word_found(F.lit(word), master) & ~word_found(F.lit(word), title))
    return F.when(lacks, 0.0).otherwise(ratio(master, title))


def _signs(col: Column) -> Column:
    """Signs of a text, each with its number among equal ones, so that sets of them count repeats."""
    every = F.split(col, "")
    return F.transform(every, lambda c, i: F.concat(c, F.size(F.filter(F.slice(every, F.lit(1), i + 1), lambda d: d == c)).cast("string")))


def _similar_pairs(t: DataFrame, m: DataFrame) -> DataFrame:
    """(title, master) that may be similar over 0.7, from an inverted index of signs.

    Then more than 7 of 13 signs of either text match. In one order of signs,
    rare ones first, the first 6 of 13 of both then share a sign. What is left
    over is deleted or inserted, so the edit distance is under 0.3 of both lengths.
    """
    own = m.select(F.col("master").alias("text"), F.explode(_signs(F.col("master"))).alias("sign"))
    often = own.groupBy("sign").agg(F.count("*").alias("often"))

    def early(df: DataFrame, name: str) -> DataFrame:
        rows = df.where(F.length(name) > 0).select(F.col(name).alias("text"), F.explode(_signs(F.col(name))).alias("sign")).join(often, "sign", "left")
        listed = rows.groupBy("text").agg(F.sort_array(F.collect_list(F.struct(F.coalesce("often", F.lit(0)).alias("often"), "sign"))).alias("signs"))
        n = F.size("signs")
        return listed.select(F.col("text").alias(name), F.explode(F.slice("signs", F.lit(1), (n - F.floor(7 * n / 13)).cast("int"))).alias("s")).select(name, "s.sign")

    pairs = early(t, "title").join(early(m, "master"), "sign").select("title", "master").distinct()
    a, b = F.length("title"), F.length("master")
    return pairs.where((13 * a > 7 * b) & (13 * b > 7 * a) & (F.levenshtein("title", "master") < 0.3 * (a + b)))


def _held_pairs(t: DataFrame, m: DataFrame) -> DataFrame:
    """(title, master) of which one holds the other in whole words, from an index of words: what is held has its rarest word in the holder."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"(?U)\w+"), F.lit(0)))
    in_t, in_m = (df.select(c, F.explode(words(F.col(c))).alias("word")) for df, c in ((t, "title"), (m, "master")))

    def of(held: DataFrame, name: str, holder: DataFrame) -> DataFrame:
        often = holder.groupBy("word").agg(F.count("*").alias("often"))
        rarest = held.join(often, "word", "left").groupBy(name).agg(F.min_by("word", F.struct(F.coalesce("often", F.lit(0)), "word")).alias("word"))
        return holder.join(rarest, "word").select("title", "master")

    return of(in_m, "master", in_t).union(of(in_t, "title", in_m)).where(word_found(F.col("title"), F.col("master"))).distinct()


def match_titles(titles: DataFrame, masters: DataFrame) -> DataFrame:
    """(title, master, score) by the cascade, first hit wins, on distinct titles.

    Equal: 1. Most similar master, over 0.7: 0.9. The only master that holds the
    title or is held by it in whole words: 0.8. The nearest by edit distance,
    under 3: 0.7 where it is held too, else 0.6. Else the better of 1 / distance
    for the nearest and, where several are held and it isn't one, 1 / their
    number for the first of these. Equal scores go to the first master by name,
    held ones before the nearest. Each step finds its candidates through an
    index (signs, words, pieces) and passes on what it leaves, so both sides may
    have any size. Null titles and masters drop out, and texts without a word
    are held by none; without masters there are no rows.
    """
    t = titles.select("title").where("title is not null").distinct()
    m = written(masters.select("master").where("master is not null").distinct(), "masters")
    exact = t.join(m, F.col("title") == F.col("master")).withColumn("score", F.lit(1.0))
    left = written(t.join(m, F.col("title") == F.col("master"), "left_anti"), "titles")
    scored = _similar_pairs(left, m).withColumn("similar", title_similarity(F.col("title"), F.col("master"))).where("similar > 0.7")
    similar = written(scored.groupBy("title").agg(F.min_by("master", F.struct(-F.col("similar"), "master")).alias("master")), "similar")
    left = written(left.join(similar, "title", "left_anti"), "titles")
    held = written(_held_pairs(left, m), "held")
    counts = held.groupBy("title").agg(F.count("*").alias("n_held"), F.min("master").alias("h"))
    single = counts.where("n_held = 1").select("title", F.col("h").alias("master"), F.lit(0.8).alias("score"))
    left = written(left.join(single, "title", "left_anti"), "titles")
    near = closest(left.select(F.col("title").alias("name")), m.select(F.col("master").alias("name")), 1)
    near = near.select(F.col("name").alias("title"), F.col("entry").alias("master"), "distance")
    near = near.join(held.withColumn("_held", F.lit(True)), ["title", "master"], "left").join(counts, "title", "left")
    is_held, n = F.col("_held").isNotNull(), F.coalesce("n_held", F.lit(0))
    by_held = (n > 1) & ~is_held & (1 / n >= 1 / F.col("distance"))
    rest = near.select(
        "title", F.when((F.col("distance") >= 3) & by_held, F.col("h")).otherwise(F.col("master")).alias("master"),
        F.when(F.col("distance") < 3, F.when(is_held, 0.7).otherwise(0.6)).when(by_held, 1 / n).otherwise(1 / F.col("distance")).alias("score"),
    )
    return exact.union(similar.withColumn("score", F.lit(0.9))).union(single).union(rest)


def assign_titles(df: DataFrame, masters: DataFrame, abbreviations: DataFrame, name: str, unknown: tuple[str, ...] | list[str] = UNKNOWN_TITLES) -> DataFrame:
    """(raw, title, master, score) of each distinct raw title: its clean form is matched, a master that is an
    abbreviation (short, long) is written out, and the best score of a title's master stays. ``unknown`` clean
    titles are ``other`` with 1. Titles whose clean form has fewer than two characters are left out."""
    titled = df.select(name).distinct().withColumn("title", clean_title(F.col(name))).where("title is not null")
    hits = match_titles(titled, masters).join(abbreviations.select(F.col("short").alias("master"), "long"), "master", "left")
    hits = hits.groupBy("title", F.coalesce("long", "master").alias("master")).agg(F.max("score").alias("score"))
    out = titled.join(hits, "title", "left")
    odd = F.col("title").isin(*unknown)
    return out.select(name, "title", F.when(odd, "other").otherwise(F.col("master")).alias("master"), F.when(odd, 1.0).otherwise(F.col("score")).alias("score")).distinct()


def seniority(masters: DataFrame, keywords: DataFrame, default: str) -> DataFrame:
    """Group of the keyword (keyword, grp) that fits a master title best, over 0.25; else the default. A null master drops out of the match and has the default."""
    hits = match_titles(masters.select(F.col("master").alias("title")), keywords.select(F.col("keyword").alias("master"))).where("score > 0.25")
    grouped = hits.join(keywords.withColumnRenamed("keyword", "master"), "master").groupBy("title").agg(F.max_by("grp", F.struct("score", "grp")).alias("grp"))
    return masters.join(grouped.withColumnRenamed("title", "master"), "master", "left").withColumn("grp", F.coalesce("grp", F.lit(default)))


def match_emails(forms: DataFrame, prospects: DataFrame) -> DataFrame:
    """Of the last day's forms, each (user, e-mail) with its newest time and the prospect id of the e-mail."""
    fold = lambda c: F.lower(F.trim(c))
    newest = forms.agg(F.max("ts").alias("_last"))
    recent = forms.join(F.broadcast(newest), F.col("ts") >= F.col("_last") - F.expr("interval 1 day"))
    seen = recent.groupBy("user_id", fold("email").alias("email")).agg(F.max("ts").alias("ts"))
    return seen.join(prospects.select(fold("email").alias("email"), "prospect_id").distinct(), "email")


def master_titles(words: DataFrame, abbreviations: DataFrame, added: list[str], removed: list[str]) -> DataFrame:
    """Distinct titles of both sources and the added ones, without the removed; a null title drops out."""
    spark = words.sparkSession
    every = words.select("master").union(abbreviations.select(F.col("long").alias("master"))).union(spark.createDataFrame([(x,) for x in added], "master string"))
    return every.where(F.col("master").isNotNull() & ~F.col("master").isin(*removed)).distinct()


def rising_terms(df: DataFrame, k: int = 20) -> DataFrame:
    """The k greatest terms by keyword and region; 5000 and more is a breakout."""
    out = top_n_per(df, ["keyword", "region"], [F.desc("value"), F.asc("term")], k)
    return out.withColumn("growth", F.when(F.col("value") >= 5000, "breakout").otherwise("rising"))
