"""Column functions that clean strings, dates and numbers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Substring lists that group referrers, tested in this order.
SOCIAL = ("facebook", "linkedin", "twitter", "t.co/", "youtube", "instagram", "reddit", "pinterest")
SEARCH = ("ask", "baidu", "bing", "duckduckgo", "google", "yahoo", "yandex")
MAIL = ("Pardot", "pardot")
#: Agent substrings and their groups; the first that is held wins, in the given case.
SYSTEMS = (
    ("Linux", "linux"), ("Android", "android"), ("Windows NT 10.0", "windows10"), ("Windows", "windows_older"), ("iPhone", "iphone"), ("Macintosh", "macintosh"), ("AppleWebKit", "apple_other"),
)
#: Hours added to UTC by continent, and zones by continent.
OFFSETS = {"North America": -6, "South America": -3, "Europe": 1, "Africa": 1, "Asia": 5}
ZONES = {"North America": "US/Central", "South America": "Brazil/West", "Europe": "Europe/Berlin", "Africa": "Europe/Berlin", "Asia": "Asia/Karachi"}
#: Job titles that a clean one is replaced by.
TITLES = {"professional and technical staff eg lawyer engineer architect": "professional"}
#: Names that hold personal data in contact tables.
PERSONAL = ("salutation", "first_name", "last_name", "email", "phone", "address", "c_name")
#: The library's own list of legal forms at the end of company names, without dots.
LEGAL_FORMS = (
    "ab", "ag", "aps", "as", "asa", "bhd", "bv", "bvba", "co", "company", "corp", "corporation", "dd", "doo", "eood", "gmbh", "inc", "incorporated", "jsc", "kft", "kg", "kk", "lda", "limited",
    "llc", "llp", "lp", "ltd", "ltda", "nv", "oao", "ohg", "ood", "ooo", "oy", "oyj", "pjsc", "plc", "pte", "pty", "pvt", "sa", "sarl", "sas", "sdn", "se", "sl", "slu", "spa", "sro", "srl", "ug", "zao", "zrt",
)


def clean_name(name: str) -> str:
    """Column name in lower case with ``_`` for ``/``, ``-`` and space, other signs gone, ``_`` before a leading digit."""
    out = re.sub(r"[^0-9a-z_]", "", re.sub(r"[/\- ]", "_", name.strip().lower()))
    return f"_{out}" if out[:1].isdigit() else out


def clean_columns(df: DataFrame) -> DataFrame:
    """Cleaned names of all columns; the rows stay."""
    return df.toDF(*map(clean_name, df.columns))


def drop_personal(df: DataFrame, names=PERSONAL) -> DataFrame:
    """Columns of personal data go; absent ones don't matter."""
    return df.drop(*names)


def coerce_numeric(df: DataFrame, names: list[str]) -> DataFrame:
    """A string column becomes double if every value that isn't null parses."""
    tests = df.agg(*(F.bool_and(F.col(c).isNull() | F.col(c).try_cast("double").isNotNull()).alias(c) for c in names)).first()
    return df.withColumns({c: F.col(c).try_cast("double") for c in names if tests[c]})


def parse_utc(col: Column, fmt: str) -> Column:
    """C4: a timestamp, or null where the text doesn't parse."""
    return F.try_to_timestamp(col, F.lit(fmt))


def null_sentinels(col: Column, values=("NA", "-", "0001-01-01T00:00:00")) -> Column:
    """Null in place of the given values; null stays."""
    return F.when(~col.isin(*values), col)


def pct_to_ratio(col: Column) -> Column:
    """``12.5%`` becomes 0.125."""
    return F.rtrim(col, F.lit("%")).try_cast("double") / 100


def pct_columns_to_ratio(df: DataFrame) -> DataFrame:
    """C6 over all columns whose names end in rate or ratio."""
    return df.withColumns({c: pct_to_ratio(F.col(c)) for c in df.columns if c.endswith(("rate", "ratio"))})


def to_bool(col: Column) -> Column:
    """Only ``true`` and ``false`` have a value."""
    return F.when(col == "true", True).when(col == "false", False)


def strip_thousands(col: Column) -> Column:
    """A number without its commas; null where it isn't one."""
    return F.regexp_replace(col, ",", "").try_cast("double")


def blank_to_null(col: Column) -> Column:
    """Blank and ``None`` become null, the rest a float."""
    return F.when(~F.trim(col).isin("", "None"), col).try_cast("float")


def html_to_text(col: Column) -> Column:
    """Tags go, common entities are decoded, white space is joined."""
    out = F.regexp_replace(col, r"(?is)<(script|style)[^>]*>.*?</\1>", " ")
    out = F.regexp_replace(out, "<[^>]+>", " ")
    for entity, sign in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        out = F.replace(out, F.lit(entity), F.lit(sign))
    return F.trim(F.regexp_replace(out, r"[ \t\n\r]+", " "))


def strip_nul(col: Column) -> Column:
    """C11: spaces in place of NUL characters; null stays."""
    return F.translate(col, "\0", " ")


def digits_id(col: Column) -> Column:
    """The digits of an id; 0 where there are none."""
    return F.coalesce(F.regexp_replace(col, "[^0-9]", "").try_cast("long"), F.lit(0).cast("long"))


def drop_prefixed(df: DataFrame, name: str, prefixes: tuple[str, ...]) -> DataFrame:
    """Rows whose text starts with a prefix go; null stays."""
    bad = F.lit(False)
    for p in prefixes:
        bad = bad | F.startswith(F.col(name), F.lit(p))
    return df.where(~F.coalesce(bad, F.lit(False)))


def url_param(col: Column, key: str) -> Column:
    """C14: value of a query parameter, null where absent."""
    return F.nullif(F.regexp_extract(col, rf"[?&]{re.escape(key)}=([^&#]*)", 1), F.lit(""))


def code_table(df: DataFrame, code: str, title: str) -> DataFrame:
    """Brackets of titles go, the code ``all`` is dropped, codes become integers."""
    return df.where(F.col(code) != "all").select(F.col(code).cast("int").alias(code), F.translate(F.col(title), "()", "").alias(title))


def fold_site(col: Column, mapping: dict[str, str] | None = None) -> Column:
    """Mapped name if there is one, else the name without ``www.``."""
    out = F.regexp_replace(col, r"^www\.", "")
    for name, to in (mapping or {}).items():
        out = F.when(col == name, to).otherwise(out)
    return out


def real_traffic(ev: DataFrame, sites: list[str] | None = None) -> DataFrame:
    """C17: no bots or preview agents, web or amp clients, listed sites."""
    agent = F.lower("agent")
    out = ev.where(~agent.like("%bot%") & ~agent.like("%preview%") & F.col("client").isin("web", "amp"))
    return out.where(F.col("site").isin(*sites)) if sites else out


def articles_only(ev: DataFrame, titles: DataFrame) -> DataFrame:
    """Views of titles that aren't in a list."""
    return ev.join(titles, "title", "left_anti")


def or_unknown(df: DataFrame, names: list[str]) -> DataFrame:
    """Null or empty becomes ``Unknown``, in arrays one such entry."""
    out = {}
    for c in names:
        if isinstance(df.schema[c].dataType, T.ArrayType):
            out[c] = F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit("Unknown")))
        else:
            out[c] = F.coalesce(F.nullif(F.col(c), F.lit("")), F.lit("Unknown"))
    return df.withColumns(out)


def slug(col: Column) -> Column:
    """C20: lower case, other than letters and digits as single ``_``."""
    return F.regexp_replace(F.lower(col), "[^a-z0-9]+", "_")


def pretty(col: Column) -> Column:
    """C20: a slug for display."""
    return F.initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def coalesce_id(own: Column, match: Column) -> Column:
    """An id that is null or ``0`` takes the matched one."""
    return F.coalesce(F.nullif(own, F.lit("0")), match)


def _holds_any(col: Column, parts: tuple[str, ...]) -> Column:
    return col.rlike("|".join(re.escape(p) for p in parts))


def referrer_group(col: Column, site: Column, network: tuple[str, ...] = ("example.net",)) -> Column:
    """Social, search, network, own site, email or other; null is typed."""
    return (
        F.when(col.isNull() | (col == ""), "typed").when(_holds_any(col, SOCIAL), "social").when(_holds_any(col, SEARCH), "search")
        .when(_holds_any(col, network), "network").when(F.contains(col, site), "own").when(_holds_any(col, MAIL), "email").otherwise("other")
    )


def os_group(col: Column) -> Column:
    """The first system whose mark the agent holds, else other_os; a null or empty agent is other_os."""
    out = F.lit("other_os")
    for mark, name in reversed(SYSTEMS):
        out = F.when(F.contains(col, F.lit(mark)), name).otherwise(out)
    return out


def local_hour_offset(hour: Column, continent: Column, wrap: bool = False) -> Column:
    """Below 0 a day is added and 24 is 0; hours past 24 stay unless ``wrap``. Other continents and null keep the hour."""
    out = F.lit(None).cast("int")
    for name, offset in OFFSETS.items():
        out = F.when(continent == name, hour + offset).otherwise(out)
    out = F.coalesce(out, hour)
    return F.pmod(out, F.lit(24)) if wrap else F.when(out < 0, out + 24).when(out == 24, 0).otherwise(out)


def local_hour_zone(ts: Column, continent: Column) -> Column:
    """Hour in the continent's zone, UTC where there is none."""
    zone = F.lit("UTC")
    for name, own in ZONES.items():
        zone = F.when(continent == name, own).otherwise(zone)
    return F.hour(F.from_utc_timestamp(ts, zone))


def split_indicator(col: Column) -> Column:
    """Struct of short, kind and code: cut at the first `` in ``, else the first ``:``, else whole."""
    by_in, by_colon = F.instr(col, " in "), F.instr(col, ":")
    short = F.when(by_in > 0, F.substring(col, F.lit(1), by_in - 1)).when(by_colon > 0, F.substring(col, F.lit(1), by_colon - 1)).otherwise(col)
    kind = F.when(by_in > 0, F.substring(col, by_in + 4, F.length(col))).when(by_colon > 0, F.substring(col, by_colon + 1, F.length(col))).otherwise("")
    return F.struct(F.trim(short).alias("short"), F.trim(kind).alias("kind"), F.substring(F.sha2(col, 256), 1, 8).alias("code"))


def big_number(col: Column) -> Column:
    """Grouped below a million, else million, bn or trn with one decimal."""
    scaled = lambda by: F.format_number(col / by, 1)
    return (
        F.when(F.abs(col) < 1e6, F.format_number(col, 0)).when(F.abs(col) < 1e9, F.concat(scaled(1e6), F.lit(" million")))
        .when(F.abs(col) < 1e12, F.concat(scaled(1e9), F.lit("bn"))).otherwise(F.concat(scaled(1e12), F.lit("trn")))
    )


def ordinal(col: Column) -> Column:
    """Words for 1 to 10, else the number with its ending."""
    words = ("first", "second", "third", "fourth", "fifth", "sixth", "seventh", "eighth", "ninth", "tenth")
    teens, unit = (col % 100).between(11, 13), col % 10
    ending = F.when(teens, "th").when(unit == 1, "st").when(unit == 2, "nd").when(unit == 3, "rd").otherwise("th")
    return F.when(col.between(1, 10), F.element_at(F.array(*map(F.lit, words)), F.greatest(F.least(col, F.lit(10)), F.lit(1)).cast("int"))).otherwise(F.concat(col.cast("string"), ending))


def unit_text(value: Column, name: Column) -> Column:
    """``%`` after rates and proportions, ``$`` before US dollars."""
    low = F.lower(name)
    return F.when(low.rlike("proportion|rate|%"), F.concat(value, F.lit("%"))).when(low.rlike("usd|us\\$"), F.concat(F.lit("$"), value)).otherwise(value)


def join_list(col: Column) -> Column:
    """Entries joined by a comma and a space, without null ones; a null list is empty."""
    return F.concat_ws(", ", col)


def form_emails(ev: DataFrame, value: str, blocked: DataFrame) -> DataFrame:
    """Form values with an at sign that aren't blocked, in lower case."""
    own = F.lower(F.trim(F.col(value)))
    return ev.where(F.contains(F.col(value), F.lit("@"))).withColumn(value, own).join(blocked, value, "left_anti")


def polish(col: Column, fact_year: Column, year: Column) -> Column:
    """Sentence capitals, en dash between numbers, ``$1 million`` as ``$1m``, past tense for past years."""
    out = F.regexp_replace(col, r"(\d)-(\d)", "$1–$2")
    out = F.regexp_replace(out, r"(\$[\d.,]+) million\b", "$1m")
    past = F.regexp_replace(F.regexp_replace(out, r"\bis\b", "was"), r"\bare\b", "were")
    out = F.when(fact_year < year, past).otherwise(out)
    parts = F.transform(F.split(out, r"\. "), lambda s: F.concat(F.upper(F.substring(s, 1, 1)), F.substring(s, 2, 1 << 20)))
    return F.array_join(parts, ". ")


def site_section(col: Column) -> Column:
    """The fourth part of a URL, else ``none``."""
    return F.coalesce(F.nullif(F.get(F.split(col, "/"), F.lit(3)), F.lit("")), F.lit("none"))


def clean_company(col: Column) -> Column:
    """L1: lower case, ``&`` as and, no ``group``, legal forms (with or without dots, several in a row) or punctuation.

    A name that is nothing but a legal form stays; null stays null."""
    out = F.replace(F.lower(col), F.lit("&"), F.lit(" and "))
    out = F.regexp_replace(out, r"\bgroup\b", "")
    forms = "|".join(r"\.?".join(f) for f in sorted(LEGAL_FORMS, key=len, reverse=True))
    out = F.regexp_replace(F.trim(out), rf"(?<=[^ ,])(?:[ ,]+(?:{forms})\.?)+$", "")
    return F.trim(F.regexp_replace(F.regexp_replace(out, r"\p{Punct}+", ""), r"\s+", " "))


def clean_title(col: Column, stop: tuple[str, ...] = (), mapped: dict[str, str] = TITLES) -> Column:
    """L4: lower case, dots gone, hyphens as spaces, then letters and white space only; ``stop`` words go where given.

    A title of fewer than two characters is null; one that ``mapped`` names is replaced. Null stays null."""
    out = F.replace(F.replace(F.lower(col), F.lit("."), F.lit("")), F.lit("-"), F.lit(" "))
    out = F.regexp_replace(F.regexp_replace(out, r"[^A-Za-z\s]+", ""), r"^\s+|\s+$", "")
    if stop:
        out = F.array_join(F.filter(F.split(out, r"\s+"), lambda w: ~w.isin(*stop)), " ")
    for title, name in mapped.items():
        out = F.when(out == title, name).otherwise(out)
    return F.when(F.length(out) >= 2, out)


def _stands_in(a: Column, b: Column) -> Column:
    quoted = F.concat(F.lit(r"(?U)\b\Q"), F.replace(a, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E\b"))
    return F.contains(b, a) & F.rlike(b, quoted)


def word_found(a: Column, b: Column) -> Column:
    """One text stands in the other, word boundaries at both of its ends. Null where one is null."""
    return _stands_in(a, b) | _stands_in(b, a)
