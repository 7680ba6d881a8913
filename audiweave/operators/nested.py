"""Nested payloads as flat child tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from audiweave.functions.text import digits_id, html_to_text, strip_nul


def explode_records(df: DataFrame, name: str, keep: list[str]) -> DataFrame:
    """Records of a list with the kept columns; null and empty lists give no row."""
    return df.select(*keep, F.explode(name).alias("_r")).select(*keep, "_r.*")


def explode_series(df: DataFrame, name: str) -> DataFrame:
    """One row per entry of a yearly series."""
    return df.select(F.inline(name))


def child_table(df: DataFrame, parent: str, name: str, alias: str = "") -> DataFrame:
    """A child list with its parent's id; ``alias`` goes before the names of its fields."""
    out = explode_records(df, name, [parent])
    return out.toDF(parent, *(f"{alias}{c}" for c in out.columns[1:]))


def child_tables(df: DataFrame, parent: str, names: list[str]) -> dict[str, DataFrame]:
    """The child table of each named list; parents with a null or empty list have no row."""
    return {c: child_table(df, parent, c) for c in names}


def answers(df: DataFrame, name: str, keys: list[str]) -> DataFrame:
    """A map of question id to answer struct as rows."""
    return df.select(*keys, F.explode(name).alias("question_key", "_a")).select(*keys, "question_key", "_a.*")


def unpack_options(df: DataFrame) -> DataFrame:
    """An option's id and text where there are options, else the row's own."""
    out = df.select("*", F.explode_outer(F.map_values("options")).alias("_o"))
    return out.withColumns({"answer_id": F.coalesce("_o.id", "answer_id"), "answer": F.coalesce("_o.answer", "answer")}).drop("_o", "options")


def unpack_subquestions(df: DataFrame) -> DataFrame:
    """Rows of sub-questions (a map of key to struct); numeric keys only, null entries dropped."""
    out = df.select(*(c for c in df.columns if c != "subquestions"), F.explode("subquestions").alias("sub_key", "_s"))
    return out.where(F.col("sub_key").rlike("^[0-9]+$") & F.col("_s").isNotNull()).select(*(c for c in out.columns if c != "_s"), F.col("_s.question").alias("sub_question"), F.col("_s.answer").alias("sub_answer"))


def unpack_textboxes(df: DataFrame, keys: list[str]) -> DataFrame:
    """Answers of multi-textbox questions, whose columns are named by digits and hold a struct each.

    Only rows without a type are of that kind. A column that isn't null gives a
    row with ``keys`` and the fields of its struct, ``id`` as ``option_id``;
    fields that one of the structs lacks are null. Without such columns the
    result is empty and has the keys alone.
    """
    boxes = [f for f in df.schema if f.name.isdigit()]
    if not boxes:
        return df.where(F.lit(False)).select(*keys)
    kinds = {x.name: x.dataType for f in boxes for x in f.dataType}
    held = {f.name: set(f.dataType.names) for f in boxes}
    alike = lambda c: F.struct(*((F.col(f"`{c}`.`{x}`") if x in held[c] else F.lit(None)).cast(k).alias("option_id" if x == "id" else x) for x, k in kinds.items()))
    each = F.array(*(F.when(F.col(f"`{f.name}`").isNotNull(), alike(f.name)) for f in boxes))
    rows = df.where("type is null").select(*keys, F.explode(F.filter(each, lambda x: x.isNotNull())).alias("_b"))
    return rows.select(*keys, "_b.*")


def simple_answers(df: DataFrame) -> DataFrame:
    """Answers without sub-questions, as clean text with a numeric id."""
    out = df.where("subquestions is null").drop("subquestions", "options")
    return out.withColumns({"question": html_to_text(F.col("question")), "answer": strip_nul(F.col("answer")), "answer_id": digits_id(F.col("answer_id"))})


def breakdown(df: DataFrame, name: str = "breakdown") -> DataFrame:
    """A row for each entry of the list, beside the other columns; null and empty lists have none."""
    return explode_records(df, name, [c for c in df.columns if c != name])


def subquestion_ids(col: Column, kind: T.DataType) -> Column:
    """Ids of a list, or keys of a map, comma-joined."""
    if isinstance(kind, T.MapType):
        return F.array_join(F.array_sort(F.map_keys(col)), ",")
    return F.array_join(F.transform(col, lambda x: x.cast("string")), ",")


def unnest_views(df: DataFrame, single: str, several: str) -> DataFrame:
    """One row per page view, whether a visit has one struct or a list; visits without any keep a row."""
    views = F.when(F.col(several).isNotNull(), F.col(several)).when(F.col(single).isNotNull(), F.array(single))
    rest = [c for c in df.columns if c not in (single, several)]
    return df.select(*rest, F.explode_outer(views).alias("_v")).select(*rest, "_v.*")


def form_fields(ev: DataFrame, name: str, pattern: str) -> DataFrame:
    """Form fields whose name is like a pattern and whose value isn't a test."""
    out = explode_records(ev, name, [c for c in ev.columns if c != name])
    return out.where(F.upper("name").like(pattern) & ~F.lower("value").like("%test%"))


def parse_pseudo_json(df: DataFrame, name: str, schema: str) -> DataFrame:
    """Rows of a list written with single quotes and stray no-break spaces."""
    text = F.translate(F.replace(F.col(name), F.lit("\\xa0"), F.lit(" ")), " ", " ")
    rows = F.from_json(text, f"array<struct<{schema}>>", {"allowSingleQuotes": "true"})
    return df.select(*(c for c in df.columns if c != name), F.inline(rows))


def flatten(df: DataFrame, sep: str = "_") -> DataFrame:
    """Fields of nested structs as columns; of maps, empty keys go."""

    def leaves(schema: T.StructType, path: str, name: str) -> list[Column]:
        out = []
        for f in schema:
            at, own = f"{path}`{f.name}`", f"{name}{f.name}"
            if isinstance(f.dataType, T.StructType):
                out += leaves(f.dataType, f"{at}.", f"{own}{sep}")
            elif isinstance(f.dataType, T.MapType):
                out.append(F.map_filter(at, lambda k, _: k != "").alias(own))
            else:
                out.append(F.col(at).alias(own))
        return out

    return df.select(*leaves(df.schema, "", ""))


def contact_rows(df: DataFrame, key: str, question: str, answer: str, questions: list[str], fallback: Column | None = None) -> DataFrame:
    """One row per response, one column per question; a missing country takes the detected one."""
    out = df.groupBy(key).pivot(question, questions).agg(F.min(answer))
    return out.withColumn("country", F.coalesce("country", fallback)) if fallback is not None and "country" in out.columns else out


def subscription_ids(ticked: DataFrame, lists: DataFrame, key: str, answer: str, always: list[int]) -> DataFrame:
    """List ids of the patterns that ticked answers hold, and the fixed ones; ``lists`` is a small rule table (list_id, pattern)."""
    hit = ticked.join(F.broadcast(lists), F.contains(F.lower(answer), F.lower("pattern")))
    ids = hit.groupBy(key).agg(F.collect_set("list_id").alias("_ids"))
    every = ticked.select(key).distinct().join(ids, key, "left")
    fixed = F.array(*(F.lit(x) for x in always)).cast("array<int>")
    return every.select(key, F.array_sort(F.array_union(fixed, F.coalesce("_ids", F.array().cast("array<int>")))).alias("list_ids"))


def plan_contacts(contacts: DataFrame, prospects: DataFrame, email: str, key: str) -> DataFrame:
    """``update`` with the matched id, or ``create``."""
    folded = lambda df: F.lower(F.trim(df[email]))
    known = prospects.select(folded(prospects).alias("_e"), F.col(key)).groupBy("_e").agg(F.min(key).alias(key))
    out = contacts.withColumn("_e", folded(contacts)).join(known, "_e", "left").drop("_e")
    return out.withColumn("action", F.when(F.col(key).isNull(), "create").otherwise("update"))
