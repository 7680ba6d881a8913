"""Decontamination and personal data against plain versions."""

import hashlib
import re

import pytest
from compare import duck, rows
from hypothesis import given, settings
from hypothesis import strategies as st

from audiweave.llm import decontaminate as D
from audiweave.llm import pii


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain_hits(docs, items, window=13):
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for k in range(len(w) - n + 1 if w else 0):
            wins.setdefault(tuple(w[k : k + n]), set()).add(i)
    sizes = {len(x) for x in wins}
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if (own := wins.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    found |= {str(x) for x in own if x is not None}
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), sha, len(hit) > 0 and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


def test_op5_equals_sql(spark, sf_dir):
    assert rows(D.op5_decontaminate(spark, sf_dir).toPandas()) == rows(duck(sf_dir, D.ORACLE))


def test_contamination_of_short_long_and_overlapping_windows(spark):
    alpha = [f"w{k}" for k in range(60)]
    items = [(1, " ".join(alpha[:20])), (2, " ".join(alpha[10:25])), (3, "w1 w2 w3"), (4, ""), (5, None), (None, "zz"), (10, "a a a a a a a a a a a a a a a"), (6, "w50")]
    docs = [(1, "x " + " ".join(alpha[:13]) + " y " + " ".join(alpha[8:25])), (2, " ".join(alpha[1:13])), (3, "W1, w2; W3!"), (4, None), (5, ""), (None, "q zz q"), (7, "a " * 40), (7, "a " * 12), (8, " ".join(alpha)), (8, " ".join(alpha))]
    got = D.contamination(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).drop("t")
    assert sorted(map(tuple, got.collect()), key=str) == plain_hits(docs, items)


def test_contamination_edges(spark, edges, empty):
    items = spark.createDataFrame([(1, "a b c", 7)], "item_id long, text string, doc_id int")
    docs = [tuple(r)[:2] for r in edges.collect()]
    assert sorted(map(tuple, D.contamination(edges, items).drop("t").collect()), key=str) == plain_hits(docs, [(1, "a b c")])
    assert D.contamination(empty, items).count() == 0
    assert D.contamination(edges, items.limit(0)).where("contaminated").count() == 0


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            bad = {"ip": lambda h, d: any(int(x) > 255 for x in h.split(".")), "card": lambda h, d: not (13 <= len(d) <= 19 and luhn(d)), "phone": lambda h, d: not 9 <= len(d) <= 15}
            if not bad.get(kind, lambda h, d: False)(m[0], d):
                out.append((kind, m.start(), m.end()))
    return out


def test_op10_base_and_spans(spark, sf_dir):
    got = {r.doc_id: r for r in pii.op10_personal_data(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    for i, t in docs:
        base = plain_spans(t)
        joined = [f"{k}:{s}:{e}" for k, s, e in base]
        assert got[i].base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert [got[i][f"n_{k}"] for k in PATTERNS] == [sum(b[0] == k for b in base) for k in PATTERNS]
        assert set(joined) <= set(got[i].spans.split(",") if got[i].spans else [])


def test_base_spans_on_odd_texts(spark):
    odd = ["a@b c@d.com é@x.org 😀 josé.x@mail.example.org", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.0255", "x" * 20_000 + "@y.com " + "1" * 20_000, "a@b.com_x@y.com a@b.c.d@e.f", "+1 (301) 555-0346 +1+123456789012 4111-1111-1111-1111 4111 1111 1111 1111 2", "1 " * 8_000, None, ""]
    rows_ = pii.proposals(spark.createDataFrame(list(enumerate(odd)), "doc_id long, text string")).collect()
    assert {r.doc_id: [(b.kind, b.s, b.e) for b in r.base] for r in rows_} == {i: plain_spans(t) for i, t in enumerate(odd)}


@settings(max_examples=6, deadline=None)
@given(st.lists(st.text(alphabet="0123456789.@+- ()ab_é", max_size=60), min_size=1, max_size=20))
def test_base_spans_of_any_text(texts):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    rows_ = pii.proposals(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).select("doc_id", "base").collect()
    assert {r.doc_id: [(b.kind, b.s, b.e) for b in r.base] for r in rows_} == {i: plain_spans(t) for i, t in enumerate(texts)}


def test_many_addresses_in_one_text_take_seconds(spark):
    import time

    text = "1.2.3.4 " * 30_000 + "me [at] host [dot] org"
    pii.redact(pii.proposals(spark.createDataFrame([(1, "a")], "doc_id long, text string")).withColumn("spans", pii.F.col("base"))).collect()
    began = time.time()
    found = pii.proposals(spark.createDataFrame([(1, text)], "doc_id long, text string")).select("doc_id", "text", "base", "found", pii.F.col("base").alias("spans"))
    row = pii.redact(found).select("text", pii.F.size("found").alias("n")).collect()[0]
    assert row.text == "[IP] " * 30_000 + "me [at] host [dot] org" and row.n >= 1
    assert time.time() - began < 40


def plain_met(base, more):
    return [any(s < y and x < e for x, y in base) for s, e in sorted(more)]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), max_size=12), st.lists(st.tuples(st.integers(0, 40), st.integers(1, 9)), min_size=1, max_size=12))
def test_meeting_spans_equal_plain_ones(base, more):
    from pyspark.sql import SparkSession

    spark = SparkSession.getActiveSession()
    base, more = ([(s, s + n) for s, n in x] for x in (base, more))
    df = spark.createDataFrame([(base, sorted(more))], "base array<struct<s:int,e:int>>, more array<struct<s:int,e:int>>")
    before, pii.BLOCK = pii.BLOCK, 4
    try:
        assert df.select(pii._met("base", "more").alias("x")).collect()[0].x == plain_met(base, more)
    finally:
        pii.BLOCK = before


@pytest.fixture(scope="module")
def learned(spark):
    """Personal data found in texts of which some are planted in formats that no base rule knows."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    planted = {
        10**9: "write to jane.roe [at] mail [dot] example [dot] org today", 10**9 + 1: "call (415) 555-0134 or 415-555-0134 now", 10**9 + 2: "card 4111.1111.1111.1111 was charged",
        10**9 + 3: "host 10[.]20[.]30[.]40 is down", 10**9 + 4: "jane.roe(at)example.org writes",
    }
    clean = {2 * 10**9: "release 1.22.3 of 2024-05-01, pages 1990-1995", 2 * 10**9 + 1: "order 4111.1111.1111.1112 meet me at example.org", 2 * 10**9 + 2: "the-quick-brown-fox-jumps-2024 over a/lazy/dog_and_more_01"}
    rows_ = spark.createDataFrame([*planted.items(), *clean.items()], "doc_id long, text string")
    return pii.find_personal_data(docs.union(rows_)).where("doc_id >= 1000000000").collect(), planted, clean


def test_the_method_adds_spans_of_formats_that_base_rules_miss(learned):
    got = {r.doc_id: r for r in learned[0]}
    for i, text in learned[1].items():
        assert not got[i].base and got[i].spans, text
    for i, text in learned[2].items():
        assert not got[i].spans, (text, got[i].spans)


def test_held_out_recall_and_precision(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    for r in pii.measured(docs).where("kind <> 'secret'").collect():
        assert r.n_right >= 0.9 * r.n_good > 0 and r.n_right >= 0.9 * r.n_taken


def test_redaction_and_edges(spark, edges, empty):
    df = spark.createDataFrame([(1, "to a@b.org, +1 (301) 555-0346."), (2, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in pii.redact(pii.find_personal_data(df)).collect()}
    assert got == {1: "to [EMAIL], [PHONE].", 2: None}
    assert pii.find_personal_data(edges).count() == edges.count()
    assert pii.find_personal_data(empty).count() == 0
