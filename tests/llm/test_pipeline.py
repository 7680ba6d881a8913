"""The pipeline's rows, worked out stage by stage in plain Python."""

import collections

import numpy as np
import pyarrow as pa
import pytest
from test_native import plain_hits, plain_spans
from test_pairs_and_packing import hold, plain_join, plain_pieces

import corpus_pipeline as C
from audiweave.llm import pii, quality


def plain_quality(spark, docs, sf_dir):
    table, network = quality.learn(docs, quality.learned_marks(spark, sf_dir))
    return [r for r in docs.collect() if network.score(quality.pooled(pa.array([r.text], pa.string()), table))[0] >= 0.3]


def plain_groups(rows):
    got = {i: c for i, _, c, _ in plain_join([(r.doc_id, r.text) for r in rows], 5, 80)}
    return [r for r in rows if got[r.doc_id] == r.doc_id]


def plain_redaction(text, spans):
    out, at = [], 0
    for s, e, kind in sorted(spans):
        if s >= at:
            out += [text[at:s], f"[{kind.upper()}]"]
        at = max(at, e)
    return "".join(out) + text[at:]


def test_rows_of_the_pipeline_equal_plain_ones(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = plain_quality(spark, docs, sf_dir)
    assert 0 < len(kept) < docs.count()
    kept = plain_groups(kept)
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    dirty = {h[0] for h in plain_hits([(r.doc_id, r.text) for r in kept], items) if h[-1]}
    kept = [r for r in kept if r.doc_id not in dirty]
    assert dirty
    found = pii.find_personal_data(spark.createDataFrame(kept, docs.schema)).collect()
    texts = {}
    for r in found:
        spans = {(c.s, c.e, c.kind) for c in r.spans}
        assert {(s, e, k) for k, s, e in plain_spans(r.text)} <= spans
        texts[r.doc_id] = plain_redaction(r.text, spans) if r.text is not None else None
    packed = C.run(spark, sf_dir).toPandas()
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, packed[names].values.tolist()), key=str) == plain_pieces(list(texts.items()))
    hold(packed)


@pytest.mark.parametrize("extra", [[], ["score", "_score", "base", "spans", "h", "tile"]])
def test_stages_on_repeated_null_and_clashing_rows(spark, sf_dir, extra):
    long = " ".join(f"word{k} is here" for k in range(60))
    rows = [(5, long), (5, long), (None, long + " x"), (None, "some other text of six words"), (None, "some other text of six words"), (7, None), (7, None), (8, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), *("z" for _ in extra)) for i, t in rows], ", ".join(["doc_id long, text string, lang string, source string, n_chars long", *(f"`{x}` string" for x in extra)]))
    got = collections.Counter((r.doc_id, r.text) for r in C.near_duplicates(spark, docs, sf_dir).collect())
    assert got == collections.Counter([(5, long), (None, "some other text of six words"), (7, None), (8, "")])
    for _, stage in C.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns and out.count() <= len(rows)
    assert np.isclose(C.packing(spark, docs, sf_dir).count(), len(rows), atol=4)
