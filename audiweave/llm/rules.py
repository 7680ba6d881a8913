"""Quality rules: exact text counts, and compression bands.

The zstandard ratio of a whole text must lie in a band that depends on its
length: repeated text compresses below the band, keys, hashes and encoded data
stay above it. Bands of half an octave of bytes are fitted on labelled rows that
pass the base rules: each leaves out ``LOSS`` of its good texts at most, at
either end. Where a band has few labels, fixed wide limits hold. Windows of
``CHUNK`` bytes, the last one at the end of the text, are held against fixed
limits, so a long text can't hide a stretch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import keep
from audiweave.llm.textbytes import Words, chunks

#: (bytes below which it holds, least and greatest ratio of the whole text) where nothing is fitted. Prose lies at 0.55 to 0.75 under 1 kB and near 0.4 over 16 kB.
BANDS = ((128, 0.30, 9.0), (256, 0.35, 1.2), (1 << 10, 0.32, 0.88), (1 << 12, 0.28, 0.80), (1 << 14, 0.24, 0.74), (1 << 16, 0.20, 0.72), (1 << 62, 0.15, 0.72))
CHUNK, CHUNK_BAND, CHUNK_SHARE = 1 << 10, (0.25, 0.80), 0.2
#: Bands of half an octave, share of good texts that a limit leaves out, good labels that a band needs, and slack of a limit.
N_BANDS, LOSS, LABELLED, SLACK = 128, 0.005, 50, 0.002
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True


def counts(column: pa.Array) -> dict[str, np.ndarray]:
    """The base counts of each text; see ``quality_rules``."""
    words = Words(column)
    n, raw, off = len(column), words.raw, words.off
    heads = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    word_chars = np.zeros(n, np.int64)
    np.add.at(word_chars, words.doc, heads[words.end] - heads[words.start])
    symbols = np.concatenate([[0], np.cumsum(SYMBOLS[raw])])

    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate([off[:-1], breaks + 1]))
    # a line that starts where its text ends belongs to no text here, and has no word
    doc = np.searchsorted(off, start, side="right") - 1
    nexts = np.concatenate([start[1:], [len(raw)]])
    end = np.minimum(nexts, off[np.minimum(doc + 1, n)])
    end = np.where((end > start) & (raw[np.maximum(end - 1, 0)] == 10 if len(raw) else False), end - 1, end)
    has_word = np.searchsorted(words.start, end) > np.searchsorted(words.start, start)
    line_doc, line_hash = doc[has_word], words.span_hash(start[has_word], end[has_word])
    order = np.lexsort((line_hash, line_doc))
    again = (line_doc[order][1:] == line_doc[order][:-1]) & (line_hash[order][1:] == line_hash[order][:-1])
    dup_lines = np.bincount(line_doc[order][1:][again], minlength=n)

    at = np.flatnonzero(words.doc[: max(0, len(words.doc) - 4)] == words.doc[4:])
    gram_doc, gram = words.grams(5)
    order = np.lexsort((gram, gram_doc))
    same = (gram_doc[order][1:] == gram_doc[order][:-1]) & (gram[order][1:] == gram[order][:-1])
    repeated = np.zeros(len(gram), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    cover = np.zeros(len(words.doc) + 1, np.int64)
    np.add.at(cover, at[repeated], 1)
    np.add.at(cover, at[repeated] + 5, -1)
    inside = np.cumsum(cover[:-1]) > 0
    return {
        "n_words": words.count.astype(np.int64),
        "word_chars": word_chars,
        "n_symbols": symbols[off[1:]] - symbols[off[:-1]],
        "n_dup_lines": dup_lines.astype(np.int64),
        "n_repeat_words": np.bincount(words.doc[inside], minlength=n).astype(np.int64),
    }


def compression(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole ratio of each text (1 where empty), and the share of its windows
    outside the chunk band. Windows of ``CHUNK`` bytes follow each other, and one
    more ends with the text; a text that is shorter has none but the whole."""
    import zstandard

    squeeze = zstandard.ZstdCompressor(level=3).compress
    whole, odd = np.ones(len(off) - 1), np.zeros(len(off) - 1)
    for k in range(len(off) - 1):
        text = raw[off[k] : off[k + 1]].tobytes()
        if text:
            whole[k] = len(squeeze(text)) / len(text)
            starts = [*range(0, len(text) - CHUNK + 1, CHUNK)]
            starts += [len(text) - CHUNK] if starts and len(text) % CHUNK else []
            ratios = np.array([len(squeeze(text[i : i + CHUNK])) / CHUNK for i in starts])
            if len(ratios):
                odd[k] = np.mean((ratios < CHUNK_BAND[0]) | (ratios > CHUNK_BAND[1]))
    return whole, odd


def band_of(size: np.ndarray) -> np.ndarray:
    """Number of the half octave of a length in bytes."""
    return np.floor(2 * np.log2(np.maximum(size, 1))).astype(np.int64)


def wide_limits() -> np.ndarray:
    """(least, greatest) ratio by band where nothing is fitted."""
    start = np.exp2(np.arange(N_BANDS) / 2)
    at = np.minimum(np.searchsorted(np.array([float(b) for b, _, _ in BANDS]), start, side="right"), len(BANDS) - 1)
    return np.array([[BANDS[k][1], BANDS[k][2]] for k in at])


def base_fails(made: dict[str, np.ndarray]) -> np.ndarray:
    return (made["n_words"] < 10) | (100 * made["n_repeat_words"] > 20 * made["n_words"])


def _measure_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in chunks(batch, "text"):
            column = part.column("text")
            made = counts(column)
            words = Words(column)
            whole, odd = compression(words.raw, words.off)
            band = np.minimum(band_of(np.diff(words.off)), N_BANDS - 1)
            yield pa.record_batch(
                [part.column("doc_id"), *(pa.array(x) for x in made.values()), pa.array(base_fails(made)), pa.array(whole), pa.array(odd), pa.array(band)],
                names=["doc_id", *made, "base_failed", "zstd_ratio", "odd_chunks", "band"],
            )


def measures(docs: DataFrame) -> DataFrame:
    """Counts, ratios and length band of every text: all that limits and verdicts need, in one pass over the texts."""
    kinds = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, zstd_ratio double, odd_chunks double, band long"
    return docs.select("doc_id", "text").mapInArrow(_measure_rows, kinds)


def fit_limits(measured: DataFrame, marks: DataFrame) -> np.ndarray:
    """Limits by band from all rows of ``measures`` that pass the base rules and have a label in ``marks`` (doc_id, label 0 or 1).

    Only counts by band, thousandth of the ratio and label reach the driver. A
    limit is moved in from its wide place only where that rejects bad texts."""
    passed = measured.where("not base_failed").select("doc_id", "band", F.rint(1000 * F.col("zstd_ratio")).cast("long").alias("ratio"))
    labelled = passed.join(marks.where("label is not null").select("doc_id", F.col("label").cast("int").alias("label")), "doc_id")
    rows = labelled.groupBy("band", "ratio", "label").agg(F.count("*").alias("n")).collect()
    limits = wide_limits()
    for band in sorted({r["band"] for r in rows}):
        good, bad = (np.sort(np.repeat([r["ratio"] / 1000 for r in rows if r["band"] == band and r["label"] == k], [r["n"] for r in rows if r["band"] == band and r["label"] == k])) for k in (1, 0))
        if len(good) >= LABELLED and band < N_BANDS:
            out = int(LOSS * len(good))
            low, high = good[out] - SLACK, good[len(good) - 1 - out] + SLACK
            if (bad < low).any():
                limits[band, 0] = max(limits[band, 0], low)
            if (bad > high).any():
                limits[band, 1] = min(limits[band, 1], high)
    return limits


def verdicts(measured: DataFrame, limits: np.ndarray | None = None) -> DataFrame:
    """``measures`` with ``kept``, by limits of ``fit_limits``, else wide ones."""
    low, high = (wide_limits() if limits is None else limits).T
    at = lambda x: F.get(F.array(*(F.lit(float(v)) for v in x)), F.col("band").cast("int"))
    inside = (F.col("zstd_ratio") >= at(low)) & (F.col("zstd_ratio") <= at(high)) & (F.col("odd_chunks") <= CHUNK_SHARE)
    return measured.select(*_COUNTS, "base_failed", (~F.col("base_failed") & inside).alias("kept"), "zstd_ratio", "odd_chunks")


_COUNTS = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def quality_rules(docs: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """Counts and verdict per row of ``docs`` (doc_id, text; others ignored).

    n_words; word_chars (code points in words); n_symbols; n_dup_lines (lines
    with a word that equal an earlier line of the text); n_repeat_words (words
    in 5-word windows that the text has twice or more); base_failed (fewer than
    10 words, or over a fifth of them repeated); kept; zstd_ratio; odd_chunks.
    A null text counts as empty: all counts 0, base_failed, not kept. Limits are
    fitted on ``marks`` (doc_id, label), where given, else wide; texts are read
    and compressed once.
    """
    if marks is None:
        return verdicts(measures(docs))
    measured = keep(measures(docs), "measures")
    return verdicts(measured, fit_limits(measured, marks))


def op7_quality_rules(spark, sf_dir: str) -> DataFrame:
    docs, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(5)) == 0
    marks = labels.where(~held_out).groupBy("doc_id").agg(F.max("quality").alias("label"))
    return quality_rules(docs, marks)
