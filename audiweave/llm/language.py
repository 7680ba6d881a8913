"""Language of words and texts by a linear-chain conditional random field.

A word's features are its lexicon entry (the whole word), affixes of one to
four bytes and all its byte trigrams, hashed into one weight table. The field is
fitted by exact gradients on a bounded sample of labelled documents, all of
whose words are used; its chains are spliced from segments of several
documents, so the transitions learn when a text switches. Forward-backward over
the whole chain of a text gives each word a distribution over languages; a
text's shares are their means over its words, and runs of words of one best
language are its stretches.

A chain is computed in pieces of ``PIECE`` words side by side. The product of the
steps of each piece carries what comes before and after it exactly.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.llm.textbytes import LOWER, U, Words, chunks, mix

TABLE, PIECE = 1 << 15, 128
#: Labelled rows that are learned from at most, words of a segment, passes.
LEARNED, SEGMENT, EPOCHS = 1_000, 20, 4
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def features(words: Words, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entries, first): hashed features of the chosen words; word k has entries[first[k]:first[k + 1]]."""
    start, end = words.start[which], words.end[which]
    own = np.arange(len(which))
    rows, keys = [own], [words.span_hash(start, end)]
    for n in range(1, 5):
        has = end - start > n
        for tag, a, b in ((2 * n, start[has], start[has] + n), (2 * n + 1, end[has] - n, end[has])):
            rows.append(own[has])
            keys.append(mix(words.span_hash(a, b) + U(tag)))
    count = np.maximum(end - start - 2, 0)
    row = np.repeat(own, count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + start[row]
    rows.append(row)
    keys.append(mix(words.span_hash(at, at + 3) + U(99)))
    row, key = np.concatenate(rows), np.concatenate(keys)
    order = np.argsort(row, kind="stable")
    first = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(which)))])
    return (key[order] % U(TABLE)).astype(np.int64), first


def pieces(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(piece, place) of each word: pieces of one text."""
    place = np.arange(len(words.doc)) - words.first[:-1][words.doc]
    new = place % PIECE == 0
    return np.cumsum(new) - 1, place % PIECE


def _alive(length: np.ndarray, places: int) -> list[int]:
    """Chains, longest first, that reach each place."""
    return [int(np.searchsorted(-length, -t, side="left")) for t in range(places)]


def forward_backward(scores: np.ndarray, length: np.ndarray, move: np.ndarray, enter=None, leave=None) -> tuple[np.ndarray, np.ndarray]:
    """Word posteriors and summed transition posteriors of padded chains (chain, place, label), longest first.

    ``enter`` weighs the labels of the first place by what comes before the
    chain, ``leave`` those of the last by what comes after; both are even
    where not given."""
    n, places, labels = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    m = np.exp(move - move.max())
    alpha = np.zeros_like(e)
    alive = _alive(length, places)
    for t in range(places):
        k = alive[t]
        if not k:
            break
        a = e[:k, t] * (alpha[:k, t - 1] @ m if t else 1.0 if enter is None else enter[:k])
        alpha[:k, t] = a / a.sum(axis=1, keepdims=True)
    beta = np.ones((n, labels)) if leave is None else leave.copy()
    post = np.zeros_like(e)
    moves = np.zeros((labels, labels))
    for t in range(places - 1, -1, -1):
        k = alive[t]
        if not k:
            continue
        p = alpha[:k, t] * beta[:k]
        post[:k, t] = p / p.sum(axis=1, keepdims=True)
        if t:
            right = e[:k, t] * beta[:k]
            pair = alpha[:k, t - 1, :, None] * m[None] * right[:, None, :]
            moves += (pair / pair.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = right @ m.T
            beta[:k] = back / back.sum(axis=1, keepdims=True)
    return post, moves


def _products(scores: np.ndarray, length: np.ndarray, move: np.ndarray) -> np.ndarray:
    """The matrix of each padded piece, from the labels of its first word to those of its last, scaled."""
    n, places, labels = scores.shape
    e = np.exp(scores - scores.max(axis=2, keepdims=True))
    m = np.exp(move - move.max())
    out = np.eye(labels)[None] * e[:, 0, None, :]
    alive = _alive(length, places)
    for t in range(1, places):
        k = alive[t]
        own = (out[:k] @ m) * e[:k, t, None, :]
        out[:k] = own / own.max(axis=(1, 2), keepdims=True)
    return out


def borders(product: np.ndarray, number: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(enter, leave) of pieces in order, ``number`` being the place of each in its text."""
    m = np.exp(move - move.max())
    scaled = lambda v: v / v.sum(axis=1, keepdims=True)
    enter, leave, end = (np.ones((len(number), len(m))) for _ in range(3))
    order = np.argsort(number, kind="stable")
    level = np.split(order, np.flatnonzero(np.diff(number[order])) + 1) if len(order) else []
    for k, own in enumerate(level):
        if k:
            enter[own] = scaled(end[own - 1] @ m)
        end[own] = scaled((enter[own, None, :] @ product[own])[:, 0])
    for own in level[:0:-1]:
        leave[own - 1] = scaled((product[own] @ leave[own, :, None])[:, :, 0] @ m.T)
    return enter, leave


def _padded(values: np.ndarray, chain: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(padded values, lengths, rank of each chain), longest chains first."""
    length = np.bincount(chain)
    order = np.argsort(-length, kind="stable")
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    out = np.zeros((len(length), int(length.max()), values.shape[1]))
    out[rank[chain], place] = values
    return out, length[order], rank


class Field:
    """Weights (table by label), transitions and label names."""

    def __init__(self, labels: list[str], segments: list[tuple[str, str]], seed: int = 3):
        self.labels = labels
        self.weights, self.move = np.zeros((TABLE, len(labels))), np.zeros((len(labels), len(labels)))
        if len(labels) > 1:
            self._fit(segments, np.random.default_rng(seed))

    def _fit(self, segments: list[tuple[str, str]], rng: np.random.Generator) -> None:
        number = {x: k for k, x in enumerate(self.labels)}
        grads, move_grads = np.full(self.weights.shape, 1e-3), np.full(self.move.shape, 1e-3)
        for epoch in range(EPOCHS):
            order = rng.permutation(len(segments))
            if epoch % 2:
                # chains that stay in one language, for the other half of the epochs
                order = np.array(sorted(order, key=lambda k: segments[k][1]))
            parts = [order[i : i + 600] for i in range(0, len(order), 600)]
            for k in rng.permutation(len(parts)):
                self._step([segments[i] for i in parts[k]], number, grads, move_grads)

    def gradient(self, words: Words, want: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Slopes of the log likelihood of labels ``want`` by weights and transitions, over chains of ``size`` words."""
        line = np.arange(len(want))
        chain, place = line // size, line % size
        entries, first = features(words, line)
        padded, length, rank = _padded(np.add.reduceat(self.weights[entries], first[:-1], axis=0), chain, place)
        post, moves = forward_backward(padded, length, self.move)
        error = -post[rank[chain], place]
        error[line, want] += 1
        each = np.repeat(line, np.diff(first))
        joined = chain[1:] == chain[:-1]
        seen = np.zeros_like(moves)
        np.add.at(seen, (want[:-1][joined], want[1:][joined]), 1)
        return np.stack([np.bincount(entries, weights=error[each, k], minlength=TABLE) for k in range(len(self.labels))], axis=1), seen - moves

    def _step(self, part: list, number: dict, grads: np.ndarray, move_grads: np.ndarray) -> None:
        words = Words(pa.array([x for x, _ in part]), member=LETTERS, fold=LOWER)
        if not len(words.doc):
            return
        want = np.array([number[y] for _, y in part])[words.doc]
        own, moves = self.gradient(words, want, PIECE)
        moves *= 50 / len(want)
        move_grads += moves**2
        self.move += 0.3 * moves / np.sqrt(move_grads)
        grads += own**2
        self.weights += 0.1 * own / np.sqrt(grads)

    def posteriors(self, words: Words) -> np.ndarray:
        """The distribution over labels of each word, given its whole text."""
        _, which, back = np.unique(words.hash, return_index=True, return_inverse=True)
        entries, first = features(words, which)
        scores = np.add.reduceat(self.weights[entries], first[:-1], axis=0)[back]
        piece, place = pieces(words)
        padded, length, rank = _padded(scores, piece, place)
        start = np.flatnonzero(place == 0)
        doc = words.doc[start]
        number = np.arange(len(start)) - np.searchsorted(doc, doc)
        several = np.bincount(doc, minlength=len(words.count))[doc] > 1
        enter, leave = np.ones((len(start), len(self.labels))), np.ones((len(start), len(self.labels)))
        if several.any():
            at = np.flatnonzero(several)
            own = at[np.argsort(rank[at])]
            product = np.empty((len(start), *self.move.shape))
            product[own] = _products(padded[rank[own]], length[rank[own]], self.move)
            enter[at], leave[at] = borders(product[at], number[at], self.move)
        ordered = np.argsort(rank)
        return forward_backward(padded, length, self.move, enter[ordered], leave[ordered])[0][rank[piece], place]

    def label(self, column: pa.Array) -> tuple[np.ndarray, list[list[tuple[str, int, int]]]]:
        """Shares of each text (mean word posterior; zeros without words), and its stretches (label, first word, past the last)."""
        words = Words(column, member=LETTERS, fold=LOWER)
        out = np.zeros((len(column), len(self.labels)))
        runs: list[list[tuple[str, int, int]]] = [[] for _ in range(len(column))]
        if not len(words.doc) or not self.labels:
            return out, runs
        post = self.posteriors(words)
        some = np.flatnonzero(words.count)
        out[some] = np.add.reduceat(post, words.first[:-1][some], axis=0) / words.count[some][:, None]
        best = post.argmax(axis=1)
        new = np.ones(len(best), dtype=bool)
        new[1:] = (best[1:] != best[:-1]) | (words.doc[1:] != words.doc[:-1])
        start = np.flatnonzero(new)
        end = np.append(start[1:], len(best))
        before = words.first[:-1][words.doc[start]]
        for row, k, i, j in zip(words.doc[start].tolist(), best[start].tolist(), (start - before).tolist(), (end - before).tolist(), strict=True):
            runs[row].append((self.labels[k], i, j))
        return out, runs


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each whole text in segments of ``SEGMENT`` words."""
    for batch in batches:
        out: tuple[list, ...] = ([], [], [], [])
        for row in batch.to_pylist():
            words = row["text"].split()
            for k in range(0, len(words), SEGMENT):
                for to, x in zip(out, (row["h"], k, row["lang"], " ".join(words[k : k + SEGMENT])), strict=True):
                    to.append(x)
        kinds = (pa.int64(), pa.int32(), pa.string(), pa.string())
        yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["h", "k", "lang", "text"])


def shares_of(counts: dict[str, int], most: int) -> dict[str, int]:
    """How many of ``most`` texts each language gives: equal numbers, and what small ones leave is shared by the others."""
    out, left = {}, most
    for k, lang in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        out[lang] = min(counts[lang], left // (len(counts) - k))
        left -= out[lang]
    return out


def learn(labelled: DataFrame, most: int = LEARNED) -> Field:
    """A field from (doc_id, text, lang): at most ``most`` distinct labelled texts, each whole.

    Of each language the texts of least hash are taken, as many as of others, so a
    rare one is learned too; only its number of texts reaches the driver. Where
    there are more languages than texts to take, the most frequent have one each."""
    known = labelled.where("text is not null and lang is not null").select("lang", "text", F.xxhash64("doc_id", "text", "lang").alias("h"))
    each = known.groupBy("lang", "h").agg(F.count("*").alias("n"))
    sizes = each.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(most).collect()
    counts = {r["lang"]: r["n"] for r in sizes}
    # hashes are even, so the least of a language lie under a bound that follows from its number: few rows are ranked
    shares = [(lang, n, min(1.0, (n + 10 * n**0.5 + 20) / counts[lang])) for lang, n in shares_of(counts, most).items()]
    share = labelled.sparkSession.createDataFrame(shares, "lang string, share int, upto double")
    low = each.join(F.broadcast(share), "lang").where(F.col("h") / 2.0**64 + 0.5 <= F.col("upto"))
    ids = low.withColumn("place", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).where("place <= share").select("h")
    got = known.join(F.broadcast(ids), "h").dropDuplicates(["h"]).mapInArrow(_segment_rows, "h long, k int, lang string, text string").toPandas()
    got = got.sort_values(["h", "k"])
    return Field(sorted(got["lang"].unique().tolist()), list(zip(got["text"], got["lang"], strict=True)))


def _language_rows(shared):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = shared.value
        kind = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            for part in chunks(batch, "text"):
                shares, runs = field.label(part.column("text"))
                best = shares.argmax(axis=1) if len(field.labels) else np.zeros(len(shares), int)
                score = shares.max(axis=1) if len(field.labels) else np.zeros(len(shares))
                names = []
                for text, b, s in zip(part.column("text"), best.tolist(), score.tolist(), strict=True):
                    names.append(field.labels[b] if s > 0 and any(map(str.isalpha, text.as_py())) else "und")
                score = np.where(np.array(names) == "und", 0.0, np.clip(score, 0, 1))
                runs = [[dict(zip(("lang", "start", "end"), x, strict=True)) for x in own] for own in runs]
                yield pa.record_batch([part.column("doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(runs, kind)], names=["doc_id", "lang_pred", "score", "stretches"])

    return rows


def identify(docs: DataFrame, field: Field) -> DataFrame:
    """(doc_id, lang_pred, score, stretches) per row of ``docs``: the language
    with the largest share of the whole text, that share, and the runs of words
    (runs of letters) of one language, as (lang, start, end) in words. A text
    that is null or has no letter, and any text where nothing was learned, is
    ``und`` with score 0; without words it has no stretches."""
    shared = docs.sparkSession.sparkContext.broadcast(field)
    kinds = "doc_id long, lang_pred string, score double, stretches array<struct<lang:string,start:int,end:int>>"
    return docs.select("doc_id", "text").mapInArrow(_language_rows(shared), kinds)


def op9_language_id(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(3)) == 1, F.lit(False))
    return identify(docs, learn(docs.where(~held_out))).select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "stretches")
