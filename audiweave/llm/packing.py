"""Best-fit packing planned over a histogram of lengths.

Documents become pieces of at most ``capacity`` token ids. Only the number of
pieces of each length reaches the driver (``capacity`` rows at most); best-fit
decreasing is run over these counts and gives runs of slots. A piece takes the
slot of its rank among the pieces of its length. Ranks are counted within
salted parts of a length, whose offsets come from their counts, so a length
that many pieces share is ranked by many tasks.
"""

from __future__ import annotations

import base64
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from audiweave.llm.scratch import keep
from audiweave.llm.textbytes import chunks

#: Pieces of one length that are ranked by one task, about.
RANKED = 50_000
#: A longer run of white space goes to the slower tokenizer: the faster one's patterns fail at about a million signs.
BLANKS = 100_000
_BLANK_RUN = re.compile(r"\s++")


def tokenizer_path(name: str = "byte_bpe_50k.tiktoken") -> str:
    """Place of a vocabulary file. The ranks of ``byte_bpe_50k`` give the same
    ids through tiktoken as its JSON form does through tokenizers (a test holds
    them against each other), in less than a third of the time."""
    import public_tokenizers

    return public_tokenizers.path(name)


def added_tokens(name: str = "byte_bpe_50k.json") -> dict[str, int]:
    """Tokens that a vocabulary matches inside texts before it splits them, with their ids."""
    with open(tokenizer_path(name), encoding="utf-8") as file:
        return {t["content"]: t["id"] for t in json.load(file)["added_tokens"]}


def coder(path: str, added: dict[str, int] | None = None):
    """Byte-level BPE over a file of ranks; literals of ``added`` tokens get their ids."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added or {})


def encoder(path: str, added: dict[str, int] | None = None):
    """Ids of a text. Texts with a long blank run get them from the JSON form that stands beside the ranks."""
    fast, slow = coder(path, added), []

    def encode(text: str) -> list[int]:
        if len(text) < BLANKS or all(m.end() - m.start() < BLANKS for m in _BLANK_RUN.finditer(text)):
            return fast.encode(text, allowed_special="all", disallowed_special=())
        if not slow:
            import tokenizers

            slow.append(tokenizers.Tokenizer.from_file(f"{os.path.splitext(path)[0]}.json"))
        return slow[0].encode(text, add_special_tokens=False).ids

    return encode


def _piece_rows(path: str, capacity: int, end_id: int, added: dict[str, int] | None):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path, added)
        for batch in batches:
            for part in chunks(batch, "text", 1 << 18):
                out: tuple[list, ...] = ([], [], [], [], [])
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist(), strict=True):
                    ids = np.array([*encode(text or ""), end_id], dtype="<u4")
                    short = len(ids) % capacity
                    cuts = [0, *range(short or capacity, len(ids) + 1, capacity)]
                    for k, (i, j) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
                        for to, x in zip(out, (doc_id, k, i, j - i, zlib.crc32(ids[i:j].tobytes())), strict=True):
                            to.append(x)
                kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
                yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return rows


def token_pieces(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None, added: dict[str, int] | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): the ids of each text and a
    closing ``end_id``, cut into pieces of ``capacity`` ids. A shorter piece,
    if any, is the first. A null text counts as empty: one piece of one id.
    Literals of ``added`` tokens in a text get their ids, which without a
    ``path`` are those of ``byte_bpe_50k.json``; the ranks of another ``path``
    have none but those given."""
    added = added_tokens() if path is None and added is None else added
    rows = _piece_rows(path or tokenizer_path(), capacity, end_id, added)
    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, piece int, start long, length long, ids_crc32 long")


def plan_slots(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over (length: number of pieces).

    Returns runs (length, first_rank, n, per_sequence, first_sequence,
    first_offset): ranks first_rank + x for x < n go to sequence first_sequence
    + x // per_sequence, at first_offset + (x % per_sequence) * length.
    """
    room: dict[int, list[tuple[int, int]]] = {}
    free = np.zeros(capacity + 1, dtype=bool)
    runs, sequences = [], 0

    def leave(space: int, first: int, n: int) -> None:
        if n and space:
            room.setdefault(space, []).append((first, n))
            free[space] = True

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            fits = np.flatnonzero(free[length:])
            if len(fits):
                space = length + int(fits[0])
                first, n = room[space].pop()
                free[space] = bool(room[space])
            else:
                space, first, n = capacity, sequences, -(-left // (capacity // length))
                sequences += n
            per = space // length
            full = min(n, left // per)
            part = left - full * per if full < n else 0
            take = full * per + part
            runs.append((length, rank, take, per, first, capacity - space))
            leave(space - per * length, first, full)
            leave(space - part * length, first + full, 1 if part else 0)
            used = full + (1 if part else 0)
            leave(space, first + used, n - used)
            left, rank = left - take, rank + take
    return runs


def _place_rows(runs: list[tuple[int, int, int, int, int, int]]):
    """Sequence and offset of each piece: a search for the run of its length and rank."""
    table = np.array(sorted(runs), np.int64).reshape(-1, 6)
    first = (table[:, 0] << 48) + table[:, 1]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            own = table[np.searchsorted(first, (length << 48) + rank, side="right") - 1]
            at, per = rank - own[:, 1], own[:, 3]
            made = [pa.array(own[:, 4] + at // per), pa.array(own[:, 5] + at % per * length)]
            yield pa.record_batch([*(batch.column(c) for c in _PIECE), *made], names=[*_PIECE, "sequence_id", "offset"])

    return rows


_PIECE = ("doc_id", "piece", "start", "length", "ids_crc32")


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 0, path: str | None = None) -> DataFrame:
    """Pack all documents into sequences of at most ``capacity`` ids.

    Takes doc_id and text; other columns are ignored. Returns a row per piece:
    doc_id, piece, start, length, ids_crc32, sequence_id, offset. Sequences are
    filled without gaps from offset 0. Repeated rows and rows of a null doc_id
    are packed like others; an empty table gives an empty result. Ids are those
    of ``byte_bpe_50k.json`` at the defaults of tokenizers, added tokens
    included; the ranks of another ``path`` have none, and a text with a blank
    run of ``BLANKS`` signs then needs their JSON form beside them.
    """
    pieces = keep(token_pieces(docs, capacity, end_id, path), "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    salts = max(256, sum(counts.values()) // RANKED)
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = keep(salted.groupBy("length", "salt").agg(F.count("*").alias("n")).select("length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("skip")), "ranks")
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", (F.row_number().over(within) - 1).cast("long")).join(offsets, ["length", "salt"]).withColumn("rank", F.col("rank") + F.col("skip"))
    kinds = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return ranked.select(*_PIECE, "rank").mapInArrow(_place_rows(plan_slots(counts, capacity)), kinds)


def op3_best_fit_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
