"""Chat transcripts: roles by a hidden Markov model, then canonical turns.

A row's text is cut into segments where a line opens with a speaker marker
("User:", "### Assistant", "<|im_start|>system"). A segment is seen as a few
coded features (marker, number and length of lines, question mark, list or
code, place in the transcript). Emission and transition counts come from all
rows whose role is known and may be learned. One thing is given and not learned:
a marker, where there is one, names its speaker (``NAMED`` of the time), since
labelled rows need not hold any. How often a role has no marker is learned.
Viterbi recovers the role of each segment from those of its whole conversation.

Segments are range-partitioned in (conversation, turn) order and cut into blocks
of bounded rows and bytes, between conversations where these aren't longer than
a block. So one conversation may span many blocks and no task holds a whole one.
Counts and Viterbi are exact across them. The driver gets a row for each
partition, to see which conversations go on there, and of each block whose
conversation came from the one before, or goes on in the next, its first and last
row and the (max, +) matrices of its first and last conversation, which it
chains; blocks then run with their entry scores and exit states.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from audiweave.llm.scratch import keep

ROLES = ("system", "user", "assistant")
#: Speaker names as transcripts write them.
SPEAKERS = {
    "system": ("system", "instruction", "instructions"),
    "user": ("user", "human", "question", "customer", "q"),
    "assistant": ("assistant", "ai", "bot", "answer", "agent", "model", "a"),
}
_ROLE_OF = {name: k for k, role in enumerate(ROLES) for name in SPEAKERS[role]}
_NAMES = "|".join(sorted(_ROLE_OF, key=len, reverse=True))
# blanks and hashes are never given back, so a line is read once
MARKER = re.compile(rf"^[ \t]*+(?:(?:<\|(?:im_start\|>)?|#++|\*\*|\[)[ \t]*+)?({_NAMES})(?:\|>|\*\*:|:\*\*|\]|[ \t]*+:)[ \t]*+|^[ \t]*+(?:<\|im_start\|>|#++[ \t]*+)({_NAMES})[ \t]*+$", re.IGNORECASE | re.MULTILINE)
_LISTED = re.compile(r"^[^\S\n]*+(?:[-*]|\d++[.)]|```)", re.MULTILINE)
_CLOSED = re.compile(r"<\|(?:im_end|end|endoftext)\|>")
#: Values of each feature, in order: marker, lines, characters, question, list or code, first of its conversation.
WIDTHS = (4, 4, 6, 2, 2, 2)
#: Share of markers that name the role that speaks.
NAMED = 0.94
#: Segments and bytes of text from which a block ends with its conversation, and as many again at which it ends anyway.
BLOCK, BLOCK_BYTES = 1 << 16, 32 << 20
_SEGMENTS = "conv_id long, turn long, h long, row long, seg int, role int, learned boolean, f array<int>, text string"


def split_segments(text: str) -> list[tuple[int, str]]:
    """(marker, text) of each segment; marker 0: none, else 1 + role."""
    out, at, marker = [], 0, 0
    for hit in MARKER.finditer(text):
        if text[at : hit.start()].strip() or marker:
            out.append((marker, text[at : hit.start()]))
        marker, at = 1 + _ROLE_OF[(hit[1] or hit[2]).lower()], hit.end()
    out.append((marker, text[at:]))
    return [(m, _CLOSED.sub("", t).strip() if len(out) > 1 or m else t) for m, t in out]


def features(marker: int, text: str) -> list[int]:
    """All but the last feature, which the place in the conversation gives."""
    lines = text.count("\n") + 1
    return [
        marker,
        min(3, lines.bit_length() - 1),
        min(5, max(0, len(text).bit_length() - 5)),
        int(text.rstrip().endswith("?")),
        int(bool(_LISTED.search(text))),
    ]


def held_out(conv_id) -> bool:
    return conv_id is not None and zlib.crc32(str(conv_id).encode()) % 5 == 0


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out: tuple[list, ...] = tuple([] for _ in range(9))
        for conv, turn, h, row, role, text in zip(*(batch.column(x).to_pylist() for x in ("conv_id", "turn", "h", "row", "role", "text")), strict=True):
            parts = split_segments(text or "")
            known = ROLES.index(role) if role in ROLES and len(parts) == 1 else -1
            for k, (marker, own) in enumerate(parts):
                made = (conv, turn, h, row, k, known, known >= 0 and not held_out(conv), features(marker, own), own)
                for to, x in zip(out, made, strict=True):
                    to.append(x)
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int32()), pa.string())
        names = ["conv_id", "turn", "h", "row", "seg", "role", "learned", "f", "text"]
        yield pa.record_batch([pa.array(x, t) for x, t in zip(out, kinds, strict=True)], names=names)


def _mark_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``same`` and ``block`` to the rows of a partition in order. same: 1 where the row before is of the same
    conversation, 2 for the partition's first row. A block is named by its partition and its number there."""
    before: list = []
    block, rows, held = TaskContext.get().partitionId() << 33, 0, 0
    for batch in batches:
        conv = batch.column("conv_id").to_pylist()
        shifted = (before or [None]) + conv[:-1]
        same = [int(x == y) for x, y in zip(shifted, conv, strict=True)]
        if same and not before:
            same[0] = 2
        before = conv[-1:] or before
        size = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_pylist()
        blocks = []
        for s, n in zip(same, size, strict=True):
            full = max(rows / BLOCK, held / BLOCK_BYTES)
            if full >= 2 or full >= 1 and not s:
                block, rows, held = block + 1, 0, 0
            rows, held = rows + 1, held + n
            blocks.append(block)
        yield pa.record_batch([*batch.columns, pa.array(same, pa.int32()), pa.array(blocks, pa.int64())], names=[*batch.schema.names, "same", "block"])


def _begun(table: pa.Table, joined: set[int]) -> np.ndarray:
    """Which rows of a block, in order, begin a conversation."""
    begun = table.column("same").to_numpy() == 0
    begun[:1] = table.column("block")[0].as_py() not in joined
    return begun


def _coded(table: pa.Table, begun: np.ndarray) -> np.ndarray:
    return np.column_stack([np.array(table.column("f").to_pylist(), int), begun])


def _count_rows(joined: set[int], met: set[int]):
    def counts(table: pa.Table) -> pa.Table:
        """Partial emission, transition and begin counts of one block; of a block that another meets also (a = -1, -2) the roles at its ends."""
        table = table.sort_by("n")
        role, learned = (table.column(x).to_numpy() for x in ("role", "learned"))
        block, begun = table.column("block")[0].as_py(), _begun(table, joined)
        out: dict[tuple[int, int, int], int] = {}
        for k, f in enumerate(_coded(table, begun).tolist()):
            if learned[k]:
                keys = [(j, int(role[k]), int(v)) for j, v in enumerate(f)]
                if begun[k]:
                    keys.append((len(WIDTHS) + 1, 0, int(role[k])))
                elif k and role[k - 1] >= 0:
                    keys.append((len(WIDTHS), int(role[k - 1]), int(role[k])))
                for key in keys:
                    out[key] = out.get(key, 0) + 1
        rows = [(*k, v) for k, v in out.items()]
        if block in met:
            rows += [(-1, block, int(role[0]) if learned[0] else -1, 0), (-2, block, int(role[-1]), 0)]
        return pa.table({x: pa.array([r[j] for r in rows], pa.int64()) for j, x in enumerate("abcn")})

    return counts


def step_counts(ends: list[tuple[int, int, int]], joined: dict[int, int]) -> dict[tuple[int, int, int], int]:
    """Transitions at the starts of blocks, from (-1, block, learned role of its first row) and (-2, block, role of its
    last), -1 for none. ``joined`` has the blocks that go on with a conversation, by the block that it comes from."""
    first, last = {b: c for a, b, c in ends if a == -1}, {b: c for a, b, c in ends if a == -2}
    out: dict[tuple[int, int, int], int] = {}
    for block, before in joined.items():
        key = (len(WIDTHS), last[before], first[block])
        if key[1] >= 0 and key[2] >= 0:
            out[key] = out.get(key, 0) + 1
    return out


class Chain:
    """Log scores of the fitted model."""

    def __init__(self, counts: dict[tuple[int, int, int], int]):
        smooth = lambda a, n: np.array([[counts.get((a, r, v), 0) + 0.5 for v in range(n)] for r in range(len(ROLES))])
        self.emit = [np.log(t / t.sum(axis=1, keepdims=True)) for t in (smooth(j, n) for j, n in enumerate(WIDTHS))]
        moves = smooth(len(WIDTHS), len(ROLES))
        self.move = np.log(moves / moves.sum(axis=1, keepdims=True))
        begin = smooth(len(WIDTHS) + 1, len(ROLES))[0]
        self.begin = np.log(begin / begin.sum())
        # a marker names its speaker, whatever the labelled rows hold
        for r in range(len(ROLES)):
            marked = 1 - np.exp(self.emit[0][r, 0])
            for m in range(1, len(ROLES) + 1):
                self.emit[0][r, m] = np.log(marked * (NAMED if m == r + 1 else (1 - NAMED) / (len(ROLES) - 1)))

    def scores(self, f: np.ndarray) -> np.ndarray:
        return sum(t[:, f[:, j]].T for j, t in enumerate(self.emit))


def _ends(chain: Chain, joined: set[int]):
    def rows(table: pa.Table) -> pa.Table:
        """Of the first and the last conversation of a block: its (max, +) matrix, from the role before it to the role at its end."""
        table = table.sort_by("n")
        begun = _begun(table, joined)
        conv = np.cumsum(begun & (np.arange(len(begun)) > 0))
        e = chain.scores(_coded(table, begun))
        first, last = int(np.searchsorted(conv, conv[0], side="right")), int(np.searchsorted(conv, conv[-1]))
        out = []
        for which, (i, j) in enumerate([(0, first)] + ([(last, len(conv))] if last else [])):
            m, begin = chain.move + e[i], chain.begin + e[i]
            for t in range(i + 1, j):
                m = (m[:, :, None] + chain.move[None]).max(axis=1) + e[t]
                begin = (begin[:, None] + chain.move).max(axis=0) + e[t]
            out.append({"block": table.column("block")[0].as_py(), "which": which, "m": m.ravel().tolist(), "begin": begin.tolist()})
        return pa.Table.from_pylist(out, pa.schema([("block", pa.int64()), ("which", pa.int32()), ("m", pa.list_(pa.float64())), ("begin", pa.list_(pa.float64()))]))

    return rows


def chain_blocks(ends: list, joined: dict[int, int], chain: Chain) -> dict[int, tuple[list | None, int | None]]:
    """{block: (entry scores of its first conversation, exit role of its last)}, None where these start or end inside it."""
    ends = sorted(ends, key=lambda r: (r["block"], r["which"]))
    runs: list[list] = []
    for row in ends:
        if row["which"] == 0 and runs and row["block"] in joined:
            runs[-1].append(row)
        else:
            runs.append([row])
    out: dict[int, list] = {}
    for run in runs:
        alphas = [np.array(run[0]["begin"])]
        for row in run[1:]:
            alphas.append((alphas[-1][:, None] + np.reshape(row["m"], chain.move.shape)).max(axis=0))
        state = int(np.argmax(alphas[-1]))
        for k in range(len(run) - 1, -1, -1):
            own = out.setdefault(run[k]["block"], [None, None])
            if k < len(run) - 1:
                own[1] = state
            if k:
                own[0] = alphas[k - 1].tolist()
                state = int(np.argmax(alphas[k - 1] + np.reshape(run[k]["m"], chain.move.shape)[:, state]))
    return {k: tuple(v) for k, v in out.items()}


def _decode(chain: Chain, edges: dict, joined: set[int]):
    def rows(table: pa.Table) -> pa.Table:
        table = table.sort_by("n")
        entry, leave = edges.get(table.column("block")[0].as_py(), (None, None))
        begun = _begun(table, joined)
        same = ~begun
        e = chain.scores(_coded(table, begun))
        back = np.zeros(e.shape, int)
        alpha = np.zeros(e.shape)
        for t in range(len(same)):
            if t == 0 and entry is None or t and not same[t]:
                alpha[t] = chain.begin + e[t]
            else:
                step = (np.array(entry) if t == 0 else alpha[t - 1])[:, None] + chain.move
                back[t] = step.argmax(axis=0)
                alpha[t] = step.max(axis=0) + e[t]
        roles = np.zeros(len(same), int)
        for t in range(len(same) - 1, -1, -1):
            if t + 1 < len(same) and same[t + 1]:
                roles[t] = back[t + 1][roles[t + 1]]
            else:
                roles[t] = leave if t + 1 == len(same) and leave is not None else int(alpha[t].argmax())
        names = [ROLES[k] for k in roles]
        text = [f"<|{r}|>\n{x}\n<|end|>\n" for r, x in zip(names, table.column("text").to_pylist(), strict=True)]
        made = {x: table.column(x) for x in ("conv_id", "turn", "seg")}
        return pa.table(made | {"role_pred": pa.array(names, pa.string()), "rendered": pa.array(text, pa.string())})

    return rows


def joined_blocks(dealt: DataFrame) -> dict[int, int]:
    """The blocks that go on with the conversation of another, by that other. The driver gets them and two rows of each partition."""
    part = F.shiftright("block", 33).alias("part")
    heads = dealt.where("same = 2").select("block", "conv_id").collect()
    tails = dealt.groupBy(part).agg(F.max_by(F.struct("block", "conv_id"), "n").alias("tail")).select("tail.*").collect()
    out = {}
    tails, at = sorted(tails), -1
    for head in sorted(heads):
        if at >= 0 and tails[at]["conv_id"] == head["conv_id"]:
            out[head["block"]] = tails[at]["block"]
        at += 1
    inner = dealt.groupBy("block").agg(F.min_by("same", "n").alias("same")).where("same = 1").select("block")
    return out | {r["block"]: r["block"] - 1 for r in inner.collect()}


def learn_chain(dealt: DataFrame) -> tuple[Chain, dict[int, int]]:
    """The model over all segments, and ``joined_blocks``."""
    joined = joined_blocks(dealt)
    counts = dealt.select("block", "n", "role", "learned", "same", "f").groupBy("block").applyInArrow(_count_rows({*joined}, {*joined, *joined.values()}), "a long, b long, c long, n long")
    counts = counts.groupBy("a", "b", "c").agg(F.sum("n").alias("n")).collect()
    total = {(r["a"], r["b"], r["c"]): r["n"] for r in counts if r["a"] >= 0}
    for key, n in step_counts([(r["a"], r["b"], r["c"]) for r in counts if r["a"] < 0], joined).items():
        total[key] = total.get(key, 0) + n
    return Chain(total), joined


def segments(turns: DataFrame) -> DataFrame:
    """All segments in order of their conversations, in blocks of bounded rows."""
    rows = turns.select("conv_id", "turn", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("row"), "role", "text").mapInArrow(_segment_rows, _SEGMENTS)
    # rows that are alike in all but ``row`` may be told apart by it; what they give is the same
    order = ["conv_id", "turn", "h", "seg", "role", "row"]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(_mark_rows, f"{_SEGMENTS}, same int, block long")
    return keep(rows.withColumn("n", F.monotonically_increasing_id()), "segments")


def format_chats(turns: DataFrame) -> DataFrame:
    """Roles and canonical text of transcripts.

    Takes conv_id, turn, role and text; other columns are ignored. Returns a
    row per segment (one per input row, more where markers stand in its text):
    conv_id, turn, seg, role_pred, rendered. Reading ``rendered`` in order of
    (conv_id, turn, seg) gives the canonical transcript. ``role`` is only a
    label to learn from: null or unknown roles teach nothing, and conversations
    whose crc32(conv_id as text) mod 5 is 0 are never learned from. A null text
    is an empty segment. Rows of a null conv_id are one conversation; a null
    turn comes first; repeated turns stand in order of their text's hash, and
    segments of repeated rows side by side. The result doesn't depend on the
    number of partitions.
    """
    dealt = segments(turns)
    chain, joined = learn_chain(dealt)
    # a block that no other meets has neither entry scores nor an exit state
    met = dealt.sparkSession.createDataFrame([(b,) for b in {*joined, *joined.values()}], "block long")
    slim = dealt.select("block", "n", "same", "f").join(F.broadcast(met), "block", "left_semi")
    slim = slim.groupBy("block").applyInArrow(_ends(chain, {*joined}), "block long, which int, m array<double>, begin array<double>")
    edges = chain_blocks(slim.collect(), joined, chain)
    return dealt.groupBy("block").applyInArrow(_decode(chain, edges, {*joined}), "conv_id long, turn long, seg int, role_pred string, rendered string")


def op1_chat_format(spark, sf_dir: str) -> DataFrame:
    return format_chats(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
