"""Chat formatting against a plain hidden Markov model and enumeration of paths."""

import collections
import itertools
import math
import zlib

import numpy as np
import pytest

from audiweave.llm import chat

WIDTHS, ROLES = chat.WIDTHS, chat.ROLES


def plain_rows(turns):
    """Segments of each conversation in order: (known role or -1, learned, features)."""
    out = collections.OrderedDict()
    for t in sorted(turns, key=lambda t: (t["conv_id"] is not None, t["conv_id"] or 0, t["turn"] is not None, t["turn"] or 0, t["h"])):
        parts = chat.split_segments(t["text"] or "")
        known = ROLES.index(t["role"]) if t["role"] in ROLES and len(parts) == 1 else -1
        held = t["conv_id"] is not None and zlib.crc32(str(t["conv_id"]).encode()) % 5 == 0
        for k, (marker, own) in enumerate(parts):
            row = (known, known >= 0 and not held, [*chat.features(marker, own), int(t["conv_id"] not in out)], t["turn"], k, own)
            out.setdefault(t["conv_id"], []).append(row)
    return out


def plain_counts(conversations):
    n = collections.Counter()
    for rows in conversations.values():
        for k, (known, learned, f, *_) in enumerate(rows):
            if learned:
                n.update((j, known, v) for j, v in enumerate(f))
                if k == 0:
                    n[len(WIDTHS) + 1, 0, known] += 1
                elif rows[k - 1][0] >= 0:
                    n[len(WIDTHS), rows[k - 1][0], known] += 1
    return n


def plain_model(n):
    def table(a, wide, r):
        total = sum(n[a, r, v] + 0.5 for v in range(wide))
        return [math.log((n[a, r, v] + 0.5) / total) for v in range(wide)]

    emit = [[table(j, wide, r) for r in range(3)] for j, wide in enumerate(WIDTHS)]
    for r in range(3):
        marked = 1 - math.exp(emit[0][r][0])
        emit[0][r][1:] = [math.log(marked * (0.94 if m == r else 0.03)) for m in range(3)]
    return emit, [table(len(WIDTHS), 3, r) for r in range(3)], table(len(WIDTHS) + 1, 3, 0)


def weight(path, rows, model):
    emit, move, begin = model
    out = begin[path[0]] + sum(move[a][b] for a, b in zip(path, path[1:], strict=False))
    return out + sum(emit[j][r][v] for r, row in zip(path, rows, strict=True) for j, v in enumerate(row[2]))


def plain_viterbi(rows, model):
    emit, move, begin = model
    own = [[sum(emit[j][r][v] for j, v in enumerate(row[2])) for r in range(3)] for row in rows]
    best = [(begin[r] + own[0][r], [r]) for r in range(3)]
    for e in own[1:]:
        best = [max(((s + move[p[-1]][r] + e[r], [*p, r]) for s, p in best), key=lambda x: x[0]) for r in range(3)]
    return max(best, key=lambda x: x[0])[1]


@pytest.fixture(scope="module")
def turns(spark):
    from pyspark.sql import functions as F

    table = spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")
    return table, [r.asDict() for r in table.withColumn("h", F.xxhash64("text")).collect()]


def test_viterbi_is_the_best_of_all_paths(turns):
    conversations = plain_rows(turns[1])
    model = plain_model(plain_counts(conversations))
    short = [rows for rows in conversations.values() if 2 <= len(rows) <= 7][:12]
    assert short
    for rows in short:
        top = max(weight(p, rows, model) for p in itertools.product(range(3), repeat=len(rows)))
        assert math.isclose(weight(plain_viterbi(rows, model), rows, model), top)


@pytest.mark.parametrize("partitions", [1, 16, 200])
def test_query_equals_plain_model_for_any_partitioning(spark, turns, monkeypatch, partitions):
    monkeypatch.setattr(chat, "BLOCK", 3)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        conversations = plain_rows(turns[1])
        n = plain_counts(conversations)
        dealt = chat.segments(turns[0])
        chain = chat.learn_chain(dealt)[0]
        emit, move, begin = plain_model(n)
        assert np.allclose(chain.move, move) and np.allclose(chain.begin, begin) and all(np.allclose(a, b) for a, b in zip(chain.emit, emit, strict=True))
        got = sorted((r.conv_id, r.turn, r.seg, r.role_pred, r.rendered) for r in chat.format_chats(turns[0]).collect())
        expected = []
        for conv, rows in conversations.items():
            for row, r in zip(rows, plain_viterbi(rows, (emit, move, begin)), strict=True):
                expected.append((conv, row[3], row[4], ROLES[r], f"<|{ROLES[r]}|>\n{row[5]}\n<|end|>\n"))
        assert got == sorted(expected)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_repeated_rows_large_ids_and_one_conversation_of_all_rows(spark, monkeypatch):
    monkeypatch.setattr(chat, "BLOCK", 2)
    big = 2**62 + 1
    rows = [(big, k // 3, ("user", "assistant")[k // 3 % 2], f"text {k // 3}") for k in range(60)] + [(None, None, None, None)] * 3
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert len(got) == 63 and sum(r.conv_id == big for r in got) == 60 and sum(r.conv_id is None for r in got) == 3


def test_blank_runs_and_other_long_texts_are_read_once(spark):
    import time

    texts = [" " * 1_000_000, "\n" * 1_000_000, "\t" * 1_000_000, "7" * 1_000_000, "#" * 1_000_000, (" " * 999 + "\n") * 1000, "user: " + " " * 1_000_000 + "\n- x", "x" * 1_000_000]
    began = time.time()
    made = [chat.features(m, own) for t in texts for m, own in chat.split_segments(t)]
    assert time.time() - began < 10 and len(made) == len(texts) and [f[4] for f in made] == [0] * 6 + [1, 0]
    got = chat.format_chats(spark.createDataFrame([(1, k, "user", t) for k, t in enumerate(texts)], "conv_id long, turn long, role string, text string"))
    assert got.count() == len(texts)


def test_conversations_whose_turns_start_at_one_have_an_opening(spark):
    rows = [(c, t, "system" if t == 1 else ("user", "assistant")[t % 2], "be brief") for c in range(40) for t in (1, 2, 3)]
    dealt = chat.segments(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    emit = chat.learn_chain(dealt)[0].emit[5]
    assert emit[0][1] > emit[0][0] and emit[1][1] < emit[1][0]


def test_edges(spark):
    schema = "role string, conv_id long, turn long, text string, block long, n string, same double"
    assert chat.format_chats(spark.createDataFrame([], schema)).count() == 0
    rows = [("user", 1, 0, None, None, "n", 1.0), (None, 1, 1, "", 7, None, None), ("odd", None, None, "a: b\nuser: c", 1, "x", 2.0), ("user", 2, None, "x" * 100_000, 1, "x", 2.0)]
    got = chat.format_chats(spark.createDataFrame(rows, schema)).collect()
    assert sorted((r.conv_id or 0, r.turn or 0, r.seg) for r in got) == [(0, 0, 0), (0, 0, 1), (1, 0, 0), (1, 1, 0), (2, 0, 0)]
    assert all(r.rendered.startswith(f"<|{r.role_pred}|>") for r in got)
