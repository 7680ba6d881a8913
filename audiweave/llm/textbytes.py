"""Vectorised word and shingle hashing over Arrow string columns.

All functions work on one bounded chunk of texts at a time (``chunks`` cuts a
record batch by bytes), so memory follows the chunk and not the partition.
Words are hashed by a polynomial over random byte codes, modulo 2**64, taken
from prefix sums; the hash is then mixed, so equal words have equal hashes and
different words collide with a chance of about 2**-64 a pair.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
_RNG = np.random.default_rng(20240607)
BYTE_CODE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * U(2) + U(1)
_P = U(0x9E3779B97F4A7C15)
_PINV = U(pow(0x9E3779B97F4A7C15, -1, 2**64))

#: Bytes that separate words written `[^\x20\x09-\x0D]+`.
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
WORD = ~SPACE
#: 1: letters, digits and bytes of other scripts; 2: other signs; 0: white space and controls.
WORD_OR_SIGN = np.full(256, 2, np.uint8)
WORD_OR_SIGN[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
WORD_OR_SIGN[:33] = 0
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_PLACE = np.arange(1, 65, dtype=np.uint64) * _P

_powers = {"n": 0, "up": np.ones(1, U), "down": np.ones(1, U)}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if _powers["n"] < n:
        size = max(n, 1 << 20)
        for key, base in (("up", _P), ("down", _PINV)):
            table = np.full(size + 1, base, U)
            table[0] = 1
            _powers[key] = np.cumprod(table, dtype=U)
        _powers["n"] = size
    return _powers["up"], _powers["down"]


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    h = (h ^ (h >> U(30))) * U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> U(27))) * U(0x94D049BB133111EB)
    return h ^ (h >> U(31))


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a string or binary column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    column = column.cast(pa.large_binary() if pa.types.is_binary(column.type) else pa.large_string())
    _, offs, data = column.buffers()
    off = np.frombuffer(offs, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None and off[-1] > off[0] else np.zeros(0, np.uint8)
    return raw, off - off[0]


def chunks(batch: pa.RecordBatch, column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``most`` bytes of text each, one row at least."""
    if not batch.num_rows:
        return
    _, off = buffers(batch.column(column))
    start = 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(off, off[start] + most, side="right")) - 1)
        yield batch.slice(start, end - start)
        start = end


class Words:
    """Words of a chunk of texts, runs of bytes of one kind other than 0 in
    ``member``: ``doc`` (row of each word), ``start``/``end``
    (byte positions in ``raw``), ``first`` (words before each row, plus the
    total) and, on demand, ``hash``."""

    def __init__(self, column: pa.Array, member: np.ndarray = WORD, fold: np.ndarray | None = None):
        raw, off = buffers(column)
        self.raw = raw = fold[raw] if fold is not None else raw
        self.off = off
        n = len(raw)
        kind = np.zeros(n + 2, dtype=np.uint8)
        kind[1:-1] = member[raw]
        edge = np.zeros(n + 1, dtype=bool)
        edge[off] = True
        edge |= kind[1:] != kind[:-1]
        begins = edge & (kind[1:] > 0)
        ends = edge & (kind[:-1] > 0)
        self.start = np.flatnonzero(begins)
        self.end = np.flatnonzero(ends)
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(off) - 1), self.count)
        self._hash: np.ndarray | None = None

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of any byte spans of the chunk."""
        up, down = _power_tables(len(self.raw) + 1)
        if not hasattr(self, "_sums"):
            self._sums = np.zeros(len(self.raw) + 1, U)
            np.cumsum(BYTE_CODE[self.raw] * up[: len(self.raw)], out=self._sums[1:])
        return mix((self._sums[end] - self._sums[start]) * down[start] + (end - start).astype(U) * U(0xD6E8FEB86659FD93))

    @property
    def hash(self) -> np.ndarray:
        if self._hash is None:
            self._hash = self.span_hash(self.start, self.end)
        return self._hash

    def grams(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, hash) of every run of ``n`` words within one row."""
        h, doc = self.hash, self.doc
        if len(h) < n:
            return np.zeros(0, np.int64), np.zeros(0, U)
        same = doc[: len(doc) - n + 1] == doc[n - 1 :]
        total = np.zeros(len(h) - n + 1, U)
        for k in range(n):
            total = mix(total + h[k : len(h) - n + 1 + k] + _PLACE[k])
        return doc[: len(doc) - n + 1][same], total[same]


def shingle_sets(column: pa.Array, n: int, fold: np.ndarray | None = LOWER) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-word shingles of each text: (row, hash), sorted by both. A
    text of fewer words, but not none, has its whole sequence as one."""
    words = Words(column, fold=fold)
    doc, gram = words.grams(n)
    few = np.flatnonzero((words.count > 0) & (words.count < n))
    if len(few):
        own = np.zeros(len(few), U)
        for k in range(n - 1):
            has = words.count[few] > k
            own[has] = mix(own[has] + words.hash[words.first[few[has]] + k] + _PLACE[k])
        doc, gram = np.concatenate([doc, few]), np.concatenate([gram, mix(own + words.count[few].astype(U))])
    order = np.lexsort((gram, doc))
    doc, gram = doc[order], gram[order]
    new = np.ones(len(doc), dtype=bool)
    new[1:] = (doc[1:] != doc[:-1]) | (gram[1:] != gram[:-1])
    return doc[new], gram[new]
