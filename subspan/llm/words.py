"""Words of a text column as numpy arrays: one pass over the UTF-8 bytes of an Arrow batch.

A word is a run of bytes of one class. Both word classes used here treat every byte from 0x80 up
as part of a word, so working on bytes gives the same words as working on code points.
Memory is a small multiple of one slice (``SLICE`` bytes of text, or one longer text).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SLICE = 1 << 20  # bytes of text that are worked on at a time
_MULTIPLIER = 0x9E3779B97F4A7C15 | 1


def _classes(spans: Iterable[tuple[int, int]]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    for low, high in spans:
        table[low : high + 1] = True
    return table


NOT_SPACE = ~_classes([(0x20, 0x20), (0x09, 0x0D)])  # [^\x20\x09-\x0D]
ALPHANUMERIC = ~_classes([(0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F)])  # after lower-casing A-Z
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = np.asarray(x, dtype=np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_MULTIPLIER))
_powers: dict[str, np.ndarray] = {}


def _power_tables(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, for ``size`` positions at least."""
    if "up" not in _powers or len(_powers["up"]) < size:
        room = max(size, SLICE) + 1
        for name, base in (("up", _MULTIPLIER), ("down", pow(_MULTIPLIER, -1, 1 << 64))):
            steps = np.full(room, base, dtype=np.uint64)
            steps[0] = 1
            _powers[name] = np.multiply.accumulate(steps)
    return _powers["up"], _powers["down"]


class Words(NamedTuple):
    data: np.ndarray  # the bytes, lower-cased where asked for
    starts: np.ndarray
    ends: np.ndarray
    rows: np.ndarray  # the row of each word
    first: np.ndarray  # of each row, and one more: the position of its first word

    def text(self, i: int, j: int) -> bytes:
        """Words i to j-1, joined by single spaces."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[i:j], self.ends[i:j], strict=True))


def slices(batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE) -> Iterator[pa.RecordBatch]:
    """The same rows in pieces of up to ``limit`` bytes of text; a longer text is a piece of its own."""
    for batch in batches:
        _, offsets = text_bytes(batch.column(column))
        at, n = 0, batch.num_rows
        while at < n:
            to = int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1
            to = min(max(to, at + 1), n)
            yield batch.slice(at, to - at)
            at = to


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, and where each row begins and ends in them (null: empty)."""
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    offsets = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if not len(offsets):
        offsets = np.zeros(1, dtype=np.int64)
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array, in_word: np.ndarray, lower: bool = True) -> Words:
    data, offsets = text_bytes(column)
    if lower:
        data = LOWER[data]
    inside = in_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)  # a row begins or ends here
    edge[offsets] = True
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    after = np.zeros(len(data) + 1, dtype=bool)
    after[:-1] = inside
    starts = np.flatnonzero(after & (~before | edge))
    ends = np.flatnonzero(before & (~after | edge))
    first = np.searchsorted(starts, offsets)
    rows = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    return Words(data, starts, ends, rows, first)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; the spans ascend and don't overlap.

    The bytes are digits of a number in an odd base modulo 2**64; prefix sums give every span at once.
    """
    out = np.empty(len(starts), dtype=np.uint64)
    i, n = 0, len(starts)
    while i < n:
        base = int(starts[i])
        j = max(i + 1, int(np.searchsorted(ends, base + SLICE, side="right")))
        size = int(ends[j - 1]) - base
        up, down = _power_tables(size)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTES[data[base : base + size]] * up[:size], out=sums[1:])
        s, e = starts[i:j] - base, ends[i:j] - base
        out[i:j] = (sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64)
        i = j
    return mix(out)


def window_hashes(hashes: np.ndarray, rows: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of all windows of ``size`` consecutive words of one row."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.uint64)
    total = hashes[:n].copy()
    for k in range(1, size):
        total *= np.uint64(_MULTIPLIER)
        total += hashes[k : k + n]
    at = np.flatnonzero(rows[:n] == rows[size - 1 :])
    return at, mix(total[at])
