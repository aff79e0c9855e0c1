"""Static range asymmetric numeral system over interleaved lanes, in numpy.

A segment's ids fill blocks of ``LANES`` lanes times up to ``STEPS`` steps, row by row. All blocks share the
segment's frequency table and nothing else: a block begins with its lanes' states (its checkpoint), has its
own words and its own checksum, and can be decoded without the others. Encoder and decoder step through
all blocks of a segment at once, one numpy operation for a step of every lane.

States are in [2**31, 2**63); 32 bits move at a time; frequencies sum to 2**20.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np

LANES, STEPS, SCALE = 32, 2048, 20
BLOCK = LANES * STEPS
_LOW = np.uint64(1 << 31)
_WORD = np.uint64(32)
_BITS = np.uint64(SCALE)
_DENSE = 1 << 20  # ids below it are counted and numbered by a table


class Block(NamedTuple):
    n_ids: int
    states: bytes  # LANES states, 64 bits each
    words: bytes  # 32 bits each
    crc32: int  # of the block's ids as 32-bit numbers


def frequencies(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids and their frequencies, which sum to 2**SCALE; each is 1 at least."""
    if len(ids) and int(ids.max()) < _DENSE:
        every = np.bincount(ids)
        symbols = np.flatnonzero(every)
        counts, symbols = every[symbols], symbols.astype(ids.dtype)
    else:
        symbols, counts = np.unique(ids, return_counts=True)
    total = 1 << SCALE
    if len(symbols) > total // 2:
        raise ValueError(f"{len(symbols)} distinct ids; a table holds {total // 2}")
    freqs = np.maximum(1, counts.astype(np.int64) * total // max(int(counts.sum()), 1))
    over = int(freqs.sum()) - total
    while over > 0:
        k = int(np.argmax(freqs))
        less = min(over, int(freqs[k]) // 2)
        freqs[k] -= less
        over -= less
    if len(freqs):
        freqs[int(np.argmax(freqs))] -= over
    return symbols, freqs


def _steps(n: int) -> int:
    return min(STEPS, -(-n // LANES))


def encode(ids: np.ndarray, symbols: np.ndarray, freqs: np.ndarray) -> list[Block]:
    n = len(ids)
    if not n:
        return []
    steps = _steps(n)
    size = steps * LANES
    blocks = -(-n // size)
    if int(symbols[-1]) < _DENSE:
        place = np.zeros(int(symbols[-1]) + 1, dtype=np.int64)
        place[symbols] = np.arange(len(symbols))
        dense = place[ids]
    else:
        dense = np.searchsorted(symbols, ids).astype(np.int64)
    padded = np.full(blocks * size, int(np.argmax(freqs)), dtype=np.int64)
    padded[:n] = dense
    by_step = np.ascontiguousarray(padded.reshape(blocks, steps, LANES).transpose(1, 0, 2)).reshape(steps, -1)
    f = freqs.astype(np.uint64)
    c = (np.cumsum(freqs) - freqs).astype(np.uint64)
    limit = f << np.uint64(31 - SCALE + 32)
    x = np.full(blocks * LANES, _LOW, dtype=np.uint64)
    words, owners = [], []
    for t in range(steps - 1, -1, -1):
        s = by_step[t]
        out = np.flatnonzero(x >= limit[s])
        if len(out):
            full = x[out]
            words.append(full.astype(np.uint32))
            owners.append(out // LANES)
            x[out] = full >> _WORD
        fs = f[s]
        q = x // fs
        x = (q << _BITS) + (x - q * fs) + c[s]
    stream = np.concatenate(words[::-1]) if words else np.empty(0, dtype=np.uint32)
    owner = np.concatenate(owners[::-1]) if owners else np.empty(0, dtype=np.int64)
    stream = stream[np.argsort(owner, kind="stable")]
    cuts = np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=blocks))))
    plain = ids.astype("<u4")
    return [
        Block(
            min(size, n - b * size),
            x[b * LANES : (b + 1) * LANES].astype("<u8").tobytes(),
            stream[cuts[b] : cuts[b + 1]].astype("<u4").tobytes(),
            zlib.crc32(plain[b * size : (b + 1) * size].tobytes()),
        )
        for b in range(blocks)
    ]


def decode(blocks: list[Block], symbols: np.ndarray, freqs: np.ndarray) -> np.ndarray:
    """The ids of consecutive blocks of one segment, any number of them; raises when a checksum differs."""
    if not blocks:
        return np.empty(0, dtype=np.uint32)
    steps = max(_steps(b.n_ids) for b in blocks)
    f = freqs.astype(np.uint64)
    c = (np.cumsum(freqs) - freqs).astype(np.uint64)
    slots = np.repeat(np.arange(len(freqs), dtype=np.int32), freqs)
    x = np.frombuffer(b"".join(b.states for b in blocks), dtype="<u8").astype(np.uint64)
    stream = np.frombuffer(b"".join(b.words for b in blocks), dtype="<u4")
    sizes = np.array([len(b.words) // 4 for b in blocks])
    # A shorter last block may run out of words before the longest has ended.
    stream = np.append(stream, np.zeros(LANES, dtype=np.uint32)).astype(np.uint64)
    at = np.cumsum(sizes) - sizes
    mask = np.uint64((1 << SCALE) - 1)
    out = np.empty((steps, len(blocks) * LANES), dtype=np.int32)
    for t in range(steps):
        slot = x & mask
        s = slots[slot]
        out[t] = s
        x = f[s] * (x >> _BITS) + slot - c[s]
        need = x < _LOW
        if need.any():
            table = need.reshape(-1, LANES)
            rank = np.cumsum(table, axis=1)
            place = np.minimum((at[:, None] + rank - 1).ravel()[need], len(stream) - 1)
            x[need] = (x[need] << _WORD) | stream[place]
            at += rank[:, -1]
    ids = symbols.astype(np.uint32)[out.reshape(steps, len(blocks), LANES).transpose(1, 0, 2).reshape(len(blocks), -1)]
    for k, b in enumerate(blocks):
        if zlib.crc32(ids[k, : b.n_ids].astype("<u4").tobytes()) != b.crc32:
            raise ValueError(f"block {k}: checksum differs")
    return np.concatenate([ids[k, : b.n_ids] for k, b in enumerate(blocks)])
