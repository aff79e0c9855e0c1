"""Periodic run detection (11): maximal pairs from a bottom-up LCP-interval tree.

A run is a stretch of words with smallest period q and length of at least ``LEAST`` and 2q that no neighbouring word extends. Its
start and the place q words later begin equal stretches of length - q words that differ in the word to their left and in the
one behind: a maximal pair whose distance is at most its length. Conversely such a pair at distance d is a stretch of period d; of
those with one start and length the smallest d is the run's period. So the runs are read off the pairs and nothing is extended.

A task takes a slice of whole texts as one sequence of word numbers in which no two documents share a number, so nothing reaches
across documents. Half of ``LEAST`` words must repeat, so only texts where so many do are sorted (exact ranks, those that tie doubled in
length each round); common prefixes follow from the ranks. The tree is walked bottom-up. A node has its places in ascending order, all
together and in a list for each class of words to the left. When two children meet at depth l, each place of the smaller one looks up those of the
other classes within l words in the larger one; stretches of its own class are skipped by comparing counts in both lists. Equal stretches of l
words within l words are periodic and but the first of them have one class, so few pairs come of a place, and merging the smaller into the
larger list bounds the steps. Memory is a small multiple of a slice or of the longest text.

Nulls and odd input: a text that is null or has no words has no runs and collapses to an empty text. Null ids and repeated
rows are judged each for itself. Extra columns are not read. An empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Callable, Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import table
from subspan.llm.words import slices, text_bytes

LEAST = 12  # words of a run at least
_RUNS = "array<struct<start:long,length:long,period:long>>"
_RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _ranked(keys: np.ndarray, within: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """How many keys are smaller than each, and whether another equals it.

    With ``within``, an earlier ranking by beginnings of the same keys, the ranks go on from it: keys are part of it.
    """
    order = np.argsort(keys, kind="stable")
    at, n = np.arange(len(keys)), len(keys)
    new = np.ones(n + 1, dtype=bool)
    new[1:-1] = keys[order[1:]] != keys[order[:-1]]
    first = np.maximum.accumulate(np.where(new[:-1], at, 0))
    tied = np.empty(n, dtype=bool)
    tied[order] = ~(new[:-1] & new[1:])
    if within is not None:
        old = within[order]
        edge = np.ones(n, dtype=bool)
        edge[1:] = old[1:] != old[:-1]
        first = old + first - np.maximum.accumulate(np.where(edge, at, 0))
    rank = np.empty(n, dtype=np.int64)
    rank[order] = first
    return rank, tied


def _grams(words: np.ndarray, at: np.ndarray, size: int, prune: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places ``at``, ranks of the ``size`` words from there on and whether others equal them; prune: only those places.
    ``words`` ends with its largest number, which it has once."""
    most, last = int(words[-1]), len(words) - 1
    rank, tied = words[at], np.ones(len(at), dtype=bool)
    if prune:
        tied = np.bincount(rank, minlength=most + 1)[rank] > 1
    for k in range(1, size + 1):
        if prune:
            at, rank = at[tied], rank[tied]
        if k < size:
            rank, tied = _ranked(rank * (most + 1) + words[np.minimum(at + k, last)])
    if size == 1:
        rank, tied = _ranked(rank)
    return at, rank, tied


def _suffixes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Places that share ``size`` words with another one, in the order of what follows from there on; and how many words each shares with the one before."""
    last = len(words) - 1
    at, _, _ = _grams(words, np.arange(last), size, True)
    some = np.zeros(len(first), dtype=bool)  # texts in which so many words repeat
    some[np.searchsorted(first, at, side="right") - 1] = True
    at = np.flatnonzero(some[np.searchsorted(first, np.arange(last), side="right") - 1])
    m = len(at)
    if not m:
        return at, at
    index = np.full(last + 1, -1, dtype=np.int64)
    index[at] = np.arange(m)
    _, rank, tied = _grams(words, at, size, False)
    alike, ranks, span = np.flatnonzero(tied), [rank], size
    left = alike
    while len(left):
        # No two texts share words, so what is tied goes on for ``span`` words within its text.
        then = index[np.minimum(at[left] + span, last)]
        rank = rank.copy()
        rank[left], tied = _ranked(rank[left] * (m + 1) + np.where(then >= 0, rank[then] + 1, 0), rank[left])
        left = left[tied]
        ranks.append(rank)
        span *= 2
    order = at[alike[np.argsort(rank[alike])]]
    a, b, shared = order[:-1], order[1:], np.zeros(len(order) - 1, dtype=np.int64)
    for k in reversed(range(len(ranks))):
        x, y = index[np.minimum(a + shared, last)], index[np.minimum(b + shared, last)]
        shared += (size << k) * ((x >= 0) & (y >= 0) & (ranks[k][x] == ranks[k][y]))
    more = shared >= size
    for _ in range(size - 1):
        more &= words[np.minimum(a + shared, last)] == words[np.minimum(b + shared, last)]
        shared += more
    return order, np.concatenate(([0], shared))


class _Node:
    """Places of a node of the tree in ascending order, all of them and by the class of the word to their left."""

    __slots__ = ("places", "classes")

    def __init__(self, place: int, its: int) -> None:
        self.places, self.classes = [place], {its: [place]}

    def others(self, its: int, low: int, high: int) -> list[int]:
        """Places from ``low`` to ``high`` of classes other than ``its``: a stretch that holds no more places than that class does there is skipped whole."""
        own, out = self.classes.get(its, ()), []
        todo = [(bisect_left(self.places, low), bisect_right(self.places, high))]
        while todo:
            i, j = todo.pop()
            if i >= j:
                continue
            known = bisect_right(own, self.places[j - 1]) - bisect_left(own, self.places[i]) if own else 0
            if known == j - i:
                continue
            if not known:
                out += self.places[i:j]
            else:
                todo += ((i, (i + j) // 2), ((i + j) // 2, j))
        return out

    def add(self, other: _Node) -> None:
        for its, places in other.classes.items():
            if its in self.classes:
                _insert(self.classes[its], places)
            else:
                self.classes[its] = places
        _insert(self.places, other.places)


def _insert(into: list[int], places: list[int]) -> None:
    if 8 * len(places) < len(into):
        for i in places:
            insort(into, i)
    else:
        into += places
        into.sort()  # two ascending runs: linear


def _maximal_pairs(order: np.ndarray, shared: np.ndarray, left: np.ndarray, size: int, least: int) -> list[tuple[int, int, int]]:
    """First place, distance and length of the maximal pairs that are as long as their distance and make ``least`` words with it."""
    found: list[tuple[int, int, int]] = []

    def joined(a: _Node, b: _Node, depth: int) -> _Node:
        if len(a.places) < len(b.places):
            a, b = b, a
        for its, places in b.classes.items():
            for i in places:
                found.extend((min(i, j), abs(i - j), depth) for j in a.others(its, i - depth, i + depth) if abs(i - j) + depth >= least)
        a.add(b)
        return a

    open_: list[tuple[int, _Node]] = []  # nodes from the root to the last leaf: depth, places of their complete children
    last = None
    for place, its, depth in zip([*order.tolist(), -1], [*left.tolist(), -1], [*shared.tolist(), 0], strict=True):
        while open_ and open_[-1][0] > depth:
            above, held = open_.pop()
            last = joined(held, last, above)
        if depth >= size:
            if open_ and open_[-1][0] == depth:
                last = joined(open_.pop()[1], last, depth)
            open_.append((depth, last))
        last = _Node(place, its)
    return found


def runs(words: np.ndarray, first: np.ndarray | None = None, least: int = LEAST) -> list[tuple[int, int, int]]:
    """Start, length and period of the runs of a sequence of numbers from 0 up, in order of start and period.

    ``first``: where the sequence's texts begin; they must not share numbers.
    """
    words, size = np.append(words.astype(np.int64), int(words.max(initial=-1)) + 1), max(1, -(-least // 2))
    order, shared = _suffixes(words, np.zeros(1, dtype=np.int64) if first is None else first, size)
    if not len(order):
        return []
    left = np.where(order > 0, words[order - 1], -1)
    periods: dict[tuple[int, int], int] = {}
    for start, d, length in _maximal_pairs(order, shared, left, size, least):
        key = (start, d + length)
        periods[key] = min(d, periods.get(key, d))
    return sorted((start, length, q) for (start, length), q in periods.items())


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """A number of each word, with numbers of its own for each text; and the first word of each text, and one more."""
    parts, base = [np.empty(0, dtype=np.int64)], 0
    for words in texts:
        known = dict.fromkeys(words)
        for k, w in enumerate(known, base):
            known[w] = k
        parts.append(np.fromiter(map(known.__getitem__, words), dtype=np.int64, count=len(words)))
        base += len(known)
    return np.concatenate(parts), np.cumsum([0, *map(len, texts)])


def _found(rewrite: Callable[[object, list[bytes]], list[bytes]] | None, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            data, offsets = text_bytes(batch.column("text"))
            texts = [data[a:b].tobytes().split() for a, b in zip(offsets, offsets[1:], strict=False)]
            if rewrite is not None:
                texts = [rewrite(doc, words) for doc, words in zip(batch.column("doc_id").to_pylist(), texts, strict=True)]
            numbers, first = _numbered(texts)
            own: list[list[dict]] = [[] for _ in texts]
            for start, length, period in runs(numbers, first[:-1], least):
                row = int(np.searchsorted(first, start, side="right")) - 1
                own[row].append({"start": start - int(first[row]), "length": length, "period": period})
            for row, its in enumerate(own):
                if its:
                    keep = np.ones(len(texts[row]), dtype=bool)
                    for r in its:
                        keep[r["start"] + r["period"] : r["start"] + r["length"]] = False
                    texts[row] = list(compress(texts[row], keep.tolist()))
            collapsed = pa.array([b" ".join(words) for words in texts], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, _RUN), collapsed], names=["doc_id", "runs", "collapsed"])

    return run


def periodic_runs(docs: DataFrame, least: int = LEAST, rewrite: Callable[[object, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, the runs and the text without their repeats of every row of ``docs`` (doc_id, text).

    ``rewrite`` gets the id and the words of each document before the search.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_found(rewrite, least), f"doc_id long, runs {_RUNS}, collapsed string")


def planted(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's words: a tenth of the documents, by a hash of the id, repeat a stretch of theirs from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a : a + p] * (-(-(n - a) // p)))[: n - a]


@query("op11_periodic_runs")
def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    found = periodic_runs(table(spark, folder, "documents"), rewrite=planted)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[c].cast("string") for c in ("start", "length", "period")]), F.lit("\n")))
    return found.withColumn("longest", longest).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.start")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.period")).alias("period"),
        F.expr("1000 * longest.length div -longest.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
