"""Quality classifier (1): attention-based multiple-instance learning over passages.

A document is a bag of passages of ``PASSAGE`` words that cover its whole text. Each passage is encoded by what its bytes and words
look like: shares of ``len(_GROUPS)`` classes of characters, lengths of words, how many words repeat the one before or any other of
the passage. A layer makes an embedding of that, gated attention (tanh and sigmoid branches, multiplied) gives the passages' weights, and a
logistic unit judges the weighted sum. Encoder, attention and unit are learned together from document labels alone, on the
driver, in numpy, from a bounded sample of whole texts (``PER_CLASS`` documents a label, ``TOTAL`` bytes of both).

Scoring is one pass over the documents without a shuffle; memory is that of one slice of text. Language, source and ids are no inputs.

Nulls and odd input: a text that is null or has no words is an empty bag and scores 0. Without labelled rows of both kinds every text with
words scores the known label, or 1 where nothing is known. Null ids are scored and never learned from; repeated rows are scored each;
extra columns pass through, but the name that is added must be free.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subspan.llm.learning import Adam, calibrated, fold, sample, sigmoid
from subspan.llm.registry import query
from subspan.llm.tables import table
from subspan.llm.words import NOT_SPACE, mix, slices, span_hashes, words

PER_CLASS, TOTAL = 1500, 24 << 20
PASSAGE, EMBEDDED, ATTENDED = 64, 16, 12
BATCH, ROUNDS, RATE = 64, 25, 0.01

# Character classes: each ASCII mark by itself, digits, capitals, small letters, other bytes, line feeds, white space.
_MARKS = [c for c in range(0x21, 0x7F) if not chr(c).isalnum()]
_GROUPS = [[c] for c in _MARKS] + [
    list(range(0x30, 0x3A)),
    list(range(0x41, 0x5B)),
    list(range(0x61, 0x7B)),
    list(range(0x80, 0x100)),
    [0x0A],
    [0x09, 0x0B, 0x0C, 0x0D, 0x20],
]
_CLASS = np.full(256, len(_GROUPS), dtype=np.int64)  # control characters are the last class
for _k, _group in enumerate(_GROUPS):
    _CLASS[_group] = _k
_CLASSES = len(_GROUPS) + 1
FEATURES = _CLASSES + 5


def passages(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The row of each passage and its features."""
    w = words(column, NOT_SPACE, lower=False)
    counts = np.diff(w.first)
    per_row = -(-counts // PASSAGE)
    rows = np.repeat(np.arange(len(counts)), per_row)
    if not len(rows):
        return rows, np.zeros((0, FEATURES))
    number = np.arange(len(rows)) - np.repeat(np.cumsum(per_row) - per_row, per_row)
    begin = w.first[:-1][rows] + number * PASSAGE
    end = np.minimum(begin + PASSAGE, w.first[1:][rows])
    n = (end - begin).astype(np.float64)
    low, high = w.starts[begin], w.ends[end - 1]
    sizes = high - low
    # Bytes from a passage's first word to its last one.
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes) + np.repeat(low, sizes)
    kinds = np.repeat(np.arange(len(rows)) * _CLASSES, sizes) + _CLASS[w.data[at]]
    shares = np.bincount(kinds, minlength=len(rows) * _CLASSES).reshape(len(rows), _CLASSES) / sizes[:, None]
    hashes = span_hashes(w.data, w.starts, w.ends)
    owner = np.repeat(np.arange(len(rows)), end - begin)
    lengths = (w.ends - w.starts).astype(np.float64)
    mean = np.bincount(owner, lengths) / n
    spread = np.sqrt(np.maximum(np.bincount(owner, lengths**2) / n - mean**2, 0))
    same = np.zeros(len(owner))
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    distinct = np.unique(mix(hashes + owner.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]
    unique = np.bincount(owner[distinct], minlength=len(rows)) / n
    others = np.stack((np.log1p(mean), np.log1p(spread), np.bincount(owner, same) / n, unique, np.log(n)), axis=1)
    return rows, np.concatenate((np.sqrt(shares), others), axis=1)


class Bags:
    """Gated attention over embedded passages."""

    def __init__(self, seed: int = 11) -> None:
        rng = np.random.default_rng(seed)
        self.centre, self.spread = np.zeros(FEATURES), np.ones(FEATURES)
        self.p = {
            "w": rng.standard_normal((FEATURES, EMBEDDED)) * FEATURES**-0.5,
            "b": np.zeros(EMBEDDED),
            "t": rng.standard_normal((EMBEDDED, ATTENDED)) * EMBEDDED**-0.5,
            "g": rng.standard_normal((EMBEDDED, ATTENDED)) * EMBEDDED**-0.5,
            "a": rng.standard_normal(ATTENDED) * 0.3,
            "o": rng.standard_normal(EMBEDDED) * 0.3,
            "c": np.zeros(1),
        }
        self.slope, self.shift = 1.0, 0.0
        self.constant: float | None = None

    def forward(self, x: np.ndarray, starts: np.ndarray):
        """Log-odds of bags; x: passages of one bag after another, starts: where each bag begins."""
        p = self.p
        e = np.tanh(x @ p["w"] + p["b"])
        t, g = np.tanh(e @ p["t"]), sigmoid(e @ p["g"])
        raw = (t * g) @ p["a"]
        owner = np.zeros(len(x), dtype=np.int64)
        owner[starts[1:]] = 1
        owner = np.cumsum(owner)
        raw = np.exp(raw - np.maximum.reduceat(raw, starts)[owner])
        weights = raw / np.add.reduceat(raw, starts)[owner]
        pooled = np.add.reduceat(weights[:, None] * e, starts, axis=0)
        return pooled @ p["o"] + p["c"], (e, t, g, weights, pooled, owner)

    def gradients(self, x: np.ndarray, starts: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> dict[str, np.ndarray]:
        p = self.p
        odds, (e, t, g, weights, pooled, owner) = self.forward(x, starts)
        d_odds = (sigmoid(odds) - labels) * importance
        out = {"o": pooled.T @ d_odds, "c": d_odds.sum(keepdims=True)}
        d_pooled = (d_odds[:, None] * p["o"])[owner]
        d_weights = (d_pooled * e).sum(axis=1)
        d_raw = weights * (d_weights - np.add.reduceat(weights * d_weights, starts)[owner])
        out["a"] = (t * g).T @ d_raw
        d_t, d_g = d_raw[:, None] * p["a"] * g * (1 - t * t), d_raw[:, None] * p["a"] * t * g * (1 - g)
        out["t"], out["g"] = e.T @ d_t, e.T @ d_g
        d_e = (weights[:, None] * d_pooled + d_t @ p["t"].T + d_g @ p["g"].T) * (1 - e * e)
        out["w"], out["b"] = x.T @ d_e, d_e.sum(axis=0)
        return out

    def documents(self, column: pa.Array) -> np.ndarray:
        """Probability of each text."""
        rows, x = passages(column)
        some, starts = np.unique(rows, return_index=True)
        out = np.zeros(len(column))
        if self.constant is not None:
            out[some] = self.constant
        elif len(some):
            odds, _ = self.forward((x - self.centre) / self.spread, starts)
            out[some] = sigmoid(self.slope * odds + self.shift)
        return out


def train(texts: list[str], labels: np.ndarray, seed: int = 11) -> Bags:
    net = Bags(seed)
    if len(set(labels.tolist())) < 2:
        net.constant = float(labels[0]) if len(labels) else 1.0
        return net
    rows, x = passages(pa.array(texts, pa.string()))
    net.centre, net.spread = x.mean(axis=0), x.std(axis=0) + 0.01
    x = (x - net.centre) / net.spread
    some, starts = np.unique(rows, return_index=True)
    ends = np.append(starts[1:], len(rows))
    labels = labels[some].astype(np.float64)
    share = np.where(labels > 0, 0.5 / max(labels.mean(), 1e-6), 0.5 / max(1 - labels.mean(), 1e-6))
    rng, adam = np.random.default_rng(seed), Adam(net.p, RATE)
    for _ in range(ROUNDS):
        order = rng.permutation(len(some))
        for i in range(0, len(order), BATCH):
            part = order[i : i + BATCH]
            own = np.concatenate([np.arange(starts[k], ends[k]) for k in part])
            begin = np.cumsum(ends[part] - starts[part]) - (ends[part] - starts[part])
            adam.step(net.gradients(x[own], begin, labels[part], share[part] / len(part)))
    odds, _ = net.forward(x, starts)
    net.slope, net.shift = calibrated(odds, labels)
    return net


def scored(docs: DataFrame, net: Bags, text: str = "text", name: str = "quality_score") -> DataFrame:
    """``docs`` with the probability ``name`` that the label is 1."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"documents already have {name}")
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = pa.array(shared.value.documents(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


THRESHOLD = 0.7


def learned(docs: DataFrame, labels: DataFrame, rows) -> Bags:
    """A classifier from those documents and labels that the expression ``rows`` admits."""
    return train(*sample(docs.where(rows), labels.where(rows), "quality", PER_CLASS, TOTAL))


@query("op1_quality")
def op1_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    net = learned(docs, table(spark, folder, "labels"), ~fold("doc_id", 4, 2))
    judged = scored(docs, net, name="score")
    return judged.select("doc_id", fold("doc_id", 4, 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
