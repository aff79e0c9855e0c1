"""Toxicity (2): a bidirectional gated recurrent network with attention pooling over word and character inputs, in numpy.

Words are the alphanumeric runs of the lower-cased text. A word's input is the embedding of its hash beside the mean
embedding of its character (byte) trigrams and beginnings, so unseen inflections share what is known of their stems. Windows of ``LENGTH`` words
overlap by half and cover the whole text; in each, a gated recurrent unit reads forwards and another backwards, attention
weighs the states of both and a logistic unit judges their sum. A document counts with its highest window, calibrated.

Training, on the driver, uses a bounded sample of whole texts (``PER_CLASS`` documents a label, ``TOTAL`` bytes of both): first
every window under its document's label, then in each round the highest windows of each document, so windows that merely stand
in toxic documents are unlearned. Scoring is one pass over the documents without a shuffle; memory is that of one slice of text.

Nulls and odd input: a text that is null or has no words scores 0. Without labelled rows of both kinds every text with words scores the
known label, or 0. Null ids are scored and never learned from; repeated rows are scored each; extra columns pass through,
but the names that are added must be free.
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
from subspan.llm.words import ALPHANUMERIC, Words, mix, slices, span_hashes, words

PER_CLASS, TOTAL = 1500, 12 << 20
LENGTH, STRIDE = 16, 8
WORDS, GRAMS, EMBEDDED, HIDDEN, ATTENDED = 1 << 14, 1 << 14, 10, 10, 8
BEGINNINGS = (4, 5, 6, 7, 8)  # bytes of a word's beginning that are inputs besides its trigrams
BATCH, RATE, DECAY, WORD_SHARE = 512, 0.01, 0.1, 0.6
FIRST_STEPS, ROUNDS, ROUND_STEPS = 120, 8, 30  # as many for few labels as for many


class Inputs:
    """Windows over the distinct words of a slice."""

    def __init__(self, w: Words) -> None:
        hashes = span_hashes(w.data, w.starts, w.ends)
        distinct, first, self.ids = np.unique(hashes, return_index=True, return_inverse=True)
        self.word = (distinct >> np.uint64(40)).astype(np.int64) % WORDS
        self.grams, self.gram_starts = self._characters(w, first)
        counts = np.diff(w.first)
        windows = np.where(counts > 0, np.maximum(0, -(-(counts - LENGTH) // STRIDE)) + 1, 0)
        self.rows = np.repeat(np.arange(len(counts)), windows)
        number = np.arange(len(self.rows)) - np.repeat(np.cumsum(windows) - windows, windows)
        self.starts = w.first[:-1][self.rows] + number * STRIDE
        self.lengths = np.minimum(LENGTH, w.first[1:][self.rows] - self.starts)

    @staticmethod
    def _characters(w: Words, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Buckets of the trigrams of each distinct word between two marks, and of its beginnings; word after word."""
        lengths = (w.ends - w.starts)[first]
        ends = np.cumsum(lengths + 2)
        framed = np.full(int(ends[-1]) + 8 if len(ends) else 8, 1, dtype=np.uint64)
        starts = ends - lengths - 2
        inner = np.arange(int(lengths.sum())) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        framed[np.repeat(starts + 1, lengths) + inner] = w.data[np.repeat(w.starts[first], lengths) + inner]
        three = framed[:-2] | framed[1:-1] << np.uint64(8) | framed[2:] << np.uint64(16)
        found, owners = [three[np.repeat(starts, lengths) + inner]], [np.repeat(np.arange(len(first)), lengths)]  # n bytes, n trigrams
        for n in BEGINNINGS:
            long = np.flatnonzero(lengths >= n)
            head = np.zeros(len(long), dtype=np.uint64)
            for k in range(n):
                head |= framed[starts[long] + 1 + k] << np.uint64(8 * k)
            found.append(head + np.uint64(n << 59 | n * 0x9E3779B97F4A7C1))
            owners.append(long)
        owner = np.concatenate(owners)
        order = np.argsort(owner, kind="stable")
        grams = (mix(np.concatenate(found)[order]) >> np.uint64(40)).astype(np.int64) % GRAMS
        return grams, np.searchsorted(owner[order], np.arange(len(first)))

    def tokens(self, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct-word numbers of the chosen windows, and which places are filled."""
        place = np.arange(LENGTH)
        filled = place < self.lengths[chosen][:, None]
        return self.ids[np.where(filled, self.starts[chosen][:, None] + place, 0)], filled


class Network:
    def __init__(self, seed: int = 7) -> None:
        rng = np.random.default_rng(seed)

        def normal(*shape: int, scale: float) -> np.ndarray:
            return (rng.standard_normal(shape) * scale).astype(np.float32)

        e, h = 2 * EMBEDDED, HIDDEN
        self.p = {"word": normal(WORDS, EMBEDDED, scale=0.1), "gram": normal(GRAMS, EMBEDDED, scale=0.3)}
        for d in "fb":
            self.p |= {f"x{d}": normal(e, 3 * h, scale=e**-0.5), f"h{d}": normal(h, 3 * h, scale=h**-0.5)}
            self.p |= {f"c{d}": np.zeros(3 * h, np.float32), f"d{d}": np.zeros(3 * h, np.float32)}
        self.p |= {"a": normal(2 * h, ATTENDED, scale=0.3), "k": np.zeros(ATTENDED, np.float32), "v": normal(ATTENDED, scale=0.3)}
        self.p |= {"o": normal(2 * h, scale=0.3), "b": np.zeros(1, np.float32)}
        self.slope, self.shift = 1.0, 0.0
        self.constant: float | None = None

    def embedded(self, word: np.ndarray, grams: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Input vectors of distinct words."""
        if not len(word):
            return np.zeros((0, 2 * EMBEDDED), np.float32)
        counts = np.diff(np.append(starts, len(grams))).astype(np.float32)
        means = np.add.reduceat(self.p["gram"][grams], starts, axis=0) / counts[:, None]
        return np.concatenate((self.p["word"][word], means), axis=1)

    def _direction(self, d: str, gates: np.ndarray, filled: np.ndarray, keep: bool):
        """States of one direction; gates: input parts of all steps. keep: also what the gradient needs."""
        n, steps, h = len(gates), gates.shape[1], HIDDEN
        u, c = self.p[f"h{d}"], self.p[f"d{d}"]
        state = np.zeros((n, h), np.float32)
        states, kept = np.empty((n, steps, h), np.float32), []
        for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
            g, own = gates[:, t], state @ u + c
            rz = sigmoid(g[:, : 2 * h] + own[:, : 2 * h])
            r, z = rz[:, :h], rz[:, h:]
            new = np.tanh(g[:, 2 * h :] + r * own[:, 2 * h :])
            after = np.where(filled[:, t, None], new + z * (state - new), state)
            if keep:
                kept.append((t, state, own[:, 2 * h :], r, z, new))
            state = after
            states[:, t] = state
        return states, kept

    def forward(self, vectors: np.ndarray, ids: np.ndarray, filled: np.ndarray, keep: bool = False):
        """Log-odds of windows; ids: rows of ``vectors``."""
        both, traces = [], []
        for d in "fb":
            gates = (vectors @ self.p[f"x{d}"] + self.p[f"c{d}"])[ids]
            states, kept = self._direction(d, gates, filled, keep)
            both.append(states)
            traces.append(kept)
        states = np.concatenate(both, axis=2)
        keys = np.tanh(states @ self.p["a"] + self.p["k"])
        scores = np.where(filled, keys @ self.p["v"], -1e9)
        weights = np.exp(scores - scores.max(axis=1, keepdims=True))
        weights /= weights.sum(axis=1, keepdims=True)
        pooled = np.einsum("nt,nth->nh", weights, states)
        odds = pooled @ self.p["o"] + self.p["b"]
        return odds, (states, keys, weights, pooled, traces)

    def gradients(self, x: Inputs, chosen: np.ndarray, labels: np.ndarray, importance: np.ndarray, rng=None) -> dict[str, np.ndarray]:
        """rng: leaves out the hash embeddings of random words, so that their characters are learned from, too."""
        tokens, filled = x.tokens(chosen)
        used, ids = np.unique(tokens, return_inverse=True)
        ids = ids.reshape(tokens.shape)
        lengths = np.diff(np.append(x.gram_starts, len(x.grams)))[used]
        begins = np.cumsum(lengths) - lengths
        grams = x.grams[np.repeat(x.gram_starts[used], lengths) + np.arange(int(lengths.sum())) - np.repeat(begins, lengths)]
        vectors = self.embedded(x.word[used], grams, begins)
        seen = np.ones(len(used), np.float32) if rng is None else (rng.random(len(used)) < WORD_SHARE).astype(np.float32)
        vectors[:, :EMBEDDED] *= seen[:, None]
        odds, (states, keys, weights, pooled, traces) = self.forward(vectors, ids, filled, keep=True)
        h, p = HIDDEN, self.p
        d_odds = ((sigmoid(odds) - labels) * importance).astype(np.float32)
        out = {"b": d_odds.sum(keepdims=True), "o": pooled.T @ d_odds}
        d_pooled = d_odds[:, None] * p["o"]
        d_weights = np.einsum("nh,nth->nt", d_pooled, states)
        d_scores = weights * (d_weights - (weights * d_weights).sum(axis=1, keepdims=True))
        out["v"] = np.einsum("nt,nta->a", d_scores, keys)
        d_keys = d_scores[:, :, None] * p["v"] * (1 - keys * keys)
        out["a"] = np.einsum("nth,nta->ha", states, d_keys)
        out["k"] = d_keys.sum(axis=(0, 1))
        d_states = weights[:, :, None] * d_pooled[:, None, :] + d_keys @ p["a"].T
        d_vectors = np.zeros_like(vectors)
        for k, d in enumerate("fb"):
            d_gates = np.zeros((*ids.shape, 3 * h), np.float32)
            d_u, d_c = np.zeros_like(p[f"h{d}"]), np.zeros_like(p[f"d{d}"])
            carried = np.zeros((len(ids), h), np.float32)
            for t, before, own_n, r, z, new in reversed(traces[k]):
                carried = carried + d_states[:, t, k * h : (k + 1) * h]
                live = filled[:, t, None]
                d_after = np.where(live, carried, 0)
                d_new = d_after * (1 - z) * (1 - new * new)
                d_z = d_after * (before - new) * z * (1 - z)
                d_r = d_new * own_n * r * (1 - r)
                d_own = np.concatenate((d_r, d_z, d_new * r), axis=1)
                d_gates[:, t] = np.concatenate((d_r, d_z, d_new), axis=1)
                d_u += before.T @ d_own
                d_c += d_own.sum(axis=0)
                carried = np.where(live, d_after * z + d_own @ p[f"h{d}"].T, carried)
            by_word = np.zeros((len(used), 3 * h), np.float32)
            np.add.at(by_word, ids.ravel(), d_gates.reshape(-1, 3 * h))
            out |= {f"x{d}": vectors.T @ by_word, f"c{d}": by_word.sum(axis=0), f"h{d}": d_u, f"d{d}": d_c}
            d_vectors += by_word @ p[f"x{d}"].T
        out["word"], out["gram"] = np.zeros_like(p["word"]), np.zeros_like(p["gram"])
        np.add.at(out["word"], x.word[used], d_vectors[:, :EMBEDDED] * seen[:, None])
        np.add.at(out["gram"], grams, np.repeat(d_vectors[:, EMBEDDED:] / lengths[:, None], lengths, axis=0))
        return out

    def windows(self, x: Inputs, at_once: int = 4096) -> np.ndarray:
        """Log-odds of every window."""
        vectors = self.embedded(x.word, x.grams, x.gram_starts)
        out = np.empty(len(x.rows), np.float32)
        for i in range(0, len(out), at_once):
            chosen = np.arange(i, min(i + at_once, len(out)))
            out[chosen] = self.forward(vectors, *x.tokens(chosen))[0]
        return out

    def documents(self, column: pa.Array) -> np.ndarray:
        """Probability of each text."""
        x = Inputs(words(column, ALPHANUMERIC))
        some = np.unique(x.rows)
        out = np.zeros(len(column))
        if self.constant is not None:
            out[some] = self.constant
        elif len(some):
            best = np.maximum.reduceat(self.windows(x), np.searchsorted(x.rows, some))
            out[some] = sigmoid(self.slope * best.astype(np.float64) + self.shift)
        return out


def train(texts: list[str], labels: np.ndarray, seed: int = 7) -> Network:
    net = Network(seed)
    if len(set(labels.tolist())) < 2:
        net.constant = float(labels[0]) if len(labels) else 0.0
        return net
    x = Inputs(words(pa.array(texts, pa.string()), ALPHANUMERIC))
    owner, rng, adam = labels[x.rows], np.random.default_rng(seed), Adam(net.p, RATE)

    def fit(chosen: np.ndarray, steps: int) -> None:
        """Steps over windows of which half stand in documents of either label."""
        pools = [chosen[owner[chosen] == c] for c in (0, 1)]
        for _ in range(steps):
            part = np.concatenate([rng.choice(p, BATCH // 2) for p in pools])
            adam.step(net.gradients(x, part, owner[part], np.full(BATCH, 1 / BATCH), rng))
            for name in ("word", "gram"):
                net.p[name] *= 1 - RATE * DECAY

    fit(np.arange(len(owner)), FIRST_STEPS)
    for _ in range(ROUNDS):
        odds = net.windows(x)
        order = np.lexsort((-odds, x.rows))
        place = np.arange(len(order)) - np.searchsorted(x.rows, x.rows)  # rows ascend, so a row's order begins at its first window
        top = order[place < 3]
        rest = rng.permutation(np.flatnonzero(owner == 0))[: len(top)]
        fit(np.concatenate((top, rest)), ROUND_STEPS)
    some = np.unique(x.rows)
    best = np.maximum.reduceat(net.windows(x), np.searchsorted(x.rows, some)).astype(np.float64)
    net.slope, net.shift = calibrated(best, labels[some])
    return net


def scored(docs: DataFrame, net: Network, text: str = "text", name: str = "toxicity") -> DataFrame:
    """``docs`` with the probability ``name``."""
    if name.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"documents already have {name}")
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            found = pa.array(shared.value.documents(batch.column(text)))
            yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, name])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


@query("op2_toxicity")
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    learned = ~fold("doc_id", 5, 0)
    net = train(*sample(docs.where(learned), table(spark, folder, "labels").where(learned), "toxic", PER_CLASS, TOTAL))
    judged = scored(docs, net, name="score")
    return judged.select("doc_id", fold("doc_id", 5, 0).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
