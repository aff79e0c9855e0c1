"""What the trained operators share: bounded samples of labelled documents, and Adam."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold(doc_id: str, parts: int, held: int) -> Column:
    """Whether crc32 of the id's text leaves ``held`` modulo ``parts``; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % parts == held, F.lit(False))


def fitting(sizes: list[int], total: int) -> list[int]:
    """Places of the rows that are taken in turn while they fit into ``total`` bytes together; one that doesn't fit is passed over."""
    taken, left = [], total
    for k, size in enumerate(sizes):
        if size <= left:
            taken.append(k)
            left -= size
    return taken


def texts_of(docs: DataFrame, taken: list[tuple[int, int]]) -> dict[tuple[int, int], str]:
    """The whole texts of the rows with these ids and text hashes."""
    if not taken:
        return {}
    keys = F.broadcast(docs.sparkSession.createDataFrame(taken, "doc_id long, hash long"))  # a bounded sample
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("hash")).join(keys, ["doc_id", "hash"])
    return {(r["doc_id"], r["hash"]): r["text"] for r in rows.dropDuplicates(["doc_id", "hash"]).collect()}


def sample(docs: DataFrame, labels: DataFrame, label: str, per_class: int, total: int) -> tuple[list[str], np.ndarray]:
    """Up to ``per_class`` documents of either label, those of smallest id hash, each with its whole text.

    ``total`` bounds the bytes of the texts of both labels together: in the order of the hash, a text that doesn't fit into what is left of its
    label's half is passed over. A document with several labels has the largest. Null ids, null labels and null texts are left out.
    """
    each = labels.where(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).groupBy("doc_id").agg(F.max(label).alias("label"))
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    some = [each.where(F.col("label") == c).orderBy(*order).limit(per_class) for c in (0, 1)]
    wanted = F.broadcast(some[0].unionByName(some[1]))  # 2 * per_class rows at most
    found = docs.where("text is not null").select("doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash")).join(wanted, "doc_id")
    rows = found.distinct().orderBy(*order, "hash").limit(2 * per_class).collect()
    taken = []
    for c in (0, 1):
        own = [r for r in rows if r["label"] == c]
        taken += [own[k] for k in fitting([r["size"] for r in own], total // 2)]
    texts = texts_of(docs, [(r["doc_id"], r["hash"]) for r in taken])
    return [texts[r["doc_id"], r["hash"]] for r in taken], np.array([r["label"] for r in taken], dtype=np.float32)


class Adam:
    def __init__(self, params: dict[str, np.ndarray], rate: float) -> None:
        self.params, self.rate, self.t = params, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in params.items()}
        self.v = {k: np.zeros_like(v) for k, v in params.items()}

    def step(self, grads: dict[str, np.ndarray]) -> None:
        self.t += 1
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in grads.items():
            self.m[k] += 0.1 * (g - self.m[k])
            self.v[k] += 0.001 * (g * g - self.v[k])
            self.params[k] -= (rate * self.m[k] / (np.sqrt(self.v[k]) + 1e-8)).astype(self.params[k].dtype)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def calibrated(raw: np.ndarray, labels: np.ndarray, rounds: int = 2000) -> tuple[float, float]:
    """Slope and shift that make a document's raw value a log-odds, by logistic regression with a little ridge."""
    centre, spread = float(raw.mean()), float(raw.std() or 1)
    x = (raw - centre) / spread
    params = {"a": np.ones(1), "b": np.zeros(1)}
    adam = Adam(params, 0.05)
    for _ in range(rounds):
        g = (sigmoid(params["a"] * x + params["b"]) - labels) / len(x)
        adam.step({"a": np.array([(g * x).sum() + 0.0001 * params["a"][0]]), "b": np.array([g.sum()])})
    a = max(float(params["a"][0]), 0.05) / spread
    return a, float(params["b"][0]) - a * centre
