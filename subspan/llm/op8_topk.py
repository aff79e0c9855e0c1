"""Exact top-k search (8): a pivot-distance index whose annuli are expanded under triangle-inequality bounds.

Vectors become integers floor(256 x). The index keys each by its nearest pivot (means of a bounded sample; one for ``PER_PIVOT`` vectors, ``PIVOTS``
at least and ``MOST_PIVOTS`` at most) and its distance to it. Range partitioning by that key and sorting within it gives blocks of up to ``BLOCK`` vectors; each is an annulus of
one pivot, with the smallest and largest distance and the largest norm that it holds. However many vectors share a
pivot or a distance, ranges also split by a hash of the id.

For a query q at distance d from a pivot p, a vector x of an annulus has distance at least g = max(0, lo - d, d - hi), so
q.x = (|q|^2 + |x|^2 - |q-x|^2) / 2 is at most (|q|^2 + norm^2 - g^2) / 2, and also at most q.p + |q| hi.
A query first searches the annuli of its own pivot that hold its own distance; its k-th best score there is a floor. Then it goes to
all pivots and there to the annuli whose bound reaches the floor; the others are skipped. Equal scores go to the smaller id, so an
annulus whose bound equals the floor is searched. Queries travel in blocks to pivots; a task compares a block of queries with an
annulus by one matrix product and passes on k rows of a query. The queries are a stated set against all rows.

Scores are exact: sums are made in floating-point numbers where none can pass their whole numbers, else in Python integers and
limited to 64 bits.

Nulls and odd input: a vector that is null or holds a null or non-finite component takes no part. Vectors of other lengths
are padded with zeros. Rows of the query's own id are no candidates. A repeated id is a candidate with each of its rows, and a query with
each: its ranks then occur once for each row. Fewer than k candidates: all. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import stored, table

PIVOTS, SAMPLE, ROUNDS = 64, 4096, 4
PER_PIVOT, MOST_PIVOTS = 16_384, 1024
BLOCK, QUERIES = 1024, 256
_SLACK = 1e-5  # bounds are floating-point numbers; they are widened by this share
_BLOCKS = "pivot int, lo double, hi double, norm double, ids binary, vectors binary"


def integers(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that take part, and their vectors as float64 integers, padded to ``width``."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.values.slice(column.offsets[0].as_py(), int(lengths.sum()))
    flat = values.cast(pa.float64()).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(column)), lengths)
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(256 * flat)
    bad = np.bincount(rows[~np.isfinite(whole)], minlength=len(column)) > 0
    out = np.zeros((len(column), width))
    out[rows, np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = whole
    good = np.flatnonzero(~bad)
    return good, out[good]


class Model:
    """Pivots and the form in which vectors are stored."""

    def __init__(self, centres: np.ndarray, width: int, dtype: str) -> None:
        self.centres, self.width, self.dtype = centres, width, np.dtype(dtype)

    def read(self, raw: bytes) -> np.ndarray:
        return np.frombuffer(raw, dtype=self.dtype).reshape(-1, self.width)

    def distances(self, x: np.ndarray) -> np.ndarray:
        x, c = x.astype(np.float64), self.centres
        squares = (x * x).sum(axis=1)[:, None] + (c * c).sum(axis=1) - 2 * x @ c.T
        return np.sqrt(np.maximum(squares, 0))

    def place(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest pivot of each vector and the distance to it."""
        d = self.distances(x)
        own = d.argmin(axis=1)
        return own, d[np.arange(len(x)), own]

    def reach(self, q: np.ndarray, pivots: np.ndarray, lo: np.ndarray, hi: np.ndarray, norm: np.ndarray) -> np.ndarray:
        """The most that each query's product with a vector of each annulus can be."""
        q = q.astype(np.float64)
        squares = (q * q).sum(axis=1)[:, None]
        d = self.distances(q)[:, pivots]
        gap = np.maximum(0, np.maximum(lo - d, d - hi))
        bound = np.minimum((squares + norm**2 - gap**2) / 2, (q @ self.centres.T)[:, pivots] + np.sqrt(squares) * hi)
        return bound + _SLACK * (1 + squares + norm**2)


def fit(vectors: DataFrame, pivots: int | None = None, sample: int = SAMPLE) -> Model:
    """Pivots from the ``sample`` rows of smallest id hash, or eight for a pivot if that is more."""
    size = F.max(F.size("v")).alias("width")
    finite = F.filter("v", lambda x: F.abs(x) < 1e30)
    most = F.max(F.greatest(F.array_max(finite), -F.array_min(finite))).alias("most")
    form = vectors.agg(size, most, F.count(F.lit(1)).alias("n")).first()
    pivots = pivots or min(max(form["n"] // PER_PIVOT, PIVOTS), MOST_PIVOTS)
    sample = max(sample, 8 * pivots)
    width = max(form["width"] or 1, 1)
    dtype = "<f4" if 256 * (form["most"] or 0) < 2**23 else "<f8"
    rows = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(sample).select("v").toArrow()
    _, x = integers(rows.column("v").combine_chunks(), width)
    if not len(x):
        return Model(np.zeros((1, width)), width, dtype)
    model = Model(x[:: max(1, len(x) // pivots)][:pivots].copy(), width, dtype)
    for _ in range(ROUNDS):
        own, _ = model.place(x)
        for k in range(len(model.centres)):
            if (own == k).any():
                model.centres[k] = x[own == k].mean(axis=0)
    return model


def _keyed(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            good, x = integers(batch.column("v"), model.width)
            pivots, near = model.place(x)
            norm = np.sqrt((x * x).sum(axis=1))
            rows = pa.array([r.tobytes() for r in x.astype(model.dtype)], pa.binary())
            columns = [batch.column("id").take(pa.array(good)), pa.array(pivots.astype(np.int32)), pa.array(near), pa.array(norm), rows]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "pivot", "near", "norm", "row"])

    return run


def _packed(names: tuple[str, ...], size: int, row):
    """Consecutive rows with the same first column, up to ``size``, as one row each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        for batch in batches:
            for x in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                if held and (held[0][0] != x[0] or len(held) == size):
                    yield row(held)
                    held = []
                held.append(x)
        if held:
            yield row(held)

    return run


def _ids(held: list, at: int) -> pa.Array:
    return pa.array([np.array([x[at] for x in held], dtype="<i8").tobytes()], pa.binary())


def _annulus(held: list) -> pa.RecordBatch:
    """held: pivot, near, norm, id, row."""
    near = [x[1] for x in held]
    columns = [pa.array([held[0][0]], pa.int32()), pa.array([min(near)]), pa.array([max(near)]), pa.array([max(x[2] for x in held)])]
    columns += [_ids(held, 3), pa.array([b"".join(x[4] for x in held)], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["pivot", "lo", "hi", "norm", "ids", "vectors"])


def _asked(held: list) -> pa.RecordBatch:
    """held: pivot, id, number, row, floor."""
    columns = [pa.array([held[0][0]], pa.int32()), _ids(held, 1), _ids(held, 2), pa.array([b"".join(x[3] for x in held)], pa.binary())]
    columns.append(pa.array([np.array([x[4] for x in held], dtype="<f8").tobytes()], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, names=["pivot", "q_ids", "q_numbers", "q_vectors", "floors"])


def _routed(shared, pivots):
    """Query blocks to the pivots that hold anything within a query's reach."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (numbers, lo, hi, norm) = shared.value, pivots.value
        for batch in batches:
            for ids, asked, vectors, floors in zip(*(batch.column(c).to_pylist() for c in ("q_ids", "q_numbers", "q_vectors", "floors")), strict=True):
                q, who, least = model.read(vectors), np.frombuffer(ids, dtype="<i8"), np.frombuffer(floors, dtype="<f8")
                asked = np.frombuffer(asked, dtype="<i8")
                near = model.reach(q, numbers, lo, hi, norm) >= least[:, None]
                for k in np.flatnonzero(near.any(axis=0)):
                    some = near[:, k]
                    parts = [pa.array([v[some].tobytes()], pa.binary()) for v in (who, asked, q, least)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([int(numbers[k])], pa.int32()), *parts], names=["pivot", "q_ids", "q_numbers", "q_vectors", "floors"]
                    )

    return run


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < 2**24:
        return (q.astype(np.float32) @ x.astype(np.float32).T).astype(np.int64)
    if most < 2**53:
        return (q.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    whole = np.vectorize(int, otypes=[object])
    return np.clip(whole(q).dot(whole(x).T), -(2**63), 2**63 - 1).astype(np.int64)


def _searched(shared, k: int, home: bool):
    """The best k of each query in each annulus that its bound reaches; home: in those that hold its own distance."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        names = ("pivot", "lo", "hi", "norm", "ids", "vectors", "q_ids", "q_numbers", "q_vectors", "floors")
        for batch in batches:
            found: list[np.ndarray] = []
            for row in zip(*(batch.column(c).to_pylist() for c in names), strict=True):
                pivot, lo, hi, norm, ids, vectors, q_ids, q_numbers, q_vectors, floors = row
                q, who, least = model.read(q_vectors), np.frombuffer(q_ids, dtype="<i8"), np.frombuffer(floors, dtype="<f8")
                asked = np.frombuffer(q_numbers, dtype="<i8")
                if home:
                    d = model.distances(q)[:, pivot]
                    some = (d >= lo - _SLACK * (1 + lo)) & (d <= hi + _SLACK * (1 + hi))
                else:
                    some = model.reach(q, np.array([pivot]), lo, hi, norm)[:, 0] >= least
                if not some.any():
                    continue
                q, who, asked, least = q[some], who[some], asked[some], least[some]
                ids = np.frombuffer(ids, dtype="<i8")
                order = np.argsort(ids, kind="stable")  # equal scores then stand in order of their ids
                ids, scores = ids[order], products(q, model.read(vectors)[order])
                scores = np.where(who[:, None] == ids, np.iinfo(np.int64).min, scores)
                if len(ids) > k:
                    # The k-th best score of a row, and of those that equal it the first ones.
                    least_kept = -np.partition(-np.maximum(scores, -(2**63) + 1), k - 1, axis=1)[:, k - 1]
                    over, equal = scores > least_kept[:, None], scores == least_kept[:, None]
                    kept = over | (equal & (np.cumsum(equal, axis=1) <= k - over.sum(axis=1)[:, None]))
                else:
                    kept = np.ones(scores.shape, dtype=bool)
                kept &= (who[:, None] != ids) & (scores >= least[:, None])
                r, c = np.nonzero(kept)
                found.append(np.stack((who[r], asked[r], ids[c], scores[r, c])))
            every = np.concatenate(found, axis=1) if found else np.empty((4, 0), dtype=np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in every], names=["query_id", "number", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query, k: int = 5, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score of the rows where ``is_query`` (an expression over ``id``) holds, against all rows."""
    share = vectors.sparkSession.sparkContext.broadcast
    usable = vectors.select(F.col(f"`{vec_id}`").cast("long").alias("id"), F.col(f"`{embedding}`").cast("array<double>").alias("v"))
    usable = usable.where("id is not null and v is not null")
    model = share(fit(usable))
    keyed = stored(usable.mapInArrow(_keyed(model), "id long, pivot int, near double, norm double, row binary"), "keyed")
    ordered = keyed.withColumn("spread", F.xxhash64("id")).repartitionByRange("pivot", "near", "spread").sortWithinPartitions("pivot", "near")
    index = ordered.mapInArrow(_packed(("pivot", "near", "norm", "id", "row"), BLOCK, _annulus), _BLOCKS)
    index = stored(index.select("pivot", "lo", "hi", "norm", "ids", "vectors"), "index")
    known = index.groupBy("pivot").agg(F.min("lo"), F.max("hi"), F.max("norm")).orderBy("pivot").collect()  # PIVOTS rows
    pivots = share(tuple(np.array([r[c] for r in known], dtype=int if c == 0 else float) for c in range(4)))
    asked = stored(keyed.where(is_query).select("id", F.monotonically_increasing_id().alias("number"), "row", "pivot"), "queries")

    def blocks(queries: DataFrame) -> DataFrame:
        near = queries.repartitionByRange("pivot", "id").sortWithinPartitions("pivot")
        form = "pivot int, q_ids binary, q_numbers binary, q_vectors binary, floors binary"
        return near.mapInArrow(_packed(("pivot", "id", "number", "row", "floor"), QUERIES, _asked), form)

    def searched(routed: DataFrame, home: bool) -> DataFrame:
        met = index.join(routed, "pivot")
        found = met.mapInArrow(_searched(model, k, home), "query_id long, number long, vec_id long, score long")
        order = Window.partitionBy("number").orderBy(F.col("score").desc(), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    lowest = F.lit(float("-inf"))
    first = stored(searched(blocks(asked.withColumn("floor", lowest)), True).where(F.col("rank") == k), "floors")
    floors = first.select("number", F.col("score").cast("double").alias("floor"))
    raised = blocks(asked.join(floors, "number", "left").withColumn("floor", F.coalesce("floor", lowest)))
    routed = raised.mapInArrow(_routed(model, pivots), raised.schema)
    return searched(routed, False).select("query_id", "rank", "vec_id", "score")


ORACLE = """
with v as (
    select row_number() over () as number, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
),
scored as (
    select q.number, q.vec_id as query_id, x.vec_id,
           cast(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * x.e[i])) as bigint) as score
    from v q join v x on q.vec_id % 50 = 0 and q.vec_id <> x.vec_id
),
ranked as (select *, row_number() over (partition by number order by score desc, vec_id) as rank from scored)
select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
"""


@query("op8_exact_top_k", ORACLE)
def op8_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    return top_k(table(spark, folder, "embeddings"), F.pmod("id", F.lit(50)) == 0)
