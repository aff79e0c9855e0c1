"""MinHash near-dedup (3): a signature-coordinate inverted join with prefix and skip merging.

A document's set is its distinct word shingles (words ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; with fewer
words than a shingle the whole sequence is one). Two documents are linked when their sets' similarity reaches
``percent``; a component is everything that links reach.

1. One pass over the texts gives each document a signature of ``coordinates`` minima, the size of its set and a
   128-bit fingerprint. Equal sets are one class from here on, known by its smallest document id and the fingerprint: a
   document with several texts may head several classes. Links are between classes, and become documents at the end.
2. Classes are posted under each (coordinate, value) pair. A pair of classes counts one collision for each pair that
   they share; linked classes have at least ``matches`` of them but for a chance of ``MISS`` at the threshold itself.
3. *Prefix.* Values of one class alone can't collide. Of a class's m other values, the m - matches + 1 rarest hold
   one of any ``matches`` shared ones, so only those are merged; classes with fewer than ``matches`` drop out.
4. *Skip.* Long posting lists are mostly copies of one text. First each class is compared with one leader of its
   lists only, and the confirmed links make components. After that a list's members skip those of their own component: what stands outside the list's largest component meets the rest of the list. A pair leaves that join if it has enough collisions and
   its sets' parity bits allow the similarity (they never differ in more bits than shingles); the join's condition tests both.
5. Links are confirmed on the full sets of 64-bit shingle hashes.

No list, class or component is gathered in one place: hot keys are reduced before a shuffle or split by the skew join,
and every step is a table in the shared folder.

Nulls and odd input: a text that is null, empty or without words has an empty set, is linked with nothing and is its own
component. Rows of one id are one document with several texts: they share a component. A row without id gets
no component and isn't kept. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from subspan.llm.components import components
from subspan.llm.registry import query
from subspan.llm.tables import new_path, remove, stored, table
from subspan.llm.words import NOT_SPACE, mix, slices, span_hashes, window_hashes, words

COORDINATES = 64
MISS = 1e-5
PARITY_BITS = 4096
_SIGNATURES = "id long, n_shingles long, print_a long, print_b long, keys array<long>"
_CLASS = "struct<doc:bigint,print_a:bigint,print_b:bigint>"  # ordered by document


def match_threshold(coordinates: int, percent: int, miss: float = MISS) -> int:
    """The most collisions that a pair at the threshold misses with a chance of at most ``miss``."""
    p, below = percent / 100, 0.0
    for t in range(coordinates + 1):
        below += comb(coordinates, t) * p**t * (1 - p) ** (coordinates - t)
        if below > miss:
            return max(t, 1)
    return coordinates


def shingle_sets(column: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    w = words(column, NOT_SPACE)
    hashes = span_hashes(w.data, w.starts, w.ends)
    at, shingles = window_hashes(hashes, w.rows, size)
    cuts = np.searchsorted(at, w.first)
    out = []
    for r in range(len(w.first) - 1):
        own = shingles[cuts[r] : cuts[r + 1]]
        n = int(w.first[r + 1] - w.first[r])
        if 0 < n < size:
            _, own = window_hashes(hashes[w.first[r] : w.first[r + 1]], np.zeros(n, dtype=np.int64), n)
            own = mix(own ^ np.uint64(n))  # else shorter sequences could look like shingles
        out.append(np.unique(own))
    return out


def _prints(sets: list[np.ndarray]) -> np.ndarray:
    """The two halves of each set's fingerprint; 0 for an empty set."""
    counts = np.array([len(s) for s in sets], dtype=np.int64)
    full = np.flatnonzero(counts)
    prints = np.zeros((2, len(sets)), dtype=np.uint64)
    if len(full):
        every = np.concatenate(sets)
        starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
        for k in range(2):
            prints[k, full] = np.add.reduceat(mix(every + np.uint64(k + 1)), starts)
    return prints.view(np.int64)


def _signatures(size: int, coordinates: int):
    seeds = mix(np.arange(1, 2 * coordinates + 1, dtype=np.uint64) << np.uint64(20))
    flips, factors = seeds[:coordinates], seeds[coordinates:] | np.uint64(1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), size)
            counts = np.array([len(s) for s in sets], dtype=np.int64)
            full = np.flatnonzero(counts)
            prints = _prints(sets)
            keys = np.empty((len(full), coordinates), dtype=np.int64)
            if len(full):
                every = np.concatenate(sets)
                starts = np.concatenate(([0], np.cumsum(counts[full])[:-1]))
                for k in range(coordinates):
                    least = np.minimum.reduceat((every ^ flips[k]) * factors[k], starts)
                    keys[:, k] = (least >> np.uint64(32)).astype(np.int64) | (k << 32)
            ends = np.zeros(len(sets) + 1, dtype=np.int32)
            ends[1:] = np.cumsum(np.where(counts > 0, coordinates, 0))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(counts),
                    *(pa.array(p) for p in prints),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(keys.ravel())),
                ],
                names=["id", "n_shingles", "print_a", "print_b", "keys"],
            )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            sets = shingle_sets(batch.column("text"), size)
            ends = np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32)
            every = np.concatenate(sets).view(np.int64) if sets else np.empty(0, dtype=np.int64)
            own = pa.StructArray.from_arrays([batch.column("id"), *(pa.array(p) for p in _prints(sets))], names=["doc", "print_a", "print_b"])
            yield pa.RecordBatch.from_arrays([own, pa.ListArray.from_arrays(pa.array(ends), pa.array(every))], names=["id", "shingles"])

    return run


def _parities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Parity bits of each set: a bit flips for every shingle that hashes to it.

    Where two sets' bits differ, some shingle is in one of them only, so they differ in no fewer shingles than bits.
    """
    for batch in batches:
        sets = batch.column("shingles")
        rows = np.repeat(np.arange(len(sets)), np.diff(sets.offsets.to_numpy()))
        bits = (mix(sets.flatten().to_numpy().view(np.uint64)) >> np.uint64(32)).astype(np.int64) % PARITY_BITS
        out = np.zeros((len(sets), PARITY_BITS), dtype=np.uint8)
        at, counts = np.unique(rows * PARITY_BITS + bits, return_counts=True)
        out.ravel()[at] = counts & 1
        packed = np.packbits(out, axis=1).view(np.int64).ravel()
        ends = np.arange(len(sets) + 1, dtype=np.int32) * (PARITY_BITS // 64)
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.ListArray.from_arrays(pa.array(ends), pa.array(packed))], names=["id", "odd"])


class _Join:
    """The tables that the steps share."""

    def __init__(self, docs: DataFrame, classes: DataFrame, size: int, percent: int, coordinates: int, under: str) -> None:
        self.under, self.percent, self.matches = under, percent, match_threshold(coordinates, percent)
        postings = classes.select("id", F.explode("keys").alias("key"))
        shared = stored(postings.groupBy("key").agg(F.count("*").alias("df")).where("df > 1"), "shared", self.under)
        ranked = F.transform(F.array_sort(F.collect_list(F.struct("df", "key"))), lambda x: x["key"])
        found = postings.join(shared, "key").groupBy("id").agg(ranked.alias("keys"), F.sum("df").alias("central"))
        found = found.where(F.size("keys") >= self.matches)
        self.members = stored(found.join(classes.select("id", F.col("n_shingles").alias("n")), "id").dropDuplicates(["id"]), "members", self.under)
        prefix = F.slice("keys", 1, F.size("keys") - (self.matches - 1))
        self.lists = self.members.select("id", "central", F.explode(prefix).alias("key"))
        texts = docs.join(self.members.select(F.col("id.doc").alias("id")), "id", "left_semi")
        self.sets = stored(texts.mapInArrow(_sets(size), f"id {_CLASS}, shingles array<long>"), "sets", self.under)

    def collide(self, a: str, b: str):
        """Enough collisions, and sizes that allow the similarity."""
        n, m = F.col(f"{a}n"), F.col(f"{b}n")
        sizes = (100 * n >= self.percent * m) & (100 * m >= self.percent * n)
        return sizes & (F.size(F.array_intersect(f"{a}keys", f"{b}keys")) >= self.matches)

    def with_members(self, pairs: DataFrame) -> DataFrame:
        """Pairs (a, b) with what ``collide`` needs; a is the side that may be hot."""
        for side in "ba":
            own = self.members.select(*[F.col(c).alias(side if c == "id" else f"{side}_{c}") for c in ("id", "n", "keys")])
            pairs = pairs.join(own, side)
        return pairs

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs (a, b) whose full sets are as similar as asked for."""
        for side in "ba":
            pairs = pairs.join(self.sets.select(F.col("id").alias(side), F.col("shingles").alias(f"{side}_set")), side)
        both = F.size(F.array_intersect("a_set", "b_set"))
        union = F.size("a_set") + F.size("b_set") - both
        return pairs.where(100 * both >= self.percent * union).select("a", "b")

    def star_links(self) -> DataFrame:
        """Each class with one leader of its lists: the one that most of its prefix shares.

        A list's leader is its most central class, that is the one whose values most others have. A text of which many
        differing copies exist is such a leader, even where no two copies are alike enough to be linked with each other.
        """
        rank = F.struct("central", "id")
        leaders = self.lists.groupBy("key").agg(F.max(rank).alias("x"), F.count("*").alias("n")).where("n > 1")
        leaders = stored(leaders.select("key", F.col("x.id").alias("a")), "leaders", self.under)
        to = self.lists.select("key", F.col("id").alias("b")).join(leaders, "key").where("a <> b")
        votes = to.groupBy("b", "a").agg(F.count("*").alias("votes"))
        best = votes.groupBy("b").agg(F.max(F.struct("votes", "a")).alias("x"))
        best = stored(best.select(F.col("x.a").alias("a"), "b"), "stars", self.under)
        return self.confirmed(self.with_members(best).where(self.collide("a_", "b_")).select("a", "b"))

    def rest_links(self, known: DataFrame) -> DataFrame:
        """All links between different components of ``known``."""
        group = F.coalesce("component", "id")
        labelled = self.members.drop("central").join(known, "id", "left").withColumn("component", group)
        labelled = stored(labelled, "labelled", self.under)
        lists = self.lists.join(labelled.select("id", "component"), "id")
        shares = lists.groupBy("key", "component").agg(F.count("*").alias("n")).groupBy("key")
        mixed = shares.agg(F.max(F.struct("n", "component")).alias("x"), F.count("*").alias("parts")).where("parts > 1")
        mixed = stored(mixed.select("key", F.col("x.component").alias("main")), "mixed", self.under)
        full = stored(lists.select("key", "id").join(mixed, "key"), "listed", self.under).join(labelled, "id")
        sets = self.sets.join(full.select("id").distinct(), "id")
        full = full.join(stored(sets.mapInArrow(_parities, f"id {_CLASS}, odd array<long>"), "parities", self.under), "id")
        names = ["id", "component", "n", "keys", "odd"]
        full = stored(full.select("key", "main", *names), "listed", self.under)
        left = full.where("component <> main").select("key", "main", *[F.col(c).alias(f"a_{c}") for c in names])
        right = full.select(F.col("key").alias("b_key"), *[F.col(c).alias(f"b_{c}") for c in names])
        meet = (F.col("a_component") != F.col("b_component")) & ((F.col("b_component") == F.col("main")) | (F.col("a_id") < F.col("b_id")))
        apart = F.aggregate(F.zip_with("a_odd", "b_odd", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)
        possible = (100 + self.percent) * apart <= (100 - self.percent) * (F.col("a_n") + F.col("b_n"))
        # Keys are in one global order, so a pair's first shared key is in both prefixes: it is met there and nowhere else.
        first = F.array_intersect("a_keys", "b_keys")[0] == F.col("key")
        on = (F.col("key") == F.col("b_key")) & meet & self.collide("a_", "b_") & first & possible
        return self.confirmed(stored(left.join(right, on).select(F.col("a_id").alias("a"), F.col("b_id").alias("b")), "rest", self.under))


def _class():
    return F.struct(F.col("id").alias("doc"), "print_a", "print_b")


def _repeated_ids(usable: DataFrame, classes: DataFrame, under: str) -> DataFrame:
    """Links between the classes of ids that several rows have."""
    repeated = usable.groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1").select("id")
    heads = usable.join(repeated, "id").select("id", "print_a", "print_b").join(
        classes.select("print_a", "print_b", _class().alias("b")), ["print_a", "print_b"]
    )
    heads = stored(heads.select("id", "b").distinct(), "repeated", under)
    return heads.join(heads.groupBy("id").agg(F.min("b").alias("a")), "id").where("a <> b").select("a", "b")


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80, coordinates: int = COORDINATES
) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row."""
    docs = docs.select(F.col(f"`{doc_id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    under = new_path(docs.sparkSession, "near")
    signed = stored(docs.mapInArrow(_signatures(size, coordinates), _SIGNATURES), "signatures")
    usable = signed.where("id is not null and n_shingles > 0")
    classes = stored(usable.groupBy("print_a", "print_b").agg(F.min("id").alias("id")), "classes", under)
    heads = stored(usable.join(classes, ["print_a", "print_b", "id"]).select(_class().alias("id"), "n_shingles", "keys"), "heads", under)
    join = _Join(docs, heads, size, percent, coordinates, under)
    first = components(join.star_links().union(_repeated_ids(usable, classes, under)), under)
    links = stored(join.rest_links(first), "links", under)
    part = F.coalesce("component", "id").alias("part")
    merged = classes.select("print_a", "print_b", _class().alias("id")).join(first, "id", "left").select("print_a", "print_b", "id", part)
    if not links.isEmpty():
        for side in "ab":
            links = links.join(first.withColumnsRenamed({"id": side, "component": f"{side}_part"}), side, "left")
        above = components(links.select(F.coalesce("a_part", "a").alias("a"), F.coalesce("b_part", "b").alias("b")), under)
        merged = merged.join(above.withColumnRenamed("id", "part"), "part", "left").withColumn("part", F.coalesce("component", "part"))
    found = stored(merged.select("print_a", "print_b", F.col("part.doc").alias("component_id")), "found")
    remove(docs.sparkSession, under)
    some = usable.join(found, ["print_a", "print_b"]).select("id", "n_shingles", "component_id")
    none = signed.where("id is null or n_shingles = 0").select("id", "n_shingles", F.col("id").alias("component_id"))
    kept = F.coalesce(F.col("id") == F.col("component_id"), F.lit(False))
    return some.unionByName(none).select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


_SQL_WORDS = (
    r"coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x20\x09-\x0D]+'), [])"
)
ORACLE = f"""
with recursive doc as (select doc_id, {_SQL_WORDS} as w from documents),
sets as (
    select distinct doc_id, array_to_string(w[i:i + least(3, len(w)) - 1], ' ') as g
    from (select doc_id, w, unnest(range(1, greatest(len(w) - 3, 0) + 2)) as i from doc where len(w) > 0)
),
n as (select doc_id, count(*) as n from sets group by doc_id),
pairs as (
    select x.doc_id as a, y.doc_id as b, count(*) as c from sets x join sets y on x.g = y.g and x.doc_id <> y.doc_id
    group by x.doc_id, y.doc_id
),
links as (
    select a, b from pairs join n as na on na.doc_id = a join n as nb on nb.doc_id = b
    where 100 * c >= 85 * (na.n + nb.n - c)
),
reach as (
    select doc_id, doc_id as other from documents
    union
    select reach.doc_id, links.b from reach join links on links.a = reach.other
),
component as (select doc_id, min(other) as component_id from reach group by doc_id)
select doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, component_id, doc_id = component_id as kept
from component left join n using (doc_id)
"""


@query("op3_minhash_dedup", ORACLE)
def op3_minhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"), size=3, percent=85)
