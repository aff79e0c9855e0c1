"""Benchmark decontamination (5): a broadcast hash set of normalised test n-grams, scanned over token windows.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A window is ``size`` consecutive
words of a benchmark item; an item of fewer words, but not none, is one window. The windows' 64-bit
hashes go to the executors as one sorted array behind a bitmap; document windows found in it are compared
word by word before they count. Hit positions are unions over all windows.

The broadcast is bounded: windows with their items are measured first and dealt by hash to as many blocks as keep each at about
``block_bytes``, the items of a window that very many share in several of them. With more than one block the documents pass through one
after another and are written in between, so no more than one block is in the driver and in the tasks at a time and a benchmark of any
size is handled whole. Documents are never shuffled.

Nulls and odd input: a null or empty text has no words, no hits and is not contaminated. A null or empty
item has no windows. Windows of items without id count as hits but name no item. Repeated items are one
item; repeated documents are judged each for itself. Other columns pass through; ``scan`` appends
``n_words``, ``hit_spans`` (half-open word ranges) and ``hit_items``, and refuses a table that has them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subspan.llm.registry import query
from subspan.llm.tables import named, new_path, numbered, remove, stored, table
from subspan.llm.words import ALPHANUMERIC, Words, slices, span_hashes, window_hashes, words

WINDOW = 13
BLOCK_BYTES = 256 << 20  # of the windows and items in one broadcast
_ROW_BYTES = 200  # that a window or an item takes besides its text
_BITS = 22

_ADDED = "n_words bigint, hit_spans array<struct<start:bigint,end:bigint>>, hit_items array<string>"


def _benchmark_windows(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            w = words(batch.column("text"), ALPHANUMERIC)
            hashes = span_hashes(w.data, w.starts, w.ends)
            counts = np.diff(w.first)
            found = []
            for length in np.unique(np.minimum(counts[counts > 0], size)):
                at, h = window_hashes(hashes, w.rows, int(length))
                whole = counts[w.rows[at]] >= size if length == size else counts[w.rows[at]] == length
                found += [(int(i), int(length), int(x)) for i, x in zip(at[whole], h[whole].view(np.int64), strict=True)]
            ids = batch.column("item_id").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([x for _, _, x in found], pa.int64()),
                    pa.array([n for _, n, _ in found], pa.int32()),
                    pa.array([w.text(i, i + n).decode("utf-8", "replace") for i, n, _ in found], pa.string()),
                    pa.array([ids[w.rows[i]] for i, _, _ in found], pa.string()),
                ],
                names=["hash", "length", "words", "item_id"],
            )

    return run


def windows(benchmark: DataFrame, size: int = WINDOW) -> DataFrame:
    """The distinct windows of each item: hash, length, words, item_id."""
    found = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").mapInArrow(
        _benchmark_windows(size), "hash long, length int, words string, item_id string"
    )
    return found.distinct()


class _Index:
    """One block of windows, as the tasks look it up."""

    def __init__(self, rows) -> None:
        self.items = {}
        by_length: dict[int, list[int]] = {}
        for r in rows:
            self.items[r["words"].encode()] = r["items"]
            by_length.setdefault(r["length"], []).append(r["hash"])
        self.hashes, self.bitmaps = {}, {}
        for length, values in by_length.items():
            self.hashes[length] = np.unique(np.array(values, dtype=np.int64).view(np.uint64))
            self.bitmaps[length] = np.zeros(1 << _BITS, dtype=bool)
            self.bitmaps[length][self.hashes[length] >> np.uint64(64 - _BITS)] = True

    def hits(self, w: Words) -> Iterator[tuple[int, int, list[str]]]:
        """First word, length and items of each window of the block that the words hold."""
        hashes = span_hashes(w.data, w.starts, w.ends)
        for length, known in self.hashes.items():
            at, h = window_hashes(hashes, w.rows, length)
            maybe = np.flatnonzero(self.bitmaps[length][h >> np.uint64(64 - _BITS)])
            place = np.minimum(np.searchsorted(known, h[maybe]), len(known) - 1)
            for i in at[maybe[known[place] == h[maybe]]].tolist():
                items = self.items.get(w.text(i, i + length))
                if items is not None:
                    yield i, length, items


def _scan(index, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = index.value
        for batch in slices(batches, text):
            w = words(batch.column(text), ALPHANUMERIC)
            spans: dict[int, list] = {}
            items: dict[int, set] = {}
            for i, length, names in block.hits(w):
                row = int(w.rows[i])
                at = i - int(w.first[row])
                spans.setdefault(row, []).append((at, at + length))
                items.setdefault(row, set()).update(names)
            before = batch.column("hit_spans"), batch.column("hit_items")
            for row in spans if before[0].null_count < batch.num_rows else ():
                spans[row] += [(s["start"], s["end"]) for s in before[0][row].as_py() or ()]
                items[row].update(before[1][row].as_py() or ())
            out_spans, out_items = before[0], before[1]
            if spans:
                old = [None] * batch.num_rows if before[0].null_count == batch.num_rows else before[0].to_pylist()
                out_spans = pa.array(
                    [[{"start": s, "end": e} for s, e in _merged(spans[r])] if r in spans else old[r] for r in range(batch.num_rows)],
                    type=before[0].type,
                )
                old = before[1].to_pylist()
                out_items = pa.array([sorted(items[r]) if r in items else old[r] for r in range(batch.num_rows)], type=before[1].type)
            kept = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True)}
            kept |= {"n_words": pa.array(np.diff(w.first)), "hit_spans": out_spans, "hit_items": out_items}
            yield pa.RecordBatch.from_arrays(list(kept.values()), names=list(kept))

    return run


def _merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def scan(
    docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, text: str = "text", block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """``docs`` with its word count, hit word ranges and the items that occur."""
    spark: SparkSession = docs.sparkSession
    taken = {c.lower() for c in docs.columns} & {f.name for f in T.StructType.fromDDL(_ADDED).fields}
    if taken:
        raise ValueError(f"documents already have {sorted(taken)}")
    under = new_path(spark, "windows")
    known = stored(windows(benchmark, size), "known", under)
    bytes_ = F.octet_length("words") + F.coalesce(F.octet_length("item_id"), F.lit(0)) + _ROW_BYTES
    blocks = max(1, -(-(known.agg(F.sum(bytes_)).first()[0] or 0) // block_bytes))
    out = docs.withColumns(
        {f.name: F.lit(None).cast(f.dataType) for f in T.StructType.fromDDL(_ADDED).fields}
    )
    for block in range(blocks):
        part = known.where(F.pmod(F.xxhash64("hash", "item_id"), F.lit(blocks)) == block)
        part = part.groupBy("hash", "length", "words").agg(F.collect_set("item_id").alias("items"))
        index = spark.sparkContext.broadcast(_Index(part.toLocalIterator()))
        out = out.mapInArrow(_scan(index, text), out.schema)
        if blocks > 1:
            out = stored(out, "scanned")
            index.destroy()
    remove(spark, under)
    return out


def judged(scanned: DataFrame) -> DataFrame:
    """``scan``'s rows with ``n_hit`` and ``contaminated``: at least a twentieth of the words are hit."""
    hit = F.coalesce(F.aggregate("hit_spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"]), F.lit(0))
    return scanned.withColumn("n_hit", hit.cast("long")).withColumn(
        "contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
    )


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """``docs`` without the contaminated ones; its columns stay as they are, whatever their names."""
    text = numbered(docs).columns[[c.lower() for c in docs.columns].index(options.pop("text", "text").lower())]
    return named(judged(scan(numbered(docs), benchmark, text=text, **options)).where(~F.col("contaminated")), docs)


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the hit words cut out of their texts, with what stands between two hit words."""
    names = docs.columns

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, text):
            w = words(batch.column(text), ALPHANUMERIC)
            texts, spans = batch.column(text).to_pylist(), batch.column("hit_spans").to_pylist()
            base = np.concatenate(([0], np.cumsum([len((t or "").encode()) for t in texts])))
            for r, ranges in enumerate(spans):
                if ranges:
                    raw, first = texts[r].encode(), int(w.first[r])
                    at, kept = 0, []
                    for x in ranges:
                        kept.append(raw[at : int(w.starts[first + x["start"]] - base[r])])
                        at = int(w.ends[first + x["end"] - 1] - base[r])
                    texts[r] = b"".join([*kept, raw[at:]]).decode()
            kept = {n: c for n, c in zip(batch.schema.names, batch.columns, strict=True)} | {text: pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays([kept[c] for c in names], names=names)

    return scan(docs, benchmark, text=text, **options).mapInArrow(cut, docs.schema)


# The two word patterns of the contract and the alphabets that it lower-cases.
_SQL_WORDS = (
    r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)
ORACLE = f"""
with item as (select item_id, {_SQL_WORDS} as w from benchmark where text is not null),
win as (
    select distinct item_id, least({WINDOW}, len(w)) as l, array_to_string(w[i:i + least({WINDOW}, len(w)) - 1], ' ') as g
    from item, lateral (select unnest(range(1, len(w) - least({WINDOW}, len(w)) + 2)) as i) where len(w) > 0
),
doc as (select doc_id, coalesce({_SQL_WORDS}, []) as w from documents),
doc_win as (
    select doc_id, l, i, array_to_string(w[i:i + l - 1], ' ') as g
    from (select d.doc_id, d.w, k.l, unnest(range(1, len(d.w) - k.l + 2)) as i from doc d, (select distinct l from win) k)
),
hit as (select doc_id, i, l, item_id from doc_win join win using (l, g)),
pos as (
    select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + l)) as p from hit) group by doc_id
),
items as (
    select doc_id, count(*) as n_items, string_agg(item_id, ',' order by item_id) as names
    from (select distinct doc_id, cast(item_id as varchar) as item_id from hit) group by doc_id
)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit,
       cast(coalesce(n_items, 0) as bigint) as n_items, sha256(coalesce(names, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join pos using (doc_id) left join items using (doc_id)
"""


@query("op5_decontaminate", ORACLE)
def op5_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    names = F.coalesce("hit_items", F.array().cast("array<string>"))
    return judged(scan(docs, table(spark, folder, "benchmark"))).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size(names).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort(names)), 256).alias("items_sha256"),
        "contaminated",
    )
