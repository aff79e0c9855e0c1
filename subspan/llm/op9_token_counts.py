"""Token counts (9): a separator scan over flat token files that have no index.

A flat file is a run of token ids in which each document ends with the end-of-document id. It is stored as equal blocks of
bytes (the last one may be shorter) and nothing says where documents lie. ``scan`` finds the end ids of each block with one
vectorised comparison, blocks in any order and each by itself. What a block can't know, how many documents end before it
and where the last of them ends, is a prefix scan over the blocks of a file: a running sum and a running
maximum. A document may span any number of blocks.

Ids are little-endian numbers of 16 or 32 bits. ``blocks_of`` cuts existing binary files; ``write_flat`` makes flat files from
documents in the order in which they are read, one file a task, without a shuffle. It also writes which documents a
file holds, in order, without any position, so counts can be given by document.

Nulls and odd input: a null or empty text has no tokens and an end id; null ids, repeated rows and extra columns are
carried along or ignored. Ids after a file's last end id are an unended document of their own. An empty file has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import new_path, table
from subspan.llm.tokens import encoder, tokenizer_json
from subspan.llm.words import slices

BLOCK_BYTES = 1 << 20
END_OF_TEXT = "<|endoftext|>"
_ROWS = "kind string, file string, block long, payload binary, doc_ids array<long>"


def _flat(content, end_text: str, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(content.value)
        end = np.array([coder.tokenizer.token_to_id(end_text)], dtype=coder.dtype).tobytes()
        name = f"{TaskContext.get().partitionId():06d}"
        held, tokens, listed = bytearray(), 0, 0

        def row(kind: str, number: int, payload: bytes | None, ids: list | None) -> pa.RecordBatch:
            columns = [[kind], [name], [number], [payload], [ids]]
            kinds = [pa.string(), pa.string(), pa.int64(), pa.binary(), pa.list_(pa.int64())]
            names = ["kind", "file", "block", "payload", "doc_ids"]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

        for batch in slices(batches, "text"):
            for raw in coder.encode(batch.column("text").to_pylist()):
                held += raw
                held += end
            while len(held) >= block_bytes:
                yield row("tokens", tokens, bytes(held[:block_bytes]), None)
                del held[:block_bytes]
                tokens += 1
            ids = batch.column("doc_id").to_pylist()
            yield row("documents", listed, None, ids)
            listed += len(ids)
        if held:
            yield row("tokens", tokens, bytes(held), None)

    return run


def write_flat(
    docs: DataFrame, path: str, tokenizer: str | None = None, end_text: str = END_OF_TEXT, block_bytes: int = BLOCK_BYTES
) -> tuple[int, int]:
    """Write flat token files of ``docs`` (doc_id, text) below ``path``; returns the end id and the bytes of an id."""
    text = tokenizer_json(tokenizer)
    coder = encoder(text)
    content = docs.sparkSession.sparkContext.broadcast(text)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(_flat(content, end_text, block_bytes), _ROWS)
    rows.write.partitionBy("kind").option("compression", "zstd").parquet(path)
    return coder.tokenizer.token_to_id(end_text), coder.dtype.itemsize


def read_flat(spark: SparkSession, path: str, kind: str) -> DataFrame:
    return spark.read.schema(_ROWS).parquet(path).where(F.col("kind") == kind)


def blocks_of(spark: SparkSession, path: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Binary files of up to 2 GB as blocks: file, block, payload."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column("path"), batch.column("content"), strict=True):
                whole = content.as_buffer()
                for k in range(-(-whole.size // block_bytes)):
                    part = whole.slice(k * block_bytes, min(block_bytes, whole.size - k * block_bytes)).to_pybytes()
                    columns = [pa.array([name.as_py()]), pa.array([k], pa.int64()), pa.array([part], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["file", "block", "payload"])

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(cut, "file string, block long, payload binary")


def _ends(end_id: int, id_bytes: int, block_ids: int):
    """Where the end ids of each block are in its file, and where the block ends."""
    kind = np.dtype(f"<u{id_bytes}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("block").to_pylist()
            found, limits = [], []
            for number, payload in zip(numbers, batch.column("payload"), strict=True):
                ids = np.frombuffer(payload.as_buffer(), dtype=kind)
                found.append(np.flatnonzero(ids == end_id) + number * block_ids)
                limits.append(number * block_ids + len(ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column("file"), batch.column("block"), pa.array(limits, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["file", "block", "limit", "ends"],
            )

    return run


def scan(blocks: DataFrame, end_id: int, id_bytes: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents of flat files (file, block, payload): file, number, start, n_tokens without the end id, ended."""
    found = blocks.select("file", "block", "payload").mapInArrow(
        _ends(end_id, id_bytes, block_bytes // id_bytes), "file string, block long, limit long, ends array<long>"
    )
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    later = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    stitched = found.select(
        "file",
        "ends",
        "limit",
        F.coalesce(F.sum(F.size("ends")).over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.max(F.element_at(F.when(F.size("ends") > 0, F.col("ends")), -1)).over(earlier), F.lit(-1)).alias("last"),
        F.max("limit").over(later).alias("more"),
    )
    own_last = F.when(F.size("ends") > 0, F.element_at("ends", -1)).otherwise(F.col("last"))
    rest = (F.col("more").isNull()) & (own_last < F.col("limit") - 1)
    # An unended rest is closed by a made-up end just behind the file.
    closed = F.when(rest, F.concat("ends", F.array("limit"))).otherwise(F.col("ends"))
    each = stitched.select("file", "before", "last", "limit", closed.alias("ends")).select(
        "file", "before", "last", "limit", "ends", F.posexplode("ends").alias("at", "end")
    )
    begin = F.when(F.col("at") > 0, F.element_at("ends", F.greatest("at", F.lit(1)))).otherwise(F.col("last")) + 1
    return each.select(
        "file",
        (F.col("before") + F.col("at")).alias("number"),
        begin.alias("start"),
        (F.col("end") - begin).alias("n_tokens"),
        (F.col("end") < F.col("limit")).alias("ended"),
    )


def counts_by_document(spark: SparkSession, path: str, end_id: int, id_bytes: int, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``scan`` of what ``write_flat`` wrote, with the documents' ids."""
    counted = scan(read_flat(spark, path, "tokens"), end_id, id_bytes, block_bytes)
    listed = read_flat(spark, path, "documents").select("file", "block", F.posexplode("doc_ids").alias("at", "doc_id"))
    listed = listed.select("file", (F.col("block") + F.col("at")).alias("number"), "doc_id")
    return counted.join(listed, ["file", "number"]).select("doc_id", "n_tokens", "file", "start", "ended")


@query("op9_token_counts")
def op9_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    path = new_path(spark, "flat")
    end_id, id_bytes = write_flat(table(spark, folder, "documents"), path)
    return counts_by_document(spark, path, end_id, id_bytes).select("doc_id", "n_tokens")
