"""Token-ID / binary output (10): token files coded by a static range asymmetric numeral system.

``write`` range-partitions the documents by id, sorts each partition, encodes the texts (each followed by ``end_id``) and
codes the ids. A task cuts its ids into segments that end with a document once they hold ``SEGMENT`` ids. A segment
is one row of a Parquet table: its frequency table, its independent blocks (see ``rans``) with their states, words and
checksums, and the ids and lengths of its documents. So files can be read from any store, split anywhere and decoded in
parallel by segment or by block, and each task holds one segment (or one longer document) at a time.

Order: segments by (part, segment), documents by ``doc_id``, null first; rows of one id by a hash of the text.

Strings of special tokens in a text become these tokens, as the library does by default.

Nulls and odd input: a null or empty text is the end id alone. A null id is kept as null and comes first. Repeated rows
are written as often as they occur. Extra columns are not written. An empty table gives an empty file.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subspan.llm import rans
from subspan.llm.registry import query
from subspan.llm.tables import new_path, table
from subspan.llm.tokens import encoder, tokenizer_json
from subspan.llm.words import slices

SEGMENT = 1 << 22  # ids after which a segment ends
TEXT = 8 << 20  # bytes of text that are encoded at a time
END_ID = 0
_FILE = (
    "part int, segment int, n_ids long, symbols binary, freqs binary, "
    "blocks array<struct<n_ids:int,states:binary,words:binary,crc32:long>>, doc_ids array<long>, lengths array<long>"
)
_BLOCKS = pa.list_(
    pa.struct([("n_ids", pa.int32()), ("states", pa.binary()), ("words", pa.binary()), ("crc32", pa.int64())])
)


def _segment_row(part: int, segment: int, parts: list[bytes], doc_ids: list, lengths: list[int], dtype) -> pa.RecordBatch:
    ids = np.frombuffer(b"".join(parts), dtype=dtype)
    symbols, freqs = rans.frequencies(ids)
    blocks = [b._asdict() for b in rans.encode(ids, symbols, freqs)]
    steps = np.diff(symbols.astype("<u4"), prepend=np.uint32(0))
    return pa.RecordBatch.from_arrays(
        [
            pa.array([part], pa.int32()),
            pa.array([segment], pa.int32()),
            pa.array([len(ids)], pa.int64()),
            pa.array([steps.astype("<u4").tobytes()], pa.binary()),
            pa.array([freqs.astype("<u4").tobytes()], pa.binary()),
            pa.array([blocks], _BLOCKS),
            pa.array([doc_ids], pa.list_(pa.int64())),
            pa.array([lengths], pa.list_(pa.int64())),
        ],
        names=["part", "segment", "n_ids", "symbols", "freqs", "blocks", "doc_ids", "lengths"],
    )


def _encoded(content, end_id: int, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(content.value, special=True)
        end = np.array([end_id], dtype=coder.dtype).tobytes()
        part, segment, held = TaskContext.get().partitionId(), 0, 0
        parts, doc_ids, lengths = [], [], []
        for batch in slices(batches, "text", TEXT):
            found = coder.encode(batch.column("text").to_pylist())
            for doc, raw in zip(batch.column("doc_id").to_pylist(), found, strict=True):
                parts += (raw, end)
                doc_ids.append(doc)
                lengths.append((len(raw) + len(end)) // coder.dtype.itemsize)
                held += lengths[-1]
                if held >= size:
                    yield _segment_row(part, segment, parts, doc_ids, lengths, coder.dtype)
                    segment, held, parts, doc_ids, lengths = segment + 1, 0, [], [], []
        if doc_ids:
            yield _segment_row(part, segment, parts, doc_ids, lengths, coder.dtype)

    return run


def write(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = END_ID, size: int = SEGMENT) -> None:
    """Write the token ids of ``docs`` (doc_id, text) below ``path``; ``tokenizer``: a tokenizer file's path."""
    content = docs.sparkSession.sparkContext.broadcast(tokenizer_json(tokenizer))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("spread", F.xxhash64("text"))
    ordered = keyed.repartitionByRange("doc_id", "spread").sortWithinPartitions("doc_id", "spread")
    rows = ordered.select("doc_id", "text").mapInArrow(_encoded(content, end_id, size), _FILE)
    rows.write.option("compression", "zstd").parquet(path)


def _decoded(make, kind: pa.DataType):
    """``make`` gets the ids of a document as numbers of 32 bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                r = {n: batch.column(n)[row] for n in batch.schema.names}
                symbols = np.cumsum(np.frombuffer(r["symbols"].as_py(), dtype="<u4"), dtype=np.uint32)
                freqs = np.frombuffer(r["freqs"].as_py(), dtype="<u4").astype(np.int64)
                blocks = [rans.Block(**b) for b in r["blocks"].as_py()]
                ids = rans.decode(blocks, symbols, freqs).astype("<u4")
                lengths = r["lengths"].values.to_numpy()
                ends = np.cumsum(lengths)
                if int(ends[-1]) != len(ids):
                    raise ValueError("the documents' lengths differ from the segment's")
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        r["doc_ids"].values,
                        pa.array(np.full(n, r["part"].as_py()), pa.int32()),
                        pa.array(np.full(n, r["segment"].as_py()), pa.int32()),
                        pa.array(ends - lengths),
                        r["lengths"].values,
                        pa.array([make(ids[e - k : e]) for e, k in zip(ends.tolist(), lengths.tolist(), strict=True)], kind),
                    ],
                    names=["doc_id", "part", "segment", "inside", "n_tokens", "made"],
                )

    return run


def read(spark: SparkSession, path: str, digest: bool = False) -> DataFrame:
    """The documents of the files: doc_id, start, n_tokens, and ``ids`` or, as a digest, ``ids_crc32``."""
    segments = spark.read.schema(_FILE).parquet(path)
    made = ("ids_crc32", "long") if digest else ("ids", "array<long>")
    decoded = segments.mapInArrow(
        _decoded((lambda ids: zlib.crc32(ids.tobytes())) if digest else (lambda ids: ids), pa.int64() if digest else pa.list_(pa.int64())),
        f"doc_id long, part int, segment int, inside long, n_tokens long, made {made[1]}",
    )
    sizes = segments.select("part", "segment", "n_ids")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row a part
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("n")).select("part", F.sum("n").over(before).alias("base"))
    within = Window.partitionBy("part").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", "segment", F.sum("n_ids").over(within).alias("own")).join(parts, "part")
    starts = starts.select("part", "segment", (F.coalesce("base", F.lit(0)) + F.coalesce("own", F.lit(0))).alias("first"))
    return decoded.join(starts, ["part", "segment"]).select(
        "doc_id", (F.col("first") + F.col("inside")).alias("start"), "n_tokens", F.col("made").alias(made[0])
    )


def round_trip(docs: DataFrame, name: str = "tokens") -> DataFrame:
    """Write the documents' ids to new files in the shared folder and read them back as digests."""
    spark = docs.sparkSession
    path = new_path(spark, name)
    write(docs, path)
    return read(spark, path, digest=True)


@query("op10_token_output")
def op10_token_output(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(table(spark, folder, "documents"))
