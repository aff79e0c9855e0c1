"""Language ID (7): compression with one raw-content dictionary a language; the smallest result names the language.

A dictionary is sample text of one language, from about ``ROWS`` labelled rows a language (a bound whatever the table's size; the sample is
those of smallest id hash). The rows are taken whole, in the order of the hash, as far as they fit into ``DICTIONARY`` bytes; one that doesn't is
passed over, and where none fits the smallest is the dictionary. A text is lower-cased, everything but letters and digits between them becomes one space, and pieces of ``PIECE`` characters are compressed with every dictionary. A text's size under
a language is the sum over all its pieces, so long texts are used whole and count with all that they hold.

``predicted`` gives the smallest language, the share ``score`` of its likelihood 2**-bits among all languages, the relative
``margin`` to the second, and ``rejected`` where that is narrower than ``MARGIN``.

Nulls and odd input: a text that is null or has no letter is ``und`` with score 0 and rejected; so is every text when nothing
was learned. A language whose sample has fewer than ``LEAST`` bytes of letters has no dictionary and is never predicted. Ties go to the language that sorts first. Rows without id or language are not learned from. Null ids and
repeated rows are kept; extra columns pass through, but the names that are added must be free.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from subspan.llm.learning import fitting, fold, texts_of
from subspan.llm.registry import query
from subspan.llm.tables import table
from subspan.llm.words import slices

ROWS, DICTIONARY = 300, 128 << 10  # sampled rows a language, bytes of a dictionary
LEAST = 8
PIECE, LEVEL, MARGIN = 4096, 3, 0.01
UNKNOWN = "und"
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def cleaned(text: str | None) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""


def dictionaries(labelled: DataFrame, rows: int = ROWS, size: int = DICTIONARY) -> dict[str, bytes]:
    """Sample text of each language from ``labelled`` (doc_id, text, lang)."""
    usable = labelled.where("lang is not null and doc_id is not null and text is not null")
    counts = {r["lang"]: r["n"] for r in usable.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    # A row's hash share must be below rows / count of its language: one read gives all samples.
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    bound = F.create_map(*[F.lit(x) for lang, n in counts.items() for x in (lang, rows / n)])[F.col("lang")] if counts else F.lit(0.0)
    drawn = usable.where(share < bound).select("lang", share.alias("share"), "doc_id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("hash"))
    own: dict[str, list] = {}
    for r in sorted(drawn.collect(), key=lambda r: (r["lang"], r["share"], r["doc_id"], r["hash"])):
        own.setdefault(r["lang"], []).append(r)
    taken = {}
    for lang, its in own.items():
        sizes = [r["size"] for r in its]
        taken[lang] = [its[k] for k in fitting(sizes, size) or [sizes.index(min(sizes))]]
    texts = texts_of(usable, sorted({(r["doc_id"], r["hash"]) for its in taken.values() for r in its}))
    return {lang: " ".join(cleaned(texts[r["doc_id"], r["hash"]]) for r in its).encode() for lang, its in taken.items()}


class Compressors:
    def __init__(self, contents: dict[str, bytes], level: int = LEVEL) -> None:
        self.languages = sorted(lang for lang, content in contents.items() if len(content) >= LEAST)
        self.each = []
        for lang in self.languages:
            words = zstandard.ZstdCompressionDict(contents[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            words.precompute_compress(level=level)
            plain = {"write_checksum": False, "write_content_size": False, "write_dict_id": False}
            self.each.append(zstandard.ZstdCompressor(level=level, dict_data=words, **plain))

    def sizes(self, text: str) -> list[int]:
        """Compressed bytes of the whole text under each language."""
        total = [0] * len(self.each)
        for at in range(0, len(text), PIECE):
            piece = text[at : at + PIECE].encode()
            for k, c in enumerate(self.each):
                total[k] += len(c.compress(piece))
        return total

    def judge(self, text: str | None) -> tuple[str, float, float]:
        """Language, score and margin."""
        words = cleaned(text)
        if not self.each or not any(c.isalpha() for c in words):
            return UNKNOWN, 0.0, 0.0
        sizes = self.sizes(words)
        best = min(sizes)
        at = sizes.index(best)
        second = min(sizes[:at] + sizes[at + 1 :], default=best)
        score = 1.0 / sum(2.0 ** max(8 * (best - s), -1000) for s in sizes)
        return self.languages[at], score, (second - best) / max(second, 1)


def _judged(contents, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by = Compressors(contents.value)
        for batch in slices(batches, text):
            found = [by.judge(t) for t in batch.column(text).to_pylist()]
            added = {
                "lang_pred": pa.array([f[0] for f in found], pa.string()),
                "score": pa.array([f[1] for f in found], pa.float64()),
                "margin": pa.array([f[2] for f in found], pa.float64()),
            }
            yield pa.RecordBatch.from_arrays([*batch.columns, *added.values()], names=[*batch.schema.names, *added])

    return run


def predicted(docs: DataFrame, contents: dict[str, bytes], text: str = "text", margin: float = MARGIN) -> DataFrame:
    """``docs`` with lang_pred, score, margin and rejected."""
    taken = {"lang_pred", "score", "margin", "rejected"} & {c.lower() for c in docs.columns}
    if taken:
        raise ValueError(f"documents already have {sorted(taken)}")
    shared = docs.sparkSession.sparkContext.broadcast(contents)
    schema = T.StructType([*docs.schema.fields, *T.StructType.fromDDL("lang_pred string, score double, margin double").fields])
    return docs.mapInArrow(_judged(shared, text), schema).withColumn("rejected", F.col("margin") < margin)


@query("op7_language_id")
def op7_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    learned = dictionaries(docs.select("doc_id", "text", "lang").where(~fold("doc_id", 3, 1)))
    judged = predicted(docs.select("doc_id", "text"), learned)
    return judged.select("doc_id", fold("doc_id", 3, 1).alias("held_out"), "lang_pred", "score", "margin", "rejected")
