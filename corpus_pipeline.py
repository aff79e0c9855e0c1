"""A training corpus from ``documents``: quality, near duplicates, contamination, mixture, token files.

Each stage takes (spark, docs, folder), works on every row that its predecessor kept and returns a frame, which is written
as Parquet and read again before the next one begins. All but the last return the columns of ``docs``, whatever else their names are.

Rows without id can't be compared or repeated by id: near-duplicate removal keeps them. Of rows with one id, which are one
document, it keeps one. Documents without words go in the first stage. Empty tables pass through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subspan.llm import op1_quality, op3_minhash, op4_mix, op5_decontaminate, op10_token_output
from subspan.llm.learning import fold
from subspan.llm.tables import named, numbered, stored, table
from subspan.session import tune


def _name(docs: DataFrame, column: str) -> str:
    """What ``numbered`` calls a column."""
    return numbered(docs).columns[[c.lower() for c in docs.columns].index(column)]


def quality(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the quality classifier accepts."""
    tune(spark)
    net = op1_quality.learned(docs.select("doc_id", "text"), table(spark, folder, "labels"), ~fold("doc_id", 4, 2))
    judged = op1_quality.scored(numbered(docs), net, text=_name(docs, "text"), name="quality")
    return named(judged.where(F.col("quality") >= op1_quality.THRESHOLD), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near duplicates: shingles of five words, similarity 0.8."""
    tune(spark)
    found = op3_minhash.near_duplicates(docs, size=5, percent=80)
    kept = found.where("kept").select(F.col("doc_id").alias("kept")).distinct()
    rows, doc_id, text = numbered(docs), _name(docs, "doc_id"), _name(docs, "text")
    one = Window.partitionBy(doc_id).orderBy(F.xxhash64(text), text)
    some = rows.join(kept, F.col(doc_id) == F.col("kept"), "left_semi").withColumn("row", F.row_number().over(one))
    return named(some.where("row = 1").drop("row").union(rows.where(F.col(doc_id).isNull())), docs)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that hold no benchmark passage to speak of."""
    return op5_decontaminate.remove_documents(docs, table(tune(spark), folder, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The documents that the mix of sources takes, each as often as it does."""
    tune(spark)
    return op4_mix.mixed(docs)


def token_files(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The mix as token files; a row for each document read back from them."""
    tune(spark)
    return op10_token_output.round_trip(docs)


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_files", token_files),
]

# The first stage is a trained model and the last a tokenizer; neither has SQL. tests/llm has brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(tune(spark), sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
