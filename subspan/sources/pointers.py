"""Append-only logs whose last entry says which folders count.

One small file appears per change, in one step, so readers see the earlier state or the new one.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F

from subspan.sources import files

LOG = "seq bigint, value string"


def entries(spark: SparkSession, log: str, n: int) -> list[Row]:
    """The last ``n`` entries, newest first."""
    if not files.exists(spark, log):
        return []
    return spark.read.schema(LOG).json(log).orderBy(F.col("seq").desc()).take(n)


def last(spark: SparkSession, log: str) -> Row | None:
    return next(iter(entries(spark, log, 1)), None)


def point(spark: SparkSession, log: str, value: str) -> None:
    before = last(spark, log)
    row = [((before["seq"] + 1) if before else 0, value)]
    spark.createDataFrame(row, LOG).coalesce(1).write.mode("append").json(log)


def sweep(spark: SparkSession, path: str, kept: Iterable[str]) -> None:
    """Remove the folders of runs and versions that are no longer named."""
    kept = set(kept)
    for name in files.children(spark, path):
        if name.removeprefix("run=") not in kept:
            files.remove(spark, f"{path}/{name}")
