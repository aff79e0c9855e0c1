"""Dense rank over groups too large for one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Distinct values one task ranks at most: a bucket spans this many consecutive integers.
BUCKET_WIDTH = 1 << 20


def dense_rank_desc(df: DataFrame, group: list[str], coarse: str, fine: Column, output: str) -> DataFrame:
    """``dense_rank() over (partition by group order by coarse desc nulls last, fine desc)``.

    ``coarse`` must have few distinct values per group and ``fine`` must be an integer, not null.
    A plain window would sort a whole group, here a whole month of accounts, in one task. Instead
    only the distinct ordering values are ranked, inside buckets of ``BUCKET_WIDTH`` consecutive
    integers, which bounds what a task sorts; bucket totals give each bucket its offset. The ranks
    return to the rows with an equi join, which adaptive execution splits when a value is hot.
    """
    rows = df.withColumn("_fine", fine)
    bucket = group + [coarse, "_bucket"]
    values = rows.select(*group, coarse, "_fine").distinct().withColumn(
        "_bucket", F.floor(F.col("_fine") / BUCKET_WIDTH)
    )
    within = Window.partitionBy(*bucket).orderBy(F.col("_fine").desc())
    earlier = (
        Window.partitionBy(*group)
        .orderBy(F.col(coarse).desc_nulls_last(), F.col("_bucket").desc())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        values.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("_size"))
        .withColumn("_offset", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
    )
    ranked = values.withColumn("_rank", F.row_number().over(within))
    ranks = _join_null_safe(ranked, offsets.drop("_size"), bucket).select(
        *group, coarse, "_fine", (F.col("_rank") + F.col("_offset")).alias(output)
    )
    return _join_null_safe(rows, ranks, group + [coarse, "_fine"]).drop("_fine")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return left.join(renamed, condition).drop(*(f"_r_{k}" for k in keys))
