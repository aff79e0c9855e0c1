"""Mart exports, their typed re-read and the latest-month summary."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The fields of the summary, in its order.
REVENUE_FIELDS = (
    "month",
    "mrr",
    "beginning_mrr",
    "new_mrr",
    "reactivation_mrr",
    "expansion_mrr",
    "contraction_mrr",
    "churn_mrr",
    "paying_accounts",
    "beginning_accounts",
    "churned_accounts",
    "arr",
    "nrr",
    "grr",
    "logo_churn_rate",
    "arpa",
    "modeled_ltv",
)
PRODUCT_FIELDS = ("month", "average_dau", "mau", "active_accounts", "stickiness")


def export_csv(marts: Mapping[str, DataFrame], folder: str) -> None:
    """Every mart as CSV with a header, written by the executors."""
    for name, df in marts.items():
        df.write.mode("overwrite").option("header", True).csv(f"{folder}/{name}")


def read_export(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """An exported table back with its types; empty text is null before any cast.

    Everything is read as text first: the CSV reader's own typing would turn a malformed value
    into a silent null, while a cast raises on it.
    """
    text = StructType([StructField(f.name, StringType()) for f in schema.fields])
    rows = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return rows.select(
        *(F.nullif(F.col(f.name), F.lit("")).cast(f.dataType).alias(f.name) for f in schema.fields)
    )


def latest_summary(
    accounts: DataFrame, product_events: DataFrame, revenue_monthly: DataFrame, product_monthly: DataFrame
) -> DataFrame:
    """One row with the account and event counts and the latest month of both marts."""

    def latest(df: DataFrame, fields: tuple[str, ...], prefix: str):
        newest = df.agg(F.max_by(F.struct(*fields), "month").alias("row"))
        return newest.select(F.struct(*(F.col(f"row.{f}").alias(f"{prefix}_{f}") for f in fields)).alias("row"))

    one = accounts.sparkSession.range(1)
    return one.select(
        accounts.agg(F.count(F.lit(1))).scalar().alias("accounts"),
        product_events.agg(F.count(F.lit(1))).scalar().alias("events"),
        latest(revenue_monthly, REVENUE_FIELDS, "revenue").scalar().alias("revenue"),
        latest(product_monthly, PRODUCT_FIELDS, "product").scalar().alias("product"),
    ).select(F.col("revenue.revenue_month").alias("latest_month"), "accounts", "events", "revenue.*", "product.*")


def write_summary(summary: DataFrame, path: str) -> None:
    summary.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(path)
