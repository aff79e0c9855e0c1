"""Staging, dimensions and plain facts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subspan.functions.columns import month_start
from subspan.sources.contracts import CONTRACTS


def staged(name: str, raw: DataFrame) -> DataFrame:
    """The contract's columns and nothing else, so new raw columns never leak through."""
    return raw.select(*CONTRACTS[name].columns)


def latest_events(versions: DataFrame, arrival: str | None = None) -> DataFrame:
    """One row per event id, the one ingested last.

    A tie goes to the version seen first when ``arrival`` names a column with the feed order,
    and otherwise to the smallest row, so that every run picks the same one. ``rank = 1`` lets
    Spark keep one row per id and map task before the shuffle (WindowGroupLimit): an id that is
    replayed billions of times sends only one candidate per task.
    """
    columns = CONTRACTS["events"].columns
    ties = [arrival] if arrival else [c for c in columns if c not in ("event_id", "ingested_at")]
    newest = Window.partitionBy("event_id").orderBy(F.col("ingested_at").desc(), *ties)
    return (
        versions.withColumn("_arrival_rank", F.row_number().over(newest))
        .where(F.col("_arrival_rank") == 1)
        .drop("_arrival_rank")
    )


def stg_events(raw: DataFrame) -> DataFrame:
    return latest_events(staged("events", raw))


def dim_account(accounts: DataFrame) -> DataFrame:
    """T3."""
    return staged("accounts", accounts).withColumn("cohort_month", month_start("signup_date"))


def dim_user(users: DataFrame) -> DataFrame:
    """T4."""
    return staged("users", users)


def dim_date(marketing: DataFrame) -> DataFrame:
    """T5: the calendar is the set of days with marketing rows.

    One row per day, a few hundred a year and at most 3.65 million for all dates there are:
    the one frame that is broadcast without asking its size.
    """
    day = F.col("date_day")
    return (
        marketing.select(F.col("spend_date").alias("date_day"))
        .distinct()
        .select(
            "date_day",
            month_start(day).alias("month"),
            F.year(day).alias("year"),
            F.month(day).alias("month_number"),
        )
    )


def calendar_months(calendar: DataFrame) -> DataFrame:
    """One row, one sorted array of the calendar's months: at most twelve entries a year.

    Used as a scalar subquery, so the per-account month spine needs no join at all.
    """
    return calendar.select("month").distinct().agg(F.sort_array(F.collect_list("month")).alias("months"))


def fct_product_event(events: DataFrame) -> DataFrame:
    """T8; ``events`` is the deduplicated staging frame."""
    return events.select(
        "event_id",
        "user_id",
        "account_id",
        F.col("occurred_at").cast("date").alias("date_day"),
        month_start("occurred_at").alias("month"),
        "occurred_at",
        "event_name",
    )


def fct_marketing_spend(marketing: DataFrame) -> DataFrame:
    """T10."""
    return marketing.select(
        F.col("spend_date").alias("date_day"),
        "channel",
        (F.col("spend_cents").cast("double") / 100).alias("spend"),
    )
