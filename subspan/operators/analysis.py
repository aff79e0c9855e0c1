"""Analyst queries (A1-A3)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subspan.functions.columns import mask_days, mask_union, money_sum, ratio
from subspan.operators.ranking import dense_rank_desc
from subspan.operators.staging import calendar_months


def revenue_bridge(account_month: DataFrame, accounts: DataFrame) -> DataFrame:
    """A1: opening to closing balance per month and segment; the residual must be zero."""
    opening, closing = F.col("beginning_mrr"), F.col("mrr")
    gained = F.col("new_mrr") + F.col("expansion_mrr") + F.col("reactivation_mrr")
    lost = F.col("contraction_mrr") + F.col("churn_mrr")
    residual = closing - (opening + gained - lost)
    parts = {
        "opening": "beginning_mrr",
        "new": "new_mrr",
        "expansion": "expansion_mrr",
        "reactivation": "reactivation_mrr",
        "contraction": "contraction_mrr",
        "churn": "churn_mrr",
        "closing": "mrr",
    }
    return (
        account_month.join(accounts.select("account_id", "segment"), "account_id")
        .groupBy("month", "segment")
        .agg(*(money_sum(c).alias(name) for name, c in parts.items()), money_sum(residual).alias("residual"))
        .orderBy("month", "segment")
    )


def _following_month(calendar: DataFrame, month: str = "month") -> Column:
    """The next month the calendar has, or NULL after the last one."""
    months = calendar_months(calendar).scalar()
    at = F.array_position(months, F.col(month)).cast("int")
    return F.when(at > 0, F.try_element_at(months, at + 1))


def expansion_drivers(account_month: DataFrame, product_events: DataFrame, calendar: DataFrame) -> DataFrame:
    """A2: how often paying accounts expand, by automation use in the month before.

    Only rows with an opening balance count, and such a row always has a month before it, so
    last month's flag is joined by moving usage one calendar month forward. The dense
    account-month fact needs no window for it.
    """
    automation = (
        product_events.where(F.col("event_name") == "automation")
        .groupBy("account_id", "month")
        .agg(F.lit(1).alias("used"))
        .select("account_id", _following_month(calendar).alias("month"), "used")
        .where(F.col("month").isNotNull())
    )
    return (
        account_month.where(F.col("beginning_mrr") > 0)
        .select("account_id", "month", "expansion_mrr")
        .join(automation, ["account_id", "month"], "left")
        .groupBy("month", F.coalesce("used", F.lit(0)).alias("prior_automation"))
        .agg(
            F.count(F.lit(1)).alias("eligible_accounts"),
            F.avg(F.when(F.col("expansion_mrr") > 0, 1.0).otherwise(0.0)).alias("expansion_incidence"),
        )
        .orderBy("month", "prior_automation")
    )


def churn_risk(
    account_month: DataFrame, accounts: DataFrame, usage: DataFrame, calendar: DataFrame, checkpoint: bool = False
) -> DataFrame:
    """A3: paying accounts per month, ranked by how much their activity fell.

    The previous month's active days exist for every month but the account's first, whether or
    not it paid then. The first is the first calendar month from the cohort month on, so the dense fact needs no window, and
    rows without a balance go before any shuffle. Each usage row goes to its own month and, as the earlier value, to the
    following one. Ranking reads its input more than once; with ``checkpoint`` that input is computed once, into the
    session's checkpoint folder, which Spark cleans up.
    """
    active = usage.groupBy("account_id", "month").agg(mask_days(mask_union("day_mask")).alias("days"))
    nothing = F.lit(None).cast("bigint")
    roles = (
        active.select(
            "account_id",
            F.explode(
                F.array(
                    F.struct(F.col("month").alias("month"), F.col("days").alias("now"), nothing.alias("before")),
                    F.struct(_following_month(calendar).alias("month"), nothing.alias("now"), F.col("days").alias("before")),
                )
            ).alias("r"),
        )
        .select("account_id", "r.*")
        .where(F.col("month").isNotNull())
        .groupBy("account_id", "month")
        .agg(F.max("now").alias("now"), F.max("before").alias("before"))
    )
    now = F.coalesce("now", F.lit(0))
    first = F.array_min(F.filter("_months", lambda m: m >= F.col("cohort_month")))
    before = F.when(F.col("month") > F.col("_first"), F.coalesce("before", F.lit(0)))
    started = accounts.select("account_id", "cohort_month", calendar_months(calendar).scalar().alias("_months"))
    started = started.select("account_id", first.alias("_first"))
    momentum = (
        account_month.where(F.col("mrr") > 0)
        .select("account_id", "month", "mrr")
        .join(started, "account_id")
        .join(roles, ["account_id", "month"], "left")
        .select("account_id", "month", "mrr", now.alias("active_days"), before.alias("prior_active_days"))
        .withColumn(
            "activity_decline",
            ratio(F.col("prior_active_days") - F.col("active_days"), "prior_active_days"),
        )
    )
    if checkpoint:
        momentum = momentum.checkpoint()
    # Active days are 0..31, so a month has few distinct declines; balances are whole cents.
    cents = (F.col("mrr") * 100).cast("bigint")
    return dense_rank_desc(momentum, ["month"], "activity_decline", cents, "review_priority").orderBy(
        F.col("month").desc(), "review_priority"
    )
