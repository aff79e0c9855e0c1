"""Signup funnel and acquisition mart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subspan.functions.columns import month_start, ratio

ACTIVATION_EVENT = "workspace_created"
ACTIVATION_DAYS = 7


def fct_account_funnel(
    accounts: DataFrame, opportunities: DataFrame, product_events: DataFrame, calendar: DataFrame
) -> DataFrame:
    """Lifecycle milestones per account; activation within seven days of signup.

    Events shrink to one row per account and day before they meet the accounts, so an account
    with a third of all events brings no more rows to the join than it has active days. Every
    join below hashes on ``account_id``.
    """
    first_of_day = (
        product_events.where(F.col("event_name") == ACTIVATION_EVENT)
        .groupBy("account_id", "date_day")
        .agg(F.min("occurred_at").alias("occurred_at"))
    )
    activated = (
        accounts.select("account_id", "signup_date")
        .join(first_of_day, "account_id")
        .where(
            (F.col("date_day") >= F.col("signup_date"))
            & (F.col("date_day") < F.date_add("signup_date", ACTIVATION_DAYS))
        )
        .groupBy("account_id")
        .agg(F.min("occurred_at").alias("activation_at"))
    )
    last_day = calendar.agg(F.max("date_day")).scalar()

    def flag(condition):
        return F.when(condition, 1).otherwise(0)

    return (
        accounts.select("account_id", "signup_date")
        .join(opportunities, "account_id", "left")
        .join(activated, "account_id", "left")
        .select(
            "account_id",
            "signup_date",
            "trial_date",
            "qualified_date",
            "paid_date",
            F.col("activation_at").cast("date").alias("activation_date"),
            flag(F.date_add("signup_date", ACTIVATION_DAYS) <= last_day).alias("activation_eligible"),
            flag(F.col("activation_at").isNotNull()).alias("activated"),
            flag(F.col("qualified_date").isNotNull()).alias("qualified"),
            flag(F.col("paid_date").isNotNull()).alias("converted"),
        )
    )


def spend_cents(spend: str = "spend") -> Column:
    """Exact cents of a spend column, so that sums do not depend on row order."""
    return F.round(F.col(spend) * 100).cast("bigint")


def mart_acquisition(funnel: DataFrame, accounts: DataFrame, marketing_spend: DataFrame) -> DataFrame:
    """M5: month x channel of spend, with the eventual results of the accounts signed up there."""
    signups = (
        funnel.join(accounts.select("account_id", "channel"), "account_id")
        .groupBy(month_start("signup_date").alias("month"), "channel")
        .agg(
            F.count(F.lit(1)).alias("signups"),
            F.sum("qualified").alias("qualified"),
            F.sum("converted").alias("paid_accounts"),
            F.sum("activation_eligible").alias("eligible_accounts"),
            F.sum(F.col("activated") * F.col("activation_eligible")).alias("activated_accounts"),
        )
    )
    spend = (
        marketing_spend.groupBy(month_start("date_day").alias("month"), "channel")
        .agg((F.sum(spend_cents()).cast("double") / 100).alias("spend"))
    )
    counts = ("signups", "qualified", "paid_accounts", "activated_accounts", "eligible_accounts")
    return spend.join(signups, ["month", "channel"], "left").select(
        "month",
        "channel",
        "spend",
        *(F.coalesce(c, F.lit(0)).alias(c) for c in counts),
        ratio("paid_accounts", "signups").alias("conversion_rate"),
        ratio("activated_accounts", "eligible_accounts").alias("activation_rate"),
        ratio("spend", "paid_accounts").alias("cohort_acquisition_cost"),
    )
