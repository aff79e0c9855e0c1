"""Account-month balances, movement classes and the monthly revenue mart."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from subspan.functions.columns import MONEY, money_sum, monthly_balance, ratio
from subspan.operators.staging import calendar_months

MOVEMENTS = ("new_mrr", "reactivation_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr")
FLAGS = {
    "paying_account": "paying_accounts",
    "beginning_account": "beginning_accounts",
    "churned_account": "churned_accounts",
}
GROSS_MARGIN = 0.8  # fixed value: assumed share of revenue left after serving cost
LTV_MONTHS = 3


def account_month_balances(accounts: DataFrame, calendar: DataFrame, subscriptions: DataFrame) -> DataFrame:
    """One row per account and calendar month from its cohort month on, zeros included.

    The dense grid (accounts x months) is by far the largest frame here, so it is produced last.
    Accounts and billing rows meet on ``account_id`` while still sparse, one window looks at the
    neighbouring billing rows, and only then does each billing row unfold into its own month plus
    the months without billing around it. The dense rows are never shuffled or sorted.
    """
    zero = F.lit(0).cast(MONEY)
    months = calendar_months(calendar).scalar()
    # Months travel as their position in the calendar, one int instead of a date array per row.
    grid = (
        accounts.select("account_id", "cohort_month", months.alias("_months"))
        .select(
            "account_id",
            (F.size(F.filter("_months", lambda m: m < F.col("cohort_month"))) + 1).alias("_first"),
            F.size("_months").alias("_last"),
        )
        .where(F.col("_first") <= F.col("_last"))
    )
    billing = subscriptions.select(
        F.col("account_id").alias("_payer"),
        F.array_position(months, F.col("month")).cast("int").alias("_at"),
        monthly_balance("amount_cents", "billing_period").alias("_mrr"),
    )
    # Billing outside the account's months (position 0 or before its first) has no place in the
    # grid and drops out here; the account itself stays.
    sparse = grid.join(
        billing, (F.col("account_id") == F.col("_payer")) & (F.col("_at") >= F.col("_first")), "left"
    )

    by_month = Window.partitionBy("account_id").orderBy("_at")
    spans = sparse.select(
        "account_id",
        "_first",
        "_at",
        "_mrr",
        F.lag("_at").over(by_month).alias("_prior_at"),
        F.lag("_mrr").over(by_month).alias("_prior_mrr"),
        F.coalesce(
            F.max("_mrr").over(by_month.rowsBetween(Window.unboundedPreceding, -1)), zero
        ).alias("_highest"),
        F.coalesce(F.lead("_at").over(by_month) - 1, "_last").alias("_until"),
    )
    # A row covers its own month and the empty ones up to the next billing row. The account's
    # first row also covers the empty ones before it, and an account without billing covers all.
    start = F.when(F.col("_prior_at").isNull(), F.col("_first")).otherwise(F.col("_at"))
    covered = F.sequence(start, F.greatest("_until", "_at", start))
    at, position = F.col("_at"), F.col("_position")
    return (
        spans.withColumn("_position", F.explode(covered))
        .select(
            "account_id",
            F.element_at(months, position).alias("month"),
            F.when(position == at, F.col("_mrr")).otherwise(zero).alias("mrr"),
            F.when((position == at) & (F.col("_prior_at") >= at - 1), F.col("_prior_mrr"))
            .when(position == at + 1, F.col("_mrr"))
            .otherwise(zero)
            .alias("beginning_mrr"),
            F.when(position == at, F.col("_highest"))
            .when(position > at, F.greatest("_highest", "_mrr"))
            .otherwise(zero)
            .alias("historical_mrr"),
        )
    )


def fct_account_month(balances: DataFrame) -> DataFrame:
    """Split each balance change into exactly one movement class."""
    now, before, ever = F.col("mrr"), F.col("beginning_mrr"), F.col("historical_mrr")
    started = (before == 0) & (now > 0)

    def amount(condition, value):
        return F.when(condition, value).otherwise(0).cast(MONEY)

    def flag(condition):
        return F.when(condition, 1).otherwise(0)

    return balances.select(
        "account_id",
        "month",
        "mrr",
        "beginning_mrr",
        amount(started & (ever == 0), now).alias("new_mrr"),
        amount(started & (ever > 0), now).alias("reactivation_mrr"),
        amount((before > 0) & (now > before), now - before).alias("expansion_mrr"),
        amount((now > 0) & (now < before), before - now).alias("contraction_mrr"),
        amount((before > 0) & (now == 0), before).alias("churn_mrr"),
        flag(now > 0).alias("paying_account"),
        flag(before > 0).alias("beginning_account"),
        flag((before > 0) & (now == 0)).alias("churned_account"),
    )


def mart_revenue_monthly(account_month: DataFrame) -> DataFrame:
    """M1. The trailing window sees one row per month, after all aggregation."""
    monthly = account_month.groupBy("month").agg(
        *(money_sum(c).alias(c) for c in ("mrr", "beginning_mrr", *MOVEMENTS)),
        *(F.sum(flag).alias(total) for flag, total in FLAGS.items()),
    )
    trailing = Window.orderBy("month").rowsBetween(1 - LTV_MONTHS, Window.currentRow)
    kept = F.col("beginning_mrr") - F.col("contraction_mrr") - F.col("churn_mrr")
    churn_rate = ratio(F.sum("churned_accounts").over(trailing), F.sum("beginning_accounts").over(trailing))
    arpa = ratio("mrr", "paying_accounts")
    return monthly.select(
        "*",
        (F.col("mrr") * 12).cast("decimal(28,2)").alias("arr"),
        ratio(kept + F.col("expansion_mrr"), "beginning_mrr").alias("nrr"),
        ratio(kept, "beginning_mrr").alias("grr"),
        ratio("churned_accounts", "beginning_accounts").alias("logo_churn_rate"),
        arpa.alias("arpa"),
        ratio(arpa * GROSS_MARGIN, churn_rate).alias("modeled_ltv"),
    )
