"""Product usage: the reusable usage base and the product, feature and cohort marts (M2-M4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from subspan.functions.columns import day_bit, mask_days, mask_union, months_apart, ratio
from subspan.operators.staging import calendar_months

# The features the adoption mart reports.
FEATURES = ("report_created", "export", "automation", "invite_sent")


def usage_base(product_events: DataFrame) -> DataFrame:
    """Month x user x account x event name with the set of active days as a 31-bit mask.

    Every product metric derives from this frame. Its aggregation combines map-side: however many events a hot account or user has, a task sends
    at most one row per key onward. User and account keys stay, so distinct counts stay exact.
    """
    return product_events.groupBy("month", "user_id", "account_id", "event_name").agg(
        mask_union(day_bit("date_day")).alias("day_mask")
    )


def calendar_masks(calendar: DataFrame) -> DataFrame:
    """One row per month: which of its days the calendar has, and how many."""
    return calendar.groupBy("month").agg(
        mask_union(day_bit("date_day")).alias("calendar_mask"),
        F.count(F.lit(1)).alias("calendar_days"),
    )


def mart_product_monthly(usage: DataFrame, calendar: DataFrame) -> DataFrame:
    """M2. Summed over a month, daily active users equal the users' active days, so the daily
    level needs neither a join with every event nor a distinct count."""
    months = calendar_masks(calendar)
    # Users and accounts are counted by one aggregation, so the usage behind them is computed once.
    who = F.array(
        F.struct(F.lit(True).alias("is_user"), F.col("user_id").alias("id")),
        F.struct(F.lit(False).alias("is_user"), F.col("account_id").alias("id")),
    )
    is_user = F.col("is_user")
    active = (
        usage.select("month", "day_mask", F.inline(who))
        .groupBy("month", "is_user", "id")
        .agg(mask_union("day_mask").alias("days"))
        # calendar_masks has one row per calendar month, so it is safe to broadcast at any scale.
        .join(F.broadcast(months.select("month", "calendar_mask")), "month")
        .groupBy("month")
        .agg(
            F.count_if(is_user).alias("mau"),
            F.sum(F.when(is_user, mask_days(F.col("days").bitwiseAND(F.col("calendar_mask"))))).alias("user_days"),
            F.count_if(~is_user).alias("active_accounts"),
        )
    )
    average_dau = F.coalesce("user_days", F.lit(0)).cast("double") / F.col("calendar_days")
    return (
        months.join(active, "month", "left")
        .select(
            "month",
            average_dau.alias("average_dau"),
            F.coalesce("mau", F.lit(0)).alias("mau"),
            F.coalesce("active_accounts", F.lit(0)).alias("active_accounts"),
            ratio(average_dau, "mau").alias("stickiness"),
        )
    )


def mart_feature_adoption(usage: DataFrame, product_monthly: DataFrame) -> DataFrame:
    """M3: four fixed features for every calendar month, zeros included."""
    counts = (
        usage.where(F.col("event_name").isin(*FEATURES))
        .select("month", "event_name", "user_id")
        .distinct()
        .groupBy("month", F.col("event_name").alias("feature"))
        .agg(F.count(F.lit(1)).alias("feature_users"))
    )
    users = F.coalesce("feature_users", F.lit(0))
    return (
        product_monthly.select("month", "mau", F.explode(F.array(*map(F.lit, FEATURES))).alias("feature"))
        .join(counts, ["month", "feature"], "left")
        .select("month", "feature", users.alias("feature_users"), "mau", ratio(users, "mau").alias("adoption_rate"))
    )


def mart_cohort_retention(accounts: DataFrame, calendar: DataFrame, usage: DataFrame) -> DataFrame:
    """M4: share of each signup cohort with any activity in each month from the cohort on.

    Cohort sizes and activity are counted first; only the small cohort x month grid is unfolded,
    never accounts x months.
    """
    active = (
        usage.select("account_id", "month")
        .distinct()
        .join(accounts.select("account_id", "cohort_month"), "account_id")
        .groupBy("cohort_month", "month")
        .agg(F.count(F.lit(1)).alias("active"))
    )
    grid = (
        accounts.groupBy("cohort_month")
        .agg(F.count(F.lit(1)).alias("cohort_accounts"))
        .withColumn("months", calendar_months(calendar).scalar())
        .withColumn("month", F.explode(F.filter("months", lambda m: m >= F.col("cohort_month"))))
    )
    retained = F.coalesce("active", F.lit(0))
    return grid.join(active, ["cohort_month", "month"], "left").select(
        "cohort_month",
        "month",
        months_apart("cohort_month", "month").alias("cohort_age"),
        "cohort_accounts",
        retained.alias("retained_accounts"),
        ratio(retained, "cohort_accounts").alias("retention_rate"),
    )
