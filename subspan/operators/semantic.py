"""Operators on top of measure queries: periods, metric choice, row filter, drill-through."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from subspan.functions.columns import ratio
from subspan.operators.measures import DATE_COLUMNS, PERIOD, Star, measure_query

# The metrics of the selector, in its order.
SELECTABLE = ("mrr", "arr", "nrr", "mau")


def _two_periods(calendar: DataFrame, shown: Column | None) -> DataFrame:
    """The shown days, and the days of the month before each shown month as that month sees them: a day bears the year and month number of the
    month after its own. ``month`` stays the day's own, since facts meet it."""
    current = calendar if shown is None else calendar.where(shown)
    after = F.add_months("month", 1)
    months = current.select(F.add_months("month", -1).alias("_before")).distinct()
    before = calendar.join(months, F.col("month") == F.col("_before"), "left_semi")  # Spark sees that months are few
    before = before.withColumns({"year": F.year(after), "month_number": F.month(after)})
    return current.withColumn(PERIOD, F.lit(0)).unionByName(before.withColumn(PERIOD, F.lit(1)))


def period_comparison(star: Star, measure: str, by: Iterable[str] = ("month",), **filters: Column) -> DataFrame:
    """A measure's current value, its value one month earlier and the relative change.

    The earlier value of a group is the measure over the group's months moved back by one, within the calendar. So a year's
    is that of December to November, and without date columns all shown months move. A date filter says which months are
    shown; the month before may lie outside of it. Months move whole, so single days can't be compared.

    One measure query gives both: a day is in its own period and, moved, in the next one, and the period is one more column of the grouping.
    """
    by = list(by)
    if "date_day" in by:
        raise ValueError("periods are whole months: group by month, month_number or year")
    shown = filters.pop("dates", None)
    dated = [c for c in by if c in DATE_COLUMNS]
    days = _two_periods(star.calendar, shown)
    # Facts outside the calendar have no period, but count in a total that no date limits.
    within = F.lit(True) if dated or shown is not None else F.col(PERIOD) == 1
    found = measure_query(star, [measure], [*by, PERIOD], dates=within, days=days, **filters)
    if "month" in by:
        found = found.withColumn("month", F.when(F.col(PERIOD) == 1, F.add_months("month", 1)).otherwise(F.col("month")))
    if not dated and shown is None:
        total = measure_query(star, [measure], by, **filters).withColumn(PERIOD, F.lit(0))
        found = found.unionByName(total)
    periods = {"current": 0, "previous_month": 1}
    both = found.groupBy(*by).agg(*(F.max(F.when(F.col(PERIOD) == k, F.col(measure))).alias(name) for name, k in periods.items()))
    value, before = F.col("current"), F.col("previous_month")
    change = ratio(F.coalesce(value, F.lit(0)) - before, before)
    return both.select(*by, *periods, change.alias("mom_change"))


def metric_selector(star: Star, by: Iterable[str] = ("month",), metrics: Iterable[str] = SELECTABLE, **filters) -> DataFrame:
    """The selectable metrics in long form (metric, position, value)."""
    by, metrics = list(by), list(metrics)
    wide = measure_query(star, metrics, by, **filters)
    rows = F.array(
        *(
            F.struct(
                F.lit(m.upper()).alias("metric"),
                F.lit(SELECTABLE.index(m)).alias("position"),
                F.col(m).cast("double").alias("value"),
            )
            for m in metrics
        )
    )
    return wide.select(*by, F.inline(rows)).where(F.col("value").isNotNull())


def restrict_to_user(star: Star, entitlements: DataFrame, user: str) -> Star:
    """E5: the star as one user may see it: accounts of the user's regions, their facts, no spend.

    An unknown user has no regions and sees nothing.
    """
    regions = entitlements.where(F.col("upn") == user).select("region").distinct()
    account = star.account.join(regions, "region", "left_semi")
    visible = account.select("account_id")
    return replace(
        star,
        account=account,
        revenue=star.revenue.join(visible, "account_id", "left_semi"),
        usage=star.usage.join(visible, "account_id", "left_semi"),
        funnel=star.funnel.join(visible, "account_id", "left_semi"),
        marketing=star.marketing.where(F.lit(False)),
    )


def drill_through(star: Star, account_id: str, measures: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """Measures of one account. The filter reaches every fact scan, not just the dimension."""
    only = F.col("account_id") == account_id
    one = replace(
        star, revenue=star.revenue.where(only), usage=star.usage.where(only), funnel=star.funnel.where(only)
    )
    return measure_query(one, measures, by, accounts=only)


def cohort_matrix(retention: DataFrame, cohorts: int = 9, ages: int = 9) -> DataFrame:
    """Retention of the latest cohorts, one column per age in months; blank if unobserved."""
    latest = retention.select("cohort_month").distinct().orderBy(F.col("cohort_month").desc()).limit(cohorts)
    return (
        retention.where(F.col("cohort_age") < ages)
        .join(F.broadcast(latest), "cohort_month", "left_semi")
        .groupBy("cohort_month")
        .pivot("cohort_age", list(range(ages)))
        .agg(F.max("retention_rate"))
        .withColumnsRenamed({str(i): f"m{i}" for i in range(ages)})
    )
