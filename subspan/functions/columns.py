"""Date, money, ratio and day-mask expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"
MONEY_SUM = "decimal(28,2)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(col: Column | str) -> Column:
    return F.trunc(_c(col).cast("date"), "MM")


def months_apart(earlier: Column | str, later: Column | str) -> Column:
    """Number of month boundaries between two dates, as an int."""
    a, b = _c(earlier), _c(later)
    return ((F.year(b) - F.year(a)) * 12 + (F.month(b) - F.month(a))).cast("int")


def monthly_balance(cents: Column | str, billing_period: Column | str) -> Column:
    """Monthly recurring amount of one billing row.

    Annual amounts are divided by twelve and rounded half-up to the cent, in decimals all the
    way: a double in between would turn 1206 yearly cents into 1.00 instead of 1.01.
    """
    per_month = F.when(_c(billing_period) == "annual", 1200).otherwise(100).cast("decimal(4,0)")
    return (_c(cents).cast("decimal(18,0)") / per_month).cast(MONEY)


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; NULL when the denominator is zero or missing."""
    return F.try_divide(_c(numerator).cast("double"), _c(denominator).cast("double"))


def money_sum(col: Column | str) -> Column:
    return F.sum(_c(col)).cast(MONEY_SUM)


# --- day masks ----------------------------------------------------------------------------
# A month has at most 31 days, so "which days of this month" fits in one bigint: bit d-1 is
# day d. Distinct-day and distinct-user-per-day counts then become bit_or + bit_count, which
# aggregate map-side, instead of COUNT(DISTINCT), which needs an Expand or a second shuffle.


def day_bit(date_col: Column | str) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.dayofmonth(_c(date_col)) - 1)


def mask_union(col: Column | str) -> Column:
    return F.bit_or(_c(col))


def mask_days(col: Column | str) -> Column:
    return F.bit_count(_c(col)).cast("bigint")


def mask_dates(month: Column | str, mask: Column | str) -> Column:
    """The dates of ``month`` whose bit is set, as an array."""
    m, bits = _c(month), _c(mask)
    return F.filter(
        F.sequence(m, F.last_day(m)),
        lambda d: bits.bitwiseAND(day_bit(d)) != 0,
    )
