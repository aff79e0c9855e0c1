"""Measures over any grouping of the star.

``measure_query`` evaluates named measures for every combination of the ``by`` columns. Filters
run on the dimensions and reach the facts through the star's one-way relationships. The measures of
a fact family share one aggregation; the families then meet in one small union.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subspan.functions.columns import MONEY_SUM, day_bit, mask_dates, mask_days, mask_union, ratio
from subspan.operators.acquisition import spend_cents
from subspan.operators.bitmaps import ATTRIBUTES, counted, users_and_days
from subspan.operators.product import calendar_masks
from subspan.operators.revenue import GROSS_MARGIN, LTV_MONTHS, MOVEMENTS

ACCOUNT_COLUMNS = ("account_id", "signup_date", "segment", "region", "channel", "cohort_month")
PERIOD = "_which"  # of a day that stands for two periods: see semantic.period_comparison
DATE_COLUMNS = ("date_day", "month", "year", "month_number", PERIOD)
EVENT_COLUMNS = ("event_name",)


@dataclass(frozen=True)
class Star:
    """The semantic model: two dimensions, four facts. ``usage`` stands for the event fact, ``bits`` for its distinct users and accounts."""

    account: DataFrame
    calendar: DataFrame
    revenue: DataFrame
    usage: DataFrame
    funnel: DataFrame
    marketing: DataFrame
    bits: DataFrame | None = None

    @classmethod
    def of(cls, models, bits: bool = False) -> Star:
        """The star of ``models``; with ``bits`` their bitmaps answer the product measures that they can."""
        return cls(
            models.dim_account,
            models.dim_date,
            models.fct_account_month,
            models.usage,
            models.fct_account_funnel,
            models.fct_marketing_spend,
            models.usage_bits if bits else None,
        )


@dataclass(frozen=True)
class Context:
    star: Star
    by: tuple[str, ...]
    accounts: Column | None = None
    dates: Column | None = None
    events: Column | None = None
    days: DataFrame | None = None  # the calendar's days as the groups see them, if otherwise

    def _of(self, columns: Iterable[str]) -> list[str]:
        return [c for c in self.by if c in columns]

    @property
    def account_by(self) -> list[str]:
        return self._of(ACCOUNT_COLUMNS)

    @property
    def date_by(self) -> list[str]:
        return self._of(DATE_COLUMNS)

    @property
    def event_by(self) -> list[str]:
        return self._of(EVENT_COLUMNS)

    def account_rows(self) -> DataFrame:
        return self.star.account if self.accounts is None else self.star.account.where(self.accounts)

    def date_rows(self) -> DataFrame:
        days = self.star.calendar if self.days is None else self.days
        return days if self.dates is None else days.where(self.dates)

    def event_rows(self) -> DataFrame:
        return self.star.usage if self.events is None else self.star.usage.where(self.events)

    def bit_rows(self, all_events: bool = False) -> DataFrame | None:
        """The filtered bitmaps; none where the query asks for more of an account than its attributes."""
        rows = self.star.bits
        if rows is None or not set(self.account_by) <= set(ATTRIBUTES):
            return None
        if self.accounts is not None:
            try:
                rows = rows.where(F.col("known") & self.accounts)
            except AnalysisException:  # a column that the bitmaps lack
                return None
        return rows if self.events is None or all_events else rows.where(self.events)

    # A fact row whose account or day is missing from the dimension belongs to a blank (NULL)
    # member while nothing filters that dimension, hence left joins there.

    def with_account(self, fact: DataFrame, hashed: bool = False) -> DataFrame:
        """Account columns for the grouping, and the account filter. No join if neither.

        ``hashed`` is for facts with many rows of each account: a task looks up its accounts in a table of them and never sorts the fact.
        """
        wanted = [c for c in self.account_by if c != "account_id"]
        if not wanted and self.accounts is None:
            return fact
        # The account dimension grows with the business: Spark picks the join by its size.
        members = self.account_rows().select("account_id", *wanted)
        members = members.hint("shuffle_hash") if hashed else members
        clash = [c for c in wanted if c in fact.columns]
        return fact.drop(*clash).join(members, "account_id", "left" if self.accounts is None else "inner")

    def with_dates(self, fact: DataFrame, day: str) -> DataFrame:
        """Calendar columns for the grouping, and the date filter. No join if neither."""
        if not self.date_by and self.dates is None:
            return fact
        members = self.date_rows().select(
            F.col("date_day").alias("_date"), *(F.col(c).alias(f"_d_{c}") for c in self.date_by)
        )
        # The calendar has one row per day, a few hundred a year: safe to broadcast.
        joined = fact.join(
            F.broadcast(members), F.col(day) == F.col("_date"), "left" if self.dates is None else "inner"
        )
        kept = [c for c in fact.columns if c not in self.date_by]
        return joined.select(*kept, *(F.col(f"_d_{c}").alias(c) for c in self.date_by))


# --- revenue --------------------------------------------------------------------------------
BALANCES = ("mrr", "beginning_mrr", *MOVEMENTS)
ACCOUNT_FLAGS = ("paying_account", "beginning_account", "churned_account")
TRAILING = {"churned": "churned_account", "beginning": "beginning_account"}


def _monthly(ctx: Context) -> DataFrame:
    """Sums of the accounts' groups by month, all months: every date column is a function of the month's first day."""
    revenue = ctx.star.revenue.withColumn("_period", F.col("month")).withColumnRenamed("month", "_day")
    return (
        ctx.with_account(revenue, hashed=True)
        .groupBy(*ctx.account_by, "_period")
        .agg(*(F.sum(c).cast(MONEY_SUM).alias(c) for c in BALANCES), *(F.sum(c).alias(c) for c in ACCOUNT_FLAGS))
        .withColumn("_day", F.col("_period"))
    )


def _latest(ctx: Context, monthly: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Balances are not additive over months: each group shows its last month's sums."""
    last = F.max_by(F.struct(*columns), "_period").alias("_last")
    return ctx.with_dates(monthly, "_day").groupBy(*ctx.by).agg(last).select(*ctx.by, "_last.*")


def _last_months(ctx: Context) -> DataFrame:
    """Each account's revenue rows of its last shown month, so that a group by account does not hold all of its months.

    Rows without an account can't be looked up and all stay.
    """
    revenue = ctx.star.revenue
    shown = ctx.with_dates(revenue.select(F.col("account_id").alias("_who"), "month", F.col("month").alias("_day")), "_day")
    last = shown.groupBy("_who").agg(F.max("month").alias("_last"))
    joined = revenue.join(last.hint("shuffle_hash"), F.col("account_id") == F.col("_who"), "left")
    return joined.where(F.col("account_id").isNull() | (F.col("month") == F.col("_last"))).select(*revenue.columns)


def _revenue(ctx: Context) -> DataFrame:
    if "account_id" in ctx.by and not ctx.date_by:
        ctx = replace(ctx, star=replace(ctx.star, revenue=_last_months(ctx)))
    return _latest(ctx, _monthly(ctx), (*BALANCES, *ACCOUNT_FLAGS))


def _revenue_and_churn(ctx: Context) -> DataFrame:
    """The revenue family with churned and beginning accounts over the calendar months ending at the group's last month.

    The trailing sums are a frame over the groups' months, a row each, before any date filter; account filters apply.
    """
    month = F.year("_period") * 12 + F.month("_period")
    trailing = Window.partitionBy(*ctx.account_by).orderBy(month).rangeBetween(1 - LTV_MONTHS, 0)
    known = F.broadcast(ctx.star.calendar.select(F.col("date_day").alias("_day"), F.lit(True).alias("_known")))
    sums = {f"trailing_{name}": F.sum(F.when(F.col("_known"), F.col(column))).over(trailing) for name, column in TRAILING.items()}
    monthly = _monthly(ctx).join(known, "_day", "left").withColumns(sums)
    return _latest(ctx, monthly, (*BALANCES, *ACCOUNT_FLAGS, *sums))


# --- product --------------------------------------------------------------------------------


def _active(ctx: Context) -> DataFrame:
    """Distinct users and accounts with an event on any day of the group."""
    bits = ctx.bit_rows()
    if bits is not None:
        if ctx.date_by or ctx.dates is not None:
            bits = _between_months(ctx, bits, ctx.date_rows(), "month")
        days = bits.withColumnRenamed("day", "_day").drop("month")
        counts = counted(ctx.with_dates(days, "_day"), list(ctx.by))
        none = (F.nullif(F.col(column), F.lit(0)).alias(name) for column, name in (("user_id", "active_users"), ("account_id", "retained_accounts")))
        return counts.select(*ctx.by, *none)
    usage = ctx.event_rows()
    if "date_day" in ctx.date_by:
        usage = _between_months(ctx, usage, ctx.date_rows(), "month")
        days = usage.withColumn("_date_day", F.explode(mask_dates("month", "day_mask"))).drop("month")
        rows = ctx.with_dates(ctx.with_account(days), "_date_day")
    elif ctx.date_by or ctx.dates is not None:
        rows = ctx.with_account(_by_month_member(ctx, usage))
    else:
        rows = ctx.with_account(usage)

    def distinct(column: str, output: str) -> DataFrame:
        who = rows.select(*ctx.by, F.col(column).alias("_who")).distinct()
        return _none_if_empty(who.groupBy(*ctx.by).agg(F.count("_who").alias(output)), output)

    return merge_groups([distinct("user_id", "active_users"), distinct("account_id", "retained_accounts")], ctx.by)


def _by_month_member(ctx: Context, usage: DataFrame) -> DataFrame:
    """Usage with the calendar's month-level columns, split into days inside and outside it."""
    members = ctx.date_rows()
    months = members.groupBy(F.col("month").alias("_month"), *(F.col(c).alias(f"_d_{c}") for c in ctx.date_by)).agg(
        mask_union(day_bit("date_day")).alias("_mask")
    )
    # One row per calendar month: safe to broadcast.
    joined = _between_months(ctx, usage, months, "_month").join(
        F.broadcast(months), F.col("month") == F.col("_month"), "left" if ctx.dates is None else "inner"
    )
    known = F.coalesce("_mask", F.lit(0).cast("bigint"))
    days = F.col("day_mask")
    inside = F.struct(days.bitwiseAND(known).alias("days"), *(F.col(f"_d_{c}").alias(c) for c in ctx.date_by))
    outside = F.struct(
        days.bitwiseAND(F.bitwise_not(known)).alias("days"),
        *(F.lit(None).cast(joined.schema[f"_d_{c}"].dataType).alias(c) for c in ctx.date_by),
    )
    parts = F.array(inside, outside) if ctx.dates is None else F.array(inside)
    others = ["user_id", "account_id", "event_name"]
    return (
        joined.select(*others, F.explode(parts).alias("_part"))
        .where(F.col("_part.days") != 0)
        .select(*others, *(F.col(f"_part.{c}").alias(c) for c in ctx.date_by))
    )


def _anchor_months(ctx: Context) -> DataFrame:
    """Each date group's reference month: the month of its last calendar day, as day mask."""
    anchors = ctx.date_rows().groupBy(*ctx.date_by).agg(F.trunc(F.max("date_day"), "MM").alias("_anchor"))
    masks = calendar_masks(ctx.star.calendar).withColumnRenamed("month", "_month")
    return anchors.join(F.broadcast(masks), F.col("_anchor") == F.col("_month")).drop("_month")


def _between_months(ctx: Context, usage: DataFrame, months: DataFrame, column: str) -> DataFrame:
    """Usage of the months a total or a date filter spans. Stored usage lies in one folder per
    month, and a subquery's bounds prune those folders where a join's key would not."""
    if ctx.date_by and ctx.dates is None:
        return usage
    bounds = [months.agg(f(column)).scalar() for f in (F.min, F.max)]
    return usage.where(F.col("month").between(*bounds))


def _month_users(ctx: Context, all_events: bool, keys: list[str], names: tuple[str, str]) -> DataFrame:
    """Users of each group's reference month and the sum of their active days.

    Many date groups may refer to one month, as its days do: a month is counted once and its totals go to all of them.
    """
    anchors = _anchor_months(ctx)
    months = anchors.select("_anchor", "calendar_mask").distinct()
    others = [k for k in keys if k not in ctx.date_by]
    bits, usage = ctx.bit_rows(all_events), ctx.star.usage if all_events else ctx.event_rows()
    source = _between_months(ctx, usage if bits is None else bits, months, "_anchor")
    rows = source.join(F.broadcast(months), F.col("month") == F.col("_anchor"))
    if bits is not None:
        rows = rows.where(day_bit("day").bitwiseAND(F.col("calendar_mask")) != 0)
        totals = users_and_days(rows, [*others, "_anchor"], names)
    else:
        rows = rows.withColumn("_days", F.col("day_mask").bitwiseAND(F.col("calendar_mask")))
        rows = rows.where(F.col("_days") != 0).select("user_id", "account_id", "event_name", "_days", "_anchor")
        totals = (
            ctx.with_account(rows)
            .groupBy(*others, "_anchor", "user_id")
            .agg(mask_union("_days").alias("_days"))
            .groupBy(*others, "_anchor")
            .agg(F.count(F.lit(1)).alias(names[0]), F.sum(mask_days("_days")).alias(names[1]))
        )
    if not keys:
        return totals.agg(*(F.max(n).alias(n) for n in names))
    # Anchors: at most one row per calendar day.
    return totals.join(F.broadcast(anchors.select("_anchor", *ctx.date_by)), "_anchor").select(*keys, *names)


def _mau(ctx: Context) -> DataFrame:
    return _none_if_empty(_month_users(ctx, False, list(ctx.by), ("mau", "user_days")), "mau")


def _mau_all_events(ctx: Context) -> DataFrame:
    keys = [*ctx.account_by, *ctx.date_by]
    return _none_if_empty(
        _month_users(ctx, True, keys, ("mau_all_events", "_unused")).drop("_unused"), "mau_all_events"
    )


def _none_if_empty(df: DataFrame, column: str) -> DataFrame:
    """A total over no rows is one row with count 0; a blank has no value."""
    return df.withColumn(column, F.nullif(F.col(column), F.lit(0)))


def _calendar_days(ctx: Context) -> DataFrame:
    return _anchor_months(ctx).select(*ctx.date_by, "calendar_days")


def _grid(ctx: Context) -> DataFrame:
    """Every group that the dimensions have, with or without facts: average daily users are 0 there, not blank.

    By account and month that is accounts x months, which is what the measure means. The date groups and event names are
    few and come as one list each, so the accounts' groups unfold in place.
    """
    result = ctx.account_rows().select(*ctx.account_by).distinct() if ctx.account_by else ctx.star.account.sparkSession.range(1).select()
    bits = ctx.bit_rows()
    events = ctx.event_rows() if bits is None or ctx.accounts is not None else bits
    lists = [(ctx.date_by, _anchor_months(ctx)), (ctx.event_by, events)]
    for columns, frame in lists:
        if columns:
            groups = frame.select(*columns).distinct().agg(F.collect_list(F.struct(*columns))).scalar()
            result = result.select(*result.columns, F.inline(groups))
    return result.select(*ctx.by, F.lit(True).alias("in_grid"))


# --- funnel, accounts, marketing ------------------------------------------------------------


def _funnel(ctx: Context) -> DataFrame:
    fact = ctx.star.funnel.withColumnRenamed("signup_date", "_signed_up")
    rows = ctx.with_dates(ctx.with_account(fact), "_signed_up")
    eligible = F.col("activation_eligible")
    return _none_if_empty(
        rows.groupBy(*ctx.by).agg(
            F.count(F.lit(1)).alias("signup_accounts"),
            F.sum("qualified").alias("qualified_accounts"),
            F.sum("converted").alias("converted_accounts"),
            F.sum(eligible).alias("eligible_accounts"),
            F.sum(F.when(eligible == 1, F.col("activated"))).alias("activated_accounts"),
        ),
        "signup_accounts",
    )


def _accounts(ctx: Context) -> DataFrame:
    return _none_if_empty(
        ctx.account_rows()
        .withColumn("_id", F.col("account_id"))
        .groupBy(*ctx.account_by)
        .agg(
            F.count(F.lit(1)).alias("cohort_accounts"),
            F.when(F.min("_id") == F.max("_id"), F.max("_id")).otherwise("Multiple accounts").alias("account_context"),
        ),
        "cohort_accounts",
    )


def _marketing(ctx: Context) -> DataFrame:
    """The whole spend of every channel that the group's accounts use; never apportioned."""
    spend = (
        ctx.with_dates(ctx.star.marketing.withColumnRenamed("date_day", "_spent_on"), "_spent_on")
        .groupBy(F.col("channel").alias("_channel"), *ctx.date_by)
        .agg(F.sum(spend_cents()).alias("_cents"))
    )
    used = ctx.account_rows().withColumn("_used", F.col("channel")).select("_used", *ctx.account_by).distinct()
    return (
        used.join(spend, F.col("_used") == F.col("_channel"))
        .groupBy(*ctx.account_by, *ctx.date_by)
        .agg((F.sum("_cents").cast("double") / 100).alias("marketing_spend"))
    )


@dataclass(frozen=True)
class Family:
    """One aggregation and the grouping columns that reach it."""

    run: Callable[[Context], DataFrame]
    reach: tuple[str, ...]


FAMILIES = {
    "revenue": Family(_revenue, ACCOUNT_COLUMNS + DATE_COLUMNS),
    "revenue_and_churn": Family(_revenue_and_churn, ACCOUNT_COLUMNS + DATE_COLUMNS),
    "active": Family(_active, ACCOUNT_COLUMNS + DATE_COLUMNS + EVENT_COLUMNS),
    "mau": Family(_mau, ACCOUNT_COLUMNS + DATE_COLUMNS + EVENT_COLUMNS),
    "mau_all_events": Family(_mau_all_events, ACCOUNT_COLUMNS + DATE_COLUMNS),
    "calendar_days": Family(_calendar_days, DATE_COLUMNS),
    "grid": Family(_grid, ACCOUNT_COLUMNS + DATE_COLUMNS + EVENT_COLUMNS),
    "funnel": Family(_funnel, ACCOUNT_COLUMNS + DATE_COLUMNS),
    "accounts": Family(_accounts, ACCOUNT_COLUMNS),
    "marketing": Family(_marketing, ACCOUNT_COLUMNS + DATE_COLUMNS),
}


@dataclass(frozen=True)
class Measure:
    families: tuple[str, ...]
    value: Callable[[], Column]


def _plain(family: str, column: str) -> Measure:
    return Measure((family,), lambda: F.col(column))


def _kept() -> Column:
    return F.col("beginning_mrr") - F.col("contraction_mrr") - F.col("churn_mrr")


def _nrr() -> Column:
    return ratio(_kept() + F.col("expansion_mrr"), "beginning_mrr")


def _arpa() -> Column:
    return ratio("mrr", "paying_account")


def _average_dau() -> Column:
    return F.coalesce("user_days", F.lit(0)).cast("double") / F.col("calendar_days")


def _reconciliation() -> Column:
    explained = _kept() + F.col("new_mrr") + F.col("reactivation_mrr") + F.col("expansion_mrr")
    return (F.col("mrr") - explained).cast(MONEY_SUM)


def _revenue_context() -> Column:
    money = F.concat(F.lit("$"), F.format_number(F.round("mrr", 0), 0))
    percent = F.concat(F.round(_nrr() * 100, 1).cast("decimal(28,1)").cast("string"), F.lit("%"))
    return F.concat(F.lit("MRR "), F.coalesce(money, F.lit("")), F.lit(" | NRR "), F.coalesce(percent, F.lit("")))


MEASURES: dict[str, Measure] = {
    # D1-D10
    **{name: _plain("revenue", name) for name in BALANCES},
    "paying_accounts": _plain("revenue", "paying_account"),
    "beginning_accounts": _plain("revenue", "beginning_account"),
    "churned_accounts": _plain("revenue", "churned_account"),
    # D11-D17
    "arr": Measure(("revenue",), lambda: (F.col("mrr") * 12).cast(MONEY_SUM)),
    "nrr": Measure(("revenue",), _nrr),
    "grr": Measure(("revenue",), lambda: ratio(_kept(), "beginning_mrr")),
    "logo_churn": Measure(("revenue",), lambda: ratio("churned_account", "beginning_account")),
    "arpa": Measure(("revenue",), _arpa),
    "modeled_ltv": Measure(
        ("revenue_and_churn",),
        lambda: ratio(_arpa() * GROSS_MARGIN, ratio("trailing_churned", "trailing_beginning")),
    ),
    "mrr_reconciliation": Measure(("revenue",), _reconciliation),
    # D18-D22
    "active_users": _plain("active", "active_users"),
    "mau": _plain("mau", "mau"),
    "average_dau": Measure(("mau", "calendar_days", "grid"), _average_dau),
    "stickiness": Measure(("mau", "calendar_days"), lambda: ratio(_average_dau(), "mau")),
    "feature_adoption": Measure(("mau", "mau_all_events"), lambda: ratio("mau", "mau_all_events")),
    # D23-D29
    "signup_accounts": _plain("funnel", "signup_accounts"),
    "qualified_accounts": _plain("funnel", "qualified_accounts"),
    "converted_accounts": _plain("funnel", "converted_accounts"),
    "conversion_rate": Measure(("funnel",), lambda: ratio("converted_accounts", "signup_accounts")),
    "activation_rate": Measure(("funnel",), lambda: ratio("activated_accounts", "eligible_accounts")),
    "marketing_spend": _plain("marketing", "marketing_spend"),
    "cohort_acquisition_cost": Measure(
        ("marketing", "funnel"), lambda: ratio("marketing_spend", "converted_accounts")
    ),
    # D30-D34
    "retained_accounts": _plain("active", "retained_accounts"),
    "cohort_accounts": _plain("accounts", "cohort_accounts"),
    "cohort_retention": Measure(("active", "accounts"), lambda: ratio("retained_accounts", "cohort_accounts")),
    "account_context": _plain("accounts", "account_context"),
    "revenue_context": Measure(("revenue",), _revenue_context),
}


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Join on equal keys where NULL equals NULL, keeping the left key columns."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    condition = reduce(Column.__and__, (F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys))
    return left.join(renamed, condition, how).drop(*(f"_right_{k}" for k in keys))


def merge_groups(frames: list[DataFrame], by: Iterable[str]) -> DataFrame:
    """Full outer join on ``by`` of frames with different value columns and unique groups.

    A union with one aggregation: one shuffle for any number of frames, and NULL groups match.
    """
    if len(frames) == 1:
        return frames[0]
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    values = [c for c in both.columns if c not in by]
    return both.groupBy(*by).agg(*(F.max(c).alias(c) for c in values))


def measure_query(
    star: Star,
    measures: Iterable[str],
    by: Iterable[str] = (),
    accounts: Column | None = None,
    dates: Column | None = None,
    events: Column | None = None,
    days: DataFrame | None = None,
) -> DataFrame:
    """``by`` columns and one column per measure; groups where all are blank are left out.

    ``accounts``, ``dates`` and ``events`` filter the account dimension, the calendar and the
    event names. ``days`` are the calendar's days with other date columns, several rows a day if a day belongs to several groups. A measure that some ``by`` column does not reach repeats over that column, for
    the groups the other measures have.
    """
    by, measures = tuple(by), list(measures)
    unknown = [c for c in by if c not in ACCOUNT_COLUMNS + DATE_COLUMNS + EVENT_COLUMNS]
    if unknown:
        raise ValueError(f"not a column of the star: {unknown}")
    ctx = Context(star, by, accounts, dates, events, days)
    needed = [f for f in FAMILIES if any(f in MEASURES[m].families for m in measures)]
    if "revenue_and_churn" in needed:  # it has all of the other
        needed = [f for f in needed if f != "revenue"]
    reached = {f: [c for c in by if c in FAMILIES[f].reach] for f in needed}
    whole = [f for f in needed if len(reached[f]) == len(by)]
    if not whole:
        raise ValueError(f"no requested measure can be grouped by {list(by)}")

    result = merge_groups([FAMILIES[f].run(ctx) for f in whole], by)
    for f in (f for f in needed if f not in whole):
        part = FAMILIES[f].run(replace(ctx, by=tuple(reached[f])))
        if reached[f]:
            result = null_safe_join(result, part, reached[f], "left")
        else:
            total = part.select(F.struct(*part.columns).alias("total")).scalar()
            result = result.withColumn("_total", total).select(*result.columns, "_total.*")
    result = result.select(*by, *(MEASURES[m].value().alias(m) for m in measures))
    if by:
        result = result.where(F.coalesce(*(F.col(m).cast("string") for m in measures)).isNotNull())
    return result
