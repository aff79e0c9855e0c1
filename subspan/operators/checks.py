"""Data tests (Q1-Q10). Each returns the failing rows, so an empty result means the data pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def unique(df: DataFrame, column: str) -> DataFrame:
    """Q1: values that occur more than once; NULLs are not compared."""
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > 1)
    )


def not_null(df: DataFrame, column: str) -> DataFrame:
    """Q2."""
    return df.where(F.col(column).isNull())


def relationships(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Q3: child keys without a parent, with their row count. NULL keys pass.

    Child rows collapse to one per key before the join, so a hot key is one row in it.
    """
    keys = (
        child.where(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    parents = parent.select(F.col(parent_column).alias("value"))
    return keys.join(parents, "value", "left_anti")


def calendar_contiguous(calendar: DataFrame) -> DataFrame:
    """Q4: one row when days are missing between the first and the last."""
    span = F.datediff("last_day", "first_day") + 1
    return (
        calendar.agg(
            F.count(F.lit(1)).alias("days"),
            F.min("date_day").alias("first_day"),
            F.max("date_day").alias("last_day"),
        )
        .where(F.col("days") != span)
        .select("days", span.alias("expected_days"))
    )


def fact_grain(account_month: DataFrame) -> DataFrame:
    """Q5."""
    return (
        account_month.groupBy("account_id", "month").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != 1)
    )


def _out_of_order() -> Column:
    return (F.col("converted") > F.col("qualified")) | (F.col("qualified") > 1) | (F.col("activation_date") < F.col("signup_date"))


def _outside_unit(c: str) -> Column:
    return (F.col(c) < 0) | (F.col(c) > 1)


# Q7: an impossible ratio, by mart; NULL ratios pass.
_BOUNDS = {
    "mart_revenue_monthly": lambda: _outside_unit("grr") | (F.col("nrr") < F.col("grr")),
    "mart_product_monthly": lambda: (F.col("average_dau") > F.col("mau")) | _outside_unit("stickiness"),
    "mart_feature_adoption": lambda: _outside_unit("adoption_rate"),
}


def _negative_balance() -> Column:
    return (F.col("mrr") < 0) | (F.col("beginning_mrr") < 0)


def _bad_retention() -> Column:
    return _outside_unit("retention_rate") | (F.col("cohort_age") < 0)


def _unexplained() -> Column:
    gained = F.col("new_mrr") + F.col("reactivation_mrr") + F.col("expansion_mrr")
    closing = F.col("beginning_mrr") + gained - (F.col("contraction_mrr") + F.col("churn_mrr"))
    return F.abs(F.col("mrr") - closing) > F.lit("0.01").cast("decimal(3,2)")


def funnel_order(funnel: DataFrame) -> DataFrame:
    """Q6."""
    return funnel.where(_out_of_order())


def metric_bounds(revenue: DataFrame, product: DataFrame, adoption: DataFrame) -> DataFrame:
    """Q7: months with an impossible ratio."""
    marts = zip((revenue, product, adoption), _BOUNDS.values(), strict=True)
    return reduce(DataFrame.unionByName, (mart.where(bad()).select("month") for mart, bad in marts))


def nonnegative_balances(account_month: DataFrame) -> DataFrame:
    """Q8."""
    return account_month.where(_negative_balance())


def retention_bounds(retention: DataFrame) -> DataFrame:
    """Q9."""
    return retention.where(_bad_retention())


def revenue_reconciles(account_month: DataFrame) -> DataFrame:
    """Q10: rows whose movements do not lead from the opening to the closing balance."""
    return account_month.where(_unexplained())


# What is declared of columns: tables with a unique column, further columns that must be filled, and references to accounts.
UNIQUE = {"dim_account": "account_id", "dim_user": "user_id", "dim_date": "date_day", "fct_product_event": "event_id", "fct_account_funnel": "account_id"}
FILLED = {"dim_user": "account_id", "fct_product_event": "account_id"}
CHILDREN = ("dim_user", "fct_product_event", "fct_account_funnel")
GRAIN = ("account_id", "month")


def row_metrics(table: str) -> list[Column]:
    """The checks that a row decides by itself, as counts of failing rows: metrics for the write of ``table`` to observe."""
    rules = {f"not_null {table}.{column}": F.col(column).isNull() for column in (UNIQUE.get(table), FILLED.get(table)) if column}
    if table == "fct_account_funnel":
        rules["funnel_order"] = _out_of_order()
    if table in _BOUNDS:
        rules["metric_bounds"] = _BOUNDS[table]()
    if table == "fct_account_month":
        rules |= {"nonnegative_balances": _negative_balance(), "revenue_reconciles": _unexplained()}
    if table == "mart_cohort_retention":
        rules["retention_bounds"] = _bad_retention()
    return [F.count_if(rule).alias(check) for check, rule in rules.items()]


def key_counts(models) -> DataFrame:
    """The checks that compare rows (Q1, Q3-Q5) as one row, a column a check, from one aggregate of all keys.

    Each table is read once and gives a row for every key that is checked in it; one shuffle brings equal keys together, after the map tasks have
    merged theirs.
    """
    accounts = "account_id of accounts"

    def key(check: str, value: Column, table: str) -> Column:
        return F.struct(F.lit(check).alias("check"), value.cast("string").alias("key"), F.lit(table).alias("table"))

    def read(table: str, keys: list[Column]) -> DataFrame:
        return getattr(models, table).select(F.inline(F.array(*keys)))

    frames = [
        read(
            table,
            [key(f"unique {table}.{column}", F.col(column), table)]
            + [key(accounts, F.col("account_id"), table)] * (table == "dim_account" or table in CHILDREN),
        )
        for table, column in UNIQUE.items()
    ]
    grain = F.concat_ws(" ", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in GRAIN))
    frames.append(read("fct_account_month", [key("fact_grain", grain, "fct_account_month")]))
    table = F.col("table")
    by_key = (
        reduce(DataFrame.unionByName, frames)
        .groupBy("check", "key")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or(table == "dim_account").alias("known"), *(F.bool_or(table == c).alias(f"in_{c}") for c in CHILDREN))
    )

    def of(check: str) -> Column:
        return (F.col("check") == check) & F.col("key").isNotNull()

    days = F.col("check") == f"unique dim_date.{UNIQUE['dim_date']}"
    last, first = (f(F.when(days, F.col("key").cast("date"))) for f in (F.max, F.min))
    gap = F.coalesce(F.sum(F.when(days, F.col("n"))), F.lit(0)) != F.datediff(last, first) + 1
    return by_key.agg(
        *(F.count_if(of(f"unique {t}.{c}") & (F.col("n") > 1)).alias(f"unique {t}.{c}") for t, c in UNIQUE.items()),
        *(F.count_if(of(accounts) & ~F.col("known") & F.col(f"in_{c}")).alias(f"relationships {c}.account_id") for c in CHILDREN),
        F.count_if(of("fact_grain") & (F.col("n") > 1)).alias("fact_grain"),
        F.when(gap, 1).otherwise(0).cast("bigint").alias("calendar_contiguous"),
    )


def all_checks(models) -> dict[str, DataFrame]:
    """Every declared test over a set of models, by name."""
    m = models
    uniques = {
        "dim_account.account_id": (m.dim_account, "account_id"),
        "dim_user.user_id": (m.dim_user, "user_id"),
        "dim_date.date_day": (m.dim_date, "date_day"),
        "fct_product_event.event_id": (m.fct_product_event, "event_id"),
        "fct_account_funnel.account_id": (m.fct_account_funnel, "account_id"),
    }
    filled = {
        **uniques,
        "dim_user.account_id": (m.dim_user, "account_id"),
        "fct_product_event.account_id": (m.fct_product_event, "account_id"),
    }
    children = {
        "dim_user.account_id": (m.dim_user, "account_id"),
        "fct_product_event.account_id": (m.fct_product_event, "account_id"),
        "fct_account_funnel.account_id": (m.fct_account_funnel, "account_id"),
    }
    return {
        **{f"unique {name}": unique(df, c) for name, (df, c) in uniques.items()},
        **{f"not_null {name}": not_null(df, c) for name, (df, c) in filled.items()},
        **{
            f"relationships {name}": relationships(df, c, m.dim_account, "account_id")
            for name, (df, c) in children.items()
        },
        "calendar_contiguous": calendar_contiguous(m.dim_date),
        "fact_grain": fact_grain(m.fct_account_month),
        "funnel_order": funnel_order(m.fct_account_funnel),
        "metric_bounds": metric_bounds(
            m.mart_revenue_monthly, m.mart_product_monthly, m.mart_feature_adoption
        ),
        "nonnegative_balances": nonnegative_balances(m.fct_account_month),
        "retention_bounds": retention_bounds(m.mart_cohort_retention),
        "revenue_reconciles": revenue_reconciles(m.fct_account_month),
    }


def failure_counts(checks: dict[str, DataFrame]) -> DataFrame:
    """One row per check: how many rows fail it."""
    counted = (
        rows.agg(F.count(F.lit(1)).alias("failing")).select(F.lit(name).alias("check"), "failing")
        for name, rows in checks.items()
    )
    return reduce(DataFrame.unionByName, counted)
