"""Models, marts, analyst queries and data tests (T, M, A, Q)."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parity.sql import with_models
from subspan.functions.columns import month_start
from subspan.operators import analysis, checks
from subspan.plans import build
from subspan.plans.models import Models
from subspan.session import shared_dir
from subspan.sources.driver_tables import DriverTables

QUERIES: dict = {}
SQL: dict[str, str] = {}


def models(spark: SparkSession, folder: str) -> Models:
    return Models(DriverTables(spark, folder).datasets())


def query(name: str, sql: str | None = None, **extra: str):
    """Register a function of (models, driver tables) under ``name``."""

    def register(fn):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            tables = DriverTables(spark, folder)
            return fn(Models(tables.datasets()), tables)

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = with_models(sql, **extra)
        return fn

    return register


def model(name: str, attribute: str, part: str) -> None:
    query(name, f"select * from {part}")(lambda m, t: getattr(m, attribute))


def dataset(name: str, attribute: str, part: str) -> None:
    query(name, f"select * from {part}")(lambda m, t: m.raw[attribute])


dataset("T1_stg_accounts", "accounts", "src_accounts")
dataset("T1_stg_users", "users", "src_users")
model("T1_stg_subscriptions", "stg_subscriptions", "src_subscriptions")
model("T1_stg_opportunities", "stg_opportunities", "src_opportunities")
model("T1_stg_marketing", "stg_marketing", "src_marketing")
model("T2_stg_events", "stg_events", "clean_events")
model("T3_dim_account", "dim_account", "account_dim")
model("T4_dim_user", "dim_user", "src_users")
model("T5_dim_date", "dim_date", "date_dim")
model("T6_int_account_month", "int_account_month", "account_month_balances")
model("T7_fct_account_month", "fct_account_month", "revenue_fact")
model("T8_fct_product_event", "fct_product_event", "event_fact")
model("T9_fct_account_funnel", "fct_account_funnel", "funnel_fact")
model("T10_fct_marketing_spend", "fct_marketing_spend", "spend_fact")
model("M1_mart_revenue_monthly", "mart_revenue_monthly", "revenue_mart")
model("M2_mart_product_monthly", "mart_product_monthly", "product_mart")
model("M3_mart_feature_adoption", "mart_feature_adoption", "adoption_mart")
model("M4_mart_cohort_retention", "mart_cohort_retention", "retention_mart")
model("M5_mart_acquisition", "mart_acquisition", "acquisition_mart")


# --- analyst queries ------------------------------------------------------------------------
@query(
    "A1_revenue_bridge",
    """select r.month, a.segment,
              cast(sum(beginning_mrr) as decimal(28,2)) as opening, cast(sum(new_mrr) as decimal(28,2)) as new,
              cast(sum(expansion_mrr) as decimal(28,2)) as expansion,
              cast(sum(reactivation_mrr) as decimal(28,2)) as reactivation,
              cast(sum(contraction_mrr) as decimal(28,2)) as contraction,
              cast(sum(churn_mrr) as decimal(28,2)) as churn, cast(sum(mrr) as decimal(28,2)) as closing,
              cast(sum(mrr) - (sum(beginning_mrr) + sum(new_mrr + reactivation_mrr + expansion_mrr)
                   - sum(contraction_mrr + churn_mrr)) as decimal(28,2)) as residual
       from revenue_fact r join account_dim a using (account_id) group by r.month, a.segment""",
)
def _revenue_bridge(m, t):
    return analysis.revenue_bridge(m.fct_account_month, m.dim_account)


@query(
    "A2_expansion_drivers",
    """with flags as (
           select account_id, month, cast(bool_or(event_name = 'automation') as integer) as flag
           from event_fact group by account_id, month),
       rows_with_prior as (
           select r.*, lag(coalesce(f.flag, 0)) over (partition by r.account_id order by r.month) as prior_automation
           from revenue_fact r left join flags f using (account_id, month))
       select month, prior_automation, count(*) as eligible_accounts,
              cast(count(*) filter (expansion_mrr > 0) as double) / cast(count(*) as double) as expansion_incidence
       from rows_with_prior where beginning_mrr > 0 group by month, prior_automation""",
)
def _expansion_drivers(m, t):
    return analysis.expansion_drivers(m.fct_account_month, m.fct_product_event, m.dim_date)


@query(
    "A3_ranked_churn_risk",
    """with daily as (
           select account_id, month, count(distinct date_day) as days from event_fact group by account_id, month),
       joined as (
           select r.account_id, r.month, r.mrr, coalesce(d.days, 0) as active_days
           from revenue_fact r left join daily d using (account_id, month)),
       lagged as (
           select *, lag(active_days) over (partition by account_id order by month) as prior_active_days
           from joined),
       scored as (
           select *, cast(prior_active_days - active_days as double)
                     / cast(nullif(prior_active_days, 0) as double) as activity_decline
           from lagged where mrr > 0)
       select *, dense_rank() over (
                  partition by month order by activity_decline desc nulls last, mrr desc) as review_priority
       from scored""",
)
def _churn_risk(m, t):
    return analysis.churn_risk(m.fct_account_month, m.dim_account, m.usage, m.dim_date, checkpoint=True)


# --- data tests -----------------------------------------------------------------------------
@query(
    "Q_all_checks",
    """with counts as (
       select 'unique dim_account.account_id' as "check", count(*) as failing
       from (select account_id from account_dim group by 1 having count(*) > 1)
       union all select 'unique dim_user.user_id', count(*)
       from (select user_id from src_users group by 1 having count(*) > 1)
       union all select 'unique dim_date.date_day', count(*)
       from (select date_day from date_dim group by 1 having count(*) > 1)
       union all select 'unique fct_product_event.event_id', count(*)
       from (select event_id from event_fact group by 1 having count(*) > 1)
       union all select 'unique fct_account_funnel.account_id', count(*)
       from (select account_id from funnel_fact group by 1 having count(*) > 1)
       union all select 'not_null dim_account.account_id', count(*) from account_dim where account_id is null
       union all select 'not_null dim_user.user_id', count(*) from src_users where user_id is null
       union all select 'not_null dim_user.account_id', count(*) from src_users where account_id is null
       union all select 'not_null dim_date.date_day', count(*) from date_dim where date_day is null
       union all select 'not_null fct_product_event.event_id', count(*) from event_fact where event_id is null
       union all select 'not_null fct_product_event.account_id', count(*) from event_fact where account_id is null
       union all select 'not_null fct_account_funnel.account_id', count(*) from funnel_fact where account_id is null
       union all select 'relationships dim_user.account_id', count(distinct account_id) from src_users
       where account_id not in (select account_id from account_dim)
       union all select 'relationships fct_product_event.account_id', count(distinct account_id) from event_fact
       where account_id not in (select account_id from account_dim)
       union all select 'relationships fct_account_funnel.account_id', count(distinct account_id) from funnel_fact
       where account_id not in (select account_id from account_dim)
       union all select 'calendar_contiguous', cast(max(date_day) - min(date_day) + 1 <> count(*) as bigint)
       from date_dim
       union all select 'fact_grain', count(*)
       from (select 1 from revenue_fact group by account_id, month having count(*) > 1)
       union all select 'funnel_order', count(*) from funnel_fact
       where converted > qualified or qualified > 1 or activation_date < signup_date
       union all select 'metric_bounds',
           (select count(*) from revenue_mart where grr not between 0 and 1 or nrr < grr)
         + (select count(*) from product_mart where average_dau > mau or stickiness not between 0 and 1)
         + (select count(*) from adoption_mart where adoption_rate not between 0 and 1)
       union all select 'nonnegative_balances', count(*) from revenue_fact where least(mrr, beginning_mrr) < 0
       union all select 'retention_bounds', count(*) from retention_mart
       where retention_rate not between 0 and 1 or cohort_age < 0
       union all select 'revenue_reconciles', count(*) from revenue_fact
       where abs(mrr - beginning_mrr - new_mrr - reactivation_mrr - expansion_mrr
                 + contraction_mrr + churn_mrr) > 0.01)
       select * from counts""",
)
def _all_checks(m, t):
    """As a build runs them: with the writes of the marts, and over their keys."""
    failing = build.write_marts(t.spark, m.raw, f"{shared_dir(t.spark)}/checked-{uuid.uuid4().hex}")
    return t.spark.createDataFrame(sorted(failing.items()), "check string, failing bigint")


# The checks pass on clean models, so each is also compared on data that break its rule.
@query(
    "Q1_unique",
    "select event_id as value, count(*) as n from event_versions group by 1 having count(*) > 1",
)
def _unique(m, t):
    return checks.unique(t.events(), "event_id")


@query("Q2_not_null", "select * from funnel_fact where qualified_date is null")
def _not_null(m, t):
    return checks.not_null(m.fct_account_funnel, "qualified_date")


@query(
    "Q3_relationships",
    """select e.account_id as value, count(*) as n from event_fact e
       where not exists (select 1 from account_dim a where a.account_id = e.account_id and a.region = 'ASIA')
       group by 1""",
)
def _relationships(m, t):
    asia = m.dim_account.where(F.col("region") == "ASIA")
    return checks.relationships(m.fct_product_event, "account_id", asia, "account_id")


@query(
    "Q4_calendar_contiguous",
    """select count(*) as days, cast(max(signup_date) - min(signup_date) + 1 as integer) as expected_days
       from (select distinct signup_date from account_dim)
       having count(*) <> max(signup_date) - min(signup_date) + 1""",
)
def _calendar(m, t):
    signups = m.dim_account.select(F.col("signup_date").alias("date_day")).distinct()
    return checks.calendar_contiguous(signups)


@query(
    "Q5_fact_grain",
    """select cast(o_custkey as varchar) as account_id, cast(date_trunc('month', o_orderdate) as date) as month,
              count(*) as n from orders group by 1, 2 having count(*) > 1""",
)
def _grain(m, t):
    single_orders = t.table("orders").select(
        F.col("o_custkey").cast("string").alias("account_id"), month_start("o_orderdate").alias("month")
    )
    return checks.fact_grain(single_orders)


@query(
    "Q6_funnel_order",
    """select * replace (converted as qualified, qualified as converted) from funnel_fact
       where qualified > converted or activation_date < signup_date""",
)
def _funnel_order(m, t):
    f = m.fct_account_funnel
    swapped = f.withColumns({"qualified": f["converted"], "converted": f["qualified"]})
    return checks.funnel_order(swapped)


@query(
    "Q7_metric_bounds",
    """select month from revenue_mart where grr * 10 > 1 or nrr < grr * 10
       union all select month from product_mart where average_dau * 40 > mau or stickiness * 40 > 1
       union all select month from adoption_mart where adoption_rate * 6 > 1""",
)
def _metric_bounds(m, t):
    return checks.metric_bounds(
        m.mart_revenue_monthly.withColumn("grr", F.col("grr") * 10),
        m.mart_product_monthly.withColumns(
            {"average_dau": F.col("average_dau") * 40, "stickiness": F.col("stickiness") * 40}
        ),
        m.mart_feature_adoption.withColumn("adoption_rate", F.col("adoption_rate") * 6),
    )


@query(
    "Q8_nonnegative_balances",
    """select account_id, month, cast(mrr - 200000 as decimal(18,2)) as mrr, beginning_mrr
       from revenue_fact where mrr < 200000""",
)
def _balances(m, t):
    less = (F.col("mrr") - 200000).cast("decimal(18,2)")
    return checks.nonnegative_balances(
        m.fct_account_month.select("account_id", "month", less.alias("mrr"), "beginning_mrr")
    )


@query(
    "Q9_retention_bounds",
    """select * replace (retention_rate * 4 as retention_rate) from retention_mart where retention_rate * 4 > 1""",
)
def _retention(m, t):
    return checks.retention_bounds(m.mart_cohort_retention.withColumn("retention_rate", F.col("retention_rate") * 4))


@query(
    "Q10_revenue_reconciles",
    """select * replace (cast(0 as decimal(18,2)) as reactivation_mrr) from revenue_fact
       where reactivation_mrr > 0.01""",
)
def _reconciles(m, t):
    return checks.revenue_reconciles(
        m.fct_account_month.withColumn("reactivation_mrr", F.lit(0).cast("decimal(18,2)"))
    )
