"""Measures and semantic operators (D, E)."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parity.core import query
from subspan.operators import semantic
from subspan.operators.measures import Star, measure_query
from subspan.plans.models import Models
from subspan.plans.pages import page
from subspan.session import shared_dir

# Blank members: a fact day outside the calendar has no date row, so its month is NULL.
DATED_EVENTS = """
    select e.user_id, e.account_id, e.event_name, e.date_day, d.month, d.year, d.date_day as known_day,
           a.segment, a.region, a.channel, a.cohort_month
    from event_fact e left join date_dim d on d.date_day = e.date_day
    left join account_dim a on a.account_id = e.account_id"""

REVENUE_COLUMNS = """
    mrr, beginning_mrr, new_mrr, reactivation_mrr, expansion_mrr, contraction_mrr, churn_mrr,
    paying_accounts, beginning_accounts, churned_accounts, arr, nrr, grr, logo_churn, arpa, mrr_reconciliation"""

REVENUE_MEASURES = [c.strip() for c in REVENUE_COLUMNS.split(",")]


def revenue_by(columns: str) -> dict[str, str]:
    """Parts ``group_months`` (sums per group and month) and ``group_last`` (the last of each)."""
    keys = f"{columns}, " if columns else ""
    partition = f"partition by {columns}" if columns else ""
    names = [c for c in columns.split(", ") if c]
    last_keys = "".join(f"l.{c}, " for c in names)
    same = " ".join(f"and w.{c} = l.{c}" for c in names)
    return {
        "group_months": f"""
            select {keys}r.month as period,
                   cast(sum(mrr) as decimal(28,2)) as mrr, cast(sum(beginning_mrr) as decimal(28,2)) as beginning_mrr,
                   cast(sum(new_mrr) as decimal(28,2)) as new_mrr,
                   cast(sum(reactivation_mrr) as decimal(28,2)) as reactivation_mrr,
                   cast(sum(expansion_mrr) as decimal(28,2)) as expansion_mrr,
                   cast(sum(contraction_mrr) as decimal(28,2)) as contraction_mrr,
                   cast(sum(churn_mrr) as decimal(28,2)) as churn_mrr,
                   cast(sum(paying_account) as bigint) as paying_accounts,
                   cast(sum(beginning_account) as bigint) as beginning_accounts,
                   cast(sum(churned_account) as bigint) as churned_accounts
            from revenue_fact r join account_dim a using (account_id)
            group by {keys}r.month""",
        "group_last": f"""
            select *, cast(mrr * 12 as decimal(28,2)) as arr,
                   cast(beginning_mrr + expansion_mrr - contraction_mrr - churn_mrr as double)
                       / cast(nullif(beginning_mrr, 0) as double) as nrr,
                   cast(beginning_mrr - contraction_mrr - churn_mrr as double)
                       / cast(nullif(beginning_mrr, 0) as double) as grr,
                   cast(churned_accounts as double) / cast(nullif(beginning_accounts, 0) as double) as logo_churn,
                   cast(mrr as double) / cast(nullif(paying_accounts, 0) as double) as arpa,
                   cast(mrr - (beginning_mrr + new_mrr + reactivation_mrr + expansion_mrr - contraction_mrr
                               - churn_mrr) as decimal(28,2)) as mrr_reconciliation
            from group_months qualify period = max(period) over ({partition})""",
        "group_ltv": f"""
            select {last_keys}l.arpa * cast(0.8 as double)
                   / nullif(cast(sum(w.churned_accounts) as double)
                            / nullif(cast(sum(w.beginning_accounts) as double), 0), 0) as modeled_ltv
            from group_last l join group_months w
              on w.period between l.period - interval 2 month and l.period {same}
             and w.period in (select date_day from date_dim)
            group by {last_keys}l.arpa""",
    }


def star_query(name: str, sql: str | None = None, **extra: str):
    def register(fn):
        query(name, sql, **extra)(lambda m, t: fn(Star.of(m), m))
        return fn

    return register


for label, columns in (("total", ""), ("by_segment", "segment"), ("by_region_channel", "region, channel")):
    keys = f"{columns}, " if columns else ""
    by = [c for c in columns.split(", ") if c]
    parts = revenue_by(columns)
    star_query(f"D1_to_D17_revenue_{label}", f"select {keys}{REVENUE_COLUMNS} from group_last", **parts)(
        lambda s, m, by=by: measure_query(s, REVENUE_MEASURES, by)
    )
    star_query(f"D16_modeled_ltv_{label}", f"select {keys}modeled_ltv from group_ltv{' where modeled_ltv is not null' if by else ''}", **parts)(
        lambda s, m, by=by: measure_query(s, ["modeled_ltv"], by)
    )

# Revenue reaches the calendar through the first day of its month; if the calendar lacks that
# day, the month is blank.
MONTHLY = revenue_by("month")
MONTHLY["group_months"] = (
    MONTHLY["group_months"]
    .replace("month, r.month as period", "d.month, r.month as period")
    .replace("from revenue_fact r", "from revenue_fact r left join date_dim d on d.date_day = r.month")
    .replace("group by month, r.month", "group by d.month, r.month")
)


@star_query("D1_to_D15_revenue_by_month", f"select month, {REVENUE_COLUMNS} from group_last", **MONTHLY)
def _(s, m):
    return measure_query(s, REVENUE_MEASURES, ["month"])


@star_query(
    "D16_modeled_ltv_by_month",
    """with ltv as (
           select l.month, l.arpa * cast(0.8 as double)
                  / nullif(cast(sum(w.churned_accounts) as double)
                           / nullif(cast(sum(w.beginning_accounts) as double), 0), 0) as modeled_ltv
           from group_last l join revenue_months w
             on w.month between l.period - interval 2 month and l.period
            and w.month in (select date_day from date_dim)
           group by l.month, l.period, l.arpa)
       select * from ltv where modeled_ltv is not null""",
    **MONTHLY,
)
def _(s, m):
    return measure_query(s, ["modeled_ltv"], ["month"])


@star_query(
    "D1_mrr_by_year_and_segment_filtered",
    """with monthly as (
           select d.year, a.segment, r.month, cast(sum(r.mrr) as decimal(28,2)) as mrr
           from revenue_fact r join account_dim a using (account_id) join date_dim d on d.date_day = r.month
           where a.region = 'EUROPE' and d.year between 1996 and 1999 group by all)
       select year, segment, mrr from monthly qualify month = max(month) over (partition by year, segment)""",
)
def _(s, m):
    return measure_query(
        s,
        ["mrr"],
        ["year", "segment"],
        accounts=F.col("region") == "EUROPE",
        dates=F.col("year").between(1996, 1999),
    )


# --- product --------------------------------------------------------------------------------
def product_sql(keys: str, anchor: str, events: str = "") -> str:
    """MAU, average DAU and stickiness of each group in its reference month.

    Groups are those of the dimensions: without any event the average is 0 and the rest blank.
    """
    lead = f"{keys}, " if keys else ""
    group = f"group by {keys}" if keys else ""
    named = [k for k in keys.split(", ") if k]
    same = " and ".join(f"u.{k} is not distinct from g.{k}" for k in named) or "true"
    days = same.replace("u.", "d.")
    sources = {"event_name": "event_fact"}
    grid = " cross join ".join(f"(select distinct {k} from {sources.get(k, 'account_dim')})" for k in named) or "(select 1 as one)"
    return f"""with reference as ({anchor}),
        in_month as (
            select x.*, x.month as event_month from dated_events x join reference on x.month = anchor {events}),
        users as (select {lead}count(distinct user_id) as mau from in_month {group}),
        days as (select {lead}date_day, count(distinct user_id) as dau from in_month group by {lead}date_day),
        dau as (select {lead}cast(sum(dau) as double) as user_days from days {group}),
        size as (select count(*) as n from date_dim join reference on month = anchor),
        grid as (select * from {grid})
        select {"".join(f"g.{k}, " for k in named)}nullif(u.mau, 0) as mau,
               coalesce(d.user_days, 0) / cast(size.n as double) as average_dau,
               coalesce(d.user_days, 0) / cast(size.n as double) / cast(nullif(u.mau, 0) as double) as stickiness
        from grid g cross join size left join users u on {same} left join dau d on {days}"""


LAST_MONTH = "select max(month) as anchor from date_dim"
PRODUCT = ["mau", "average_dau", "stickiness"]
star_query("D19_to_D21_product_total", product_sql("", LAST_MONTH), dated_events=DATED_EVENTS)(
    lambda s, m: measure_query(s, PRODUCT)
)
for label, columns in (("by_segment", "segment"), ("by_event_name", "event_name"), ("by_segment_event", "segment, event_name")):
    star_query(f"D19_to_D21_product_{label}", product_sql(columns, LAST_MONTH), dated_events=DATED_EVENTS)(
        lambda s, m, by=columns.split(", "): measure_query(s, PRODUCT, by)
    )


@star_query(
    "D19_to_D21_product_by_month",
    """with days as (
           select d.month, d.date_day, count(distinct e.user_id) as dau
           from date_dim d left join event_fact e on e.date_day = d.date_day group by all),
       users as (select month, count(distinct user_id) as mau from dated_events where month is not null group by 1)
       select d.month, u.mau, cast(sum(dau) as double) / cast(count(*) as double) as average_dau,
              cast(sum(dau) as double) / cast(count(*) as double) / cast(u.mau as double) as stickiness
       from days d left join users u on u.month = d.month group by d.month, u.mau""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, PRODUCT, ["month"])


def acquisition_sql(columns: str) -> str:
    """Groups are account attributes; spend is that of every channel seen in the group."""
    keys = [c for c in columns.split(", ") if c]
    lead = "".join(f"{k}, " for k in keys)
    group = f"group by {columns}" if keys else ""
    on = " and ".join(f"s.{k} = g.{k}" for k in keys) or "true"
    return f"""with joined as (select f.*, a.segment, a.region, a.channel from funnel_fact f join account_dim a using (account_id)),
        gained as (
            select {lead}count(*) as signup_accounts, cast(sum(qualified) as bigint) as qualified_accounts,
                   cast(sum(converted) as bigint) as converted_accounts,
                   cast(sum(converted) as double) / cast(count(*) as double) as conversion_rate,
                   cast(sum(activated) filter (activation_eligible = 1) as double)
                       / cast(nullif(sum(activation_eligible), 0) as double) as activation_rate
            from joined {group}),
        channels as (select distinct {lead}channel as used from account_dim),
        spent as (
            select {"".join(f"c.{k}, " for k in keys)}cast(sum(m.spend_cents) as double) / 100 as marketing_spend
            from channels c join src_marketing m on m.channel = c.used {"group by " + ", ".join(f"c.{k}" for k in keys) if keys else ""})
        select g.*, s.marketing_spend,
               s.marketing_spend / cast(nullif(g.converted_accounts, 0) as double) as cohort_acquisition_cost
        from gained g left join spent s on {on}"""


PRODUCT_BY_MONTH = """
    with days as (
        select d.month, d.date_day, count(distinct e.user_id) as dau
        from date_dim d left join event_fact e on e.date_day = d.date_day group by all),
    users as (select month, count(distinct user_id) as mau from dated_events where month is not null group by 1)
    select d.month, u.mau, cast(sum(dau) as double) / cast(count(*) as double) as average_dau
    from days d left join users u on u.month = d.month group by d.month, u.mau"""
ACTIVATION_RATE = """
    select cast(sum(activated) filter (activation_eligible = 1) as double)
           / cast(nullif(sum(activation_eligible), 0) as double) as activation_rate
    from funnel_fact"""


@star_query("E2_product_usage", PRODUCT_BY_MONTH, dated_events=DATED_EVENTS)
def _(s, m):
    return page(s, "product", "usage")


@star_query(
    "E2_product_headline",
    f"select * from ({product_sql('', LAST_MONTH)}) cross join ({ACTIVATION_RATE})",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return page(s, "product", "headline")


@star_query(
    "E2_acquisition_funnel",
    f"""select channel, signup_accounts, qualified_accounts, converted_accounts, conversion_rate, activation_rate
        from ({acquisition_sql('channel')})""",
)
def _(s, m):
    return page(s, "acquisition", "funnel")


@star_query(
    "E2_retention_cohorts",
    """with seen as (
           select cohort_month, month, count(distinct account_id) as retained from dated_events group by 1, 2),
       size as (select cohort_month, count(*) as n from account_dim group by 1)
       select cohort_month, month, cast(retained as double) / cast(n as double) as cohort_retention
       from seen join size using (cohort_month)""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return page(s, "retention", "cohorts")


@star_query(
    "D19_mau_by_region_and_month",
    """select region, month, count(distinct user_id) as mau from dated_events where month is not null group by 1, 2""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["mau"], ["region", "month"])


@star_query(
    "D18_D30_active_by_month",
    """select month, count(distinct user_id) as active_users, count(distinct account_id) as retained_accounts
       from dated_events group by month""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["active_users", "retained_accounts"], ["month"])


@star_query(
    "D18_D30_active_by_segment",
    """select segment, count(distinct user_id) as active_users, count(distinct account_id) as retained_accounts
       from dated_events group by segment""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["active_users", "retained_accounts"], ["segment"])


def bit_query(name: str, sql: str, **extra: str):
    """A measure query over models that are written tables, with bitmaps of their usage."""

    def register(fn):
        def run(m, t):
            folder = f"{shared_dir(t.spark)}/models-{uuid.uuid4().hex}"
            return fn(Star.of(Models(m.raw, folder), bits=True))

        query(name, sql, **extra)(run)
        return fn

    return register


@bit_query(
    "D18_D30_bitmaps_by_segment_and_event",
    """select segment, event_name, count(distinct user_id) as active_users, count(distinct account_id) as retained_accounts
       from dated_events group by segment, event_name""",
    dated_events=DATED_EVENTS,
)
def _(s):
    return measure_query(s, ["active_users", "retained_accounts"], ["segment", "event_name"])


@bit_query(
    "D19_bitmaps_by_segment_and_month",
    """select segment, month, count(distinct user_id) as mau from dated_events where month is not null group by 1, 2""",
    dated_events=DATED_EVENTS,
)
def _(s):
    return measure_query(s, ["mau"], ["segment", "month"])


@star_query(
    "D18_active_by_day_and_event",
    """select known_day as date_day, event_name, count(distinct user_id) as active_users
       from dated_events group by 1, 2""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["active_users"], ["date_day", "event_name"])


@star_query(
    "D18_active_total",
    "select count(distinct user_id) as active_users from event_fact",
)
def _(s, m):
    return measure_query(s, ["active_users"])


@star_query(
    "D22_feature_adoption_by_event",
    """with here as (select * from dated_events where month = (select max(month) from date_dim)),
       everyone as (select count(distinct user_id) as n from here)
       select event_name, cast(count(distinct user_id) as double) / cast(any_value(n) as double) as feature_adoption
       from here cross join everyone group by event_name""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["feature_adoption"], ["event_name"])


@star_query(
    "D22_feature_adoption_by_month_and_event",
    """with everyone as (select month, count(distinct user_id) as n from dated_events group by 1),
       each as (select month, event_name, count(distinct user_id) as k from dated_events group by 1, 2)
       select month, event_name, cast(k as double) / cast(n as double) as feature_adoption
       from each join everyone using (month)""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["feature_adoption"], ["month", "event_name"])


# --- acquisition and retention --------------------------------------------------------------
ACQUISITION = [
    "signup_accounts",
    "qualified_accounts",
    "converted_accounts",
    "conversion_rate",
    "activation_rate",
    "marketing_spend",
    "cohort_acquisition_cost",
]


for label, columns in (("total", ""), ("by_channel", "channel"), ("by_segment", "segment")):
    star_query(f"D23_to_D29_acquisition_{label}", acquisition_sql(columns))(
        lambda s, m, by=[c for c in columns.split(", ") if c]: measure_query(s, ACQUISITION, by)
    )


@star_query(
    "D23_to_D29_acquisition_by_month",
    """with gained as (
           select d.month, count(*) as signup_accounts, cast(sum(qualified) as bigint) as qualified_accounts,
                  cast(sum(converted) as bigint) as converted_accounts,
                  cast(sum(converted) as double) / cast(count(*) as double) as conversion_rate,
                  cast(sum(activated) filter (activation_eligible = 1) as double)
                      / cast(nullif(sum(activation_eligible), 0) as double) as activation_rate
           from funnel_fact f left join date_dim d on d.date_day = f.signup_date group by d.month),
       spent as (
           select cast(date_trunc('month', spend_date) as date) as month,
                  cast(sum(spend_cents) as double) / 100 as marketing_spend
           from src_marketing where channel in (select channel from account_dim) group by 1)
       select coalesce(g.month, s.month) as month, signup_accounts, qualified_accounts, converted_accounts,
              conversion_rate, activation_rate, marketing_spend,
              marketing_spend / cast(nullif(converted_accounts, 0) as double) as cohort_acquisition_cost
       from gained g full join spent s on s.month = g.month""",
)
def _(s, m):
    return measure_query(s, ACQUISITION, ["month"])


@star_query(
    "D30_to_D32_cohort_retention",
    """with seen as (
           select cohort_month, month, count(distinct account_id) as retained_accounts from dated_events group by 1, 2),
       size as (select cohort_month, count(*) as cohort_accounts from account_dim group by 1)
       select cohort_month, month, retained_accounts, cohort_accounts,
              cast(retained_accounts as double) / cast(cohort_accounts as double) as cohort_retention
       from seen join size using (cohort_month)""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["retained_accounts", "cohort_accounts", "cohort_retention"], ["cohort_month", "month"])


@star_query(
    "D31_D33_accounts_by_signup_date",
    """select signup_date, count(*) as cohort_accounts,
              case when count(*) = 1 then min(account_id) else 'Multiple accounts' end as account_context
       from account_dim group by 1""",
)
def _(s, m):
    return measure_query(s, ["cohort_accounts", "account_context"], ["signup_date"])


@star_query(
    "D34_revenue_context",
    """select segment, 'MRR $' || format('{:,}', cast(round(mrr) as bigint)) || ' | NRR '
                  || coalesce(cast(cast(round(nrr * 100, 1) as decimal(28,1)) as varchar) || '%', '') as revenue_context
       from group_last""",
    **revenue_by("segment"),
)
def _(s, m):
    return measure_query(s, ["revenue_context"], ["segment"])


# --- semantic operators ---------------------------------------------------------------------
@star_query(
    "E1_star_join",
    """select d.year, a.region, cast(sum(r.expansion_mrr) as decimal(28,2)) as expansion_mrr
       from revenue_fact r join account_dim a using (account_id) join date_dim d on d.date_day = r.month
       where a.channel = 'partner' and d.month_number = 12 group by 1, 2""",
)
def _(s, m):
    return measure_query(
        s,
        ["expansion_mrr"],
        ["year", "region"],
        accounts=F.col("channel") == "partner",
        dates=F.col("month_number") == 12,
    )


@star_query(
    "E2_validation_bridge",
    """select month, mrr, arr, nrr, grr, mrr_reconciliation from group_last""",
    **MONTHLY,
)
def _(s, m):
    return page(s, "validation", "bridge").orderBy("month")


def comparison_sql(measure: str, source: str, keys: str = "") -> str:
    lead = "".join(f"coalesce(c.{k}, p.{k}) as {k}, " for k in keys.split(", ") if k)
    on = "".join(f" and p.{k} = c.{k}" for k in keys.split(", ") if k)
    return f"""with cur as (select {keys}{", " if keys else ""}month, {measure} as v from {source} where {measure} is not null and month is not null),
        prev as (select * replace (cast(month + interval 1 month as date) as month) from cur)
        select {lead}coalesce(c.month, p.month) as month, c.v as current, p.v as previous_month,
               cast(coalesce(c.v, 0) - p.v as double) / cast(nullif(p.v, 0) as double) as mom_change
        from cur c full join prev p on p.month = c.month{on}
        where coalesce(c.month, p.month) in (select month from month_list)"""


@star_query("E3_period_comparison_mrr", comparison_sql("mrr", "group_last"), **MONTHLY)
def _(s, m):
    return semantic.period_comparison(s, "mrr")


@star_query(
    "E3_period_comparison_mau_by_segment",
    comparison_sql("mau", "segment_mau", "segment"),
    dated_events=DATED_EVENTS,
    segment_mau="""select segment, month, count(distinct user_id) as mau from dated_events
                   where month is not null group by 1, 2""",
)
def _(s, m):
    return semantic.period_comparison(s, "mau", ["segment", "month"])


# The definition by shifting: a group's earlier value is the measure over its months moved back by one.
def shifted_sql(key: str, label: str, value: str, at: str) -> str:
    """``value``: an aggregate of a month's rows ``at``; a group shows its last month."""
    lead = f"{key}, " if key else ""
    names = [n for n in (key, label) if n]
    return f"""with monthly as (select r.month, {lead}{value} as v from {at} {"group by r.month" + (", " + key if key else "")}),
        calendar as (select month, year from date_dim where date_day = month),
        cur as (select {", ".join(n for n in names) + ", " if names else ""}max_by(v, month) as v
                from monthly join calendar using (month) {"group by " + ", ".join(names) if names else ""}),
        moved as (select m.* exclude (month), m.month, year(m.month + interval 1 month) as year from monthly m join calendar using (month)
                  where cast(m.month + interval 1 month as date) in (select month from date_dim)),
        prev as (select {", ".join(n for n in names) + ", " if names else ""}max_by(v, month) as v
                 from moved {"group by " + ", ".join(names) if names else ""})
        select {"".join(f"coalesce(c.{n}, p.{n}) as {n}, " for n in names)}c.v as current, p.v as previous_month,
               cast(coalesce(c.v, 0) - p.v as double) / cast(nullif(p.v, 0) as double) as mom_change
        from cur c full join prev p on {" and ".join(f"c.{n} = p.{n}" for n in names) or "true"}"""


MRR_ROWS = "revenue_fact r join account_dim a using (account_id)"
MRR_SUM = "cast(sum(r.mrr) as decimal(28,2))"
for _label, _key, _dates, _by in (
    ("total", "", "", []),
    ("by_segment_without_month", "segment", "", ["segment"]),
    ("by_year", "", "year", ["year"]),
):
    star_query(f"E3_period_comparison_mrr_{_label}", shifted_sql(_key, _dates, MRR_SUM, MRR_ROWS))(
        lambda s, m, by=_by: semantic.period_comparison(s, "mrr", by)
    )


@star_query(
    "E3_period_comparison_mrr_by_year_and_month",
    comparison_sql("mrr", "group_last").replace("select coalesce(c.month", "select cast(year(coalesce(c.month, p.month)) as integer) as year, coalesce(c.month"),
    **MONTHLY,
)
def _(s, m):
    return semantic.period_comparison(s, "mrr", ["year", "month"])


@star_query(
    "E3_period_comparison_signups",
    """with monthly as (
           select d.month, count(*) as v from funnel_fact f join date_dim d on d.date_day = f.signup_date group by 1),
       months as (select distinct month from date_dim)
       select m.month, c.v as current, p.v as previous_month,
              cast(coalesce(c.v, 0) - p.v as double) / cast(p.v as double) as mom_change
       from months m left join monthly c on c.month = m.month
       left join monthly p on p.month = cast(m.month - interval 1 month as date)
       where c.v is not null or p.v is not null""",
)
def _(s, m):
    return semantic.period_comparison(s, "signup_accounts")


@star_query(
    "D20_average_dau_by_segment_and_month",
    """with grid as (select distinct a.segment, d.month from account_dim a cross join date_dim d),
       days as (
           select segment, month, known_day, count(distinct user_id) as dau from dated_events
           where known_day is not null group by all),
       size as (select month, count(*) as n from date_dim group by 1)
       select g.segment, g.month, cast(coalesce(sum(d.dau), 0) as double) / cast(size.n as double) as average_dau
       from grid g join size using (month) left join days d on d.segment = g.segment and d.month = g.month
       group by g.segment, g.month, size.n""",
    dated_events=DATED_EVENTS,
)
def _(s, m):
    return measure_query(s, ["average_dau"], ["segment", "month"])


@star_query(
    "D19_mau_by_day",
    """with users as (select d.month, count(distinct e.user_id) as mau from event_fact e join date_dim d using (date_day) group by 1)
       select date_day, mau from date_dim join users using (month)""",
)
def _(s, m):
    return measure_query(s, ["mau"], ["date_day"])


@star_query(
    "E4_metric_selector",
    """with wide as (
           select coalesce(r.month, u.month) as month, r.mrr, r.arr, r.nrr, u.mau from group_last r
           full join (select month, count(distinct user_id) as mau from dated_events
                      where month is not null group by 1) u on u.month = r.month),
       long as (
           select month, 'MRR' as metric, cast(0 as integer) as position, cast(mrr as double) as value from wide
           union all select month, 'ARR', 1, cast(arr as double) from wide
           union all select month, 'NRR', 2, nrr from wide
           union all select month, 'MAU', 3, cast(mau as double) from wide)
       select * from long where value is not null""",
    dated_events=DATED_EVENTS,
    **MONTHLY,
)
def _(s, m):
    return semantic.metric_selector(s)


# Every user of the nation table is entitled to the region of their nation.
ENTITLEMENTS = "select lower(n_name) || '@example.com' as upn, r_name as region from nation join region on r_regionkey = n_regionkey"


def _entitlements(t):
    return (
        t.table("nation")
        .join(t.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(F.concat(F.lower("n_name"), F.lit("@example.com")).alias("upn"), F.col("r_name").alias("region"))
    )


def _first_user(t):
    """Some user that exists in the table: the smallest name, taken by the query itself."""
    return _entitlements(t).agg(F.min("upn")).scalar()


@query(
    "E5_visible_revenue",
    """select a.region, a.segment, cast(sum(r.mrr) as decimal(28,2)) as mrr, cast(null as double) as marketing_spend
       from revenue_fact r join account_dim a using (account_id)
       where a.region in (select region from entitlements where upn = (select min(upn) from entitlements))
         and r.month = (select max(month) from month_list)
       group by 1, 2""",
    entitlements=ENTITLEMENTS,
)
def _(m, t):
    seen = semantic.restrict_to_user(Star.of(m), _entitlements(t), _first_user(t))
    return measure_query(seen, ["mrr", "marketing_spend"], ["region", "segment"])


@query(
    "E5_unknown_user_sees_nothing",
    """select segment, cast(mrr as decimal(28,2)) as mrr, cast(mrr as bigint) as cohort_accounts
       from revenue_fact join account_dim using (account_id) where false""",
)
def _(m, t):
    seen = semantic.restrict_to_user(Star.of(m), _entitlements(t), "nobody@example.com")
    return measure_query(seen, ["mrr", "cohort_accounts"], ["segment"])


@star_query(
    "E6_drill_through_account",
    """with mine as (
           select * from revenue_fact where account_id = '1' qualify month = max(month) over ()),
       people as (select count(distinct user_id) as active_users from event_fact where account_id = '1')
       select cast(mrr as decimal(28,2)) as mrr, cast(mrr * 12 as decimal(28,2)) as arr,
              cast(beginning_mrr + expansion_mrr - contraction_mrr - churn_mrr as double)
                  / cast(nullif(beginning_mrr, 0) as double) as nrr,
              nullif(active_users, 0) as active_users, account_id as account_context
       from mine cross join people""",
)
def _(s, m):
    return semantic.drill_through(s, "1", ["mrr", "arr", "nrr", "active_users", "account_context"])


@star_query(
    "E6_drill_through_months",
    """select d.month, cast(r.mrr as decimal(28,2)) as mrr
       from revenue_fact r left join date_dim d on d.date_day = r.month
       where r.account_id = '1' qualify r.month = max(r.month) over (partition by d.month)""",
)
def _(s, m):
    return semantic.drill_through(s, "1", ["mrr"], ["month"])


@star_query(
    "E7_cohort_matrix",
    "select cohort_month, "
    + ", ".join(f"max(retention_rate) filter (cohort_age = {i}) as m{i}" for i in range(9))
    + """ from retention_mart
       where cohort_month in (select distinct cohort_month from retention_mart order by 1 desc limit 9) group by 1""",
)
def _(s, m):
    return semantic.cohort_matrix(m.mart_cohort_retention)


# --- report pages ---------------------------------------------------------------------------
@star_query(
    "E2_overview_movements",
    """select month, new_mrr, expansion_mrr, contraction_mrr, churn_mrr, reactivation_mrr from group_last""",
    **MONTHLY,
)
def _(s, m):
    return page(s, "overview", "movements")


@star_query(
    "E2_overview_accounts",
    """with last as (select * from revenue_fact qualify month = max(month) over (partition by account_id))
       select account_id, cast(mrr as decimal(28,2)) as mrr,
              cast(beginning_mrr + expansion_mrr - contraction_mrr - churn_mrr as double)
                  / cast(nullif(beginning_mrr, 0) as double) as nrr
       from last""",
)
def _(s, m):
    return page(s, "overview", "accounts")


@star_query(
    "E2_overview_headline",
    """select mrr, arr, nrr, (select count(distinct user_id) from dated_events
                              where month = (select max(month) from month_list)) as mau
       from group_last""",
    dated_events=DATED_EVENTS,
    **revenue_by(""),
)
def _(s, m):
    return page(s, "overview", "headline")


@star_query(
    "E2_retention_trend",
    "select month, nrr, grr from group_last where coalesce(nrr, grr) is not null",
    **MONTHLY,
)
def _(s, m):
    return page(s, "retention", "trend")


@star_query(
    "E2_acquisition_activation",
    """select d.month, cast(sum(activated) filter (activation_eligible = 1) as double)
                      / cast(nullif(sum(activation_eligible), 0) as double) as activation_rate,
              cast(sum(converted) as double) / cast(count(*) as double) as conversion_rate
       from funnel_fact f left join date_dim d on d.date_day = f.signup_date group by d.month""",
)
def _(s, m):
    return page(s, "acquisition", "activation")


@star_query(
    "E2_tooltip_context",
    """select 'MRR $' || format('{:,}', cast(round(mrr) as bigint)) || ' | NRR '
                  || coalesce(cast(cast(round(nrr * 100, 1) as decimal(28,1)) as varchar) || '%', '') as revenue_context,
              grr
       from group_last""",
    **revenue_by(""),
)
def _(s, m):
    return page(s, "revenue_tooltip", "context")
