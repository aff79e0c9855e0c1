"""Plain SQL for the datasets and models, as common table expressions.

Written for DuckDB over the same Parquet tables; used only to compare results. ``with_models``
prefixes a query with exactly the expressions it needs.
"""

from __future__ import annotations

import re

PARTS: dict[str, str] = {}

# --- the six datasets, from the driver's tables ---------------------------------------------
PARTS["first_orders"] = """
    select o_custkey, cast(min(o_orderdate) as date) as signup_date from orders group by o_custkey"""
PARTS["src_accounts"] = """
    select cast(c.c_custkey as varchar) as account_id, f.signup_date, c.c_mktsegment as segment,
           r.r_name as region,
           case c.c_custkey % 4 when 0 then 'organic' when 1 then 'paid_search'
                when 2 then 'partner' else 'content' end as channel
    from customer c
    join first_orders f on f.o_custkey = c.c_custkey
    join nation n on n.n_nationkey = c.c_nationkey
    join region r on r.r_regionkey = n.n_regionkey"""
PARTS["order_lines"] = """
    select l.*, o.o_custkey from lineitem l join orders o on o.o_orderkey = l.l_orderkey"""
PARTS["src_users"] = """
    select cast(o_custkey as varchar) || 'U' || cast(l_linenumber as varchar) as user_id,
           cast(o_custkey as varchar) as account_id, cast(min(l_shipdate) as date) as created_date
    from order_lines group by o_custkey, l_linenumber"""
PARTS["src_subscriptions"] = """
    select cast(o_custkey as varchar) as account_id,
           cast(date_trunc('month', o_orderdate) as date) as month,
           cast(sum(cast(round(o_totalprice * 100) as bigint)) as bigint) as amount_cents,
           case when o_custkey % 4 = 0 then 'annual' else 'monthly' end as billing_period,
           case o_custkey % 3 when 0 then 'Starter' when 1 then 'Growth' else 'Scale' end as plan
    from orders group by o_custkey, cast(date_trunc('month', o_orderdate) as date)"""
PARTS["event_versions"] = """
    select cast(l_orderkey * 10 + l_linenumber as varchar) as event_id,
           cast(o_custkey as varchar) || 'U' || cast(l_linenumber as varchar) as user_id,
           cast(o_custkey as varchar) as account_id, l_shipdate as occurred_at,
           case l_partkey % 6 when 0 then 'login' when 1 then 'workspace_created'
                when 2 then 'invite_sent' when 3 then 'report_created'
                when 4 then 'export' else 'automation' end as event_name,
           l_shipdate + to_days(cast(l_suppkey % 5 as integer)) as ingested_at
    from order_lines"""
PARTS["src_events"] = "select * from event_versions"
PARTS["src_opportunities"] = """
    select cast(f.o_custkey as varchar) as account_id, f.signup_date as trial_date,
           case when f.o_custkey % 5 <> 0 or f.o_custkey % 7 <> 0
                then cast(f.signup_date + 2 as date) end as qualified_date,
           case when f.o_custkey % 5 <> 0
                then cast(f.signup_date + cast(3 + f.o_custkey % 19 as integer) as date) end as paid_date
    from first_orders f join customer c on c.c_custkey = f.o_custkey"""
PARTS["src_marketing"] = """
    select cast(o_orderdate as date) as spend_date,
           case o_custkey % 4 when 0 then 'organic' when 1 then 'paid_search'
                when 2 then 'partner' else 'content' end as channel,
           cast(sum(cast(round(o_totalprice) as bigint)) as bigint) as spend_cents
    from orders group by 1, 2"""

# --- dimensions and facts -------------------------------------------------------------------
PARTS["account_dim"] = """
    select *, cast(date_trunc('month', signup_date) as date) as cohort_month from src_accounts"""
PARTS["date_dim"] = """
    select distinct spend_date as date_day, cast(date_trunc('month', spend_date) as date) as month,
           cast(year(spend_date) as integer) as year, cast(month(spend_date) as integer) as month_number
    from src_marketing"""
PARTS["month_list"] = "select distinct month from date_dim"
PARTS["clean_events"] = """
    select event_id, user_id, account_id, occurred_at, event_name, ingested_at from src_events
    qualify row_number() over (
        partition by event_id
        order by ingested_at desc, user_id, account_id, occurred_at, event_name) = 1"""
PARTS["event_fact"] = """
    select event_id, user_id, account_id, cast(occurred_at as date) as date_day,
           cast(date_trunc('month', occurred_at) as date) as month, occurred_at, event_name
    from clean_events"""
PARTS["balances"] = """
    select a.account_id, m.month,
           cast(coalesce(
               cast(case when s.billing_period = 'annual' then (s.amount_cents * 2 + 12) // 24
                         else s.amount_cents end as decimal(18,0)) * cast(0.01 as decimal(3,2)), 0)
               as decimal(18,2)) as mrr
    from account_dim a
    join month_list m on a.cohort_month <= m.month
    left join src_subscriptions s on s.account_id = a.account_id and s.month = m.month"""
PARTS["account_month_balances"] = """
    select account_id, month, mrr,
           cast(lag(mrr, 1, 0) over w as decimal(18,2)) as beginning_mrr,
           cast(coalesce(max(mrr) over (w rows between unbounded preceding and 1 preceding), 0)
                as decimal(18,2)) as historical_mrr
    from balances window w as (partition by account_id order by month)"""
PARTS["revenue_fact"] = """
    select account_id, month, mrr, beginning_mrr,
           cast(if(beginning_mrr = 0 and historical_mrr = 0, mrr, 0) as decimal(18,2)) as new_mrr,
           cast(if(beginning_mrr = 0 and historical_mrr > 0, mrr, 0) as decimal(18,2)) as reactivation_mrr,
           cast(if(beginning_mrr > 0, greatest(mrr - beginning_mrr, 0), 0) as decimal(18,2)) as expansion_mrr,
           cast(if(mrr > 0, greatest(beginning_mrr - mrr, 0), 0) as decimal(18,2)) as contraction_mrr,
           cast(if(mrr = 0, beginning_mrr, 0) as decimal(18,2)) as churn_mrr,
           cast(mrr > 0 as integer) as paying_account,
           cast(beginning_mrr > 0 as integer) as beginning_account,
           cast(beginning_mrr > 0 and mrr = 0 as integer) as churned_account
    from account_month_balances"""
PARTS["activations"] = """
    select a.account_id, min(e.occurred_at) as activation_at
    from account_dim a join event_fact e using (account_id)
    where e.event_name = 'workspace_created'
      and e.date_day between a.signup_date and a.signup_date + 6
    group by a.account_id"""
PARTS["funnel_fact"] = """
    select a.account_id, a.signup_date, o.trial_date, o.qualified_date, o.paid_date,
           cast(v.activation_at as date) as activation_date,
           cast(a.signup_date + 7 <= (select max(date_day) from date_dim) as integer) as activation_eligible,
           cast(v.activation_at is not null as integer) as activated,
           cast(o.qualified_date is not null as integer) as qualified,
           cast(o.paid_date is not null as integer) as converted
    from account_dim a
    left join src_opportunities o using (account_id)
    left join activations v using (account_id)"""
PARTS["spend_fact"] = """
    select spend_date as date_day, channel, cast(spend_cents as double) / 100 as spend from src_marketing"""

# --- marts ----------------------------------------------------------------------------------
PARTS["revenue_months"] = """
    select month,
           cast(sum(mrr) as decimal(28,2)) as mrr, cast(sum(beginning_mrr) as decimal(28,2)) as beginning_mrr,
           cast(sum(new_mrr) as decimal(28,2)) as new_mrr,
           cast(sum(reactivation_mrr) as decimal(28,2)) as reactivation_mrr,
           cast(sum(expansion_mrr) as decimal(28,2)) as expansion_mrr,
           cast(sum(contraction_mrr) as decimal(28,2)) as contraction_mrr,
           cast(sum(churn_mrr) as decimal(28,2)) as churn_mrr,
           cast(sum(paying_account) as bigint) as paying_accounts,
           cast(sum(beginning_account) as bigint) as beginning_accounts,
           cast(sum(churned_account) as bigint) as churned_accounts
    from revenue_fact group by month"""
PARTS["revenue_mart"] = """
    select *, cast(mrr * 12 as decimal(28,2)) as arr,
           cast(beginning_mrr - contraction_mrr - churn_mrr + expansion_mrr as double)
               / cast(nullif(beginning_mrr, 0) as double) as nrr,
           cast(beginning_mrr - contraction_mrr - churn_mrr as double)
               / cast(nullif(beginning_mrr, 0) as double) as grr,
           cast(churned_accounts as double) / cast(nullif(beginning_accounts, 0) as double) as logo_churn_rate,
           cast(mrr as double) / cast(nullif(paying_accounts, 0) as double) as arpa,
           cast(mrr as double) / cast(nullif(paying_accounts, 0) as double) * cast(0.8 as double)
               / nullif(cast(sum(churned_accounts) over w as double)
                        / nullif(cast(sum(beginning_accounts) over w as double), 0), 0) as modeled_ltv
    from revenue_months
    window w as (order by month rows between 2 preceding and current row)"""
PARTS["product_mart"] = """
    with days as (
        select d.date_day, d.month, count(distinct e.user_id) as dau
        from date_dim d left join event_fact e on e.date_day = d.date_day group by all),
    averages as (
        select month, cast(sum(dau) as double) / cast(count(*) as double) as average_dau
        from days group by month),
    totals as (
        select month, count(distinct user_id) as mau, count(distinct account_id) as active_accounts
        from event_fact group by month)
    select a.month, a.average_dau, coalesce(t.mau, 0) as mau,
           coalesce(t.active_accounts, 0) as active_accounts,
           a.average_dau / cast(nullif(t.mau, 0) as double) as stickiness
    from averages a left join totals t on t.month = a.month"""
PARTS["adoption_mart"] = """
    select p.month, f.feature, count(distinct e.user_id) as feature_users, p.mau,
           cast(count(distinct e.user_id) as double) / cast(nullif(p.mau, 0) as double) as adoption_rate
    from product_mart p
    cross join (values ('report_created'), ('export'), ('automation'), ('invite_sent')) f(feature)
    left join event_fact e on e.month = p.month and e.event_name = f.feature
    group by p.month, f.feature, p.mau"""
PARTS["retention_mart"] = """
    with seen as (select distinct account_id, month from event_fact)
    select a.cohort_month, m.month,
           cast(datediff('month', a.cohort_month, m.month) as integer) as cohort_age,
           count(*) as cohort_accounts, count(s.account_id) as retained_accounts,
           cast(count(s.account_id) as double) / cast(count(*) as double) as retention_rate
    from account_dim a
    join month_list m on m.month >= a.cohort_month
    left join seen s on s.account_id = a.account_id and s.month = m.month
    group by a.cohort_month, m.month"""
PARTS["acquisition_mart"] = """
    with gained as (
        select a.cohort_month as month, a.channel, count(*) as signups,
               cast(sum(f.qualified) as bigint) as qualified,
               cast(sum(f.converted) as bigint) as paid_accounts,
               cast(sum(f.activated) filter (f.activation_eligible = 1) as bigint) as activated_accounts,
               cast(sum(f.activation_eligible) as bigint) as eligible_accounts
        from funnel_fact f join account_dim a using (account_id) group by 1, 2),
    spent as (
        select cast(date_trunc('month', spend_date) as date) as month, channel,
               cast(sum(spend_cents) as double) / 100 as spend
        from src_marketing group by 1, 2)
    select s.month, s.channel, s.spend, coalesce(g.signups, 0) as signups,
           coalesce(g.qualified, 0) as qualified, coalesce(g.paid_accounts, 0) as paid_accounts,
           coalesce(g.activated_accounts, 0) as activated_accounts,
           coalesce(g.eligible_accounts, 0) as eligible_accounts,
           cast(g.paid_accounts as double) / cast(nullif(g.signups, 0) as double) as conversion_rate,
           cast(coalesce(g.activated_accounts, 0) as double)
               / cast(nullif(g.eligible_accounts, 0) as double) as activation_rate,
           s.spend / cast(nullif(g.paid_accounts, 0) as double) as cohort_acquisition_cost
    from spent s left join gained g using (month, channel)"""


def with_models(query: str, **extra: str) -> str:
    """``query`` preceded by the parts it names, in dependency order. ``extra`` adds parts."""
    parts = {**PARTS, **extra}
    words = {name: set(re.findall(r"\w+", text)) for name, text in parts.items()}
    needed, todo = set(), set(re.findall(r"\w+", query)) & set(parts)
    while todo:
        name = todo.pop()
        needed.add(name)
        todo |= (words[name] & set(parts)) - needed - {name}
    ordered = [n for n in parts if n in needed]
    if not ordered:
        return query
    opening = "with " + ",\n".join(f"{n} as ({parts[n]})" for n in ordered)
    body = query.strip()
    return f"{opening},\n{body[5:]}" if body.startswith("with ") else f"{opening}\n{body}"
