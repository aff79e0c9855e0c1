"""Hand-computed results on the golden accounts."""

from collections import defaultdict
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from subspan.functions.columns import monthly_balance
from subspan.operators import analysis, checks
from subspan.operators.revenue import account_month_balances
from subspan.plans import build
from tests.conftest import golden_rows

# month: mrr, begin, new, reactivation, expansion, contraction, churn, paying, begin accounts, churned, nrr, grr, ltv
REVENUE = {
    1: (300, 0, 300, 0, 0, 0, 0, 2, 0, 0, None, None, None),
    2: (200, 300, 50, 0, 50, 0, 200, 2, 2, 1, 0.5, 1 / 3, 160),
    3: (170, 200, 0, 0, 0, 30, 0, 2, 2, 0, 0.85, 0.85, 272),
    4: (50, 170, 0, 0, 0, 0, 120, 1, 2, 1, 5 / 17, 5 / 17, 120),
    5: (130, 50, 0, 80, 0, 0, 0, 2, 1, 0, 1, 1, 260),
    6: (130, 130, 0, 0, 0, 0, 0, 2, 2, 0, 1, 1, 260),
}


def test_monthly_revenue_table(golden):
    got = {r["month"].month: r for r in golden.mart_revenue_monthly.collect()}
    names = (
        "mrr beginning_mrr new_mrr reactivation_mrr expansion_mrr contraction_mrr churn_mrr "
        "paying_accounts beginning_accounts churned_accounts nrr grr modeled_ltv"
    ).split()
    assert set(got) == set(REVENUE)
    for month, expected in REVENUE.items():
        for name, value in zip(names, expected, strict=True):
            actual = got[month][name]
            if value is None:
                assert actual is None, (month, name)
            else:
                assert float(actual) == pytest.approx(value), (month, name)
    assert got[2]["arr"] == Decimal("2400.00")


def test_movements_of_one_account(golden):
    rows = {r["month"].month: r for r in golden.fct_account_month.where("account_id = 'A0000'").collect()}
    assert rows[5]["reactivation_mrr"] == 80 and rows[5]["new_mrr"] == 0
    assert rows[3]["contraction_mrr"] == 30
    assert rows[4]["churn_mrr"] == 120 and rows[4]["mrr"] == 0
    assert len(rows) == 6


def test_accounts_without_billing_keep_zero_rows(golden):
    zero = golden.fct_account_month.where("account_id = 'A0011'").collect()
    assert len(zero) == 6 and all(r["mrr"] == 0 and r["beginning_mrr"] == 0 for r in zero)


def test_product_counts_match_a_recount(golden):
    users, days = defaultdict(set), defaultdict(set)
    for e in golden_rows()["events"]:
        users[e["occurred_at"].month].add(e["user_id"])
        days[e["occurred_at"].month].add((e["user_id"], e["occurred_at"].date()))
    sizes = {1: 31, 2: 29, 3: 31, 4: 30, 5: 31, 6: 30}
    for r in golden.mart_product_monthly.collect():
        month = r["month"].month
        assert r["mau"] == len(users[month])
        assert r["average_dau"] == pytest.approx(len(days[month]) / sizes[month])
        assert r["stickiness"] == pytest.approx(r["average_dau"] / r["mau"])


def test_cohort_denominator_and_ages(golden):
    rows = golden.mart_cohort_retention.collect()
    assert {r["cohort_accounts"] for r in rows} == {12}
    assert sorted(r["cohort_age"] for r in rows) == [0, 1, 2, 3, 4, 5]


def test_activation_window_is_half_open(golden):
    funnel = {r["account_id"]: r for r in golden.fct_account_funnel.collect()}
    assert funnel["A0008"]["activated"] == 1
    assert funnel["A0010"]["activated"] == 0  # on day seven exactly
    assert funnel["A0001"]["activated"] == 0
    assert {r["activation_eligible"] for r in funnel.values()} == {1}


def test_feature_adoption_keeps_zero_rows(golden):
    assert golden.mart_feature_adoption.count() == 6 * 4


def test_acquisition_without_customers_has_zero_counts_and_no_rate(golden):
    rows = {(r["month"].month, r["channel"]): r for r in golden.mart_acquisition.collect()}
    assert rows[1, "organic"]["signups"] == 3
    later = rows[2, "organic"]
    assert later["signups"] == 0 and later["conversion_rate"] is None and later["cohort_acquisition_cost"] is None


def test_all_data_tests_pass(golden):
    failing = {r["check"]: r["failing"] for r in checks.failure_counts(checks.all_checks(golden)).collect()}
    assert len(failing) == 22
    assert not any(failing.values())


def test_bridge_residual_is_zero(golden):
    bridge = analysis.revenue_bridge(golden.fct_account_month, golden.dim_account).collect()
    assert {r["residual"] for r in bridge} == {Decimal("0.00")}


@pytest.mark.parametrize(
    ("cents", "period", "balance"),
    [(1206, "annual", "1.01"), (1205, "annual", "1.00"), (1200, "annual", "1.00"), (6, "annual", "0.01"), (101, "monthly", "1.01")],
)
def test_balances_round_half_up_exactly(spark, cents, period, balance):
    row = spark.createDataFrame([(cents, period)], "c bigint, p string").select(monthly_balance("c", "p").alias("b"))
    assert row.first()["b"] == Decimal(balance)


def test_spine_against_brute_force(spark):
    """Sparse, late, early and missing billing, a calendar with a missing month."""
    months = [date(2024, m, 1) for m in (1, 2, 4, 5, 6, 7)]
    cohorts = {f"a{i}": date(2024, 1 + i % 8, 1) for i in range(40)}
    billing = {
        (a, date(2024, m, 1)): ((i * 7 + m * 3) % 5) * 100
        for i, a in enumerate(cohorts)
        for m in range(1, 9)
        if i % 6 and (i * m) % 4 != 1
    }
    accounts = spark.createDataFrame(list(cohorts.items()), "account_id string, cohort_month date")
    calendar = spark.createDataFrame([(m,) for m in months], "month date")
    subs = spark.createDataFrame(
        [(a, m, c, "monthly") for (a, m), c in billing.items()],
        "account_id string, month date, amount_cents bigint, billing_period string",
    )
    expected = set()
    for account, cohort in cohorts.items():
        before, highest = 0, 0
        for month in (m for m in months if m >= cohort):
            now = billing.get((account, month), 0) // 100
            expected.add((account, month, now, before, highest))
            before, highest = now, max(highest, now)
    got = account_month_balances(accounts, calendar, subs).collect()
    assert {(r[0], r[1], int(r[2]), int(r[3]), int(r[4])) for r in got} == expected
    assert len(got) == len(expected)


def test_duplicate_billing_rows_stay_visible_to_the_grain_check(spark, golden):
    twice = golden.stg_subscriptions.unionByName(golden.stg_subscriptions.where("account_id = 'A0001' and month = '2024-03-01'"))
    grid = account_month_balances(golden.dim_account, golden.dim_date, twice)
    assert [tuple(r) for r in checks.fact_grain(grid).collect()] == [("A0001", date(2024, 3, 1), 2)]


def test_calendar_gap_is_reported(golden):
    gap = golden.dim_date.where(F.col("date_day") != date(2024, 2, 10))
    row = checks.calendar_contiguous(gap).first()
    assert (row["days"], row["expected_days"]) == (181, 182)


def test_failing_check_leaves_the_earlier_build(spark, rows, tmp_path):
    from subspan.operators.validation import with_faults
    from subspan.plans.build import BuildError, build, built
    from subspan.sources import feeds
    from subspan.sources.contracts import CONTRACTS

    def raw():
        frames = feeds.from_rows(spark, rows)
        return {n: with_faults(n, frames[n]).select(*CONTRACTS[n].columns) for n in CONTRACTS}

    folder = str(tmp_path / "marts")
    build(spark, raw(), folder)
    before = built(spark, folder)["dim_user"].count()
    rows["users"].append(dict(rows["users"][0]))
    with pytest.raises(BuildError) as e:
        build(spark, raw(), folder)
    assert set(e.value.failing) == {"unique dim_user.user_id"}
    assert built(spark, folder)["dim_user"].count() == before
    assert len(list((tmp_path / "marts" / "builds").iterdir())) == 1


def test_counts_of_a_build_are_those_of_the_single_checks(spark, golden, rows, tmp_path):
    """All 22 checks, on marts that break every rule: metrics of writes and one aggregate of keys against the failing rows of each."""
    from types import SimpleNamespace

    from subspan.plans.models import MARTS

    def twice(df, **changed):
        return df.unionByName(df.limit(2).withColumns({c: F.expr(v).cast(df.schema[c].dataType) for c, v in changed.items()}))

    bad = {name: getattr(golden, name) for name in MARTS}
    bad["dim_date"] = twice(bad["dim_date"], date_day="null").where("date_day is null or date_day <> date'2024-02-10'")
    bad["dim_user"] = twice(twice(bad["dim_user"]), account_id="'none'")
    bad["fct_product_event"] = twice(twice(twice(bad["fct_product_event"], account_id="null"), account_id="'gone'"), event_id="null")
    bad["fct_account_funnel"] = twice(bad["fct_account_funnel"], qualified="2", account_id="'lost'")
    bad["fct_account_month"] = twice(twice(bad["fct_account_month"], mrr="-5"))
    bad["mart_revenue_monthly"] = twice(bad["mart_revenue_monthly"], grr="1.5")
    bad["mart_product_monthly"] = twice(bad["mart_product_monthly"], stickiness="-1")
    bad["mart_feature_adoption"] = twice(bad["mart_feature_adoption"], adoption_rate="2")
    bad["mart_cohort_retention"] = twice(bad["mart_cohort_retention"], cohort_age="-1")
    for models in (golden, SimpleNamespace(**bad)):
        single = {r["check"]: r["failing"] for r in checks.failure_counts(checks.all_checks(models)).collect()}
        found = checks.key_counts(models).first().asDict()
        for name in MARTS:
            metrics = checks.row_metrics(name)
            if metrics:
                for check, n in getattr(models, name).agg(*metrics).first().asDict().items():
                    found[check] = found.get(check, 0) + n
        assert found == single and len(found) == 22
        assert models is golden or sum(n > 0 for n in found.values()) >= 16


def test_marts_of_a_wave_are_written_together(spark, golden, rows, tmp_path, monkeypatch):
    """Two marts that don't need each other wait for one another; every mart is written, the shared ones by their models."""
    from threading import Barrier

    both, plain, made = Barrier(2, timeout=120), build.written, []

    def together(df, path):
        name = path.rsplit("/", 1)[1]
        made.append(name)
        if name in ("mart_revenue_monthly", "mart_acquisition"):
            both.wait()
        return plain(df, path)

    monkeypatch.setattr(build, "written", together)
    build.write_marts(spark, golden.raw, str(tmp_path))
    shared = {"dim_account", "dim_date", "fct_account_month", "fct_product_event", "fct_account_funnel"}
    assert sorted(made) == sorted(set(build.MARTS) - shared)
    for name in build.MARTS:
        assert spark.read.parquet(f"{tmp_path}/{name}").count() == getattr(golden, name).count()
