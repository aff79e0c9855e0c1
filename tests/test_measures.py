"""Measures and semantic operators on the golden star."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from subspan.operators import semantic
from subspan.operators.measures import MEASURES, Star, measure_query
from subspan.plans.pages import PAGES, page


@pytest.fixture(scope="module")
def star(golden):
    return Star.of(golden)


def rows(df, *keys):
    return {tuple(r[k] for k in keys): r for r in df.collect()}


def test_there_are_34_measures():
    assert len(MEASURES) == 34


def test_balances_are_semi_additive(star):
    one = measure_query(star, ["mrr", "arr", "beginning_mrr", "paying_accounts", "nrr", "mrr_reconciliation"]).first()
    assert (one["mrr"], one["arr"], one["beginning_mrr"], one["paying_accounts"], one["nrr"]) == (130, 1560, 130, 2, 1)
    assert one["mrr_reconciliation"] == 0
    first_quarter = measure_query(star, ["mrr", "churn_mrr"], dates=F.col("month_number") <= 3).first()
    assert (first_quarter["mrr"], first_quarter["churn_mrr"]) == (170, 0)


def test_ltv_window_ignores_date_filters(star):
    by_month = rows(measure_query(star, ["modeled_ltv"], ["month"]), "month")
    assert by_month[(date(2024, 6, 1),)]["modeled_ltv"] == pytest.approx(260)
    only_june = measure_query(star, ["modeled_ltv"], dates=F.col("month_number") == 6).first()
    assert only_june["modeled_ltv"] == pytest.approx(260)


def test_a_day_filter_that_skips_the_first_blanks_revenue(star):
    assert measure_query(star, ["mrr"], dates=F.dayofmonth("date_day") == 15).first()["mrr"] is None


def test_mau_follows_the_last_calendar_day(star, golden):
    total = measure_query(star, ["mau", "average_dau", "stickiness", "active_users"]).first()
    june = golden.mart_product_monthly.where("month = '2024-06-01'").first()
    assert (total["mau"], total["average_dau"], total["stickiness"]) == (june["mau"], june["average_dau"], june["stickiness"])
    assert total["active_users"] >= total["mau"]
    for r in measure_query(star, ["mau", "average_dau"], ["month"]).collect():
        expected = golden.mart_product_monthly.where(F.col("month") == r["month"]).first()
        assert (r["mau"], r["average_dau"]) == (expected["mau"], expected["average_dau"])


def test_average_dau_of_a_month_without_events_is_zero_and_mau_blank(star):
    quiet = Star(star.account, star.calendar, star.revenue, star.usage.where("month < '2024-06-01'"), star.funnel, star.marketing)
    june = rows(measure_query(quiet, ["mau", "average_dau", "stickiness"], ["month"]), "month")[(date(2024, 6, 1),)]
    assert (june["mau"], june["average_dau"], june["stickiness"]) == (None, 0, None)


def test_feature_adoption_ignores_the_event_filter_below(star):
    some = measure_query(star, ["feature_adoption"], events=F.col("event_name") == "export").first()
    every = rows(measure_query(star, ["feature_adoption"], ["event_name"]), "event_name")
    assert some["feature_adoption"] == every[("export",)]["feature_adoption"] < 1


def test_spend_repeats_under_every_segment_that_uses_the_channel(star):
    total = measure_query(star, ["marketing_spend"]).first()["marketing_spend"]
    by_segment = [r["marketing_spend"] for r in measure_query(star, ["marketing_spend"], ["segment"]).collect()]
    assert by_segment == [total] * 3
    smb_organic = measure_query(star, ["marketing_spend"], accounts=F.col("account_id") == "A0000").first()
    assert smb_organic["marketing_spend"] == pytest.approx(total / 4)


def test_contexts(star):
    one = measure_query(star, ["account_context"], accounts=F.col("account_id") == "A0003").first()
    many = measure_query(star, ["account_context", "revenue_context"]).first()
    assert (one["account_context"], many["account_context"]) == ("A0003", "Multiple accounts")
    assert many["revenue_context"] == "MRR $130 | NRR 100.0%"
    january = measure_query(star, ["revenue_context"], dates=F.col("month_number") == 1).first()
    assert january["revenue_context"] == "MRR $300 | NRR "


def test_measures_repeat_over_columns_that_do_not_reach_them(star):
    got = rows(measure_query(star, ["active_users", "mrr", "cohort_accounts"], ["event_name"]), "event_name")
    assert {(r["mrr"], r["cohort_accounts"]) for r in got.values()} == {(130, 12)}
    with pytest.raises(ValueError, match="can be grouped"):
        measure_query(star, ["mrr"], ["event_name"])
    with pytest.raises(ValueError, match="not a column"):
        measure_query(star, ["mrr"], ["plan"])


def test_events_outside_the_calendar_form_a_blank_month(star):
    short = Star(star.account, star.calendar.where("month_number < 6"), star.revenue, star.usage, star.funnel, star.marketing)
    by_month = rows(measure_query(short, ["active_users"], ["month"]), "month")
    june = measure_query(star, ["active_users"], dates=F.col("month_number") == 6).first()["active_users"]
    assert by_month[(None,)]["active_users"] == june and len(by_month) == 6


def test_period_comparison(star):
    got = rows(semantic.period_comparison(star, "mrr"), "month")
    assert got[(date(2024, 1, 1),)]["previous_month"] is None and got[(date(2024, 1, 1),)]["mom_change"] is None
    may = got[(date(2024, 5, 1),)]
    assert (may["current"], may["previous_month"], may["mom_change"]) == (130, 50, pytest.approx(1.6))
    only_may = semantic.period_comparison(star, "mrr", dates=F.col("month_number") == 5).collect()
    assert [(r["current"], r["previous_month"]) for r in only_may] == [(130, 50)]


def test_metric_selector_is_long(star):
    got = semantic.metric_selector(star).where("month = '2024-02-01'").orderBy("position").collect()
    assert [(r["metric"], r["position"]) for r in got] == [("MRR", 0), ("ARR", 1), ("NRR", 2), ("MAU", 3)]
    assert [r["value"] for r in got][:3] == [200, 2400, 0.5]


ENTITLED = [("amer.analyst@example.com", "AMER"), ("emea.analyst@example.com", "EMEA"), ("emea.analyst@example.com", "EMEA")]


@pytest.mark.parametrize(("user", "regions"), [("amer.analyst@example.com", {"AMER"}), ("emea.analyst@example.com", {"EMEA"}), ("who@example.com", set())])
def test_row_filter(spark, star, user, regions):
    entitlements = spark.createDataFrame(ENTITLED, "upn string, region string")
    seen = semantic.restrict_to_user(star, entitlements, user)
    assert {r["region"] for r in seen.account.collect()} == regions
    assert seen.marketing.count() == 0
    whole = measure_query(star, ["mrr", "active_users", "signup_accounts"], ["region"]).where(F.col("region").isin(*regions) if regions else F.lit(False))
    part = measure_query(seen, ["mrr", "active_users", "signup_accounts"], ["region"])
    assert sorted(map(tuple, part.collect())) == sorted(map(tuple, whole.collect()))
    assert measure_query(seen, ["marketing_spend"]).first()["marketing_spend"] is None


def test_drill_through_equals_the_filtered_query(star):
    metrics = ["mrr", "nrr", "active_users", "account_context", "mau"]
    drilled = semantic.drill_through(star, "A0002", metrics, ["month"])
    grouped = measure_query(star, metrics, ["account_id", "month"]).where("account_id = 'A0002'").drop("account_id")
    columns = [c for c in grouped.columns if c != "account_context"]
    assert sorted(map(str, drilled.select(columns).collect())) == sorted(map(str, grouped.select(columns).collect()))


def test_cohort_matrix_blanks_the_unobserved(golden):
    matrix = semantic.cohort_matrix(golden.mart_cohort_retention).first()
    assert matrix["m0"] is not None and matrix["m6"] is None and matrix["m8"] is None


@pytest.mark.parametrize("name", PAGES)
def test_every_page_runs(star, name):
    for visual, (by, measures) in PAGES[name].items():
        df = page(star, name, visual)
        assert df.columns == [*by, *measures] and df.count() >= 1


def leaves(df):
    return df._jdf.queryExecution().optimizedPlan().collectLeaves().size()


def test_both_periods_come_of_one_aggregation(star):
    shown = F.col("month_number") > 2
    for measure, filters in (("mrr", {}), ("mau", {}), ("mrr", {"dates": shown})):
        one = leaves(measure_query(star, [measure], ["segment", "month"], **filters))
        # The calendar is read for the shown months, the months before and the list of those.
        calendar = leaves(star.calendar)
        assert leaves(semantic.period_comparison(star, measure, ["segment", "month"], **filters)) <= one + 6 * calendar
    assert leaves(semantic.period_comparison(star, "mrr", ["segment", "month"])) < 2 * leaves(measure_query(star, ["mrr"], ["segment", "month"])) + 3 * leaves(star.calendar)


def test_churn_over_months_reads_revenue_once(star):
    plan = measure_query(star, ["modeled_ltv", "mrr", "nrr"], ["segment"])._jdf.queryExecution().optimizedPlan().toString()
    fact = star.revenue._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window [") == fact.count("Window [") + 1  # and the frame of trailing months
