"""Registered queries against their SQL on the smallest tables.

A cross-section that touches every module; ``python -m parity.compare`` runs all of them.
"""

import duckdb
import pytest

import __spark_entry__ as registry
from parity.compare import connect, difference
from tests.conftest import TEST_TABLES

SAMPLE = (
    "T2_stg_events T7_fct_account_month T9_fct_account_funnel M1_mart_revenue_monthly M2_mart_product_monthly "
    "M3_mart_feature_adoption M4_mart_cohort_retention M5_mart_acquisition A1_revenue_bridge A2_expansion_drivers "
    "A3_ranked_churn_risk Q7_metric_bounds V9_orphans V13_funnel_chronology S7_guarded_upsert S10_latest_summary "
    "D16_modeled_ltv_by_segment D18_D30_active_by_month D19_to_D21_product_by_segment_event "
    "D23_to_D29_acquisition_by_month D30_to_D32_cohort_retention E3_period_comparison_mrr E5_visible_revenue"
).split()


@pytest.fixture(scope="module")
def con() -> duckdb.DuckDBPyConnection:
    return connect(TEST_TABLES)


@pytest.mark.parametrize("name", SAMPLE)
def test_query_matches_sql(spark, con, name):
    df = registry.queries()[name](spark, TEST_TABLES)
    result = con.execute(registry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert difference([tuple(r) for r in df.collect()], df.columns, result.fetchall(), columns) is None


def test_registry_is_consistent():
    assert set(registry.oracle_sql()) <= set(registry.queries())
    assert registry.FLAGSHIP in registry.queries()


def test_entry_runs(spark):
    assert registry.entry(spark).count() > 0
