"""Hot keys against brute force, and the plans the operators rely on."""

import random
import re
from collections import defaultdict
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from __spark_entry__ import queries
from subspan.operators import analysis, product, ranking, staging, validation
from subspan.operators.acquisition import fct_account_funnel
from subspan.operators.measures import Star, measure_query
from subspan.sources.contracts import CONTRACTS
from subspan.sources.driver_tables import DriverTables
from subspan.plans.models import Models
from tests.conftest import TEST_TABLES


@pytest.fixture()
def no_broadcast(spark):
    """Plans as they are when no table is small."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def hot_events(seed=7, size=3000):
    """A third of all rows belongs to one account, one user and one replayed event id."""
    rng, rows = random.Random(seed), []
    for i in range(size):
        hot = i % 3 == 0
        account = "hot" if hot else f"a{rng.randrange(40)}"
        when = datetime(2024, 1, 1) + timedelta(hours=rng.randrange(24 * 90))
        rows.append(
            (
                "replayed" if hot and i % 2 else f"e{rng.randrange(size)}",
                f"{account}-u{0 if hot else rng.randrange(3)}",
                account,
                when,
                rng.choice(["login", "workspace_created", "export", "automation"]),
                when + timedelta(days=rng.randrange(4)),
            )
        )
    return rows


def deduplicated(rows):
    best = {}
    for r in rows:
        # Newest first; equal times: the smallest of the remaining columns.
        rank = (-r[5].timestamp(), r[1], r[2], r[3], r[4])
        if r[0] not in best or rank < best[r[0]][0]:
            best[r[0]] = (rank, r)
    return [r for _, r in best.values()]


@pytest.fixture(scope="module")
def hot(spark):
    rows = hot_events()
    return rows, spark.createDataFrame(rows, CONTRACTS["events"].schema).repartition(7)


def test_hot_event_id_is_deduplicated_before_the_shuffle(hot):
    rows, df = hot
    got = staging.stg_events(df)
    text = plan(got)
    assert text.index("WindowGroupLimit") < text.index("Exchange hashpartitioning") < text.rindex("WindowGroupLimit")
    assert sorted(map(tuple, got.collect())) == sorted(deduplicated(rows))


def test_usage_of_a_hot_account_matches_distinct_counts(spark, hot):
    events = deduplicated(hot[0])
    fact = staging.fct_product_event(staging.stg_events(hot[1]))
    usage = product.usage_base(fact)
    days = [date(2024, 1, 1) + timedelta(days=d) for d in range(91) if d != 40]
    calendar = spark.createDataFrame([(d, d.replace(day=1)) for d in days], "date_day date, month date")
    users, accounts, daily = defaultdict(set), defaultdict(set), defaultdict(set)
    for _, user, account, when, _, _ in events:
        month = when.date().replace(day=1)
        users[month].add(user)
        accounts[month].add(account)
        if when.date() in set(days):
            daily[month].add((user, when.date()))
    for r in product.mart_product_monthly(usage, calendar).collect():
        m = r["month"]
        size = sum(d.replace(day=1) == m for d in days)
        assert (r["mau"], r["active_accounts"]) == (len(users[m]), len(accounts[m]))
        assert r["average_dau"] == pytest.approx(len(daily[m]) / size)


def test_first_activation_of_a_hot_account(spark, hot):
    events = deduplicated(hot[0])
    signups = {a: date(2024, 1, 1) + timedelta(days=i) for i, a in enumerate(sorted({e[2] for e in events}))}
    accounts = spark.createDataFrame(list(signups.items()), "account_id string, signup_date date")
    none = spark.createDataFrame([], CONTRACTS["opportunities"].schema)
    calendar = spark.createDataFrame([(date(2024, 3, 1),)], "date_day date")
    funnel = fct_account_funnel(accounts, none, staging.fct_product_event(staging.stg_events(hot[1])), calendar)
    for r in funnel.collect():
        day = signups[r["account_id"]]
        first = [e[3].date() for e in events if e[2] == r["account_id"] and e[4] == "workspace_created" and day <= e[3].date() < day + timedelta(days=7)]
        assert r["activation_date"] == (min(first) if first else None)
        assert r["activation_eligible"] == int(day + timedelta(days=7) <= date(2024, 3, 1))


def test_event_rules_join_aggregated_keys(spark, hot, no_broadcast):
    rows, df = hot
    users = spark.createDataFrame(
        sorted({(r[1], r[2], date(2024, 2, 1)) for r in rows if r[2] != "a3"}), "user_id string, account_id string, created_date date"
    )
    survivors = deduplicated(rows)
    found = validation.event_user_faults(staging.stg_events(df), users)
    text = plan(found)
    assert text.index("SortMergeJoin") < text.index("partial_count"), "the aggregation feeds the join"
    got = {(r["rule"], r["key"]): r["rows"] for r in found.collect()}
    expected = defaultdict(int)
    for r in survivors:
        rule = "V11" if r[2] == "a3" else "V12" if r[3].date() < date(2024, 2, 1) else None
        if rule:
            expected[rule, f"{r[1]}|{r[2]}"] += 1
    assert got == dict(expected)


@pytest.mark.parametrize("width", [1, 7, 1 << 20])
def test_bucketed_dense_rank_equals_the_window(spark, monkeypatch, width):
    monkeypatch.setattr(ranking, "BUCKET_WIDTH", width)
    rng = random.Random(width)
    rows = [(f"g{i % 2}", None if i % 3 == 0 else rng.randrange(-3, 4) / 4, 50 if i % 3 else rng.randrange(-40, 60)) for i in range(900)]
    df = spark.createDataFrame(rows, "g string, coarse double, fine bigint")
    window = Window.partitionBy("g").orderBy(F.col("coarse").desc_nulls_last(), F.col("fine").desc())
    expected = df.withColumn("r", F.dense_rank().over(window))
    got = ranking.dense_rank_desc(df, ["g"], "coarse", F.col("fine"), "r")
    assert sorted(map(str, got.select("g", "coarse", "fine", "r").collect())) == sorted(map(str, expected.collect()))


@pytest.fixture(scope="module")
def models(spark):
    return Models(DriverTables(spark, TEST_TABLES).datasets())


def test_account_months_unfold_after_the_last_shuffle(models, no_broadcast):
    text = plan(models.fct_account_month)
    unfold = text.index("Generate explode")
    assert "hashpartitioning(account_id" not in text[:unfold] and "Sort [account_id" not in text[:unfold]
    assert "hashpartitioning(account_id" in text[unfold:]


def test_no_model_needs_a_nested_loop_or_python(models, no_broadcast):
    frames = {
        **models.marts(),
        "drivers": analysis.expansion_drivers(models.fct_account_month, models.fct_product_event, models.dim_date),
        "risk": analysis.churn_risk(models.fct_account_month, models.dim_account, models.usage, models.dim_date),
    }
    for name, df in frames.items():
        text = plan(df)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "Expand"):
            assert bad not in text, (name, bad)


def test_scans_read_only_what_a_query_needs(models, no_broadcast):
    text = plan(models.dim_date)
    assert text.count("Scan parquet") == 1 and "lineitem" not in text
    assert "ReadSchema: struct<o_orderdate:timestamp_ntz>" in text


def test_written_models_give_the_same_marts(spark, models, tmp_path):
    stored = Models(models.raw, str(tmp_path))
    latest = measure_query(Star.of(stored), ["mau", "stickiness"])
    filters = re.findall(r"PartitionFilters: \[([^\]]*)\]", plan(latest))
    assert any("month" in f and "Subquery" in f for f in filters), "one month's folder is read"
    assert latest.collect() == measure_query(Star.of(models), ["mau", "stickiness"]).collect()
    for name in ("mart_revenue_monthly", "mart_product_monthly", "mart_acquisition"):
        assert sorted(map(str, getattr(stored, name).collect())) == sorted(map(str, getattr(models, name).collect()))


def test_shared_folder_comes_from_the_session():
    from types import SimpleNamespace

    from subspan.session import shared_dir

    def session(**conf):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: conf.get(key, default)))

    warehouse = {"spark.sql.warehouse.dir": "hdfs:///warehouse/"}
    assert shared_dir(session(**{"spark.checkpoint.dir": "hdfs:///shared"}, **warehouse)) == "hdfs:///shared"
    assert shared_dir(session(**warehouse)) == "hdfs:///warehouse/subspan-shared"


def test_late_dates_reach_the_marts(spark, tmp_path):
    """The derived datasets have no end date."""
    for name in ("region", "nation", "customer", "lineitem"):
        spark.read.parquet(f"{TEST_TABLES}/{name}.parquet").write.parquet(f"{tmp_path}/{name}.parquet")
    orders = spark.read.parquet(f"{TEST_TABLES}/orders.parquet")
    late = orders.orderBy("o_orderkey").limit(1).withColumn("o_orderdate", F.expr("timestamp_ntz '2031-05-07 00:00:00'"))
    orders.unionByName(late.withColumn("o_orderkey", F.lit(10**9).cast("bigint"))).write.parquet(f"{tmp_path}/orders.parquet")
    found = Models(DriverTables(spark, str(tmp_path)).datasets())
    for mart in (found.mart_revenue_monthly, found.mart_product_monthly):
        assert str(mart.agg(F.max("month")).first()[0]) == "2031-05-01"


def test_churn_risk_drops_empty_rows_before_any_shuffle(spark, models, tmp_path, no_broadcast):
    stored = Models(models.raw, str(tmp_path / "models"))
    text = plan(analysis.churn_risk(stored.fct_account_month, stored.dim_account, stored.usage, stored.dim_date))
    assert "Window [min(month" not in text and "GreaterThan(mrr,0.00)" in text


@pytest.mark.parametrize("by", [["segment"], ["account_id"], ["account_id", "segment"]])
def test_months_of_accounts_are_neither_sorted_nor_held(spark, no_broadcast, by):
    """Revenue rows of odd accounts (repeated, missing, null, repeated months) against a recount, and the plan's joins."""
    months = [date(2024, m, 1) for m in range(1, 7)]
    rng, facts = random.Random(3), []
    for account in ["a0", "a1", "a2", "gone", None]:
        for month in months[: 6 if account == "a0" else rng.randrange(1, 7)]:
            facts += [(account, month, rng.randrange(100))] * (2 if account in ("a1", None) else 1)
    other = ("beginning_mrr", "new_mrr", "reactivation_mrr", "expansion_mrr", "contraction_mrr", "churn_mrr")
    flags = ("paying_account", "beginning_account", "churned_account")
    fact = spark.createDataFrame(facts, "account_id string, month date, mrr int").withColumn("mrr", F.col("mrr").cast("decimal(18,2)"))
    fact = fact.withColumns({c: F.lit(0).cast("decimal(18,2)") for c in other} | {c: F.lit(0) for c in flags})
    members = [("a0", "x"), ("a1", "x"), ("a2", "y"), ("a2", "z"), (None, "n")]
    account = spark.createDataFrame(members, "account_id string, segment string")
    days = [(d, d, d.year, d.month) for d in months[:5]]  # the last month lies after the calendar
    calendar = spark.createDataFrame(days, "date_day date, month date, year int, month_number int")
    star = Star(account, calendar, fact, None, None, None)
    for dates in (None, F.col("month_number") <= 3):
        sums = defaultdict(lambda: defaultdict(int))
        for who, month, mrr in facts:
            if dates is None or month.month <= 3:
                for segment in [s for a, s in members if "segment" in by and a == who is not None] or [None]:
                    group = tuple({"account_id": who, "segment": segment}[c] for c in by)
                    sums[group][month] += mrr
        expected = {group: sum_[max(sum_)] for group, sum_ in sums.items()}
        found = measure_query(star, ["mrr"], by, dates=dates)
        assert {tuple(r[c] for c in by): r["mrr"] for r in found.collect()} == expected
        assert "ShuffledHashJoin [account_id" in plan(found) and "SortMergeJoin [account_id" not in plan(found)


# The queries whose tasks sorted the dense months of their accounts.
MONTHS_BY_HASH = (
    "D16_modeled_ltv_by_segment",
    "D1_to_D17_revenue_by_region_channel",
    "D1_to_D17_revenue_by_segment",
    "D34_revenue_context",
)


@pytest.mark.parametrize("name", MONTHS_BY_HASH)
def test_registered_revenue_queries_sort_no_dense_months(spark, no_broadcast, name):
    text = plan(queries()[name](spark, TEST_TABLES))
    assert "ShuffledHashJoin [account_id" in text
    assert not re.search(r"SortMergeJoin \[account_id#\d+\], \[account_id#\d+\]", text)
