"""Product measures from bitmaps equal those from the usage rows, for any grouping and filter."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from subspan.operators import bitmaps
from subspan.operators.measures import Star, measure_query
from subspan.plans.models import Models
from subspan.sources import feeds
from subspan.sources.contracts import CONTRACTS

PRODUCT = ["active_users", "mau", "average_dau", "stickiness", "feature_adoption", "retained_accounts", "cohort_retention"]


@pytest.fixture(scope="module")
def stars(spark, tmp_path_factory):
    from tests.conftest import golden_rows

    rows = golden_rows()
    first = rows["events"][0]
    odd = [
        {**first, "event_id": "X1", "account_id": "A0001"},  # a user of two accounts
        {**first, "event_id": "X2", "account_id": "missing", "user_id": "stranger"},
        {**first, "event_id": "X3", "user_id": "early", "occurred_at": datetime(2023, 12, 5), "ingested_at": datetime(2023, 12, 6)},  # before the calendar
        {**first, "event_id": "X4", "occurred_at": datetime(2024, 3, 31, 5), "user_id": "other"},
    ]
    rows["events"] = rows["events"] + odd
    frames = {n: f.select(*(F.col(c.name).cast(c.dataType) for c in CONTRACTS[n].schema.fields)) for n, f in feeds.from_rows(spark, rows).items()}
    models = Models(frames, str(tmp_path_factory.mktemp("models")))
    return Star.of(models), Star.of(models, bits=True)


GROUPINGS = [
    [], ["month"], ["date_day"], ["segment"], ["segment", "month"], ["event_name"], ["region", "channel", "year"],
    ["cohort_month", "month", "event_name"], ["account_id", "month"], ["signup_date"],
]


@pytest.mark.parametrize("by", GROUPINGS)
def test_any_grouping(stars, by):
    rows, bits = (sorted(map(str, measure_query(s, PRODUCT[:6], by).collect())) for s in stars)
    assert rows == bits and rows


@pytest.mark.parametrize(
    "filters",
    [
        {"accounts": "region = 'AMER'"},
        {"accounts": "account_id = 'A0003'"},
        {"dates": "date_day between date'2024-02-03' and date'2024-04-02'"},
        {"events": "event_name = 'export'", "dates": "month = date'2024-03-01'"},
        {"accounts": "segment = 'none such'"},
    ],
)
def test_filters(stars, filters):
    filters = {k: F.expr(v) for k, v in filters.items()}
    for by in ([], ["segment", "event_name"]):
        rows, bits = (sorted(map(str, measure_query(s, PRODUCT[:5], by, **filters).collect())) for s in stars)
        assert rows == bits


def test_queries_by_attributes_read_no_user_rows(stars):
    read = measure_query(stars[1], ["active_users", "mau", "average_dau", "retained_accounts"], ["segment", "month", "event_name"]).inputFiles()
    assert any("/usage_bits/" in f for f in read) and not any("/usage/" in f for f in read)


def test_numbers_are_dense_and_buckets_add_up(spark, tmp_path):
    n = 70_000  # more than two buckets
    usage = spark.range(n).select(
        F.concat(F.lit("u"), F.col("id")).alias("user_id"), F.concat(F.lit("a"), F.pmod("id", F.lit(1000))).alias("account_id"),
        F.lit(date(2024, 1, 1)).alias("month"), F.lit("login").alias("event_name"), F.lit(5).cast("bigint").alias("day_mask"),
    ).repartition(5)
    account = spark.range(1, 1000).select(
        F.concat(F.lit("a"), F.col("id")).alias("account_id"), F.pmod("id", F.lit(3)).cast("string").alias("segment"), F.lit("r").alias("region"),
        F.lit("c").alias("channel"), F.lit(date(2024, 1, 1)).alias("cohort_month"),
    )
    given = bitmaps.numbers(usage, account, "user_id", f"{tmp_path}/n").agg(F.min("number"), F.max("number"), F.count_distinct("number")).first()
    assert tuple(given) == (1, n, n)
    bits = bitmaps.usage_bits(usage, account, str(tmp_path)).persist()
    total = bitmaps.counted(bits, []).first()
    assert (total["user_id"], total["account_id"]) == (n, 1000)
    by = {r["segment"]: (r["user_id"], r["account_id"]) for r in bitmaps.counted(bits, ["segment"]).collect()}
    assert by == {"0": (70 * 333, 333), "1": (70 * 333, 333), "2": (70 * 333, 333), None: (70, 1)}
    days = bitmaps.users_and_days(bits, ["month"], ("users", "days")).first()
    assert (days["users"], days["days"]) == (n, 2 * n)
    bits.unpersist()


def usage_rows(spark):
    """Users of two accounts, accounts without a row or a key, several days of a month and users without a key."""
    rows, first = [], date(2024, 2, 1)
    for i in range(400):
        user, account = f"u{i % 150}", f"a{i % 40}"
        rows.append((first if i % 2 else date(2024, 3, 1), None if i == 7 else user, None if i == 9 else account, ("login", "export")[i % 2], 1 << i % 29 | 1 << (i * 7) % 29))
    usage = spark.createDataFrame(rows, "month date, user_id string, account_id string, event_name string, day_mask bigint")
    members = [(f"a{k}", f"s{k % 3}", "r", "c", first) for k in range(38)]  # a38 and a39 are unknown
    return rows, members, usage, spark.createDataFrame(members, "account_id string, segment string, region string, channel string, cohort_month date")


def test_bitmap_rows_against_sets(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bitmaps, "_RANGE_BITS", 5)  # many ranges, which no bitmap's members respect
    rows, members, usage, account = usage_rows(spark)
    bits = bitmaps.usage_bits(usage, account, str(tmp_path)).persist()
    segments = {m[0]: m[1] for m in members}
    who, daily = {}, {}
    for month, user, member, event, mask in rows:
        for d in range(31):
            if mask >> d & 1:
                key = (segments.get(member), event)
                users, accounts = who.setdefault(key, (set(), set()))
                users |= {user} - {None}
                accounts |= {member} - {None}
                daily.setdefault((segments.get(member), month), set()).update({(user, d)} if user else ())
    got = {(r["segment"], r["event_name"]): (r["user_id"], r["account_id"]) for r in bitmaps.counted(bits, ["segment", "event_name"]).collect()}
    assert got == {k: (len(u), len(a)) for k, (u, a) in who.items()}
    months = bitmaps.users_and_days(bits, ["segment", "month"], ("users", "days")).collect()
    assert {(r["segment"], r["month"]): (r["users"], r["days"]) for r in months} == {k: (len({u for u, _ in v}), len(v)) for k, v in daily.items()}
    assert all(r["day"].replace(day=1) == r["month"] for r in bits.select("day", "month").distinct().collect())
    bits.unpersist()


def test_usage_is_not_sorted_for_its_bitmaps(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        _, _, usage, account = usage_rows(spark)
        bits = bitmaps.usage_bits(usage, account, str(tmp_path))
        text = bits._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "HashAggregate" in text and "SortAggregate" not in text
    assert text.count("ShuffledHashJoin") == 2 and bits.schema["bits"].dataType.simpleString() == "bigint"


@pytest.mark.parametrize("measures, by", [(["active_users", "retained_accounts"], ["segment", "event_name"]), (["mau"], ["segment", "month"])])
def test_bitmap_measures_are_hash_aggregates(stars, measures, by):
    text = measure_query(stars[1], measures, by)._jdf.queryExecution().executedPlan().toString()
    assert "bit_or" in text and "SortAggregate" not in text
