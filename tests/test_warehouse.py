"""Snapshot, upsert, audit, rolling refresh, exports."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subspan.sources import exports, feeds, files, landing, warehouse
from subspan.sources.contracts import CONTRACTS

EVENTS = CONTRACTS["events"].schema


def event(key, day, ingested, name="login", user="U1"):
    return (key, user, "A1", datetime(2024, 1, day, 8), name, datetime(2024, 2, ingested))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), EVENTS)


def stored(spark, path):
    return {r["event_id"]: (r["occurred_at"].day, r["event_name"], r["day"].day) for r in warehouse.read_events(spark, path).collect()}


def test_upsert_replaces_adds_keeps_and_guards(spark, tmp_path):
    path = f"{tmp_path}/events"
    warehouse.upsert_events(spark, path, frame(spark, event("a", 1, 5), event("b", 2, 5), event("c", 3, 5), event("d", 3, 5)))
    batch = frame(
        spark,
        event("b", 2, 6, "export"),  # newer: replaces
        event("c", 3, 4, "export"),  # older: ignored
        event("d", 3, 5, "export"),  # as old: replaces
        event("e", 9, 5),  # new
    )
    for _ in range(2):  # replaying changes nothing
        warehouse.upsert_events(spark, path, batch)
        assert stored(spark, path) == {
            "a": (1, "login", 1),
            "b": (2, "export", 2),
            "c": (3, "login", 3),
            "d": (3, "export", 3),
            "e": (9, "login", 9),
        }


def test_correction_moves_an_event_to_another_day(spark, tmp_path):
    path = f"{tmp_path}/events"
    warehouse.upsert_events(spark, path, frame(spark, event("a", 1, 5), event("b", 7, 5)))
    warehouse.upsert_events(spark, path, frame(spark, event("a", 4, 6)))
    assert stored(spark, path) == {"a": (4, "login", 4), "b": (7, "login", 7)}
    assert sorted(warehouse._days_of(spark, path)) == ["2024-01-04", "2024-01-07"]


def test_untouched_days_are_not_rewritten(spark, tmp_path):
    path = f"{tmp_path}/events"
    warehouse.upsert_events(spark, path, frame(spark, event("a", 1, 5), event("b", 7, 5)))
    before = warehouse._days_of(spark, path)
    warehouse.upsert_events(spark, path, frame(spark, event("a", 1, 6, "export")))
    after = warehouse._days_of(spark, path)
    assert after["2024-01-07"] == before["2024-01-07"] and after["2024-01-01"] != before["2024-01-01"]


def test_upsert_that_stops_before_the_entry_changes_nothing(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/events"
    warehouse.upsert_events(spark, path, frame(spark, event("a", 1, 5), event("b", 1, 5)))
    batch = frame(spark, event("a", 4, 6))
    with monkeypatch.context() as m:
        m.setattr(warehouse, "_point", lambda *_: (_ for _ in ()).throw(RuntimeError("stopped")))
        with pytest.raises(RuntimeError):
            warehouse.upsert_events(spark, path, batch)
    assert stored(spark, path) == {"a": (1, "login", 1), "b": (1, "login", 1)}
    warehouse.upsert_events(spark, path, batch)
    assert stored(spark, path) == {"a": (4, "login", 4), "b": (1, "login", 1)}


def test_the_state_before_stays_readable_and_older_folders_go(spark, tmp_path):
    path = f"{tmp_path}/events"
    warehouse.upsert_events(spark, path, frame(spark, event("a", 1, 5)))
    old = warehouse.read_events(spark, path)
    for ingested in (6, 7, 8):
        warehouse.upsert_events(spark, path, frame(spark, event("a", 1, ingested, f"export{ingested}")))
        if ingested == 6:
            assert old.first()["event_name"] == "login"
    assert len(files.children(spark, f"{path}/data")) == 2


def scanned_rows(df):
    """What the scan of a plan without exchanges gave out."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().collectLeaves().apply(0).metrics().apply("numOutputRows").value()


def test_stored_ids_are_looked_up_without_a_shuffle(spark, tmp_path, monkeypatch):
    path = f"{tmp_path}/events"
    hours = F.timestamp_seconds(F.lit(1704067200) + F.pmod(F.col("id"), F.lit(20)) * 86400).cast("timestamp_ntz")
    many = spark.range(40_000).select(
        F.md5(F.col("id").cast("string")).alias("event_id"), F.lit("U").alias("user_id"), F.lit("A").alias("account_id"),
        hours.alias("occurred_at"), F.lit("login").alias("event_name"), hours.alias("ingested_at"),
    )
    warehouse.upsert_events(spark, path, many)
    state = warehouse._days_of(spark, path)
    read = warehouse._read_days(spark, path, state, EVENTS)
    ids = many.orderBy("event_id").limit(40).select("event_id")
    some = [r[0] for r in ids.collect()]
    found = read.where(F.col("event_id").isin(some[0], some[-1])).select("day")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "PushedFilters: [In(event_id" in plan
    missing = read.where(F.col("event_id").isin([some[0][:16] + "0" * 16])).select("day")
    assert scanned_rows(missing) == 0  # within the range of ids that a file holds, so a Bloom filter or the page index skipped it
    want = {r["day"] for r in read.join(ids, "event_id").select("day").collect()}
    seen = []
    real = F.broadcast
    monkeypatch.setattr(warehouse.F, "broadcast", lambda df: seen.append(df) or real(df))
    for pushed, sent in ((1000, 1000), (5, 1000), (5, 20)):
        monkeypatch.setattr(warehouse, "PUSHED_IDS", pushed)
        monkeypatch.setattr(warehouse, "SENT_IDS", sent)
        assert warehouse.days_with(read, ids) == want
    assert len(seen) == 1
    assert warehouse.days_with(read, ids.limit(0)) == set()
    # A correction finds the day that its event leaves, and only days with one of its events are written again.
    moved = many.where(F.col("event_id").isin(some[:1])).withColumn("ingested_at", F.lit(datetime(2024, 3, 1)).cast("timestamp_ntz"))
    moved = moved.withColumn("occurred_at", F.lit(datetime(2024, 2, 9)).cast("timestamp_ntz"))
    warehouse.upsert_events(spark, path, moved)
    after = warehouse._days_of(spark, path)
    assert len({d for d in state if after[d] != state[d]}) == 1 and set(after) - set(state) == {"2024-02-09"}
    assert warehouse.read_events(spark, path).count() == 40_000


@pytest.mark.parametrize("stop_at", ["table", "entry"])
def test_merge_load_moves_all_tables_or_none(spark, rows, tmp_path, monkeypatch, stop_at):
    store = f"{tmp_path}/store"

    def publish():
        return landing.publish(spark, feeds.from_rows(spark, rows), str(tmp_path)).batch_id

    def content():
        return {n: sorted(map(str, df.collect())) for n, df in warehouse.merged_tables(spark, store).items()}

    warehouse.load_merge(spark, str(tmp_path), publish(), store)
    before = content()
    rows["accounts"][0]["segment"] = "Enterprise"
    rows["events"][0]["occurred_at"] += timedelta(days=1)
    rows["events"][0]["ingested_at"] += timedelta(days=1)
    rows["marketing"][0]["spend_cents"] += 5
    second = publish()
    name = "_merge_version" if stop_at == "table" else "_point"
    real, calls = getattr(warehouse, name), []

    def stopping(*args):
        calls.append(args)
        if len(calls) == (4 if stop_at == "table" else 1):
            raise RuntimeError("stopped")
        return real(*args)

    with monkeypatch.context() as m:
        m.setattr(warehouse, name, stopping)
        with pytest.raises(RuntimeError):
            warehouse.load_merge(spark, str(tmp_path), second, store)
    assert content() == before and warehouse.read_audit(spark, store).count() == 1
    warehouse.load_merge(spark, str(tmp_path), second, store)
    after = content()
    assert {n for n in after if after[n] != before[n]} == {"accounts", "events", "marketing"}
    assert len(after["events"]) == len(before["events"]) and warehouse.read_audit(spark, store).count() == 2


def test_merge_load_accumulates_batches_and_audits_once(spark, rows, tmp_path):
    def load():
        batch = landing.publish(spark, feeds.from_rows(spark, rows), str(tmp_path))
        warehouse.load_merge(spark, str(tmp_path), batch.batch_id, f"{tmp_path}/store")
        return batch.batch_id

    first = load()
    assert load() == first
    rows["accounts"][0]["segment"] = "Enterprise"
    removed = rows["subscriptions"].pop()
    second = load()
    tables = warehouse.merged_tables(spark, f"{tmp_path}/store")
    assert tables["accounts"].where("account_id = 'A0000'").first()["segment"] == "Enterprise"
    assert tables["accounts"].count() == 12
    kept = tables["subscriptions"].where(F.col("account_id") == removed["account_id"]).where(F.col("month") == removed["month"])
    assert kept.count() == 1  # absent from the batch, still stored
    audit = warehouse.read_audit(spark, f"{tmp_path}/store").collect()
    assert sorted(r["batch_id"] for r in audit) == sorted([first, second])


def test_snapshot_follows_the_pointer(spark, rows, tmp_path):
    first = landing.publish(spark, feeds.from_rows(spark, rows), str(tmp_path))
    rows["subscriptions"].pop()
    second = landing.publish(spark, feeds.from_rows(spark, rows), str(tmp_path))
    store, sizes = f"{tmp_path}/store", []
    for batch in (first, second, first):
        warehouse.load_snapshot(spark, str(tmp_path), batch.batch_id, store)
        sizes.append(warehouse.raw_tables(spark, store)["subscriptions"].count())
    assert sizes == [18, 17, 18]


def test_refresh_reloads_a_week_and_drops_old_months(spark, tmp_path):
    path, as_of = f"{tmp_path}/facts", date(2024, 6, 30)

    def source(tag, *days):
        return spark.createDataFrame([(f"{tag}{d}", d) for d in days], "event_id string, date_day date")

    def content():
        found = warehouse.read_days(spark, path, StructType.fromDDL("event_id string, date_day date"))
        return sorted((r["event_id"][0], r["day"]) for r in found.collect())

    old, edge, early, gone = date(2021, 5, 31), date(2021, 6, 1), date(2024, 6, 1), as_of - timedelta(days=6)
    warehouse.refresh_events(
        spark, path, source("x", old, edge, early, gone, as_of), as_of - timedelta(days=30), extra_days=[old, edge, early, gone, as_of]
    )
    assert len(content()) == 5
    # A week later: the last seven days are replaced, one of them is now empty, one month expires.
    warehouse.refresh_events(spark, path, source("y", early, as_of), as_of)
    assert content() == [("x", edge), ("x", early), ("y", as_of)]
    warehouse.refresh_events(spark, path, source("z", early), as_of, extra_days=[early])
    assert content() == [("x", edge), ("z", early)]


def test_export_round_trip_turns_empty_text_into_null(spark, golden, tmp_path):
    marts = {"mart_revenue_monthly": golden.mart_revenue_monthly, "fct_account_funnel": golden.fct_account_funnel}
    exports.export_csv(marts, str(tmp_path))
    for name, df in marts.items():
        back = exports.read_export(spark, f"{tmp_path}/{name}", df.schema)
        assert back.dtypes == df.dtypes
        assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))


def test_summary_shows_the_latest_month(spark, golden, tmp_path):
    summary = exports.latest_summary(
        golden.dim_account, golden.fct_product_event, golden.mart_revenue_monthly, golden.mart_product_monthly
    )
    row = summary.first()
    assert row["latest_month"] == row["product_month"] == date(2024, 6, 1)
    assert row["accounts"] == 12 and row["revenue_mrr"] == 130
    exports.write_summary(summary, f"{tmp_path}/summary")
    assert spark.read.json(f"{tmp_path}/summary").first()["revenue_modeled_ltv"] == 260.0


def test_time_range_is_half_open_and_pushed_down(spark, tmp_path, capsys):
    path = f"{tmp_path}/events"
    frame(spark, *(event(str(d), d, 1) for d in range(1, 10))).write.parquet(path)
    ranged = feeds.time_range(spark.read.parquet(path), "occurred_at", datetime(2024, 1, 2, 8), datetime(2024, 1, 5, 8))
    assert sorted(r["event_id"] for r in ranged.collect()) == ["2", "3", "4"]
    ranged.explain()
    assert "GreaterThanOrEqual(occurred_at" in capsys.readouterr().out


def test_an_upsert_computes_its_batch_once(spark, tmp_path):
    path, seen = f"{tmp_path}/events", spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    for day in (3, 5):
        batch = frame(spark, event("a", day, day), event(f"b{day}", 4, 5))
        warehouse.upsert_events(spark, path, batch.mapInArrow(count, EVENTS))
    assert seen.value == 4
    assert stored(spark, path) == {"a": (5, "login", 5), "b3": (4, "login", 4), "b5": (4, "login", 4)}
    assert files.children(spark, f"{path}/incoming") == []


def test_exported_marts_share_written_models(spark):
    from __spark_entry__ import queries
    from subspan.session import shared_dir
    from tests.conftest import TEST_TABLES

    before = set(files.children(spark, shared_dir(spark)))
    counts = queries()["S9_all_marts"](spark, TEST_TABLES).collect()
    (made,) = (n for n in set(files.children(spark, shared_dir(spark))) - before if n.startswith("export-"))
    assert len(counts) == 12 and {"usage", "fct_account_month", "fct_product_event"} <= set(files.children(spark, f"{shared_dir(spark)}/{made}/models"))
