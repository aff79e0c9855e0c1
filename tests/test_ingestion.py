"""Landing: validation, replay, tampering, feeds."""

import json
import time
from copy import deepcopy
from datetime import date, datetime, timedelta

import pyarrow.compute as pc
import pyarrow.parquet as pq
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from subspan.operators import validation
from subspan.operators.validation import ContractError
from subspan.session import SHUFFLE_CLEANUP, brief_shuffles
from subspan.sources import feeds, files, landing, warehouse
from subspan.sources.landing import ChecksumError


def publish(spark, rows, folder):
    return landing.publish(spark, feeds.from_rows(spark, rows), str(folder))


def landed_runs(spark, folder):
    return files.children(spark, f"{folder}/data")


def test_replay_keeps_one_copy(spark, rows, tmp_path):
    first = publish(spark, rows, tmp_path)
    again = publish(spark, deepcopy(rows), tmp_path)
    assert first == again
    assert len(first.batch_id) == 24
    assert landed_runs(spark, tmp_path) == [first.run]
    store = f"{tmp_path}/warehouse"
    for _ in range(2):
        warehouse.load_snapshot(spark, str(tmp_path), first.batch_id, store)
    assert warehouse.raw_tables(spark, store)["events"].count() == len(rows["events"])


def test_row_order_does_not_change_the_batch(spark, rows, tmp_path):
    first = publish(spark, rows, tmp_path)
    rows["events"].reverse()
    assert publish(spark, rows, tmp_path).batch_id == first.batch_id
    rows["accounts"][0]["segment"] = "Enterprise"
    assert publish(spark, rows, tmp_path).batch_id != first.batch_id


def test_latest_event_version_wins(spark, rows, tmp_path):
    newer = {**rows["events"][0], "event_name": "export"}
    newer["ingested_at"] += timedelta(days=1)
    rows["events"].append(newer)
    batch = publish(spark, rows, tmp_path)
    got = landing.read_batch(spark, str(tmp_path), batch.batch_id)["events"]
    assert [r["event_name"] for r in got.where(f"event_id = '{newer['event_id']}'").collect()] == ["export"]


def test_files_are_sorted_by_key(spark, rows, tmp_path):
    batch = publish(spark, rows, tmp_path)
    subs = landing.read_batch(spark, str(tmp_path), batch.batch_id)["subscriptions"]
    assert all(name.endswith(".zstd.parquet") for f in subs.inputFiles() for name in [f])
    for file in subs.inputFiles():
        keys = [(r["account_id"], r["month"]) for r in spark.read.parquet(file).collect()]
        assert keys == sorted(keys)


def change(dataset, index, **values):
    def apply(rows):
        rows[dataset][index].update(values)

    return apply


ROW_FAULTS = {
    "negative": (change("subscriptions", 0, amount_cents=-1), ("subscriptions", "V5", "A0000|2024-01-01")),
    "month day": (change("subscriptions", 2, month=date(2024, 3, 2)), ("subscriptions", "V10", "A0000|2024-03-02")),
    "funnel order": (change("opportunities", 1, paid_date=date(2023, 12, 31)), ("opportunities", "V13", "A0001")),
    "paid without qualified": (change("opportunities", 0, paid_date=date(2024, 1, 9)), ("opportunities", "V13", "A0000")),
    "bad date": (change("users", 3, created_date="soon"), ("users", "V3", "U011")),
    "missing value": (change("accounts", 4, segment=None), ("accounts", "V3", "A0004")),
    "category": (change("accounts", 5, region="MOON"), ("accounts", "V4", "A0005")),
}
OTHER_FAULTS = {
    "orphan": (change("subscriptions", 0, account_id="GONE"), ("subscriptions", "V9", "GONE")),
    "orphan event": (change("events", 0, account_id="MISSING"), ("events", "V9", "MISSING")),
    "its user": (lambda rows: None, ("events", "V11", "U000|MISSING")),
    "user mismatch": (change("events", 1, user_id="MISSING"), ("events", "V11", "MISSING|A0000")),
    "duplicate": (lambda rows: rows["accounts"].append(dict(rows["accounts"][0])), ("accounts", "V7", "A0000")),
    "event before user": (change("users", 23, created_date=date(2024, 6, 30)), ("events", "V12", "U111|A0011")),
    "ingested early": (change("events", 9, ingested_at=datetime(2023, 1, 1)), ("events", "V12", "E00009")),
}


@pytest.mark.parametrize("faults", [ROW_FAULTS, OTHER_FAULTS], ids=["row", "relational"])
def test_every_fault_is_reported_and_nothing_published(spark, rows, tmp_path, faults):
    for apply, _ in faults.values():
        apply(rows)
    frames = feeds.from_rows(spark, rows)
    found = {(f["dataset"], f["rule"], f["key"]) for f in validation.violations(frames).collect()}
    assert found == {expected for _, expected in faults.values()}
    with pytest.raises(ContractError) as caught:
        landing.publish(spark, frames, str(tmp_path))
    assert {f[:2] for f in caught.value.faults} == {expected[:2] for _, expected in faults.values()}
    assert landed_runs(spark, tmp_path) == [] and files.children(spark, f"{tmp_path}/batches") == []


def test_empty_dataset_is_rejected(spark, rows, tmp_path):
    rows["marketing"].clear()
    with pytest.raises(ContractError, match="marketing V2"):
        publish(spark, rows, tmp_path)
    assert landed_runs(spark, tmp_path) == []


def test_unknown_column_is_rejected(spark, rows, tmp_path):
    rows["accounts"][4]["owner"] = "x"
    with pytest.raises(ContractError, match="accounts V3 unknown column owner"):
        publish(spark, rows, tmp_path)


def test_missing_and_unknown_dataset(spark, rows, tmp_path):
    del rows["users"]
    with pytest.raises(ContractError, match="users V1 missing dataset"):
        publish(spark, rows, tmp_path)


def test_superseded_versions_are_typed_but_not_compared(spark, rows, tmp_path):
    """Only survivors meet the rules that look at other rows; every version must be well formed."""
    old = {**rows["events"][0], "user_id": "MISSING"}
    old["ingested_at"] -= timedelta(minutes=1)
    rows["events"].insert(0, old)
    publish(spark, rows, tmp_path)
    rows["events"][0] = {**old, "event_name": "dance"}
    with pytest.raises(ContractError) as caught:
        publish(spark, rows, tmp_path)
    assert {f[1] for f in caught.value.faults} == {"V4"}


def test_tampered_batch_is_rejected_before_load(spark, rows, tmp_path):
    batch = publish(spark, rows, tmp_path)
    path = f"{tmp_path}/data/{batch.run}/accounts"
    changed = spark.createDataFrame(spark.read.parquet(path).collect(), spark.read.parquet(path).schema)
    changed.replace("SMB", "Enterprise", "segment").write.mode("overwrite").parquet(path)
    store = f"{tmp_path}/warehouse"
    with pytest.raises(ChecksumError, match="accounts"):
        warehouse.load_snapshot(spark, str(tmp_path), batch.batch_id, store)
    assert not files.exists(spark, store)


def test_the_changed_file_is_named(spark, rows, tmp_path):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        batch = publish(spark, rows, tmp_path)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    folder = tmp_path / "data" / batch.run / "subscriptions"
    parts = sorted(folder.glob("*.parquet"))
    assert len(parts) > 2 and landing.verify(spark, str(tmp_path), batch.batch_id) == batch
    lanes = spark.read.parquet(f"{tmp_path}/lanes/{batch.run}").where("dataset = 'subscriptions'")
    assert lanes.count() == sum(pq.read_metadata(f).num_rows > 0 for f in parts) and lanes.agg(F.sum("rows")).first()[0] == len(rows["subscriptions"])
    changed = max(parts, key=lambda f: pq.read_metadata(f).num_rows)
    table = pq.read_table(changed)
    cents = pc.add(table.column("amount_cents"), 1)
    for extra in folder.glob(".*.crc"):
        extra.unlink()
    pq.write_table(table.set_column(table.schema.get_field_index("amount_cents"), "amount_cents", cents), changed)
    with pytest.raises(ChecksumError, match=f"^checksum mismatch: subscriptions .1 files, e.g. {changed.name}.$"):
        landing.verify(spark, str(tmp_path), batch.batch_id)


def as_json(rows):
    return {n: [{k: v.isoformat() if hasattr(v, "isoformat") else v for k, v in r.items()} for r in data] for n, data in rows.items()}


@pytest.mark.parametrize("lines", [False, True])
def test_json_feeds_equal_rows_in_memory(spark, rows, tmp_path, lines):
    for name, data in as_json(rows).items():
        text = "\n".join(map(json.dumps, data)) if lines else json.dumps(data, indent=1)
        (tmp_path / f"{name}.{'jsonl' if lines else 'json'}").write_text(text)
    batch = landing.publish(spark, feeds.read_feeds(spark, str(tmp_path), lines), f"{tmp_path}/a")
    assert batch.files == publish(spark, rows, f"{tmp_path}/b").files


def test_ties_go_to_the_first_of_a_feed_of_many_files_and_blocks(spark, rows, tmp_path):
    """One number is an element's place in the whole feed; versions take no path along."""
    data = as_json(rows)
    names = ("login", "report_created", "export", "automation", "invite_sent")
    twice = [{**e, "event_name": names[k % 5]} for k, e in enumerate(data["events"])]
    files_of = {"a": twice[:150], "b": twice[150:], "c": data["events"]}
    (tmp_path / "events.json").mkdir()
    for file, records in files_of.items():
        (tmp_path / "events.json" / f"{file}.json").write_text(json.dumps(records))
    for name in data.keys() - {"events"}:
        (tmp_path / f"{name}.json").write_text(json.dumps(data[name]))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 1000)
    try:
        read = feeds.read_feeds(spark, str(tmp_path))
        assert dict(read["events"].dtypes)["_arrival"] == "bigint"
        batch = landing.publish(spark, read, f"{tmp_path}/a")
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    got = landing.read_batch(spark, f"{tmp_path}/a", batch.batch_id)["events"].collect()
    assert {r["event_id"]: r["event_name"] for r in got} == {e["event_id"]: e["event_name"] for e in twice}


def shuffle_files(spark):
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def test_a_landed_batch_leaves_no_shuffle_files(spark, rows, tmp_path):
    frames = feeds.from_rows(spark, rows)
    before, was = shuffle_files(spark), spark.conf.get(SHUFFLE_CLEANUP)
    landing.publish(spark, frames, str(tmp_path))
    for _ in range(100):
        if not (left := shuffle_files(spark) - before):
            break
        time.sleep(0.1)
    assert not left and spark.conf.get(SHUFFLE_CLEANUP) == was


def test_brief_shuffles_restore_the_setting_when_the_last_has_left(spark):
    was = spark.conf.get(SHUFFLE_CLEANUP)
    first, second = brief_shuffles(spark), brief_shuffles(spark)
    first.__enter__()
    second.__enter__()
    first.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == "true"
    second.__exit__(None, None, None)
    assert spark.conf.get(SHUFFLE_CLEANUP) == was


def test_users_of_events_are_screened_before_their_days_are_looked_at(spark, rows):
    """A row of the screening for each kind of fault, none for a good batch; the report is that of the whole rules."""
    names = ("events", "users")

    def frames(data):
        return {n: validation.with_faults(n, f).drop(validation.FAULTS) for n, f in feeds.from_rows(spark, data).items()}

    def doubts(data):
        typed = frames(data)
        return validation.event_users_in_doubt(*(typed[n] for n in names)).count(), validation.event_user_faults(*(typed[n] for n in names)).count()

    assert doubts(rows) == (0, 0)
    validation.reject_relational(frames(rows))
    for name in ("its user", "user mismatch", "event before user"):
        broken = deepcopy(rows)
        OTHER_FAULTS["orphan event" if name == "its user" else name][0](broken)
        screened, found = doubts(broken)
        assert screened == 1 and found >= 1
        with pytest.raises(ContractError) as caught:
            validation.reject_relational(frames(broken))
        assert OTHER_FAULTS[name][1][:2] in {f[:2] for f in caught.value.faults} and not any("to look at" in f[2] for f in caught.value.faults)
    repeated = deepcopy(rows)
    repeated["users"].append({**repeated["users"][0], "account_id": "A0001"})
    assert doubts(repeated)[0] == 1


def test_json_feed_reports_unknown_fields_and_wrong_types(spark, rows, tmp_path):
    data = as_json(rows)
    data["accounts"][0]["owner"] = "x"
    data["accounts"][1]["segment"] = 7
    data["subscriptions"][2]["amount_cents"] = "many"
    del data["users"][0]["created_date"]
    for name, records in data.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(records))
    found = validation.violations(feeds.read_feeds(spark, str(tmp_path))).where("rule = 'V3'").collect()
    assert {(f["dataset"], f["key"], f["detail"]) for f in found} == {
        ("accounts", "A0000", "unknown field owner"),
        ("accounts", "A0001", "not text: segment"),
        ("subscriptions", "A0000|2024-03-01", "amount_cents is not a bigint"),
        ("users", "U000", "created_date is missing"),
    }


def test_equal_ingestion_times_keep_the_first_in_the_feed(spark, rows, tmp_path):
    data = as_json(rows)
    data["events"].append({**data["events"][0], "event_name": "export"})
    data["events"].append({**data["events"][0], "event_name": "automation"})
    for name, records in data.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(records))
    batch = landing.publish(spark, feeds.read_feeds(spark, str(tmp_path)), f"{tmp_path}/a")
    got = landing.read_batch(spark, f"{tmp_path}/a", batch.batch_id)["events"]
    first = got.where(f"event_id = '{data['events'][0]['event_id']}'").collect()
    assert [r["event_name"] for r in first] == ["workspace_created"]


@pytest.mark.parametrize(
    ("text", "utc"),
    [
        ("2024-01-02T00:30:00+02:00", datetime(2024, 1, 1, 22, 30)),
        ("2024-01-02T00:30:00Z", datetime(2024, 1, 2, 0, 30)),
        ("2024-01-02T00:30:00", datetime(2024, 1, 2, 0, 30)),
        ("2024-01-02 00:30:00.250", datetime(2024, 1, 2, 0, 30, 0, 250000)),
        ("yesterday", None),
    ],
)
def test_offsets_become_utc(spark, text, utc):
    from pyspark.sql import functions as F

    row = spark.createDataFrame([(text,)], "t string").select(validation.utc_timestamp(F.col("t")).alias("t")).first()
    assert row["t"] == utc


def test_parquet_feed_round_trip(spark, rows, tmp_path):
    batch = publish(spark, rows, tmp_path)
    typed = feeds.read_parquet_feeds(spark, f"{tmp_path}/data/{batch.run}")
    assert landing.publish(spark, typed, f"{tmp_path}/again").batch_id == batch.batch_id


def test_numbers_are_no_text(spark):
    frame = spark.createDataFrame([(1, date(2024, 1, 1), "SMB", "AMER", "organic")], "account_id bigint, signup_date date, segment string, region string, channel string")
    checked = validation.with_faults("accounts", frame)
    assert [f["detail"] for f in checked.first()[validation.FAULTS]] == ["account_id is not a string"]


def test_summary_has_one_line_for_all_unknown_fields(spark):
    rows = [("accounts", "V3", f"A{k}", f"unknown field x{k}", 1) for k in range(50)] + [("accounts", "V4", "A1", "segment not allowed", 2)]
    got = validation.summary(spark.createDataFrame(rows, validation.REPORT)).collect()
    assert sorted((r["detail"], r["rows"], r["example"]) for r in got) == [("segment not allowed", 2, "A1"), ("unknown field", 50, "x0 in A0")]


def test_a_feed_is_read_once(spark, rows, tmp_path):
    seen = Observation()
    raw = feeds.from_rows(spark, rows)["users"].observe(seen, F.count(F.lit(1)).alias("n"))
    landing._land("users", raw, f"{tmp_path}/users", validation.DOMAINS)
    assert seen.get["n"] == len(rows["users"]) == spark.read.parquet(f"{tmp_path}/users").count()


def test_fingerprint_lanes_are_wide(spark):
    kinds = spark.range(1).select(F.lit("x").alias("a")).agg(*landing.fingerprint_columns(StructType.fromDDL("a string"))).dtypes
    assert {k for n, k in kinds if n.startswith("lane")} == {"decimal(38,0)"}


def test_lanes_are_sums_of_plain_integers(spark):
    """The lanes are those of the row's sha256, its highest bits too, and no row becomes a decimal."""
    import hashlib

    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    lanes = df.agg(*landing.fingerprint_columns(df.schema))
    digests = [hashlib.sha256(f"{len(str(i))}:{i}".encode()).hexdigest() for i in range(500)]
    expected = [sum(int(d[16 * i : 16 * i + 16], 16) for d in digests) for i in range(landing.LANES)]
    assert [int(lanes.first()[f"lane{i}"]) for i in range(landing.LANES)] == expected
    empty = df.where("false").agg(*landing.fingerprint_columns(df.schema)).first()
    assert [empty["rows"], *(empty[f"lane{i}"] for i in range(landing.LANES))] == [0, *[None] * landing.LANES]
    plan = lanes._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(cast(conv" not in plan and "as decimal(28,0)))" not in plan


def test_plain_records_are_told_by_their_schema(spark, tmp_path):
    plain = dict(account_id="a1", month="2020-01-01", amount_cents=12, billing_period="monthly", plan="P")
    cases = [
        (plain, [], []),
        ({**plain, "amount_cents": 1.5, "plan": None}, [], []),
        ({}, [], []),
        ({"plan": "x, y>"}, [], []),
        ({**plain, "plan": 3}, [], ["plan"]),
        ({**plain, "account_id": {"b": 1}}, [], ["account_id"]),
        ({**plain, "plan: STRING, q": 1}, ["plan: STRING, q"], []),
        ({**plain, "plans": None}, ["plans"], []),
        ([1], ["(not an object)"], []),
    ]
    (tmp_path / "s.jsonl").write_text("".join(json.dumps(record) + "\n" for record, *_ in cases))
    read = feeds.read_json(spark, "subscriptions", f"{tmp_path}/s.jsonl", lines=True)
    found = read.orderBy("_arrival").collect()
    assert [(r[validation.UNKNOWN_FIELDS], r[validation.NOT_TEXT]) for r in found] == [(unknown, wrong) for _, unknown, wrong in cases]
    plan = read._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("OBJECT<(account_id: ") == 2
