"""Raw tables: snapshot replacement, keyed upsert, load audit, rolling refresh.

Data folders are written once and never changed. What a table holds is said by the last entry of an
append-only log, so a load that stops anywhere before its entry leaves the earlier state whole, and one
entry moves any number of tables at once. Folders that neither the last entry nor the one before names are
removed after an entry was written; readers of the state before keep theirs until the next load. One writer at a
time.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructField, StructType

from subspan.session import written
from subspan.sources import files, landing
from subspan.sources.contracts import CONTRACTS
from subspan.sources.pointers import LOG
from subspan.sources.pointers import entries as _entries
from subspan.sources.pointers import last as _last
from subspan.sources.pointers import point as _point
from subspan.sources.pointers import sweep as _sweep

AUDIT = "batch_id string, loaded_at timestamp_ntz"
PUSHED_IDS = 1_000  # event ids of a batch that go to the scan of the stored ones as a filter
SENT_IDS = 2_000_000  # that are broadcast: some 100 MB
Days = dict[str, str]  # of a table stored by day: the run whose folder holds a day


def load_snapshot(spark: SparkSession, landing_dir: str, batch_id: str, warehouse: str) -> None:
    """Make a verified batch the content of all raw tables at once.

    The batch is immutable, so the tables point at it and no data move. Loading it again, or an
    older one, only moves the pointer.
    """
    landing.verify(spark, landing_dir, batch_id)
    _point(spark, f"{warehouse}/raw", f"{batch_id} {landing_dir}")


def raw_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    last = _last(spark, f"{warehouse}/raw")
    if last is None:
        raise FileNotFoundError(f"no batch was loaded into {warehouse}")
    batch_id, landing_dir = last["value"].split(" ", 1)
    return landing.read_batch(spark, landing_dir, batch_id)


# --- keyed upsert ---------------------------------------------------------------------------


def merge_rows(target: DataFrame, batch: DataFrame, keys: Iterable[str], newest: str | None = None) -> DataFrame:
    """Batch rows replace target rows of the same key, new keys are added, the rest stays.

    With ``newest`` a batch row replaces only when its value is at least the target's, so
    replaying an old batch cannot undo a later correction. Keys are unique on both sides, so the
    merge is "best row per key" over the union: one shuffle.
    """
    columns = target.columns
    both = target.withColumn("_from_batch", F.lit(0)).unionByName(
        batch.select(*columns).withColumn("_from_batch", F.lit(1))
    )
    order = ([F.col(newest).desc()] if newest else []) + [F.col("_from_batch").desc()]
    best = Window.partitionBy(*keys).orderBy(*order)
    return both.withColumn("_rank", F.row_number().over(best)).where(F.col("_rank") == 1).select(*columns)


def _version(spark: SparkSession, path: str, version: str | None, schema) -> DataFrame:
    if version is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/data/{version}")


def _merge_version(spark: SparkSession, path: str, version: str | None, batch: DataFrame, keys, schema) -> str:
    """Write a table's next version beside the others; nothing reads it yet."""
    merged = merge_rows(_version(spark, path, version, schema), batch, keys)
    new = uuid.uuid4().hex
    merged.write.option("compression", "zstd").parquet(f"{path}/data/{new}")
    return new


def read_table(spark: SparkSession, path: str, schema) -> DataFrame:
    """The current version of a table written by ``upsert_table``; empty before the first."""
    last = _last(spark, f"{path}/versions")
    return _version(spark, path, last and last["value"], schema)


def upsert_table(spark: SparkSession, path: str, batch: DataFrame, keys: Iterable[str], schema) -> None:
    """S7 for a table that is rewritten whole: a new version beside the old, then the pointer."""
    last = _last(spark, f"{path}/versions")
    _point(spark, f"{path}/versions", _merge_version(spark, path, last and last["value"], batch, keys, schema))
    _sweep(spark, f"{path}/data", [e["value"] for e in _entries(spark, f"{path}/versions", 2)])


# --- tables stored by day -------------------------------------------------------------------
# <path>/data/run=<run>/day=<day>/. Days are bounded by the calendar, so a list of them may pass the driver.


def _read_days(spark: SparkSession, path: str, days: Days, schema: StructType) -> DataFrame:
    """The rows of ``days`` with their ``day``."""
    full = StructType([*schema.fields, StructField("day", DateType())])
    if not days:
        return spark.createDataFrame([], full)
    folders = [f"{path}/data/run={run}/day={day}" for day, run in sorted(days.items())]
    read = spark.read.schema(full).option("basePath", f"{path}/data").parquet(*folders)
    return read.select(*full.names)


def _write_days(spark: SparkSession, path: str, rows: DataFrame, days: Iterable[date], before: Days) -> Days:
    """``before`` with ``rows`` as the whole content of ``days``, written to a new run."""
    days = sorted({d.isoformat() for d in days})
    if not days:
        return dict(before)
    run = uuid.uuid4().hex
    # One day goes to one task, or to several when it is large. Files are sorted by event and have a Bloom filter of them.
    rows = rows.where(F.col("day").isin([date.fromisoformat(d) for d in days])).hint("rebalance", "day")
    write = rows.sortWithinPartitions("day", "event_id").write.option("compression", "zstd").partitionBy("day")
    blooms = {"parquet.bloom.filter.enabled#event_id": "true", "parquet.bloom.filter.adaptive.enabled": "true"}
    write.options(**blooms).parquet(f"{path}/data/run={run}")
    present = {n.removeprefix("day=") for n in files.children(spark, f"{path}/data/run={run}") if n.startswith("day=")}
    return {d: r for d, r in before.items() if d not in days} | {d: run for d in present}


def _days_of(spark: SparkSession, path: str) -> Days:
    last = _last(spark, f"{path}/days")
    return json.loads(last["value"]) if last else {}


def _point_days(spark: SparkSession, path: str, days: Days) -> None:
    _point(spark, f"{path}/days", json.dumps(days, sort_keys=True))
    kept = [json.loads(e["value"]) for e in _entries(spark, f"{path}/days", 2)]
    _sweep(spark, f"{path}/data", {run for state in kept for run in state.values()})


def days_with(stored: DataFrame, ids: DataFrame) -> set[date]:
    """Days of ``stored`` (event_id, day) that hold any of the distinct ``ids`` (event_id).

    Few ids are a filter that the scan gets: statistics and Bloom filters of the files skip what can't hold them. More are broadcast. Either
    way the stored ids are not shuffled, as they are for a batch beyond ``SENT_IDS``.
    """
    few = [r[0] for r in ids.limit(PUSHED_IDS + 1).collect()]
    if len(few) <= PUSHED_IDS:
        return {r[0] for r in stored.where(F.col("event_id").isin(few)).select("day").collect()} if few else set()
    if ids.limit(SENT_IDS + 1).count() <= SENT_IDS:
        ids = F.broadcast(ids)
    return {r[0] for r in stored.join(ids, "event_id", "left_semi").select("day").distinct().collect()}


def _merge_days(spark: SparkSession, path: str, before: Days, batch: DataFrame, unit: str) -> Days:
    """Merge events into the days they touch: the batch's and those where its event ids already sit."""
    columns = CONTRACTS["events"].columns
    incoming = _with_day(batch.select(*columns), "occurred_at", unit)
    days = {r["day"] for r in incoming.select("day").distinct().collect()}
    others = {d: run for d, run in before.items() if date.fromisoformat(d) not in days}
    if others:
        days |= days_with(_read_days(spark, path, others, CONTRACTS["events"].schema), incoming.select("event_id"))
    touched = {d.isoformat(): before[d.isoformat()] for d in days if d.isoformat() in before}
    old = _read_days(spark, path, touched, CONTRACTS["events"].schema)
    return _write_days(spark, path, merge_rows(old, incoming, ["event_id"], "ingested_at"), days, before)


def _with_day(df: DataFrame, column: str, unit: str = "day") -> DataFrame:
    """Add the partition column: the day of ``column``, or the first day of its month."""
    day = F.col(column).cast("date")
    return df.withColumn("day", day if unit == "day" else F.trunc(day, unit))


def read_days(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The current rows, with their ``day``, of a table written by ``upsert_events`` or ``refresh_events``."""
    return _read_days(spark, path, _days_of(spark, path), schema)


def read_events(spark: SparkSession, path: str) -> DataFrame:
    return read_days(spark, path, CONTRACTS["events"].schema)


def upsert_events(spark: SparkSession, path: str, batch: DataFrame, unit: str = "day") -> None:
    """S7 for the event table, stored by day of occurrence; rewrites only the days it must.

    ``unit="month"`` stores by month instead, for tables too small to fill daily files. A correction may
    move an event to another day: both days are rewritten and appear together.
    """
    # A merge reads the batch several times: its days, its ids, its rows. Written first, it is computed once.
    incoming = f"{path}/incoming/{uuid.uuid4().hex}"
    try:
        batch = written(batch.select(*CONTRACTS["events"].columns), incoming)
        _point_days(spark, path, _merge_days(spark, path, _days_of(spark, path), batch, unit))
    finally:
        files.remove(spark, incoming)


# --- the accumulated tables -----------------------------------------------------------------


def _state(entry) -> dict:
    return json.loads(entry["value"]) if entry else {"versions": {}, "days": {}}


def load_merge(spark: SparkSession, landing_dir: str, batch_id: str, warehouse: str, unit: str = "day") -> None:
    """Merge a verified batch into the six accumulated tables and note the load, all at once.

    Every table's new data are written first; one log entry then names them and the batch. Loading a batch again
    merges it again, which changes no row, and leaves its first time in the audit.
    """
    landing.verify(spark, landing_dir, batch_id)
    before = _state(_last(spark, f"{warehouse}/loads"))
    versions, days = dict(before["versions"]), before["days"]
    for name, frame in landing.read_batch(spark, landing_dir, batch_id).items():
        path, contract = f"{warehouse}/{name}", CONTRACTS[name]
        if name == "events":
            days = _merge_days(spark, path, days, frame, unit)
        else:
            versions[name] = _merge_version(spark, path, versions.get(name), frame, contract.key, contract.schema)
    now = spark.range(1).select(F.current_timestamp().cast("timestamp_ntz").cast("string")).first()[0]
    state = {"batch_id": batch_id, "loaded_at": now, "versions": versions, "days": days}
    _point(spark, f"{warehouse}/loads", json.dumps(state, sort_keys=True))
    kept = [_state(e) for e in _entries(spark, f"{warehouse}/loads", 2)]
    for name in CONTRACTS:
        named = [set(s["days"].values()) if name == "events" else {s["versions"][name]} for s in kept]
        _sweep(spark, f"{warehouse}/{name}/data", set().union(*named))


def merged_tables(spark: SparkSession, warehouse: str) -> dict[str, DataFrame]:
    """The six tables of one state."""
    state = _state(_last(spark, f"{warehouse}/loads"))
    return {
        name: _read_days(spark, f"{warehouse}/{name}", state["days"], c.schema).select(*c.columns)
        if name == "events"
        else _version(spark, f"{warehouse}/{name}", state["versions"].get(name), c.schema)
        for name, c in CONTRACTS.items()
    }


def read_audit(spark: SparkSession, warehouse: str) -> DataFrame:
    """Each loaded batch once, with the time of its first load."""
    if not files.exists(spark, f"{warehouse}/loads"):
        return spark.createDataFrame([], AUDIT)
    loads = spark.read.schema(LOG).json(f"{warehouse}/loads").select(F.from_json("value", AUDIT).alias("load"))
    return loads.groupBy("load.batch_id").agg(F.min("load.loaded_at").alias("loaded_at"))


def unrecorded_loads(loads: DataFrame, audit: DataFrame) -> DataFrame:
    """The loads the audit does not hold yet."""
    return loads.dropDuplicates(["batch_id"]).join(audit.select("batch_id"), "batch_id", "left_anti")


# --- rolling refresh ------------------------------------------------------------------------
KEEP_MONTHS = 36
RELOAD_DAYS = 7


def refresh_days(as_of: date, reload_days: int = RELOAD_DAYS, extra_days: Iterable[date] = ()) -> list[date]:
    """The last days up to and with ``as_of``, and days named for restatement."""
    return sorted({as_of - timedelta(days=i) for i in range(reload_days)} | set(extra_days))


def first_kept_day(as_of: date, keep_months: int = KEEP_MONTHS) -> date:
    """First day of the month ``keep_months`` before the one of ``as_of``."""
    months = as_of.year * 12 + as_of.month - 1 - keep_months
    return date(months // 12, months % 12 + 1, 1)


def refresh_events(
    spark: SparkSession,
    store: str,
    source: DataFrame,
    as_of: date,
    keep_months: int = KEEP_MONTHS,
    reload_days: int = RELOAD_DAYS,
    extra_days: Iterable[date] = (),
) -> None:
    """Reload recent days of the event fact from ``source`` and drop days past retention.

    ``source`` is filtered on ``date_day`` before anything else, so a day-partitioned or sorted
    source is read only for those days. Older corrections need ``extra_days``. Reloaded and dropped days
    change together.
    """
    oldest = first_kept_day(as_of, keep_months)
    days = [d for d in refresh_days(as_of, reload_days, extra_days) if d >= oldest]
    slice_ = source.where(F.col("date_day").isin(days)).withColumn("day", F.col("date_day"))
    kept = {d: run for d, run in _days_of(spark, store).items() if d >= oldest.isoformat()}
    _point_days(spark, store, _write_days(spark, store, slice_, days, kept))
