"""Contract rules V2-V13 as columns and joins.

``with_faults`` checks everything that one row can decide in the pass that types the row.
``relational`` holds the rules that need other rows. Both report (dataset, rule, key, detail,
rows): the offending key and how many rows it stands for. Joins see pre-aggregated keys, so a
key that owns a third of all rows is one row in them.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType, TimestampNTZType

from subspan.operators.staging import latest_events
from subspan.sources.contracts import ACCOUNT_CHILDREN, AMOUNTS, CONTRACTS, DOMAINS

FAULTS = "_faults"
UNKNOWN_FIELDS = "_unknown_fields"  # set by feed readers: fields the contract does not have
UNKNOWN_FIELD = "unknown field "
NOT_TEXT = "_not_text"  # set by feed readers: text fields that arrived as numbers or objects
REPORT = "dataset string, rule string, key string, detail string, rows bigint"


class ContractError(ValueError):
    """A batch broke its contract; ``faults`` holds (dataset, rule, detail, rows, example)."""

    def __init__(self, faults: list[tuple]) -> None:
        self.faults = faults
        super().__init__("; ".join(f"{d} {r} {what}: {n} rows, e.g. {e}" for d, r, what, n, e in faults))


def check_datasets(names) -> None:
    """V1: exactly the contracted datasets."""
    missing, extra = set(CONTRACTS) - set(names), set(names) - set(CONTRACTS)
    if missing or extra:
        raise ContractError([(d, "V1", "missing dataset", 0, None) for d in sorted(missing)]
                            + [(d, "V1", "unknown dataset", 0, None) for d in sorted(extra)])


def utc_timestamp(text: Column) -> Column:
    """V6: text with an offset is moved to UTC, text without one is UTC already.

    Needs a UTC session, which gives text without an offset its meaning.
    """
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def _typed(column: Column, have: DataType, want: DataType) -> Column:
    if have == want:
        return column
    if isinstance(want, TimestampNTZType) and isinstance(have, StringType):
        return utc_timestamp(column)
    return column.try_cast(want)


def _row_rules(dataset: str, domains: Mapping[str, Mapping[str, tuple]]) -> list[tuple[str, str, Column]]:
    """(rule, detail, is broken) for V4, V5, V10 and V13 over typed columns."""
    rules = [
        ("V4", f"{column} not allowed", ~F.col(column).isin(*allowed))
        for column, allowed in domains.get(dataset, {}).items()
    ]
    if dataset in AMOUNTS:
        rules.append(("V5", f"{AMOUNTS[dataset]} negative", F.col(AMOUNTS[dataset]) < 0))
    if dataset == "subscriptions":
        rules.append(("V10", "month is not a first day", F.dayofmonth("month") != 1))
    if dataset == "opportunities":
        trial, qualified, paid = F.col("trial_date"), F.col("qualified_date"), F.col("paid_date")
        disorder = (qualified < trial) | (paid < trial) | (paid < qualified)
        rules += [
            ("V13", "milestones out of order", disorder),
            ("V13", "paid without qualified", paid.isNotNull() & qualified.isNull()),
        ]
    return rules


def _fault(rule: str | Column, detail: str | Column, broken: Column) -> Column:
    def text(v):
        return F.lit(v) if isinstance(v, str) else v

    return F.when(broken, F.struct(text(rule).alias("rule"), text(detail).alias("detail")))


def _listed(names: str, what: str) -> Column:
    """One V3 fault per entry of an array column of field names."""
    entries = F.coalesce(F.col(names), F.array().cast("array<string>"))
    return F.transform(
        entries, lambda name: F.struct(F.lit("V3").alias("rule"), F.concat(F.lit(what), name).alias("detail"))
    )


def with_faults(dataset: str, raw: DataFrame, domains=DOMAINS) -> DataFrame:
    """The contract's typed columns, any extra columns, and the row's faults."""
    contract = CONTRACTS[dataset]
    have = {f.name: f.dataType for f in raw.schema.fields}
    helpers = {UNKNOWN_FIELDS, NOT_TEXT, "_arrival"}
    absent = [c for c in contract.columns if c not in have]
    unknown = [c for c in raw.columns if c not in contract.columns and c not in helpers]
    if absent or unknown:
        raise ContractError([(dataset, "V3", f"missing column {c}", 0, None) for c in absent]
                            + [(dataset, "V3", f"unknown column {c}", 0, None) for c in unknown])

    before = {f.name: F.col(f"_raw.{f.name}") for f in contract.schema.fields}
    kept = [c for c in ("_arrival",) if c in raw.columns]
    flags = [c for c in (UNKNOWN_FIELDS, NOT_TEXT) if c in raw.columns]
    typed = raw.select(
        F.struct(*contract.columns).alias("_raw"),
        *(_typed(F.col(f.name), have[f.name], f.dataType).alias(f.name) for f in contract.schema.fields),
        *kept,
        *flags,
    )
    faults = []
    for f in contract.schema.fields:
        if have[f.name] != f.dataType:
            # Text is never made from numbers or other types: any such value is a fault.
            wrong = before[f.name].isNotNull()
            if f.dataType != StringType():
                wrong = wrong & F.col(f.name).isNull()
            faults.append(_fault("V3", f"{f.name} is not a {f.dataType.simpleString()}", wrong))
        if not f.nullable:
            faults.append(_fault("V3", f"{f.name} is missing", before[f.name].isNull()))
    faults += [_fault(*rule) for rule in _row_rules(dataset, domains)]
    found = F.array_compact(F.array(*faults))
    if flags:
        listed = [
            _listed(c, what)
            for c, what in ((UNKNOWN_FIELDS, UNKNOWN_FIELD), (NOT_TEXT, "not text: "))
            if c in flags
        ]
        found = F.concat(found, *listed)
    return typed.withColumn(FAULTS, found).select(*contract.columns, *kept, FAULTS)


def key_text(columns) -> Column:
    return F.concat_ws("|", *(F.col(c).cast("string") for c in columns))


def row_violations(dataset: str, checked: DataFrame) -> DataFrame:
    """The row faults of ``with_faults``, one line per key and fault."""
    return (
        checked.where(F.size(FAULTS) > 0)
        .select(key_text(CONTRACTS[dataset].key).alias("key"), F.explode(FAULTS).alias("f"))
        .groupBy(F.lit(dataset).alias("dataset"), "f.rule", "key", "f.detail")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def _report(df: DataFrame, dataset: str, rule: str, detail: str, key: Column, rows: Column | str) -> DataFrame:
    return df.select(
        F.lit(dataset).alias("dataset"),
        F.lit(rule).alias("rule"),
        key.alias("key"),
        F.lit(detail).alias("detail"),
        (F.col(rows) if isinstance(rows, str) else rows).cast("bigint").alias("rows"),
    )


def empty_dataset(dataset: str, df: DataFrame) -> DataFrame:
    """V2."""
    none = df.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == 0)
    return _report(none, dataset, "V2", "dataset is empty", F.lit(None).cast("string"), "n")


def duplicate_keys(dataset: str, df: DataFrame, key=None) -> DataFrame:
    """V7."""
    key = list(key or CONTRACTS[dataset].key)
    repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    return _report(repeated, dataset, "V7", "duplicate key", key_text(key), "n")


def orphans(dataset: str, child: DataFrame, accounts: DataFrame) -> DataFrame:
    """V9: account ids without an account."""
    missing = (
        child.groupBy("account_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .join(accounts.select("account_id"), "account_id", "left_anti")
    )
    return _report(missing, dataset, "V9", "account does not exist", F.col("account_id"), "n")


def event_user_faults(events: DataFrame, users: DataFrame) -> DataFrame:
    """V11 and the first half of V12, over one row per user, account and day.

    ``events`` are the surviving versions only, like every rule that compares rows.
    """
    days = (
        events.groupBy("user_id", "account_id", F.col("occurred_at").cast("date").alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .join(
            users.select("user_id", F.col("account_id").alias("owner"), "created_date"), "user_id", "left"
        )
    )
    mismatch = F.col("owner").isNull() | (F.col("owner") != F.col("account_id"))
    early = ~mismatch & (F.col("day") < F.col("created_date"))
    key = key_text(["user_id", "account_id"])
    found = (
        days.withColumn(
            "f",
            F.when(mismatch, F.struct(F.lit("V11").alias("rule"), F.lit("user does not belong to account").alias("detail")))
            .when(early, F.struct(F.lit("V12").alias("rule"), F.lit("occurred before the user existed").alias("detail"))),
        )
        .where(F.col("f").isNotNull())
        .groupBy(F.lit("events").alias("dataset"), "f.rule", key.alias("key"), "f.detail")
        .agg(F.sum("n").alias("rows"))
    )
    return found


def event_users_in_doubt(events: DataFrame, users: DataFrame) -> DataFrame:
    """One row if ``event_user_faults`` may find anything, none if it can't.

    A pair of user and account is without fault if the user's account is that one and its first day not too early. So the pairs, which are
    far fewer than their days, are what meets the users.
    """
    pairs = events.groupBy("user_id", "account_id").agg(F.min(F.col("occurred_at").cast("date")).alias("first"))
    met = pairs.join(users.select("user_id", F.col("account_id").alias("owner"), "created_date"), "user_id", "left")
    fine = (F.col("owner") == F.col("account_id")) & (F.col("first") >= F.col("created_date"))
    doubts = met.where(~F.coalesce(fine, F.lit(False))).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 0)
    return _report(doubts, "events", "V11", "users to look at", F.lit(None).cast("string"), "n")


def ingested_early(events: DataFrame) -> DataFrame:
    """The second half of V12."""
    bad = events.where(F.col("ingested_at") < F.col("occurred_at"))
    return _report(bad, "events", "V12", "ingested before it occurred", F.col("event_id"), F.lit(1))


def relational(frames: Mapping[str, DataFrame], screened: bool = False) -> DataFrame:
    """V2, V7, V9, V11 and V12 over typed frames whose events are already the latest versions.

    ``screened`` only tells whether users of events are to be looked at, which costs less: without any row there is no fault.
    """
    parts = [empty_dataset(name, frames[name]) for name in CONTRACTS]
    parts += [duplicate_keys(name, frames[name]) for name in CONTRACTS if name != "events"]
    parts += [orphans(name, frames[name], frames["accounts"]) for name in ACCOUNT_CHILDREN]
    of_users = event_users_in_doubt if screened else event_user_faults
    parts += [of_users(frames["events"], frames["users"]), ingested_early(frames["events"])]
    return reduce(DataFrame.unionByName, parts)


def violations(feeds: Mapping[str, DataFrame], domains=DOMAINS) -> DataFrame:
    """Every broken rule of a batch as one long table; empty when the batch is good."""
    check_datasets(feeds)
    checked = {name: with_faults(name, feeds[name], domains) for name in CONTRACTS}
    rows = [row_violations(name, df) for name, df in checked.items()]
    arrival = "_arrival" if "_arrival" in checked["events"].columns else None
    survivors = {**checked, "events": latest_events(checked["events"], arrival)}
    return reduce(DataFrame.unionByName, [*rows, relational(survivors)])


def summary(found: DataFrame) -> DataFrame:
    """One line per dataset, rule and kind of fault: bounded by the contract, whatever the data hold.

    Names of unknown fields come from the data, so all of them are one kind and the example names one.
    """
    unknown = F.col("detail").startswith(UNKNOWN_FIELD)
    named = F.concat(F.substring("detail", len(UNKNOWN_FIELD) + 1, 1000), F.lit(" in "), F.coalesce("key", F.lit("?")))
    return (
        found.select(
            "dataset",
            "rule",
            F.when(unknown, UNKNOWN_FIELD.strip()).otherwise(F.col("detail")).alias("detail"),
            "rows",
            F.when(unknown, named).otherwise(F.col("key")).alias("key"),
        )
        .groupBy("dataset", "rule", "detail")
        .agg(F.sum("rows").alias("rows"), F.min("key").alias("example"))
    )


def reject(found: DataFrame) -> None:
    """Raise when there is any violation."""
    faults = summary(found).orderBy("dataset", "rule", "detail").collect()
    if faults:
        raise ContractError([(f.dataset, f.rule, f.detail, f.rows, f.example) for f in faults])


def reject_relational(frames: Mapping[str, DataFrame]) -> None:
    """V14 for the rules that look at other rows. A good batch is screened only."""
    if summary(relational(frames, screened=True)).collect():
        reject(relational(frames))
