"""Contract rules, batches, raw tables and exports (V, S)."""

from __future__ import annotations

import uuid
from datetime import date, datetime
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from parity.core import query
from parity.sql import PARTS
from subspan.functions.columns import month_start
from subspan.operators import staging, validation
from subspan.plans import build
from subspan.plans.models import Models
from subspan.session import brief_shuffles, shared_dir
from subspan.sources import exports, feeds, files, landing, warehouse
from subspan.sources.contracts import CONTRACTS, DOMAINS

# The categories the driver's tables use instead of the contract's.
TABLE_DOMAINS = {
    **DOMAINS,
    "accounts": {
        "segment": ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"),
        "region": ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"),
        "channel": DOMAINS["accounts"]["channel"],
    },
}


def _row_report(dataset, raw, domains=DOMAINS):
    return validation.row_violations(dataset, validation.with_faults(dataset, raw, domains))


# --- rules ----------------------------------------------------------------------------------
@query(
    "V2_empty_dataset",
    """select 'accounts' as dataset, 'V2' as rule, cast(null as varchar) as key, 'dataset is empty' as detail,
              count(*) as "rows" from account_dim where region = 'ATLANTIS' having count(*) = 0""",
)
def _(m, t):
    return validation.empty_dataset("accounts", m.dim_account.where(F.col("region") == "ATLANTIS"))


@query(
    "V3_types_and_required",
    """with found as (
           select account_id, 'signup_date is not a date' as detail from src_accounts a
           join customer c on cast(c.c_custkey as varchar) = a.account_id where c.c_acctbal < 0
           union all select account_id, 'segment is missing' from src_accounts where segment = 'BUILDING')
       select 'accounts' as dataset, 'V3' as rule, account_id as key, detail, cast(1 as bigint) as "rows" from found""",
)
def _(m, t):
    owed = t.table("customer").select(F.col("c_custkey").cast("string").alias("account_id"), "c_acctbal", "c_name")
    raw = (
        m.raw["accounts"]
        .join(owed, "account_id")
        .withColumn("signup_date", F.when(F.col("c_acctbal") < 0, F.col("c_name")).otherwise(F.col("signup_date").cast("string")))
        .withColumn("segment", F.nullif(F.col("segment"), F.lit("BUILDING")))
        .select(*CONTRACTS["accounts"].columns)
    )
    return _row_report("accounts", raw, {})


@query(
    "V4_category_domains",
    """select 'accounts' as dataset, 'V4' as rule, account_id as key, unnest(['segment not allowed', 'region not allowed']) as detail,
              cast(1 as bigint) as "rows" from src_accounts""",
)
def _(m, t):
    return _row_report("accounts", m.raw["accounts"])


@query(
    "V5_nonnegative_amounts",
    """select 'subscriptions' as dataset, 'V5' as rule,
              cast(c_custkey as varchar) || '|' || cast(cast(date_trunc('month', signup_date) as date) as varchar) as key,
              'amount_cents negative' as detail, cast(1 as bigint) as "rows"
       from customer join first_orders on o_custkey = c_custkey where round(c_acctbal * 100) < 0""",
)
def _(m, t):
    raw = (
        t.table("customer")
        .join(t.first_orders(), F.col("c_custkey") == F.col("o_custkey"))
        .select(
            F.col("c_custkey").cast("string").alias("account_id"),
            month_start("signup_date").alias("month"),
            F.round(F.col("c_acctbal") * 100).cast("bigint").alias("amount_cents"),
            F.lit("monthly").alias("billing_period"),
            F.lit("Starter").alias("plan"),
        )
    )
    return _row_report("subscriptions", raw)


@query(
    "V6_utc_timestamps",
    """select o_orderkey, case when o_orderstatus = 'O' then o_orderdate - interval 150 minute else o_orderdate end as occurred_at
       from orders""",
)
def _(m, t):
    local = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("o_orderstatus") == "O", F.concat(local, F.lit("+02:30"))).otherwise(local)
    return t.table("orders").select("o_orderkey", validation.utc_timestamp(text).alias("occurred_at"))


@query(
    "V7_duplicate_keys",
    """select 'users' as dataset, 'V7' as rule,
              cast(o_custkey as varchar) || 'U' || cast(l_linenumber as varchar) as key, 'duplicate key' as detail,
              count(*) as "rows" from order_lines group by o_custkey, l_linenumber having count(*) > 1""",
)
def _(m, t):
    return validation.duplicate_keys("users", m.raw["events"].select("user_id"))


@query(
    "V8_latest_event_version",
    """select event_id, user_id, account_id, occurred_at, event_name, ingested_at from event_versions
       qualify row_number() over (partition by event_id
           order by ingested_at desc, user_id, account_id, occurred_at, event_name) = 1""",
)
def _(m, t):
    return staging.latest_events(m.raw["events"])


@query(
    "V9_orphans",
    """with missing as (
           select 'users' as dataset, account_id from src_users
           union all select 'subscriptions', account_id from src_subscriptions
           union all select 'opportunities', account_id from src_opportunities
           union all select 'events', account_id from clean_events)
       select dataset, 'V9' as rule, account_id as key, 'account does not exist' as detail, count(*) as "rows"
       from missing where account_id not in (select account_id from src_accounts where region = 'ASIA') group by all""",
)
def _(m, t):
    asia = m.raw["accounts"].where(F.col("region") == "ASIA")
    frames = {
        "users": m.raw["users"],
        "subscriptions": m.raw["subscriptions"],
        "opportunities": m.raw["opportunities"],
        "events": m.stg_events,
    }
    found = None
    for name, frame in frames.items():
        part = validation.orphans(name, frame, asia)
        found = part if found is None else found.unionByName(part)
    return found


@query(
    "V10_month_first_day",
    """select 'subscriptions' as dataset, 'V10' as rule,
              cast(o_custkey as varchar) || '|' || cast(cast(o_orderdate as date) as varchar) as key,
              'month is not a first day' as detail, count(*) as "rows"
       from orders where day(o_orderdate) <> 1 group by all""",
)
def _(m, t):
    raw = t.table("orders").select(
        F.col("o_custkey").cast("string").alias("account_id"),
        F.col("o_orderdate").cast("date").alias("month"),
        F.round(F.col("o_totalprice") * 100).cast("bigint").alias("amount_cents"),
        F.lit("monthly").alias("billing_period"),
        F.lit("Starter").alias("plan"),
    )
    return _row_report("subscriptions", raw)


@query(
    "V11_V12_event_users",
    """with known as (
           select distinct cast(o_custkey as varchar) || 'U' || cast(l_linenumber as varchar) as user_id,
                  cast(o_custkey as varchar) as account_id, signup_date as created_date
           from order_lines join first_orders using (o_custkey) where l_returnflag = 'R'),
       newest as (
           select * from event_versions qualify row_number() over (partition by event_id
               order by ingested_at desc, user_id, account_id, occurred_at, event_name) = 1),
       judged as (
           select n.user_id || '|' || n.account_id as key,
                  case when k.user_id is null then 'V11' when cast(n.occurred_at as date) < k.created_date then 'V12' end as rule
           from newest n left join known k on k.user_id = n.user_id and k.account_id = n.account_id)
       select 'events' as dataset, rule, key,
              case rule when 'V11' then 'user does not belong to account' else 'occurred before the user existed' end as detail,
              count(*) as "rows" from judged where rule is not null group by all""",
)
def _(m, t):
    known = (
        t.order_lines()
        .where(F.col("l_returnflag") == "R")
        .select("o_custkey", "l_linenumber")
        .distinct()
        .join(t.first_orders(), "o_custkey")
        .select(
            F.concat(F.col("o_custkey").cast("string"), F.lit("U"), F.col("l_linenumber").cast("string")).alias("user_id"),
            F.col("o_custkey").cast("string").alias("account_id"),
            F.col("signup_date").alias("created_date"),
        )
    )
    return validation.event_user_faults(staging.latest_events(m.raw["events"]), known)


@query(
    "V12_ingested_early",
    """select 'events' as dataset, 'V12' as rule, event_id as key, 'ingested before it occurred' as detail,
              cast(1 as bigint) as "rows"
       from clean_events where ingested_at - interval 2 day < occurred_at""",
)
def _(m, t):
    early = F.col("ingested_at") - F.expr("interval 2 days")
    return validation.ingested_early(m.stg_events.withColumn("ingested_at", early))


@query(
    "V13_funnel_chronology",
    """with milestones as (
           select o_custkey, min(cast(o_orderdate as date)) as trial,
                  max(case when o_orderstatus = 'F' then cast(o_orderdate as date) end) as qualified,
                  min(case when o_orderstatus = 'P' then cast(o_orderdate as date) end) as paid
           from orders group by o_custkey)
       select 'opportunities' as dataset, 'V13' as rule, cast(o_custkey as varchar) as key,
              'milestones out of order' as detail, cast(1 as bigint) as "rows"
       from milestones where qualified < trial or paid < trial or paid < qualified
       union all
       select 'opportunities', 'V13', cast(o_custkey as varchar), 'paid without qualified', 1
       from milestones where paid is not null and qualified is null""",
)
def _(m, t):
    day = F.col("o_orderdate").cast("date")
    raw = (
        t.table("orders")
        .groupBy(F.col("o_custkey").cast("string").alias("account_id"))
        .agg(
            F.min(day).alias("trial_date"),
            F.max(F.when(F.col("o_orderstatus") == "F", day)).alias("qualified_date"),
            F.min(F.when(F.col("o_orderstatus") == "P", day)).alias("paid_date"),
        )
    )
    return _row_report("opportunities", raw)


@query(
    "V14_violation_summary",
    """with newest as (
           select * from event_versions qualify row_number() over (partition by event_id
               order by ingested_at desc, user_id, account_id, occurred_at, event_name) = 1),
       early as (
           select n.user_id || '|' || n.account_id as key from newest n
           join first_orders f on cast(f.o_custkey as varchar) = n.account_id
           where cast(n.occurred_at as date) < f.signup_date)
       select 'accounts' as dataset, 'V4' as rule, unnest(['segment not allowed', 'region not allowed']) as detail,
              count(*) as "rows", min(account_id) as example from src_accounts
       union all
       select 'events', 'V12', 'occurred before the user existed', count(*), min(key) from early""",
)
def _(m, t):
    """With users who exist from their account's first order on, some events come too early."""
    signup = t.first_orders().select(F.col("o_custkey").cast("string").alias("account_id"), "signup_date")
    users = m.raw["users"].join(signup, "account_id").select("user_id", "account_id", F.col("signup_date").alias("created_date"))
    batch = {**m.raw, "users": users}
    return validation.summary(validation.violations(batch))


# --- batches and raw tables -----------------------------------------------------------------
# The part that is each dataset's content once landed.
LANDED = {
    "accounts": "src_accounts",
    "users": "src_users",
    "subscriptions": "src_subscriptions",
    "events": "clean_events",
    "opportunities": "src_opportunities",
    "marketing": "src_marketing",
}


def fingerprint_sql(parts: dict[str, str]) -> str:
    """Row count and fingerprint lanes of each dataset."""

    def text(column: str, kind) -> str:
        value = f"strftime({column}, '%Y-%m-%d %H:%M:%S.%f')" if isinstance(kind, TimestampNTZType) else f"cast({column} as varchar)"
        return f"coalesce(cast(length({value}) as varchar) || ':' || {value}, '-')"

    each = []
    for name, part in parts.items():
        fields = sorted(CONTRACTS[name].schema.fields, key=lambda f: f.name)
        row = " || ',' || ".join(text(f.name, f.dataType) for f in fields)
        lanes = ", ".join(
            f"cast(sum(cast('0x' || substr(h, {1 + 16 * i}, 16) as ubigint)) as decimal(38,0)) as lane{i}" for i in range(landing.LANES)
        )
        each.append(f"select '{name}' as dataset, count(*) as \"rows\", {lanes} from (select sha256({row}) as h from {part})")
    return " union all ".join(each)


def _fingerprints(frames):
    each = (df.agg(*landing.fingerprint_columns(df.schema)).withColumn("dataset", F.lit(name)) for name, df in frames.items())
    return reduce(DataFrame.unionByName, each)


def _published(m):
    spark = m.raw["accounts"].sparkSession
    root = f"{shared_dir(spark)}/batches-{uuid.uuid4().hex}"
    return spark, root, landing.publish(spark, m.raw, root, TABLE_DOMAINS)


@query("S1_json_feed", "select * from clean_events")
def _(m, t):
    """The event versions as a JSON Lines feed on shared storage, read, typed and deduplicated."""
    path = f"{shared_dir(t.spark)}/feed-{uuid.uuid4().hex}"
    m.raw["events"].write.json(path)
    checked = validation.with_faults("events", feeds.read_json(t.spark, "events", path, lines=True))
    return staging.stg_events(checked.where(F.size(validation.FAULTS) == 0))


def _array_lines(batches):
    """A JSON array of a task's records, line by line."""
    yield pa.RecordBatch.from_pydict({"value": ["["]})
    comma = ""
    for batch in batches:
        lines = []
        for text in batch.column("value").to_pylist():
            lines.append(comma + text)
            comma = ","
        yield pa.RecordBatch.from_pydict({"value": pa.array(lines, pa.string())})
    yield pa.RecordBatch.from_pydict({"value": ["]"]})


def _feed_fields(frame):
    """A feed's fields: times with as many digits as they have."""
    times = {f.name for f in frame.schema.fields if isinstance(f.dataType, TimestampNTZType)}
    return [F.translate(F.col(c).cast("string"), " ", "T").alias(c) if c in times else F.col(c) for c in frame.columns]


def _landed_feeds(t, lines: bool):
    """The six tables as JSON feeds on shared storage, read, landed, and read back."""
    spark, root = t.spark, f"{shared_dir(t.spark)}/feeds-{uuid.uuid4().hex}"
    with brief_shuffles(spark):
        tables = t.with_stored_arrivals(f"{root}/arrivals")
        for name, frame in tables.datasets().items():
            if name == "events":
                frame = tables.events_in_order()  # feeds keep the first of equally new versions, the SQL the smallest
            frame = frame.select(*_feed_fields(frame))
            if lines:
                frame.write.json(f"{root}/{name}.jsonl")
            else:
                frame.select(F.to_json(F.struct("*")).alias("value")).mapInArrow(_array_lines, "value string").write.text(f"{root}/{name}.json")
        files.remove(spark, f"{root}/arrivals")
    batch = landing.publish(spark, feeds.read_feeds(spark, root, lines), f"{root}/landing", TABLE_DOMAINS)
    return _fingerprints(landing.read_batch(spark, f"{root}/landing", batch.batch_id))


@query("S1_json_array_feeds", fingerprint_sql(LANDED))
def _(m, t):
    """All six feeds as JSON arrays, which many tasks read."""
    return _landed_feeds(t, lines=False)


@query("S1_json_line_feeds", fingerprint_sql(LANDED))
def _(m, t):
    """All six feeds as JSON Lines."""
    return _landed_feeds(t, lines=True)


@query(
    "V1_dataset_set",
    """select cast(count(*) as bigint) as complete, sum(case when n > 0 then 1 else 0 end)::bigint as with_rows from (
select count(*) as n from src_accounts union all select count(*) from src_users union all select count(*) from src_subscriptions
union all select count(*) from src_events union all select count(*) from src_opportunities union all select count(*) from src_marketing)""",
)
def _(m, t):
    """The six tables are the contracted datasets; each that is left out, or one too many, is refused by name."""
    validation.check_datasets(m.raw)
    for changed in ({n: f for n, f in m.raw.items() if n != "marketing"}, {**m.raw, "leads": m.raw["accounts"]}):
        try:
            validation.check_datasets(changed)
        except validation.ContractError as e:
            assert {f[0] for f in e.faults} == set(changed) ^ set(m.raw)
        else:
            raise AssertionError("a wrong set of datasets was taken")
    counts = reduce(DataFrame.unionByName, (f.agg(F.count("*").alias("n")) for f in m.raw.values()))
    return counts.agg(F.count("*").alias("complete"), F.sum(F.when(F.col("n") > 0, 1).otherwise(0)).alias("with_rows"))


@query("S2_S5_published_batch", fingerprint_sql(LANDED))
def _(m, t):
    """Land and verify; the rows that the files hold."""
    spark, folder, batch = _published(m)
    landing.verify(spark, folder, batch.batch_id)
    return _fingerprints(landing.read_batch(spark, folder, batch.batch_id))


@query("S3_S5_published_batch", f'select dataset, "rows" from ({fingerprint_sql(LANDED)})')
def _(m, t):
    """Land, verify and count: the manifest's own row counts."""
    spark, folder, batch = _published(m)
    checked = landing.verify(spark, folder, batch.batch_id)
    rows = [(name, info["rows"]) for name, info in checked.files.items()]
    return spark.createDataFrame(rows, "dataset string, rows bigint")


@query("S6_snapshot_tables", fingerprint_sql(LANDED))
def _(m, t):
    spark, folder, batch = _published(m)
    store = f"{folder}/warehouse"
    warehouse.load_snapshot(spark, folder, batch.batch_id, store)
    return _fingerprints(warehouse.raw_tables(spark, store))


@query("S6_snapshot_events", "select * from clean_events")
def _(m, t):
    spark, folder, batch = _published(m)
    store = f"{folder}/warehouse"
    warehouse.load_snapshot(spark, folder, batch.batch_id, store)
    return warehouse.raw_tables(spark, store)["events"]


@query("S4_row_fingerprints", fingerprint_sql(LANDED))
def _(m, t):
    return _fingerprints({**m.raw, "events": m.stg_events})


# Two overlapping halves of the event versions: what is stored, and a later batch.
STORED = """
    select * from event_versions where ingested_at < timestamp '1999-01-01'
    qualify row_number() over (partition by event_id
        order by ingested_at desc, user_id, account_id, occurred_at, event_name) = 1"""
ARRIVING = """
    select * from event_versions where occurred_at >= timestamp '1998-06-01'
    qualify row_number() over (partition by event_id
        order by ingested_at desc, user_id, account_id, occurred_at, event_name) = 1"""
MERGED = """
    select coalesce(t.event_id, s.event_id) as event_id,
           case when replace_it then s.user_id else t.user_id end as user_id,
           case when replace_it then s.account_id else t.account_id end as account_id,
           case when replace_it then s.occurred_at else t.occurred_at end as occurred_at,
           case when replace_it then s.event_name else t.event_name end as event_name,
           case when replace_it then s.ingested_at else t.ingested_at end as ingested_at
    from (select coalesce(s.ingested_at >= t.ingested_at, t.event_id is null) as replace_it, t.event_id as t_id, s.event_id as s_id
          from stored t full join arriving s on s.event_id = t.event_id) d
    left join stored t on t.event_id = d.t_id left join arriving s on s.event_id = d.s_id"""


def _halves(t):
    stored = t.events().where(F.col("ingested_at") < F.lit(datetime(1999, 1, 1)).cast("timestamp_ntz"))
    arriving = t.events().where(F.col("occurred_at") >= F.lit(datetime(1998, 6, 1)).cast("timestamp_ntz"))
    return staging.latest_events(stored), staging.latest_events(arriving)


@query("S7_guarded_upsert", MERGED, stored=STORED, arriving=ARRIVING)
def _(m, t):
    stored, arriving = _halves(t)
    return warehouse.merge_rows(stored, arriving, ["event_id"], "ingested_at")


@query("S7_upsert_partitions", MERGED, stored=STORED, arriving=ARRIVING)
def _(m, t):
    """The same merge through the partitioned event table on shared storage."""
    spark = t.spark
    store = f"{shared_dir(spark)}/events-{uuid.uuid4().hex}"
    stored, arriving = _halves(t)
    warehouse.upsert_events(spark, store, stored, unit="month")
    warehouse.upsert_events(spark, store, arriving, unit="month")
    return warehouse.read_events(spark, store).drop("day")


@query(
    "S7_plain_upsert",
    """with old as (select account_id, month, amount_cents, billing_period, plan from src_subscriptions where month < date '1999-01-01'),
       new as (select account_id, month, amount_cents * 2 as amount_cents, billing_period, plan from src_subscriptions
               where month >= date '1998-01-01')
       select * from new
       union all select * from old where (account_id, month) not in (select (account_id, month) from new)""",
)
def _(m, t):
    subs = m.raw["subscriptions"]
    old = subs.where(F.col("month") < date(1999, 1, 1))
    new = subs.where(F.col("month") >= date(1998, 1, 1)).withColumn("amount_cents", F.col("amount_cents") * 2)
    return warehouse.merge_rows(old, new, CONTRACTS["subscriptions"].key)


# Two batches after each other: what the six tables hold then.
LATER_SUBSCRIPTIONS = """
    select account_id, month, amount_cents * 2 as amount_cents, billing_period, plan from src_subscriptions
    where month >= date '1998-01-01'
    union all select account_id, month, amount_cents, billing_period, plan from src_subscriptions
    where month < date '1998-01-01'"""
LATER_MARKETING = """
    select spend_date, channel, spend_cents + if(spend_date >= date '1999-01-01', 5, 0) as spend_cents from src_marketing"""


@query(
    "S7_load_merge",
    fingerprint_sql(LANDED | {"events": "merged", "subscriptions": "later_subscriptions", "marketing": "later_marketing"}),
    stored=STORED,
    arriving=ARRIVING,
    merged=MERGED,
    later_subscriptions=LATER_SUBSCRIPTIONS,
    later_marketing=LATER_MARKETING,
)
def _(m, t):
    """Two overlapping batches merged into the accumulated tables; all six are compared."""
    spark = t.spark
    root = f"{shared_dir(spark)}/merge-{uuid.uuid4().hex}"
    stored, arriving = _halves(t)
    subs, spend = m.raw["subscriptions"], m.raw["marketing"]
    batches = (
        {**m.raw, "events": stored, "subscriptions": subs.where(F.col("month") < date(1999, 1, 1))},
        {
            **m.raw,
            "events": arriving,
            "subscriptions": subs.where(F.col("month") >= date(1998, 1, 1)).withColumn("amount_cents", F.col("amount_cents") * 2),
            "marketing": spend.where(F.col("spend_date") >= date(1999, 1, 1)).withColumn("spend_cents", F.col("spend_cents") + 5),
        },
    )
    for frames in batches:
        batch = landing.publish(spark, frames, root, TABLE_DOMAINS)
        warehouse.load_merge(spark, root, batch.batch_id, f"{root}/store", unit="month")
    return _fingerprints(warehouse.merged_tables(spark, f"{root}/store"))


@query(
    "S8_unrecorded_loads",
    """select distinct cast(o_custkey as varchar) as batch_id from orders
       where o_custkey not in (select c_custkey from customer where c_acctbal > 0)""",
)
def _(m, t):
    loads = t.table("orders").select(F.col("o_custkey").cast("string").alias("batch_id"))
    audit = t.table("customer").where(F.col("c_acctbal") > 0).select(F.col("c_custkey").cast("string").alias("batch_id"))
    return warehouse.unrecorded_loads(loads, audit)


@query("S9_S11_export_round_trip", "select * from revenue_mart")
def _(m, t):
    return _exported(m, t, "mart_revenue_monthly")


def _exported(m, t, name):
    """One mart as CSV and back with its types."""
    folder = f"{shared_dir(t.spark)}/export-{uuid.uuid4().hex}"
    mart = getattr(m, name)
    exports.export_csv({name: mart}, folder)
    return exports.read_export(t.spark, f"{folder}/{name}", mart.schema)


# Every table that is exported, back with its types; the monthly revenue mart is above.
for _name, _part in {
    "dim_user": "src_users",
    "mart_product_monthly": "product_mart",
    "mart_feature_adoption": "adoption_mart",
    "mart_cohort_retention": "retention_mart",
    "mart_acquisition": "acquisition_mart",
    "dim_account": "account_dim",
    "dim_date": "date_dim",
    "fct_account_month": "revenue_fact",
    "fct_product_event": "event_fact",
    "fct_account_funnel": "funnel_fact",
    "fct_marketing_spend": "spend_fact",
}.items():
    query(f"S11_{_name}", f"select * from {_part}")(lambda m, t, name=_name: _exported(m, t, name))

MART_PARTS = {
    "dim_account": "account_dim",
    "dim_user": "src_users",
    "dim_date": "date_dim",
    "fct_account_month": "revenue_fact",
    "fct_product_event": "event_fact",
    "fct_account_funnel": "funnel_fact",
    "fct_marketing_spend": "spend_fact",
    "mart_revenue_monthly": "revenue_mart",
    "mart_product_monthly": "product_mart",
    "mart_feature_adoption": "adoption_mart",
    "mart_cohort_retention": "retention_mart",
    "mart_acquisition": "acquisition_mart",
}


@query(
    "S9_all_marts",
    " union all ".join(f"select '{name}' as mart, count(*) as \"rows\" from {part}" for name, part in MART_PARTS.items()),
)
def _(m, t):
    """Every mart exported; the rows that come back. What marts share is written and computed once."""
    folder = f"{shared_dir(t.spark)}/export-{uuid.uuid4().hex}"
    marts = Models(m.raw, f"{folder}/models").marts()
    exports.export_csv(marts, folder)
    each = (
        exports.read_export(t.spark, f"{folder}/{name}", df.schema).agg(F.count(F.lit(1)).alias("rows")).withColumn("mart", F.lit(name))
        for name, df in marts.items()
    )
    return reduce(DataFrame.unionByName, each)


# The build's test for a calendar without gaps holds once days without orders have a row.
WITHOUT_GAPS = f"""
    with o as ({PARTS["src_marketing"]}),
    days as (select unnest(generate_series((select min(spend_date) from o), (select max(spend_date) from o), interval 1 day)) as d)
    select * from o
    union all select cast(d as date), 'organic', cast(0 as bigint) from days where cast(d as date) not in (select spend_date from o)"""


@query(
    "Q_gated_build",
    " union all ".join(f"select '{name}' as mart, count(*) as \"rows\" from {part}" for name, part in MART_PARTS.items()),
    src_marketing=WITHOUT_GAPS,
)
def _(m, t):
    """All marts written, tested and shown."""
    spend = m.raw["marketing"]
    days = spend.agg(F.explode(F.sequence(F.min("spend_date"), F.max("spend_date"))).alias("spend_date"))
    idle = days.join(spend, "spend_date", "left_anti").select("spend_date", F.lit("organic").alias("channel"), F.lit(0).cast("bigint").alias("spend_cents"))
    folder = f"{shared_dir(t.spark)}/build-{uuid.uuid4().hex}"
    build.build(t.spark, {**m.raw, "marketing": spend.unionByName(idle)}, folder)
    marts = build.built(t.spark, folder)
    each = (df.agg(F.count(F.lit(1)).alias("rows")).withColumn("mart", F.lit(name)) for name, df in marts.items())
    return reduce(DataFrame.unionByName, each)


SUMMARY = (
    "select r.month as latest_month, (select count(*) from account_dim) as accounts, (select count(*) from event_fact) as events, "
    + ", ".join(f"r.{c} as revenue_{c}" for c in exports.REVENUE_FIELDS)
    + ", "
    + ", ".join(f"p.{c} as product_{c}" for c in exports.PRODUCT_FIELDS)
    + """ from (select * from revenue_mart order by month desc limit 1) r
          cross join (select * from product_mart order by month desc limit 1) p"""
)


def _summary(m):
    return exports.latest_summary(m.dim_account, m.fct_product_event, m.mart_revenue_monthly, m.mart_product_monthly)


@query("S10_latest_summary", SUMMARY)
def _(m, t):
    return _summary(m)


@query("S10_written_summary", SUMMARY)
def _(m, t):
    """The summary as its file has it."""
    path, summary = f"{shared_dir(t.spark)}/summary-{uuid.uuid4().hex}", _summary(m)
    exports.write_summary(summary, path)
    return t.spark.read.schema(summary.schema).json(path)


@query(
    "S12_time_range_scan",
    """select event_id, ts, user_id, event_type, value from events
       where ts >= timestamp '2024-01-05 06:00:00' and ts < timestamp '2024-01-12 18:30:00'""",
)
def _(m, t):
    ranged = feeds.time_range(t.table("events"), "ts", datetime(2024, 1, 5, 6), datetime(2024, 1, 12, 18, 30))
    return ranged.select("event_id", "ts", "user_id", "event_type", "value")


@query(
    "S13_rolling_refresh",
    """select * from event_fact where date_day between date '2001-07-25' and date '2001-07-31'
       or date_day in (date '2001-03-05', date '1998-08-01')""",
)
def _(m, t):
    """Load the last week, then again with two days restated; only kept months may come back."""
    store = f"{shared_dir(t.spark)}/refresh-{uuid.uuid4().hex}"
    as_of = date(2001, 7, 31)
    warehouse.refresh_events(t.spark, store, m.fct_product_event, as_of)
    restated = [date(2001, 3, 5), date(1998, 8, 1), date(1998, 6, 30)]  # the last is past retention
    warehouse.refresh_events(t.spark, store, m.fct_product_event, as_of, extra_days=restated)
    return warehouse.read_days(t.spark, store, m.fct_product_event.schema).drop("day")
