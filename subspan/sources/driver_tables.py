"""The six contract datasets derived from order/lineitem style tables.

Every derivation runs over the whole tables. Event versions are kept as they come: the same
event id arrives several times with different ingestion times, so the cleaning operators have
real work to do. Shipments go on after the last order, so some events lie after the calendar.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subspan.functions.columns import month_start
from subspan.session import written
from subspan.sources.contracts import CHANNELS, CONTRACTS, EVENT_NAMES

# Columns read from each table. Naming them saves a footer read per query.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    ),
}

PLANS = ("Starter", "Growth", "Scale")


def _pick(names: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, names)), (number % len(names) + 1).cast("int"))


def _text(col: str) -> Column:
    return F.col(col).cast("string")


def _event_number() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def _event_columns() -> dict[str, Column]:
    """The columns of an event from those of its arrival."""
    return {
        "event_id": _event_number().cast("string"),
        "user_id": F.concat(_text("o_custkey"), F.lit("U"), _text("l_linenumber")),
        "account_id": _text("o_custkey"),
        "occurred_at": F.col("l_shipdate"),
        "event_name": _pick(EVENT_NAMES, F.col("kind")),
        "ingested_at": F.col("l_shipdate") + F.make_dt_interval(days=F.col("late")),
    }


class DriverTables:
    def __init__(self, spark: SparkSession, folder: str, arrivals: DataFrame | None = None) -> None:
        self.spark, self.folder = spark, folder
        self._read: dict[str, DataFrame] = {}
        self._arrivals = arrivals

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            path = f"{self.folder}/{name}.parquet"
            self._read[name] = self.spark.read.schema(SCHEMAS[name]).parquet(path)
        return self._read[name]

    def first_orders(self) -> DataFrame:
        return (
            self.table("orders")
            .groupBy("o_custkey")
            .agg(F.min("o_orderdate").cast("date").alias("signup_date"))
        )

    def accounts(self) -> DataFrame:
        # nation and region are fixed lists (25 and 5 rows); Spark broadcasts them by size.
        places = self.table("nation").join(
            self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")
        )
        return (
            self.table("customer")
            .join(self.first_orders(), F.col("c_custkey") == F.col("o_custkey"))
            .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
            .select(
                _text("c_custkey").alias("account_id"),
                "signup_date",
                F.col("c_mktsegment").alias("segment"),
                F.col("r_name").alias("region"),
                _pick(CHANNELS, F.col("c_custkey")).alias("channel"),
            )
        )

    def order_lines(self) -> DataFrame:
        return self.table("lineitem").join(
            self.table("orders").select("o_orderkey", "o_custkey"),
            F.col("l_orderkey") == F.col("o_orderkey"),
        )

    def arrivals(self) -> DataFrame:
        """What users and event versions are made of: few columns and small numbers go through the join's shuffle."""
        if self._arrivals is not None:
            return self._arrivals
        lines = self.table("lineitem").select(
            "l_orderkey",
            "l_linenumber",
            (F.col("l_partkey") % len(EVENT_NAMES)).alias("kind"),
            (F.col("l_suppkey") % 5).cast("int").alias("late"),
            "l_shipdate",
        )
        orders = self.table("orders").select("o_orderkey", "o_custkey")
        return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).drop("o_orderkey")

    def with_stored_arrivals(self, path: str) -> DriverTables:
        """These tables with the arrivals written once, for more than one of the datasets."""
        return DriverTables(self.spark, self.folder, written(self.arrivals(), path))

    def users(self) -> DataFrame:
        """One user per account and line number, who exists from the day of the first shipment on."""
        return (
            self.arrivals()
            .groupBy("o_custkey", "l_linenumber")
            .agg(F.min("l_shipdate").cast("date").alias("created_date"))
            .select(
                F.concat(_text("o_custkey"), F.lit("U"), _text("l_linenumber")).alias("user_id"),
                _text("o_custkey").alias("account_id"),
                "created_date",
            )
        )

    def subscriptions(self) -> DataFrame:
        cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
        return (
            self.table("orders")
            .groupBy("o_custkey", month_start("o_orderdate").alias("month"))
            .agg(F.sum(cents).alias("amount_cents"))
            .select(
                _text("o_custkey").alias("account_id"),
                "month",
                "amount_cents",
                F.when(F.col("o_custkey") % 4 == 0, "annual").otherwise("monthly").alias("billing_period"),
                _pick(PLANS, F.col("o_custkey")).alias("plan"),
            )
        )

    def events(self) -> DataFrame:
        """Every arrival of every event, before any cleaning."""
        return self.arrivals().select(*(column.alias(name) for name, column in _event_columns().items()))

    def events_in_order(self) -> DataFrame:
        """``events()`` by the number of their id, and those of one id in the order of all columns. Their texts are made behind shuffle and sort."""
        columns = _event_columns()
        order = [_event_number(), *columns.values()]
        placed = self.arrivals().repartitionByRange(*order).sortWithinPartitions(*order)
        return placed.select(*(column.alias(name) for name, column in columns.items()))

    def opportunities(self) -> DataFrame:
        account = F.col("o_custkey")
        paid = F.when(
            account % 5 != 0, F.date_add("signup_date", (account % 19 + 3).cast("int"))
        )
        qualified = F.when((account % 5 != 0) | (account % 7 != 0), F.date_add("signup_date", 2))
        return (
            self.first_orders()
            .join(self.table("customer").select("c_custkey"), account == F.col("c_custkey"))
            .select(
                _text("o_custkey").alias("account_id"),
                F.col("signup_date").alias("trial_date"),
                qualified.alias("qualified_date"),
                paid.alias("paid_date"),
            )
        )

    def marketing(self) -> DataFrame:
        """Spend by order day and channel; its days are the calendar, whatever the last of them is."""
        return (
            self.table("orders")
            .groupBy(
                F.col("o_orderdate").cast("date").alias("spend_date"),
                _pick(CHANNELS, F.col("o_custkey")).alias("channel"),
            )
            .agg(F.sum(F.round("o_totalprice").cast("bigint")).alias("spend_cents"))
        )

    def datasets(self) -> Mapping[str, DataFrame]:
        return _Datasets(self)


class _Datasets(Mapping):
    """Builds a dataset's plan when a query first asks for it."""

    def __init__(self, tables: DriverTables) -> None:
        self._tables = tables
        self._built: dict[str, DataFrame] = {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in CONTRACTS:
            raise KeyError(name)
        if name not in self._built:
            self._built[name] = getattr(self._tables, name)()
        return self._built[name]

    def __iter__(self) -> Iterator[str]:
        return iter(CONTRACTS)

    def __len__(self) -> int:
        return len(CONTRACTS)
