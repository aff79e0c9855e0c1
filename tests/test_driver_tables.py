"""The driver's tables as feeds: odd line numbers, ties and fractions of seconds."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from parity import batches
from subspan.sources.driver_tables import SCHEMAS, DriverTables


@pytest.fixture()
def tables(spark, tmp_path):
    """Event ids that several orders share, lines that come twice, customers whose texts and numbers are ordered differently, nulls."""
    day = datetime(2020, 1, 1, 0, 0, 0, 123456)
    orders = [(k, (9, 10, 100, 8)[k % 4], "O", 1.0, day, "1") for k in range(-3, 40)] + [(5, 77, "O", 1.0, day, "1")]
    lines = [(k, p, k % 7, n, 1.0, 1.0, 0.0, 0.0, "N", "O", day) for k in range(-3, 40) for n in (1, 11, -9, 21, None) for p in (3, 4, 4, None)]
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, SCHEMAS[name]).repartition(3).write.parquet(f"{tmp_path}/{name}.parquet")
    return DriverTables(spark, str(tmp_path))


def seen(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_versions_of_an_id_lie_in_the_order_of_their_columns(spark, tables, tmp_path):
    events = tables.events()
    assert events.groupBy("event_id").agg(F.countDistinct("user_id").alias("n")).where("event_id is not null and n > 2").count()
    for t in (tables, tables.with_stored_arrivals(f"{tmp_path}/arrivals")):
        assert seen(t.events()) == seen(t.events_in_order()) == seen(events) and seen(t.users()) == seen(tables.users())
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            placed = t.events_in_order().withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
        finally:
            spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        assert len({r["task"] for r in placed}) > 1
        ids = {}
        for r in sorted(placed, key=lambda r: r["at"]):
            ids.setdefault(r["event_id"], []).append(tuple((v is not None, v) for v in r[: len(events.columns)]))
        assert all(v == sorted(v) for v in ids.values())


def test_texts_of_events_are_made_behind_the_shuffle(tables, tmp_path):
    ordered = tables.with_stored_arrivals(f"{tmp_path}/arrivals").events_in_order()
    text = ordered._jdf.queryExecution().optimizedPlan().toString()
    assert text.index(" AS user_id") < text.index("RepartitionByExpression") and " AS user_id" not in text[text.index("RepartitionByExpression") :]
    assert "Join" not in text  # the arrivals are joined once, for users too


def test_feed_fields_keep_fractions_of_seconds(spark, tables):
    event = tables.events().where("occurred_at is not null")
    found = event.select(F.to_json(F.struct(*batches._feed_fields(event))).alias("value"), "occurred_at").first()
    assert json.loads(found["value"])["occurred_at"] == found["occurred_at"].isoformat() == "2020-01-01T00:00:00.123456"
    whole = spark.sql("select timestamp_ntz'2020-01-01 00:00:00' as t")
    assert whole.select(*batches._feed_fields(whole)).first()["t"] == "2020-01-01T00:00:00"
