"""Distinct users and accounts as exact bitmaps.

Users and accounts of the usage base get dense numbers, those of accounts with equal attributes next to each other. A bitmap row stands for up to
64 of them: who was active on a day, by the account's attributes and the event name. Distinct counts of any grouping by these columns
and the calendar's are unions of bitmaps and counts of bits. A bitmap is one bigint, so unions are hash aggregates of plain integers: on a single
day few users of one event are neighbours, and a wide bitmap would be sorted and moved for a bit or two.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from subspan.functions.columns import mask_union
from subspan.session import written

ATTRIBUTES = ("segment", "region", "channel", "cohort_month")
WHO = {"user": "user_id", "account": "account_id"}
_WORD_BITS = 6  # of a number: its place among the 64 of a bitmap
_RANGE_BITS = 20  # users whose bitmaps of a month are made in one task
_PART_BITS = 33  # of monotonically_increasing_id: the rows of a partition


def numbers(usage: DataFrame, account: DataFrame, column: str, path: str) -> DataFrame:
    """``column``, ``number`` (from 1, without gaps) of every user or account of ``usage``; writes a table to ``path``.

    A global sort deals them out in ranges; a range's first number is the count of all before it, a row a range.
    """
    who = usage.where(F.col(column).isNotNull()).groupBy(column).agg(F.min("account_id").alias("_account"))
    members = account.select(F.col("account_id").alias("_account"), *ATTRIBUTES)
    placed = who.join(members, "_account", "left").orderBy(*ATTRIBUTES, "_account", column)
    ordered = written(placed.select(column, F.monotonically_increasing_id().alias("at")), path)
    part = F.shiftright("at", _PART_BITS).alias("part")
    sizes = ordered.groupBy(part).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = F.broadcast(sizes.select("part", before.alias("first")))  # a row a partition
    within = F.col("at").bitwiseAND(F.lit((1 << _PART_BITS) - 1))
    return ordered.select(column, part, within.alias("within")).join(firsts, "part").select(column, (F.col("first") + F.col("within") + 1).alias("number"))


def _bit(number: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), (number % (1 << _WORD_BITS)).cast("int"))


def _days(rows: DataFrame) -> DataFrame:
    """``rows`` once for each day of their mask. All days of a month are tried: an integer test each, cheaper than a list of dates a row."""
    place = F.explode(F.array(*map(F.lit, range(31)))).alias("_place")
    tried = rows.select("*", place).where(F.call_function("shiftright", F.col("day_mask"), F.col("_place")).bitwiseAND(F.lit(1)) != 0)
    return tried.withColumn("day", F.date_add("month", F.col("_place"))).where(F.col("day") <= F.last_day("month")).drop("day_mask", "_place")


def usage_bits(usage: DataFrame, account: DataFrame, folder: str) -> DataFrame:
    """Who (kind), month, day, the attributes, whether the account is known, event_name, bucket and bits; ``folder`` gets the numbers.

    Tasks look users and accounts up in hash tables of these, so the usage rows are never sorted. They are shuffled as they are, by month and a
    range of users; days and bitmaps unfold after that. A bitmap whose members lie in two ranges comes as two rows, which is as good for a union.
    """
    members = account.select("account_id", *ATTRIBUTES, F.lit(True).alias("known"))
    user, place = (numbers(usage, account, column, f"{folder}/{kind}_numbers").withColumnRenamed("number", f"_{kind}") for kind, column in WHO.items())
    places = place.join(members, "account_id", "left")
    rows = usage.join(user.hint("shuffle_hash"), "user_id", "left").drop("user_id").join(places.hint("shuffle_hash"), "account_id", "left")
    ranged = rows.withColumn("_range", F.shiftright(F.coalesce("_user", "_account"), _RANGE_BITS)).repartition("month", "_range")
    who = F.inline(F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(f"_{kind}").alias("number")) for kind in WHO)))
    known = F.coalesce("known", F.lit(False)).alias("known")
    days = _days(ranged.select("month", "_range", "day_mask", *ATTRIBUTES, known, "event_name", who).where(F.col("number").isNotNull()))
    keys = ["month", "_range", "day", *ATTRIBUTES, "known", "event_name", "kind", F.shiftright("number", _WORD_BITS).alias("bucket")]
    return days.groupBy(*keys).agg(mask_union(_bit(F.col("number"))).alias("bits")).drop("_range")


def counted(rows: DataFrame, by: list[str]) -> DataFrame:
    """``by``, users and accounts of bitmap rows."""
    whole = rows.groupBy(*by, "kind", "bucket").agg(mask_union("bits").alias("bits"))
    return whole.groupBy(*by).agg(*(F.sum(F.when(F.col("kind") == kind, F.bit_count("bits"))).alias(column) for kind, column in WHO.items()))


def users_and_days(rows: DataFrame, by: list[str], names: tuple[str, str]) -> DataFrame:
    """``by``, users of bitmap rows and the sum over days of each day's users."""
    daily = rows.where("kind = 'user'").groupBy(*by, "day", "bucket").agg(mask_union("bits").alias("bits"))
    whole = daily.groupBy(*by, "bucket").agg(mask_union("bits").alias("bits"), F.sum(F.bit_count("bits")).alias("days"))
    return whole.groupBy(*by).agg(F.sum(F.bit_count("bits")).alias(names[0]), F.sum("days").alias(names[1]))
