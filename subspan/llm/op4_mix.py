"""Mixing sources to target weights (4): weighted fair queueing of shuffled documents.

Sources, ordered by code point with null last, weigh 3, 1, 2, repeating. They share ``budget`` times all words by weight; no
target passes ``repeats`` times its source's words, and what is over goes to the others by weight. Each source offers its
documents in a shuffled order, ``repeats`` times over. An offer's virtual finish time is the words that its source has offered
until its end, divided by the source's target. The mix takes the offers in order of that time until the next one
would pass the whole budget, so at any point of the order the sources are served in proportion to their targets, and at the end
each is within a document or so of its target. Documents are taken whole.

Every running sum has two levels: sums of ``_PLACES`` hash ranges of a source, then rows of one range. So no window holds a
source, however large, and texts are read once and not shuffled. The global order is cut at one offer: sums over ranges of the
virtual time say in which range the budget ends and only that range is sorted.

Nulls and odd input: null and empty texts have no words and are taken 0 times; a null source is a source; a null id is
an id like others. Repeated rows are offered each for itself, equal ones in any order. Without words nothing is
taken and targets are 0. Reruns agree: the shuffle is a hash of the id and the text, so rows of one id, or without any, are spread, too. ``mixed``
returns every column of its table as it is, whatever its name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import named, new_path, numbered, remove, stored, table

WEIGHTS = (3, 1, 2)
BUDGET, REPEATS = 1.5, 2
_PLACES = 3  # hexadecimal digits of the shuffle's hash: 4096 ranges of a source
_TIMES = 4096  # ranges of the virtual time up to a target
SEED = "mix-1:"


def targets(sizes: DataFrame, budget: float = BUDGET, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source``, ``source_size``, ``place`` and ``target`` from one row a source (source, source_size).

    Sources reach their caps in the order of cap / weight. With those before a source capped, the rest of the budget
    divides by the weights from it on; the first source whose cap that level doesn't pass gives the level for all.
    """
    in_order = Window.orderBy(F.col("source").asc_nulls_last())
    weighted = sizes.withColumn("place", F.row_number().over(in_order)).withColumn(
        "weight", F.element_at(F.array(*[F.lit(w) for w in weights]), F.pmod(F.col("place") - 1, F.lit(len(weights))).cast("int") + 1)
    )
    weighted = weighted.withColumn("cap", repeats * F.col("source_size"))
    everything = Window.partitionBy()
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), "place")
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    level = (budget * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("weight").over(onward)
    levelled = weighted.withColumn("own", level).withColumn("at", F.row_number().over(by_cap))
    first = F.min(F.when(F.col("own") <= F.col("cap") / F.col("weight"), F.struct("at", "own"))).over(everything)
    target = F.least(F.col("cap").cast("double"), first["own"] * F.col("weight"))
    return levelled.select("source", "source_size", "place", F.coalesce(target, F.lit(0.0)).alias("target"))


def taken(docs: DataFrame, budget: float = BUDGET, repeats: int = REPEATS, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """doc_id, text_hash, size, source_size, target and taken (words, repeats counted) of every row."""
    under = new_path(docs.sparkSession, "mix")
    size = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    own = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    hashed = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lit(":"), own))
    sized = docs.select("doc_id", "source", size.alias("size"), F.xxhash64("text").alias("text_hash"), hashed.alias("hash"))
    sized = stored(sized.withColumn("range", F.substring("hash", 1, _PLACES)), "sized", under)
    sums = stored(sized.groupBy("source", "range").agg(F.sum("size").alias("words")), "sums", under)
    goals = stored(targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), budget, repeats, weights), "targets", under)
    ranges = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    bases = sums.select("source", "range", F.coalesce(F.sum("words").over(ranges), F.lit(0)).alias("base"))
    bases = stored(_by_source(bases, goals), "bases", under)
    inside = Window.partitionBy("source", "range").orderBy("hash", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    placed = sized.withColumn("until", F.sum("size").over(inside))
    queue = stored(_by_source(placed, bases, "range").withColumn("until", F.col("base") + F.col("until")).drop("base", "range"), "queue")

    def offer(k: int):
        """The order of the k-th offer of a row among all."""
        finish = (F.col("until") + k * F.col("source_size")).cast("double") / F.col("target")
        return F.struct(finish.alias("finish"), "place", F.lit(k).alias("pass"), "hash", F.coalesce("doc_id", F.lit(-1)).alias("id"), "size")

    waiting = queue.where("size > 0 and target > 0")
    offers = waiting.select(F.explode(F.array(*[offer(k) for k in range(repeats)])).alias("o"))
    slot = F.least(F.floor(F.col("o.finish") * _TIMES), F.lit(4 * _TIMES)).cast("int")
    offers = offers.select("o", slot.alias("slot"), F.col("o.size").alias("size"))
    limit = budget * (goals.agg(F.sum("source_size")).first()[0] or 0)
    running = Window.orderBy("slot")  # one row a range of the virtual time
    slots = offers.groupBy("slot").agg(F.sum("size").alias("words")).withColumn("until", F.sum("words").over(running))
    last = slots.where(F.col("until") > limit).orderBy("slot").select("slot", (F.col("until") - F.col("words")).alias("base")).first()
    count = F.lit(0)
    if last is not None:
        exact = offers.where(F.col("slot") == last["slot"]).withColumn("until", last["base"] + F.sum("size").over(Window.orderBy("o")))
        cut = exact.where(F.col("until") > limit).agg(F.min("o").alias("o")).first()["o"]
        refused = F.struct(*[F.lit(cut[c]).alias(c) for c in cut.__fields__])
        for k in range(repeats):
            count = count + F.when(offer(k) < refused, 1).otherwise(0)
    else:
        count = F.lit(repeats)  # the budget holds every offer
    remove(docs.sparkSession, under)
    words = F.when((F.col("size") > 0) & (F.col("target") > 0), F.col("size") * count).otherwise(0).cast("long")
    return queue.select("doc_id", "text_hash", "size", "source_size", "target", words.alias("taken"))


def _by_source(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join on the source, null included, and on ``keys``."""
    right = right.withColumnRenamed("source", "its_source")
    same = F.col("source").eqNullSafe(F.col("its_source"))
    for k in keys:
        right = right.withColumnRenamed(k, f"its_{k}")
        same = same & (F.col(k) == F.col(f"its_{k}"))
    return left.join(right, same).drop("its_source", *[f"its_{k}" for k in keys])


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that the mix takes, each as often as it does."""
    rows = taken(docs, **options).where("taken > 0")
    rows = rows.select("doc_id", "text_hash", (F.col("taken") / F.col("size")).cast("int").alias("copies"))
    keys = ["its_id", "its_null", "its_hash"]
    rows = rows.select(F.coalesce("doc_id", F.lit(-1)).alias("its_id"), F.col("doc_id").isNull().alias("its_null"), F.col("text_hash").alias("its_hash"), "copies")
    rows = rows.withColumn("its_row", F.row_number().over(Window.partitionBy(*keys).orderBy(F.col("copies").desc())))
    at = {c.lower(): f"c{k}" for k, c in enumerate(docs.columns)}
    own = numbered(docs).withColumns(
        {"its_id": F.coalesce(at["doc_id"], F.lit(-1)), "its_null": F.col(at["doc_id"]).isNull(), "its_hash": F.xxhash64(at["text"])}
    )
    own = own.withColumn("its_row", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(0))))
    return named(own.join(rows, [*keys, "its_row"]).withColumn("its_copy", F.explode(F.array_repeat(F.lit(0), F.col("copies")))), docs)


ORACLE = f"""
with sized as (
    select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) as bigint) as size,
           md5('{SEED}' || cast(doc_id as varchar) || ':' || md5(coalesce(text, ''))) as hash
    from documents
),
sources as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
placed as (select *, row_number() over (order by source nulls last) as place from sources),
weighted as (select *, [3, 1, 2][cast((place - 1) % 3 as integer) + 1] as weight, 2 * source_size as cap from placed),
levelled as (
    select *, row_number() over (order by cap / weight, place) as nth,
        (cast(1.5 as double) * cast(sum(source_size) over () as bigint)
            - cast(coalesce(sum(cap) over (order by cap / weight, place rows between unbounded preceding and 1 preceding), 0) as bigint))
        / cast(sum(weight) over (order by cap / weight, place rows between current row and unbounded following) as bigint) as own
    from weighted
),
level as (select own as l from levelled where own <= cap / weight order by nth limit 1),
goals as (select source, source_size, place, least(cast(cap as double), l * weight) as target from levelled, level),
ordered as (
    select s.doc_id, s.hash, s.size, g.*,
        cast(sum(s.size) over (partition by g.place order by s.hash, s.doc_id rows unbounded preceding) as bigint) as until
    from sized s join goals g on s.source is not distinct from g.source
),
offers as (
    select doc_id, hash, size, place, pass, cast(until + pass * source_size as double) / target as finish
    from ordered, (select unnest([0, 1]) as pass) where size > 0 and target > 0
),
served as (
    select *, sum(size) over (order by finish, place, pass, hash, doc_id rows unbounded preceding) as words from offers
),
mix as (
    select doc_id, cast(sum(size) as bigint) as taken from served
    where words <= (select 1.5 * sum(source_size) from sources) group by doc_id
)
select doc_id, size, source_size, target, coalesce(taken, 0) as taken from ordered left join mix using (doc_id)
"""


@query("op4_mix_sources", ORACLE)
def op4_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return taken(table(spark, folder, "documents")).drop("text_hash")
