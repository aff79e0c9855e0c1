"""Source divergence audit (13): a translate-table tokenizer, counters of each document and sparse aggregation.

``bytes.translate`` lowers A-Z and blanks every separator in one pass, ``bytes.split`` gives the terms and a ``Counter`` of each document
their frequencies. A task adds the counters up by (language, source) and passes on what it holds when that reaches ``HELD`` terms, so
a shuffled row stands for many occurrences. One shuffle by (language, term) brings the sources of a term together. A language keeps the terms
of at least ``DOCUMENTS`` of its documents, and a kept term is one row with its sources.

Each group (language, source) and each language gives a kept term the smoothed share 1 + floor(10^9 (count + 5) / (N + 5 V)), in whole numbers.
``pairs`` sums the differences of any two sources of a language over all kept terms; ``leading_terms`` ranks the terms that a source
uses more than its language does. Tasks add the sums of pairs up in a matrix of ``AT_ONCE`` sources by as many; with more sources they pass
over the kept terms once for each two such blocks, so no more than two blocks of the groups' names and sums are broadcast, and
no row is made for a term and a pair.

Nulls and odd input: a null text, language or source is an empty one. Documents without terms count as members of their group. Repeated rows
count each; ids and extra columns are not read. A language without kept terms has pairs of value 0. An empty table gives
an empty result.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import stored, table
from subspan.llm.words import slices, text_bytes

DOCUMENTS, LEADING = 30, 50
SMOOTH, UNIT = 5, 1_000_000_000
HELD, HELD_BYTES = 200_000, 32 << 20  # terms, and bytes of text, after which a task passes its counts on
AT_ONCE = 1024  # sources a block
_CELLS = 1 << 20  # of a matrix of terms by sources

# [^\x00-\x40\x5B-\x60\x7B-\x7F] after A-Z is lowered; everything else becomes a space.
TABLE = bytes(ord(chr(b).lower()) if chr(b).isascii() and chr(b).isalpha() else b if b >= 0x80 else 0x20 for b in range(256))


def _rows(held: dict[tuple[str, str], tuple[Counter, Counter]]) -> Iterator[pa.RecordBatch]:
    for (lang, source), (counts, documents) in held.items():
        n = len(counts)
        columns = [
            pa.array([lang], pa.string()).take(pa.array(np.zeros(n, np.int64))),
            pa.array([source], pa.string()).take(pa.array(np.zeros(n, np.int64))),
            pa.array(list(counts), pa.binary()).cast(pa.string()),
            pa.array(list(counts.values()), pa.int64()),
            pa.array(list(map(documents.__getitem__, counts)), pa.int64()),
        ]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "source", "term", "n", "documents"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    seen = 0
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        rows = zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), offsets.tolist(), offsets.tolist()[1:], strict=False)
        for lang, source, a, b in rows:
            if a == b:
                continue
            own = Counter(data[a:b].tobytes().translate(TABLE).split())
            if (lang, source) not in held:
                held[lang, source] = Counter(), Counter()
            counts, documents = held[lang, source]
            documents.update(own.keys())
            for term, n in own.items():
                counts[term] += n
        seen += len(data)
        if seen >= HELD_BYTES or sum(len(c) for c, _ in held.values()) >= HELD:
            yield from _rows(held)
            held, seen = {}, 0
    yield from _rows(held)


def kept_terms(docs: DataFrame, least: int = DOCUMENTS) -> DataFrame:
    """lang, term, total (occurrences) and its sources (source, n) of every term in at least ``least`` documents of its language."""
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")]
    counted = docs.select(*names).mapInArrow(_counted, "lang string, source string, term string, n long, documents long")
    # Both groupings have what one shuffle by language and term brings together.
    by_source = counted.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("documents").alias("documents"))
    terms = by_source.groupBy("lang", "term").agg(
        F.sum("documents").alias("documents"), F.sum("n").alias("total"), F.collect_list(F.struct("source", "n")).alias("sources")
    )
    return terms.where(F.col("documents") >= least).select("lang", "term", "total", "sources")


def groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group that occurs: lang, source, place among all, terms kept by its language, ``own`` and ``whole``: the divisor N + 5 V of group and language."""
    every = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]).distinct()
    langs = kept.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("total").alias("whole"))
    counts = kept.select("lang", F.explode("sources").alias("s")).groupBy("lang", F.col("s.source").alias("source")).agg(F.sum("s.n").alias("own"))
    number = F.row_number().over(Window.orderBy("lang", "source"))  # a row a group
    some = every.join(langs, "lang", "left").join(counts, ["lang", "source"], "left").fillna(0, ["terms", "whole", "own"])
    smooth = SMOOTH * F.col("terms")
    return some.select("lang", "source", number.alias("place"), "terms", (F.col("own") + smooth).alias("own"), (F.col("whole") + smooth).alias("whole"))


def shares(counts: np.ndarray, divisors: np.ndarray) -> np.ndarray:
    """1 + floor(UNIT (count + 5) / divisor), exact for divisors below 9 * 10^15: nine decimal places in three steps."""
    rest, out = counts + SMOOTH, np.zeros(np.broadcast_shapes(counts.shape, divisors.shape), dtype=np.int64)
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // divisors
        rest = rest % divisors
    return out + 1


def _share(count: str, divisor: str):
    whole = f"cast({UNIT} as decimal(10,0)) * cast({count} + {SMOOTH} as decimal(20,0))"
    return F.expr(f"1 + {whole} div cast({divisor} as decimal(20,0))").cast("long")


def _differences(shared):
    """Sums of differences of the sources of the first block with those of the second, over the terms of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value  # rows: lang, source, place, own
        by_lang: dict[str, tuple[list, list]] = {}
        for side, rows in enumerate((first, second)):
            for r in rows:
                by_lang.setdefault(r[0], ([], []))[side].append(r)
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column("lang").to_pylist(), dtype=object)
            sources = batch.column("sources").to_pylist()
            for lang in dict.fromkeys(langs):
                sides = by_lang.get(lang)
                if sides is None or not all(sides):
                    continue
                every = [*sides[0], *sides[1]]
                columns: dict[str, list[int]] = {}
                for k, r in enumerate(every):
                    columns.setdefault(r[1], []).append(k)
                divisors = np.array([r[3] for r in every], dtype=np.int64)
                out = sums.setdefault(lang, np.zeros((len(sides[0]), len(sides[1])), dtype=np.int64))
                terms = np.flatnonzero(langs == lang)
                step = max(1, _CELLS // len(every))
                for i in range(0, len(terms), step):
                    counts = np.zeros((len(terms[i : i + step]), len(every)), dtype=np.int64)
                    for row, k in enumerate(terms[i : i + step]):
                        for s in sources[k]:
                            for c in columns.get(s["source"], ()):
                                counts[row, c] = s["n"]
                    p = shares(counts, divisors)
                    a, b = p[:, : len(sides[0])], p[:, len(sides[0]) :]
                    for k in range(a.shape[1]):
                        out[k] += np.abs(a[:, k : k + 1] - b).sum(axis=0)
        for lang, out in sums.items():
            sides = by_lang[lang]
            a, b = (np.array([r[2] for r in side], dtype=np.int64) for side in sides)
            x, y = np.nonzero(a[:, None] < b)
            yield pa.RecordBatch.from_arrays([pa.array(a[x]), pa.array(b[y]), pa.array(out[x, y])], names=["a", "b", "value"])

    return run


def pairs(kept: DataFrame, known: DataFrame, at_once: int = AT_ONCE) -> DataFrame:
    """lang, source, item (another source of the language) and the sum of their differences over all kept terms."""
    spark = known.sparkSession
    number = known.agg(F.max("place")).first()[0] or 0
    blocks = []  # first and last language of each block
    for k in range(0, number, at_once):
        edge = known.where(F.col("place").between(k + 1, k + at_once)).agg(F.min("lang"), F.max("lang")).first()
        blocks.append((k, edge[0], edge[1]))

    def rows(k: int) -> list[tuple]:
        some = known.where((F.col("terms") > 0) & F.col("place").between(k + 1, k + at_once))
        return [tuple(r) for r in some.select("lang", "source", "place", "own").collect()]  # at_once rows

    found = spark.createDataFrame([], "a long, b long, value long")
    for i, (k, _, highest) in enumerate(blocks):
        for j, (l, lowest, _) in enumerate(blocks[i:], i):
            if i == j or lowest <= highest:  # they share a language
                shared = spark.sparkContext.broadcast((rows(k), rows(l)))
                part = kept.select("lang", "sources").mapInArrow(_differences(shared), "a long, b long, value long")
                part = part.groupBy("a", "b").agg(F.sum("value").alias("value"))
                found = found.unionByName(part if len(blocks) == 1 else stored(part, "differences"))
                if len(blocks) > 1:
                    shared.destroy()
    both = found.union(found.select("b", "a", "value")).toDF("place", "its_place", "value")
    other = known.select("lang", F.col("source").alias("item"), F.col("place").alias("its_place"))
    every = known.select("lang", "source", "place").join(other, "lang").where("place <> its_place")  # as many rows as the result
    return every.join(both, ["place", "its_place"], "left").select("lang", "source", "item", F.coalesce("value", F.lit(0)).cast("long").alias("value"))


def leading_terms(kept: DataFrame, known: DataFrame, ranks: int = LEADING) -> DataFrame:
    """The ``ranks`` terms that each source uses more than its language, by the difference of their shares."""
    each = kept.select("lang", "term", "total", F.explode("sources").alias("s")).select("lang", "term", "total", "s.source", "s.n")
    met = each.join(known.select("lang", "source", "own", "whole"), ["lang", "source"])
    valued = met.select("lang", "source", F.col("term").alias("item"), (_share("n", "own") - _share("total", "whole")).alias("value")).where("value > 0")
    return _ranked(valued).where(F.col("rank") <= ranks)


def _ranked(valued: DataFrame) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item")
    return valued.withColumn("rank", F.row_number().over(order))


def audit(docs: DataFrame, least: int = DOCUMENTS, ranks: int = LEADING, at_once: int = AT_ONCE) -> DataFrame:
    """lang, source, part, item, value, rank: the distances of the sources of a language, and the leading terms of each."""
    kept = stored(kept_terms(docs, least), "kept")
    known = stored(groups(docs, kept), "groups")
    parts = [("pair", _ranked(pairs(kept, known, at_once))), ("term", leading_terms(kept, known, ranks))]
    named = [p.select("lang", "source", F.lit(name).alias("part"), "item", "value", "rank") for name, p in parts]
    return named[0].unionByName(named[1])


ORACLE = f"""
with words as (
    select row_number() over () as doc, coalesce(lang, '') as lang, coalesce(source, '') as source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') as w
    from documents
),
each as (select doc, lang, source, unnest(w) as term from words),
counted as (select lang, source, term, count(*) as n from each group by lang, source, term),
kept as (select lang, term from each group by lang, term having count(distinct doc) >= {DOCUMENTS}),
sizes as (select lang, count(*) as v from kept group by lang),
pool as (select distinct lang, source from words),
dense as (
    select g.lang, g.source, k.term, coalesce(c.n, 0) as n
    from pool g join kept k on g.lang = k.lang
    left join counted c on c.lang = g.lang and c.source = g.source and c.term = k.term
),
shares as (
    select d.lang, d.source, d.term, d.n, 1 + cast(floor({UNIT} * (d.n + {SMOOTH}) // (t.total + {SMOOTH} * s.v)) as bigint) as p
    from dense d join sizes s on d.lang = s.lang
    join (select lang, source, cast(sum(n) as bigint) as total from dense group by lang, source) t on t.lang = d.lang and t.source = d.source
),
whole as (
    select a.lang, a.term, 1 + cast(floor({UNIT} * (a.n + {SMOOTH}) // (b.total + {SMOOTH} * s.v)) as bigint) as q
    from (select lang, term, cast(sum(n) as bigint) as n from dense group by lang, term) a
    join (select lang, cast(sum(n) as bigint) as total from dense group by lang) b on a.lang = b.lang join sizes s on a.lang = s.lang
),
sums as (
    select x.lang, x.source, y.source as item, cast(sum(abs(x.p - y.p)) as bigint) as value
    from shares x join shares y on x.lang = y.lang and x.term = y.term and x.source <> y.source group by x.lang, x.source, y.source
),
valued as (
    select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value
    from pool a join pool b on a.lang = b.lang and a.source <> b.source
    left join sums s on s.lang = a.lang and s.source = a.source and s.item = b.source
    union all
    select x.lang, x.source, 'term', x.term, x.p - w.q from shares x join whole w on x.lang = w.lang and x.term = w.term where x.n > 0 and x.p > w.q
),
ranked as (select *, row_number() over (partition by lang, source, part order by value desc, item) as rank from valued)
select lang, source, part, item, cast(value as bigint) as value, cast(rank as integer) as rank from ranked where part = 'pair' or rank <= {LEADING}
"""


@query("op13_source_divergence", ORACLE)
def op13_source_divergence(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"))
