"""License scans (12): an exact set-similarity join of text blocks with license templates, in DataFrame functions alone.

Words are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z. A text's blocks are windows of 2 ``STRIDE`` words that begin
every ``STRIDE`` words, so whatever has up to ``STRIDE`` words stands whole in the block in whose first half it begins.
A template is a set of words and the share of them, its containment, that a block must hold.

Words of templates are ordered by how many documents of the whole table hold them, rarest first. Of a template's ordered words the first
size - need + 1 are its prefix: a block that meets the threshold holds one of these at least. So

1. one pass counts the documents of each template word,
2. one pass keeps the blocks that hold a prefix word, as ordered word numbers; they are cut from a text's words one by one, so the cost follows its length,
3. the prefix words of kept blocks join the templates' prefixes; length filter (a block has as many template words as needed) and positional
   filter (what stands behind the shared word in either order suffices) drop pairs,
4. the rest is verified by its intersection, at the first word that both share, so a pair counts once.

Texts are not shuffled. The join's other side is the templates' prefixes; templates are a parameter, limited to ``MOST`` words in all. Spark broadcasts
that side if it is below its own limit and splits skewed keys if not.

Base phrases are templates that need all their words and then stand consecutively somewhere in the first half of the block, which is checked on
the verified pairs; the notices are found by containment alone. ``score`` is the largest containment of a match, 0 without one.

Nulls and odd input: a text that is null or has no words has no matches. Null ids and repeated rows are judged each for itself. Extra
columns are not read. An empty table gives an empty result; without templates there are no matches.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from subspan.llm.registry import query
from subspan.llm.tables import stored, table

STRIDE, MOST = 64, 100_000
CONTAINMENT = 80  # percent of a notice's words
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Template(NamedTuple):
    label: str
    text: str
    phrase: bool = False  # its words must stand consecutively, and its label is a base label
    percent: int = CONTAINMENT

    def words(self) -> list[str]:
        return re.findall(_WORD, self.text.translate(str.maketrans(_UPPER, _LOWER)))


# The contract's phrases and labels.
PHRASES = (
    Template("gpl", "gnu general public license", True),
    Template("apache", "apache license", True),
    Template("cc-by", "cc by", True),
    Template("mit", "mit license", True),
)
# Sentences of public licenses and of the notices that name them.
NOTICES = (
    Template("apache-2.0", "Licensed under the Apache License, Version 2.0"),
    Template("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    Template("cc-by-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    Template("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0"),
    Template("gpl-3.0", "Licensed under the GNU General Public License, version 3"),
    Template(
        "gpl-notice",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "as published by the Free Software Foundation",
    ),
    Template(
        "mit-permission",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files, "
        "to deal in the Software without restriction",
    ),
    Template("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)


def words_of(text: str) -> Column:
    return F.coalesce(F.regexp_extract_all(F.translate(F.col(text), _UPPER, _LOWER), F.lit(_WORD), F.lit(0)), F.array().cast("array<string>"))


def order_of_words(docs: DataFrame, known: list[str]) -> dict[str, int]:
    """Number of each template word from 1 up: by the documents of the whole table that hold it, then by the word."""
    held = docs.select(F.array_distinct(F.filter(words_of("text"), lambda w: w.isin(known))).alias("held"))
    found = held.select(F.explode("held").alias("word")).groupBy("word").agg(F.count("*").alias("n")).collect()  # a row a template word
    n = {r["word"]: r["n"] for r in found}
    return {w: k for k, w in enumerate(sorted(known, key=lambda w: (n.get(w, 0), w)), 1)}


def _literals(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def matches(docs: DataFrame, templates: tuple[Template, ...], stride: int = STRIDE) -> tuple[DataFrame, DataFrame]:
    """The documents (row, doc_id, n_words) and what was found: row, block, label, phrase, containment, places (starts of a phrase)."""
    spark = docs.sparkSession
    every = [(t, t.words()) for t in templates]
    every = [(t, w) for t, w in every if w]
    if any(len(w) > stride for _, w in every):
        raise ValueError(f"a template has more than {stride} words")
    known = sorted({w for _, words in every for w in words})
    if len(known) > MOST:
        raise ValueError(f"templates have more than {MOST} words")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    order = order_of_words(docs, known) if known else {}

    prefixes, sets = [], []
    for number, (t, words) in enumerate(every):
        ordered = sorted({order[w] for w in words})
        need = len(ordered) if t.phrase else max(1, -(-t.percent * len(ordered) // 100))
        prefixes += [(token, number, at) for at, token in enumerate(ordered[: len(ordered) - need + 1])]
        sets.append((number, t.label, t.phrase, len(ordered), need, ordered, words))
    prefixes = spark.createDataFrame(prefixes, "token int, template int, its_place int")
    sets = spark.createDataFrame(sets, "template int, label string, phrase boolean, size int, need int, tokens array<int>, words array<string>")
    first = {r["token"] for r in prefixes.select("token").collect()}
    rare = [w for w in known if order[w] in first]

    # Cut blocks one by one from the words: linear in the text.
    cut = F.transform(
        F.sequence(F.lit(0), F.floor((F.col("n_words") - 1) / stride).cast("int")),
        lambda b: F.struct(b.alias("block"), F.slice(F.col("words"), b * stride + 1, F.lit(2 * stride)).alias("words")),
    )
    near = F.filter(cut, lambda b: F.exists(b["words"], lambda w: w.isin(rare)))
    split = docs.select("doc_id", words_of("text").alias("words")).withColumn("n_words", F.size("words").cast("long"))
    nothing = F.array().cast("array<struct<block:int,words:array<string>>>")
    scanned = split.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "n_words", F.when((F.col("n_words") > 0) & F.lit(bool(rare)), near).otherwise(nothing).alias("blocks")
    )
    scanned = stored(scanned, "blocks")  # row numbers are fixed by being written

    blocks = scanned.select("row", F.explode("blocks").alias("b")).select("row", "b.block", F.col("b.words").alias("block_words"))
    # Ordered template words of a block: numbers, rarest first.
    numbers = F.create_map(*[F.lit(x) for w in known for x in (w, order[w])]) if known else F.create_map().cast("map<string,int>")
    own = F.array_sort(F.array_distinct(F.transform(F.filter("block_words", lambda w: w.isin(known)), lambda w: F.element_at(numbers, w))))
    blocks = blocks.withColumn("own", own)
    posted = blocks.select("row", "block", "block_words", "own", F.posexplode("own").alias("place", "token"))
    met = posted.where(F.col("token").isin(sorted(first))).join(prefixes, "token").join(sets, "template")
    rest = F.least(F.col("size") - F.col("its_place"), F.size("own") - F.col("place"))
    possible = met.where((F.size("own") >= F.col("need")) & (rest >= F.col("need")))
    common = possible.withColumn("common", F.array_intersect("tokens", "own"))
    verified = common.where((F.col("common")[0] == F.col("token")) & (F.size("common") >= F.col("need")))
    starts = F.filter(
        F.sequence(F.lit(0), F.least(F.lit(stride), F.size("block_words")) - 1),
        lambda i: F.slice(F.col("block_words"), i + 1, F.size("words")) == F.col("words"),
    )
    places = F.when(F.col("phrase"), F.transform(starts, lambda i: (i + F.col("block") * stride).cast("long"))).otherwise(F.array().cast("array<long>"))
    found = verified.select("row", "block", "label", "phrase", (F.size("common") / F.col("size")).alias("containment"), places.alias("places"))
    return scanned.select("row", "doc_id", "n_words"), found.where(~F.col("phrase") | (F.size("places") > 0))


def licenses(docs: DataFrame, templates: tuple[Template, ...] = PHRASES + NOTICES, stride: int = STRIDE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels (arrays) and score of every row of ``docs``."""
    rows, found = matches(docs, templates, stride)
    each = found.groupBy("row").agg(
        F.sum(F.size("places")).cast("long").alias("n_base"),
        F.min(F.array_min("places")).alias("first_word"),
        F.max(F.array_max("places")).alias("last_word"),
        F.array_sort(F.collect_set(F.when(F.col("phrase"), F.col("label")))).alias("base_labels"),
        F.array_sort(F.collect_set("label")).alias("labels"),
        F.max("containment").alias("score"),
    )
    none = F.array().cast("array<string>")
    return rows.join(each, "row", "left").select(
        "doc_id",
        "n_words",
        F.coalesce("n_base", F.lit(0).cast("long")).alias("n_base"),
        "first_word",
        "last_word",
        F.coalesce("base_labels", none).alias("base_labels"),
        F.coalesce("labels", none).alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"),
    )


def _oracle() -> str:
    """Every block against every template, and every place against every phrase."""

    def listed(words: list[str]) -> str:
        return "[" + ", ".join(f"'{w}'" for w in words) + "]"

    rows = ", ".join(
        f"('{t.label}', {str(t.phrase).lower()}, {listed(sorted(set(t.words())))}, {listed(t.words())}, {100 if t.phrase else t.percent})" for t in PHRASES + NOTICES
    )
    return f"""
with template(label, phrase, tokens, words, percent) as (select * from (values {rows})),
doc as (
    select row_number() over () as doc, doc_id,
           coalesce(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
    from documents
),
place as (
    select doc, label, unnest(range(0, len(w) - len(words) + 1)) as i, w, words from doc, template where phrase and len(w) >= len(words)
),
base as (select doc, label, i from place where w[i + 1:i + len(words)] = words),
block as (select doc, w[b * {STRIDE} + 1:b * {STRIDE} + 2 * {STRIDE}] as w from (select doc, w, unnest(range(0, (len(w) + {STRIDE - 1}) // {STRIDE})) as b from doc)),
held as (
    select doc, label, cast(len(list_intersect(tokens, w)) as double) / len(tokens) as containment
    from block, template where not phrase and 100 * len(list_intersect(tokens, w)) >= percent * len(tokens)
),
labelled as (
    select doc, string_agg(label, ',' order by label) as labels, max(containment) as score
    from (select doc, label, max(containment) as containment from (select doc, label, containment from held union all select doc, label, 1.0 from base) group by doc, label)
    group by doc
),
counted as (select doc, count(*) as n_base, min(i) as first_word, max(i) as last_word from base group by doc),
names as (select doc, string_agg(label, ',' order by label) as base_labels from (select distinct doc, label from base) group by doc)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_base, 0) as bigint) as n_base, cast(first_word as bigint) as first_word,
       cast(last_word as bigint) as last_word, coalesce(base_labels, '') as base_labels, coalesce(labels, '') as labels, coalesce(score, 0.0) as score
from doc left join counted using (doc) left join names using (doc) left join labelled using (doc)
"""


@query("op12_license_scan", _oracle())
def op12_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses(table(spark, folder, "documents"))
    return found.withColumns({c: F.concat_ws(",", c) for c in ("base_labels", "labels")})
