"""The pipeline's stages against their operators' rules on the smallest tables."""

import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from tokenizers import Tokenizer

import corpus_pipeline
from subspan.llm import op1_quality
from subspan.llm.tokens import tokenizer_json
from tests.llm.test_documents import components, contamination, water_level

FOLDER = "/root/testdata/sf0.001"


def test_stages_do_what_they_say(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, kept[-1], FOLDER).write.parquet(f"{tmp_path}/{name}")
        kept.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(k.schema.names == docs.schema.names for k in kept[:-1])
    rows = [[tuple(r) for r in k.collect()] for k in kept]
    assert all(set(b) <= set(a) for a, b in zip(rows[:4], rows[1:5], strict=True))

    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    accepted = {r[0] for r in rows[1]}
    known = [(labels[r[0]], r[0] in accepted) for r in rows[0] if r[0] in labels]
    assert sum(q == a for q, a in known) / len(known) > 0.95

    group = components([(r[0], r[1]) for r in rows[1]], 5, 80)
    assert sorted(r[0] for r in rows[2]) == sorted(d for d in group if group[d] == d)

    items = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").select("item_id", "text").collect()]
    bad = {d for d, *_, contaminated in contamination([(r[0], r[1]) for r in rows[2]], items) if contaminated}
    assert sorted(r[0] for r in rows[3]) == sorted(r[0] for r in rows[2] if r[0] not in bad)

    sizes, taken = Counter(), Counter()
    source = docs.schema.names.index("source")
    for r in rows[3]:
        sizes[r[source]] += len(r[1].split())
    for r in rows[4]:
        taken[r[source]] += len(r[1].split())
    longest = max(len(r[1].split()) for r in rows[3])
    target = water_level(sizes)
    assert all(abs(taken[s] - target[s]) <= 2 * longest for s in sizes)
    assert max(Counter(rows[4]).values()) <= 2

    library = Tokenizer.from_str(tokenizer_json())
    want, start = [], 0
    for r in sorted(rows[4], key=lambda r: r[0]):
        ids = library.encode(r[1] or "", add_special_tokens=False).ids + [0]
        want.append((r[0], start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(rows[5]) == want


def test_threshold_is_the_operators(spark):
    assert op1_quality.THRESHOLD == 0.7 and [n for n, _ in corpus_pipeline.STAGES][1] == "near_duplicates"
    assert corpus_pipeline.ORACLE_SQL is None


def test_stages_keep_columns_of_any_name(spark, odd):
    helpers = "quality kept row c0 its_row copies n_words n_hit contaminated hit_spans __row __quality".split()
    docs = odd.withColumns({c: F.lit(f"own {c}") for c in helpers})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, FOLDER)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes, name
        assert all(r[c] == f"own {c}" for r in out.collect() for c in helpers), name
