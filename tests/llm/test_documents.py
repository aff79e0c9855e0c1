"""Near duplicates, decontamination and mixing against brute force, and odd input."""

import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from subspan.llm import op3_minhash, op4_mix, op5_decontaminate
from tests.llm.conftest import DOCUMENTS, document, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 3 --------------------------------------------------------------------------------------
def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def components(rows, size, percent):
    """doc_id -> smallest id reachable; rows of one id are one document."""
    sets = [(d, shingles(t, size)) for d, t in rows if d is not None]
    near = defaultdict(set)
    for a, x in sets:
        for b, y in sets:
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                near[a].add(b)
    out = {}
    for d, _ in sets:
        seen, todo = {d}, [d]
        while todo:
            for b in near[todo.pop()] - seen:
                seen.add(b)
                todo.append(b)
        out[d] = min(seen)
    return out


def edited(text, places):
    w = text.split()
    for k in places:
        w[k % len(w)] = f"edit{k}"
    return " ".join(w)


@pytest.mark.parametrize(("size", "percent"), [(3, 85), (5, 80)])
def test_components_are_those_of_brute_force(spark, size, percent):
    base, other = prose(10, 200), prose(11, 200)
    rows = [(100 + k, edited(base, range(0, 29 * (k % 6), 29))) for k in range(30)]  # a family around a base
    rows += [(300 + k, edited(base, [3 * k, 3 * k + 90, 150 + k, 40 + k, 180 - k])) for k in range(15)]  # not linked with each other
    rows += [(200 + k, other + f" tail{k // 2}") for k in range(8)] + [(250 + k, base) for k in range(9)]
    rows += [(400 + k, prose(50 + k, 40) + " " + prose(12, 60)) for k in range(20)]  # a passage that many share
    rows += [(500, "one two"), (501, "ONE two"), (502, "two one"), (503, ""), (504, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = op3_minhash.near_duplicates(docs, size=size, percent=percent).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == components(rows, size, percent)
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {d: len(shingles(t, size)) for d, t in rows}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_duplicates_of_odd_input(odd, odd_rows, no_docs):
    got = op3_minhash.near_duplicates(odd).collect()
    assert len(got) == len(odd_rows)
    want = components([(r[0], r[1]) for r in odd_rows], 5, 80)
    assert all(r["component_id"] == want.get(r["doc_id"]) for r in got)
    assert [(r["component_id"], r["kept"]) for r in got if r["doc_id"] is None] == [(None, False)]
    assert want[9] == 8  # one of its rows is a copy
    assert op3_minhash.near_duplicates(no_docs).count() == 0


def test_an_id_with_texts_of_different_sizes_is_linked_by_each(spark):
    rows = []
    for k in range(0, 40, 10):
        short, long = prose(60 + k, 100), prose(61 + k, 1000)
        rows += [(k + 5, short), (k + 5, long), (k + 8, edited(short, [50])), (k + 9, edited(long, [300, 700])), (k + 7, prose(62 + k, 100))]
    for part in (rows, rows[::-1]):
        docs = spark.createDataFrame(part, "doc_id long, text string").repartition(3)
        got = op3_minhash.near_duplicates(docs).collect()
        assert {r["doc_id"]: r["component_id"] for r in got} == components(rows, 5, 80)
        assert sorted((r["doc_id"], r["n_shingles"]) for r in got) == sorted((d, len(shingles(t, 5))) for d, t in rows)


def test_linked_pairs_miss_the_threshold_rarely():
    for percent in (80, 85):
        t = op3_minhash.match_threshold(op3_minhash.COORDINATES, percent)
        assert 0.5 * op3_minhash.COORDINATES < t < percent / 100 * op3_minhash.COORDINATES


# --- 5 --------------------------------------------------------------------------------------
def contamination(docs, items, size=13):
    def split(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    out = []
    for d, t in docs:
        w, hit, names = split(t), set(), set()
        for name, text in items:
            x = split(text)
            n = min(size, len(x))
            for i in range(len(x) - n + 1 if x else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == x[i : i + n]:
                        hit |= set(range(j, j + n))
                        names |= {str(name)} if name is not None else set()
        out.append((d, len(w), len(hit), tuple(sorted(names)), bool(hit) and 20 * len(hit) >= len(w)))
    return out


ITEMS = [
    (1, prose(20, 40)),
    (2, "Three Short-Words"),
    (3, None),
    (4, ""),
    (1, prose(20, 40)),
    (10, prose(20, 25)),
    (None, "nameless item"),
    (5, "!!! ..."),
    (6, "é日本"),
]


@pytest.mark.parametrize("block_bytes", [op5_decontaminate.BLOCK_BYTES, 4000])
def test_hits_are_those_of_brute_force(spark, odd_rows, block_bytes):
    x = prose(20, 40).split()
    docs = [(r[0], r[1]) for r in odd_rows if r[1] is None or len(r[1]) < 50_000]
    docs += [(50, prose(21, 30) + " " + " ".join(x[5:25]).upper() + ". " + prose(22, 500)), (51, " ".join(x[:12])), (52, ", ".join(x))]
    docs += [(53, "three, short  words " * 3), (54, "a nameless item é日本"), (55, " ".join(x[:13] + x[1:14]))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = op5_decontaminate.judged(op5_decontaminate.scan(frame, benchmark, block_bytes=block_bytes)).collect()
    got = [(r["doc_id"], r["n_words"], r["n_hit"], tuple(r["hit_items"] or ()), r["contaminated"]) for r in got]
    key = lambda r: str(r)
    assert sorted(got, key=key) == sorted(contamination(docs, ITEMS), key=key)


def test_removal_keeps_clean_documents_and_cuts_spans(spark, odd, odd_rows):
    benchmark = spark.createDataFrame([(1, odd_rows[7][1]), (2, "no such words here")], "item_id long, text string")
    helpers = "n_words n_hit contaminated hit_spans hit_items its_row its_copy its_id its_null its_hash copies c0 c1 text_hash row".split()
    named = odd.withColumns({c: F.lit(f"own {c}") for c in helpers})
    for rows in (op5_decontaminate.remove_documents(named, benchmark), op4_mix.mixed(named)):
        assert rows.columns == named.columns and rows.count() and rows.dtypes == named.dtypes
        assert all(r[c] == f"own {c}" for r in rows.collect() for c in helpers)
    kept = op5_decontaminate.remove_documents(odd, benchmark)
    assert kept.columns == odd.columns
    gone = Counter(map(str, odd.collect())) - Counter(map(str, kept.collect()))
    assert sum(gone.values()) == 3  # both rows of 8 and the copy under 9
    cut = {r["text"] for r in op5_decontaminate.remove_spans(odd, benchmark).where("doc_id = 8").collect()}
    assert cut == {""}
    x = spark.createDataFrame([(1, "Before. NO such, words here! After")], "doc_id long, text string")
    assert op5_decontaminate.remove_spans(x, benchmark).first()["text"] == "Before. ! After"


def test_empty_tables_have_no_contamination(spark, odd, no_docs):
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert op5_decontaminate.remove_documents(odd, nothing).count() == odd.count()
    assert op5_decontaminate.remove_documents(no_docs, nothing).count() == 0
    with pytest.raises(ValueError):
        op5_decontaminate.scan(odd.withColumn("hit_items", F.lit(1)), nothing)


# --- 4 --------------------------------------------------------------------------------------
def water_level(sizes, budget=1.5, repeats=2, weights=(3, 1, 2)):
    """The contract's rule, step by step: cap, reshare, again."""
    names = sorted(sizes, key=lambda s: (s is None, s.encode() if s is not None else b""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    rest, open_, target = budget * sum(sizes.values()), set(names), {}
    while open_:
        share = rest / sum(weight[s] for s in open_)
        over = {s for s in open_ if share * weight[s] > repeats * sizes[s]}
        if not over:
            return target | {s: share * weight[s] for s in open_}
        target |= {s: repeats * sizes[s] for s in over}
        rest -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mix_meets_its_targets(spark):
    rows = [document(k, prose(k, 5 + k % 37), source=("b", "a", None, "ä", "Z")[min(k % 9, 4)]) for k in range(600)]
    docs = spark.createDataFrame(rows, DOCUMENTS).repartition(4)
    got = op4_mix.taken(docs).collect()
    by_id = {r[0]: r for r in rows}
    sizes, taken = Counter(), Counter()
    for r in got:
        sizes[by_id[r["doc_id"]][3]] += r["size"]
        taken[by_id[r["doc_id"]][3]] += r["taken"]
        assert r["size"] == len(by_id[r["doc_id"]][1].split()) and r["taken"] in (0, r["size"], 2 * r["size"])
    want = water_level(sizes)
    for r in got:
        source = by_id[r["doc_id"]][3]
        assert r["source_size"] == sizes[source] and r["target"] == pytest.approx(want[source])
        assert abs(taken[source] - want[source]) <= 42  # a document or so
    assert sum(taken.values()) <= 1.5 * sum(sizes.values()) < sum(taken.values()) + 42
    again = op4_mix.taken(docs.repartition(7)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    copies = Counter(r["doc_id"] for r in op4_mix.mixed(docs).collect())
    assert copies == Counter({r["doc_id"]: r["taken"] // r["size"] for r in got if r["taken"]})


def test_mix_of_odd_input(spark, odd, odd_rows, no_docs):
    got = op4_mix.taken(odd).collect()
    assert len(got) == len(odd_rows) and all(r["taken"] == 0 for r in got if not r["size"])
    assert sum(r["taken"] for r in got) <= 1.5 * sum(r["size"] for r in got)
    mixed = op4_mix.mixed(odd)
    assert mixed.columns == odd.columns and {str(r) for r in mixed.collect()} <= {str(r) for r in odd.collect()}
    assert sum(len(r["text"].split()) for r in mixed.collect()) == sum(r["taken"] for r in got)
    assert op4_mix.taken(no_docs).count() == 0 and op4_mix.mixed(no_docs).count() == 0
    assert [r["taken"] for r in op4_mix.taken(odd.where("doc_id < 4")).collect()] == [0, 0, 0]
