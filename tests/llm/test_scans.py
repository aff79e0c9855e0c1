"""Periodic runs, license scans and the divergence audit against brute force, and odd input."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from subspan.llm import op11_runs, op12_licenses, op13_divergence
from subspan.llm.queries import QUERIES
from tests.llm.conftest import DOCUMENTS, document, prose

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# --- 11 -------------------------------------------------------------------------------------
def stretches(words, least=op11_runs.LEAST):
    """Start, length and smallest period of every run, by trying each period."""
    found, n = {}, len(words)
    for q in range(1, n // 2 + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)  # periods ascend
            i = j + 1
    return sorted((s, length, q) for (s, length), q in found.items())


def collapsed(words, found):
    gone = {i for s, length, q in found for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def sequences():
    rng = random.Random(5)
    yield from ([], ["a"], ["a"] * 11, ["a"] * 12, ["a"] * 400, list("ab" * 6), list("ab" * 5), list("abcdef" * 2), list("abcdef" * 2 + "a"), list("abcde" * 2))
    for k in range(150):
        alphabet = "abcdef"[: rng.randint(1, 6)]
        words = [rng.choice(alphabet) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):  # stretches that repeat, some of them broken or nested
            piece = [rng.choice(alphabet) for _ in range(rng.randint(1, 12))]
            at = rng.randint(0, len(words))
            words[at:at] = (piece * rng.randint(2, 9))[: rng.randint(1, 80)] * rng.randint(1, 3)
        yield words
    line = [f"w{k}" for k in range(30)]
    yield line * 7 + ["x"] + line * 3
    yield [w for k in range(60) for w in (f"only{k}", *line[:7])]  # many words to the left of one line


def test_runs_are_those_of_brute_force():
    for words in sequences():
        numbers, _ = op11_runs._numbered([[w.encode() for w in words]])
        assert op11_runs.runs(numbers) == stretches(words), words


@pytest.mark.parametrize("least", [2, 5, 7])
def test_runs_of_other_lengths(least):
    for words in list(sequences())[:60]:
        numbers, _ = op11_runs._numbered([[w.encode() for w in words]])
        assert op11_runs.runs(numbers, None, least) == stretches(words, least), words


def test_a_long_repetition_takes_few_steps():
    period = np.arange(3)
    assert op11_runs.runs(np.tile(period, 70_000)) == [(0, 210_000, 3)]
    assert op11_runs.runs(np.zeros(100_000, dtype=np.int64)) == [(0, 100_000, 1)]


def test_runs_of_documents(spark, odd, odd_rows, no_docs):
    rows = [(k, " ".join(w), "en", "a") for k, w in enumerate(sequences())] + [(None, "x " * 20, None, None), (3, "  a b \n" * 14, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    want = []
    for doc, text, *_ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        found = stretches(words)
        want.append((doc, tuple(found), collapsed(words, found)))
    got = [(r["doc_id"], tuple(tuple(x) for x in r["runs"]), r["collapsed"]) for r in op11_runs.periodic_runs(docs).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    got = op11_runs.periodic_runs(odd).collect()
    assert len(got) == len(odd_rows) and all(not r["runs"] and r["collapsed"] == " ".join((r0[1] or "").split()) for r in got for r0 in odd_rows if r0[1] is None and r0[0] == r["doc_id"])
    assert op11_runs.periodic_runs(no_docs).count() == 0


def test_query_plants_and_digests(spark):
    import hashlib
    import zlib

    folder, want = "/root/testdata/sf0.001", {}
    for r in spark.read.parquet(f"{folder}/documents.parquet").collect():
        words = re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")
        h, n = zlib.crc32(str(r["doc_id"]).encode()), len(words)
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = stretches(words)
        start, length, period = min(found, key=lambda x: (-x[1], x[0], x[2]), default=(None, None, None))
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda x: (x[0], x[2])))
        digests = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapsed(words, found))]
        want[r["doc_id"]] = (len(found), start, length, period, None if start is None else 1000 * length // period, *digests)
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op11_periodic_runs"](spark, folder).collect()}
    assert got == want and sum(x[0] > 0 for x in want.values()) > 10


# --- 12 -------------------------------------------------------------------------------------
def licensed(text, templates, stride=op12_licenses.STRIDE):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))
    places, base, labels, score = [], set(), set(), 0.0
    for t in templates:
        words = t.words()
        if t.phrase:
            at = [i for i in range(len(w) - len(words) + 1) if w[i : i + len(words)] == words]
            places += at
            if at:
                base.add(t.label)
                labels.add(t.label)
                score = 1.0
            continue
        for b in range(0, len(w), stride):
            share = len(set(words) & set(w[b : b + 2 * stride])) / len(set(words))
            if 100 * share >= t.percent:
                labels.add(t.label)
                score = max(score, share)
    return len(w), len(places), min(places, default=None), max(places, default=None), sorted(base), sorted(labels), pytest.approx(score)


TEMPLATES = op12_licenses.PHRASES + op12_licenses.NOTICES
NOTICE = op12_licenses.NOTICES[5].text


def licensed_rows():
    rng, rows = random.Random(3), []
    for k in range(60):
        words = prose(k, rng.randint(0, 400)).split()
        for _ in range(rng.randint(0, 4)):
            t = rng.choice(TEMPLATES).text.split()
            for _ in range(rng.randint(0, 6)):  # some words lost or replaced, so that the shares lie around the threshold
                t[rng.randrange(len(t))] = rng.choice(["", "of", "GNU", "mit"])
            at = rng.randint(0, len(words))
            words[at:at] = t
        rows.append(document(k, rng.choice([" ", "  \n", ", "]).join(words)))
    rows.append(document(100, "MIT-License mit license MIT license cc by cc by cc, by; Apache (license) " * 40))
    rows.append(document(101, "GNU General Kublic License gnu general public license"))
    rows.append(document(102, " ".join(["x"] * 62 + ["gnu", "general", "public", "license"] + ["y"] * 59 + ["apache", "license"])))
    rows.append(document(102, NOTICE * 2))
    rows.append(document(None, NOTICE))
    return rows


def test_licenses_are_those_of_brute_force(spark, odd, odd_rows, no_docs):
    for rows, docs in ((licensed_rows(), None), (odd_rows, odd)):
        docs = spark.createDataFrame(rows, DOCUMENTS).repartition(3) if docs is None else docs
        got = [tuple(r) for r in op12_licenses.licenses(docs).collect()]
        want = [(r[0], *licensed(r[1], TEMPLATES)) for r in rows]
        key = lambda r: str(r[:4])
        assert len(got) == len(want) and all(a == b for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True))
    assert op12_licenses.licenses(no_docs).count() == 0


def test_templates_are_a_parameter(spark):
    docs = spark.createDataFrame([document(1, "one two three four"), document(2, "two one")], DOCUMENTS)
    own = (op12_licenses.Template("ab", "one two", True), op12_licenses.Template("half", "two nine", percent=50), op12_licenses.Template("empty", "..."))
    got = {r["doc_id"]: (r["n_base"], r["labels"], r["score"]) for r in op12_licenses.licenses(docs, own).collect()}
    assert got == {1: (1, ["ab", "half"], 1.0), 2: (0, ["half"], 0.5)}
    assert [r["labels"] for r in op12_licenses.licenses(docs, ()).collect()] == [[], []]
    with pytest.raises(ValueError):
        op12_licenses.licenses(docs, own, stride=1)


def test_license_scan_has_no_python_workers(spark):
    docs = spark.createDataFrame(licensed_rows(), DOCUMENTS)
    plan = op12_licenses.licenses(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


# --- 13 -------------------------------------------------------------------------------------
def divergence(rows, least, ranks):
    docs = [tuple(x or "" for x in r) for r in rows]  # text, lang, source
    split = [re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t.translate(LOWER)) for t, _, _ in docs]
    out = []
    for lang in {x[1] for x in docs}:
        holding = Counter(w for (_, x, _), words in zip(docs, split, strict=True) if x == lang for w in set(words))
        kept = sorted((w for w, n in holding.items() if n >= least), key=lambda w: w.encode())
        counts = defaultdict(Counter)
        for (_, x, source), words in zip(docs, split, strict=True):
            if x == lang:
                counts[source].update(w for w in words if holding[w] >= least)
        whole = sum(counts.values(), Counter())

        def share(c, kept=kept):
            return {w: 1 + 10**9 * (c[w] + 5) // (sum(c.values()) + 5 * len(kept)) for w in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            other = [(sum(abs(p[s][w] - p[o][w]) for w in kept), o) for o in counts if o != s]
            terms = [(p[s][w] - q[w], w) for w in kept if counts[s][w] and p[s][w] > q[w]]
            for part, found in (("pair", other), ("term", terms)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                out += [(lang, s, part, item, value, k) for k, (value, item) in enumerate(found, 1) if part == "pair" or k <= ranks]
    return sorted(out)


def divergent_rows():
    rng = random.Random(9)
    rows = [(" ".join(rng.choice(("alpha Beta", "GAMMA", "délta", "x_y", "日本", "Z")) + str(k) for _ in range(rng.randint(0, 40))), *key)
            for k in range(40) for key in (("en", "a"), ("en", "b"), ("en", None), (None, "a"), ("de", "\U0001f600"), ("de", "￿"))[: 3 + k % 4]]
    return rows + [(None, "fr", "only"), ("", "fr", "two"), ("%% 12", "en", "no terms"), ("alpha " * 3000, "en", "a")]


@pytest.mark.parametrize(("at_once", "held"), [(op13_divergence.AT_ONCE, op13_divergence.HELD), (2, 3)])
def test_divergence_is_that_of_brute_force(spark, monkeypatch, at_once, held):
    monkeypatch.setattr(op13_divergence, "HELD", held)
    rows = divergent_rows()
    docs = spark.createDataFrame([(t, x, s, 1, "t") for t, x, s in rows], "text string, lang string, source string, n int, term string").repartition(3)
    got = op13_divergence.audit(docs, least=6, ranks=4, at_once=at_once).select("lang", "source", "part", "item", "value", "rank")
    assert sorted(tuple(r) for r in got.collect()) == divergence(rows, 6, 4)


def test_divergence_of_odd_input(odd, odd_rows, no_docs):
    got = op13_divergence.audit(odd, least=2, ranks=50).select("lang", "source", "part", "item", "value", "rank").collect()
    assert sorted(tuple(r) for r in got) == divergence([(r[1], r[2], r[3]) for r in odd_rows], 2, 50)
    assert op13_divergence.audit(no_docs).count() == 0


def test_shares_are_exact():
    rng = random.Random(1)
    for _ in range(300):
        divisor = rng.randint(1, 9 * 10**15)
        n = rng.randint(0, divisor - 1)
        assert op13_divergence.shares(np.array([n]), np.array([divisor]))[0] == 1 + 10**9 * (n + 5) // divisor


def test_translate_table_is_the_pattern():
    text = bytes(range(256))
    want = re.findall(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in text))
    assert text.translate(op13_divergence.TABLE).split() == want
