"""The trained operators: gradients, held-out accuracy, odd input."""

import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from subspan.llm import op1_quality, op2_toxicity, op7_language
from subspan.llm.learning import fold, sample
from subspan.llm.queries import QUERIES
from subspan.llm.words import mix, span_hashes
from tests.llm.conftest import prose

FOLDER = "/root/testdata/sf0.01"


def check_gradients(params, gradients, loss):
    for name, g in gradients.items():
        at = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        kept, step = params[name][at], 1e-4
        params[name][at] = kept + step
        up = loss()
        params[name][at] = kept - step
        down = loss()
        params[name][at] = kept
        assert g[at] == pytest.approx((up - down) / (2 * step), rel=2e-2, abs=1e-5), name


def test_gradients_of_the_bags():
    net, x, starts, labels = op1_quality.Bags(1), np.random.default_rng(0).standard_normal((9, op1_quality.FEATURES)), np.array([0, 4, 5]), np.array([1.0, 0, 1])

    def loss():
        odds, _ = net.forward(x, starts)
        return float((np.log1p(np.exp(odds)) - labels * odds).sum())

    check_gradients(net.p, net.gradients(x, starts, labels, np.ones(3)), loss)


def test_gradients_of_the_recurrent_network():
    net = op2_toxicity.Network(1)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    texts = ["a bb ccc dddd eee ff " * 3, "x yy", "loser zz"]
    x = op2_toxicity.Inputs(op2_toxicity.words(pa.array(texts), op2_toxicity.ALPHANUMERIC))
    every = np.arange(len(x.rows))
    labels = np.array([1.0, 0, 1])[x.rows]

    def loss():
        odds, _ = net.forward(net.embedded(x.word, x.grams, x.gram_starts), *x.tokens(every))
        return float((np.log1p(np.exp(odds)) - labels * odds).sum())

    check_gradients(net.p, net.gradients(x, every, labels, np.ones(len(every))), loss)


def test_windows_overlap_and_cover_the_text():
    for n in (1, 8, 15, 16, 17, 24, 25, 100):
        x = op2_toxicity.Inputs(op2_toxicity.words(pa.array([" ".join(f"w{k}" for k in range(n))]), op2_toxicity.ALPHANUMERIC))
        covered = {int(s) + k for s, length in zip(x.starts, x.lengths, strict=True) for k in range(length)}
        assert covered == set(range(n)) and all(b - a == op2_toxicity.STRIDE for a, b in zip(x.starts, x.starts[1:], strict=False))


@pytest.mark.parametrize(("name", "label", "parts", "held", "least"), [("op1_quality", "quality", 4, 2, 0.95), ("op2_toxicity", "toxic", 5, 0, 0.9)])
def test_held_out_accuracy(spark, name, label, parts, held, least):
    got = {r["doc_id"]: r for r in QUERIES[name](spark, FOLDER).collect()}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % parts == held) for d, r in got.items())
    assert all(0 <= r["score"] <= 1 for r in got.values()) and len(got) == 1000
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{FOLDER}/labels.parquet").collect()}
    right = [got[d]["predicted"] == y for d, y in labels.items() if got[d]["held_out"]]
    assert len(right) > 50 and sum(right) / len(right) >= least


def test_held_out_languages(spark):
    got = QUERIES["op7_language_id"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang", "text"), "doc_id")
    rows = got.where("held_out and lang is not null").collect()
    assert sum(r["lang_pred"] == r["lang"] for r in rows) / len(rows) > 0.97
    assert all(0 <= r["score"] <= 1 for r in rows)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(4, 1, 0), (5, 0, 1), (5, 1, 0), (8, 1, None), (None, 1, 1), (99, 0, 1)], "doc_id long, quality int, toxic int")


def test_sample_is_bounded_and_takes_the_larger_label(odd, labels):
    texts, y = sample(odd, labels, "quality", 10, 10_000)
    assert {"one", "One"} < set(texts) and len(texts) == 3 and y.tolist() == [1, 1, 1]  # the repeated row of 8 once; 5 has label 1, too
    assert max(map(len, texts)) > 300  # whole texts
    assert sorted(sample(odd, labels, "quality", 10, 12)[0]) == ["One", "one"]  # what fits
    assert len(sample(odd, labels, "quality", 1, 10_000)[0]) <= 2


def test_labels_are_learned_from_behind_a_long_beginning(spark):
    """What makes the label stands behind 20,000 characters that say nothing."""
    common = [prose(1000 + k, 3000) for k in range(24)]
    assert min(map(len, common)) > 20_000
    toxic, plain = "you worthless stinking maggot ", "you wonderful sparkling meadow "
    rows = [(k, common[k] + " " + (toxic if k % 2 else plain) * 4, k % 2, 1 - k % 2) for k in range(24)]
    docs = spark.createDataFrame([(k, t) for k, t, *_ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, a, b) for k, _, a, b in rows], "doc_id long, toxic int, quality int")
    texts, y = sample(docs, labels, "toxic", 100, 12 << 20)
    assert len(texts) == 24 and all(t.rstrip().endswith(("maggot", "meadow")) for t in texts)
    net = op2_toxicity.train(texts, y)
    found = net.documents(pa.array([prose(7, 3000) + " " + x * 4 for x in (toxic, plain)]))
    assert found[0] > 0.5 > found[1]


@pytest.mark.parametrize(("module", "label"), [(op1_quality, "quality"), (op2_toxicity, "toxic")])
def test_scores_of_odd_input(odd, no_docs, labels, module, label):
    texts = ["fine words in a fine row of words", "bad bad bad bad bad"] * 4
    for net in (module.train(texts, np.array([1.0, 0.0] * 4)), module.train([], np.zeros(0)), module.train(["x"], np.ones(1))):
        rows = module.scored(odd, net, name="p").collect()
        assert len(rows) == odd.count() and all(0 <= r["p"] <= 1 for r in rows)
        assert all(r["p"] == 0 for r in rows if not (r["text"] or "").strip())
        assert module.scored(no_docs, net, name="p").count() == 0
    same = {r["p"] for r in module.scored(odd, net, name="p").where("doc_id = 8").collect()}
    assert len(same) == 1
    with pytest.raises(ValueError):
        module.scored(odd, net, name="hash")


def test_languages_are_learned_behind_a_common_beginning(spark):
    header = "This page has the same words at its top in each of the languages. " * 12
    body = {"de": "der hund und die katze schlafen nicht ", "fr": "le chien avec une souris mange toujours "}
    rows = [(k, header + 40 * body[lang], lang) for k, lang in enumerate(["de", "fr"] * 5)] + [(99, "ab", "xx")]
    learned = op7_language.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert "katze schlafen" in learned["de"].decode() and "souris mange" in learned["fr"].decode()
    judge = op7_language.Compressors(learned)
    assert [judge.judge(body[lang])[0] for lang in ("de", "fr")] == ["de", "fr"] and judge.languages == ["de", "fr"]


def test_languages_of_odd_input(spark, odd, no_docs):
    rows = [(1, "der die das und nicht " * 20, "de"), (2, "the and of that with " * 20, "en"), (3, None, "fr"), (4, "x", None)]
    learned = op7_language.dictionaries(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert set(learned) == {"de", "en"}
    got = op7_language.predicted(odd.select("doc_id", "text", "hash"), learned).collect()
    assert {r["lang_pred"] for r in got if not (r["text"] or "").strip()} == {"und"}
    assert all(r["rejected"] and r["score"] == 0 for r in got if r["lang_pred"] == "und")
    assert op7_language.Compressors(learned).judge("½ 123 %%")[0] == "und"
    assert op7_language.Compressors(learned).judge("THE AND of that")[0] == "en"
    assert op7_language.predicted(no_docs, {}).count() == 0
    assert {r["lang_pred"] for r in op7_language.predicted(odd, {}).collect()} == {"und"}
    with pytest.raises(ValueError):
        op7_language.predicted(odd.withColumn("score", F.lit(1)), learned)


def test_folds(spark):
    got = spark.createDataFrame([(7,), (None,)], "doc_id long").select(fold("doc_id", 3, zlib.crc32(b"7") % 3).alias("f")).collect()
    assert [r["f"] for r in got] == [True, False]


# --- the same scores by loops over passages, windows and languages -----------------------------
def hash_of(word: bytes) -> int:
    return int(span_hashes(np.frombuffer(word, dtype=np.uint8), np.array([0]), np.array([len(word)]))[0])


TEXTS = [None, "", " \n", "One word", prose(3, 200), "Und, noch! 123 ÄÖ é日本 &&& " * 40, "same same same " * 50, prose(4, 64), prose(5, 65), "x" * 3000]


def slow_quality(net, text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
    if not words:
        return 0.0
    spans = [m.span() for m in re.finditer(rb"[^\x20\x09-\x0D]+", text.encode())]
    embedded, raw = [], []
    for i in range(0, len(words), op1_quality.PASSAGE):
        own, at = words[i : i + op1_quality.PASSAGE], spans[i : i + op1_quality.PASSAGE]
        whole = text.encode()[at[0][0] : at[-1][1]]
        shares = [0.0] * op1_quality._CLASSES
        for byte in whole:
            kind = next((k for k, group in enumerate(op1_quality._GROUPS) if byte in group), op1_quality._CLASSES - 1)
            shares[kind] += 1 / len(whole)
        lengths = [len(w) for w in own]
        mean = sum(lengths) / len(own)
        spread = (sum(n * n for n in lengths) / len(own) - mean**2) ** 0.5 if len(set(lengths)) > 1 else 0.0
        same = sum(a == b for a, b in zip(own, own[1:], strict=False)) / len(own)
        x = np.array([s**0.5 for s in shares] + [np.log1p(mean), np.log1p(spread), same, len(set(own)) / len(own), np.log(len(own))])
        e = np.tanh(((x - net.centre) / net.spread) @ net.p["w"] + net.p["b"])
        embedded.append(e)
        gate = 1 / (1 + np.exp(-(e @ net.p["g"])))
        raw.append(float((np.tanh(e @ net.p["t"]) * gate) @ net.p["a"]))
    weights = np.exp(np.array(raw) - max(raw))
    pooled = sum(w * e for w, e in zip(weights / weights.sum(), embedded, strict=True))
    odds = float(pooled @ net.p["o"] + net.p["c"][0])
    return 1 / (1 + np.exp(-(net.slope * odds + net.shift)))


def slow_toxicity(net, text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", bytes(b + 32 if 65 <= b <= 90 else b for b in (text or "").encode()))
    if not words:
        return 0.0
    h, e = op2_toxicity.HIDDEN, op2_toxicity.EMBEDDED

    def embedded(word):
        framed = b"\x01" + word + b"\x01"
        grams = [framed[i] | framed[i + 1] << 8 | framed[i + 2] << 16 for i in range(len(word))]
        for n in op2_toxicity.BEGINNINGS:
            if len(word) >= n:
                grams.append((int.from_bytes(word[:n], "little") + (n << 59 | n * 0x9E3779B97F4A7C1)) % 2**64)
        at = [int(mix(np.array([g], dtype=np.uint64))[0]) >> 40 for g in grams]
        mean = np.mean([net.p["gram"][k % op2_toxicity.GRAMS] for k in at], axis=0)
        return np.concatenate((net.p["word"][(hash_of(word) >> 40) % op2_toxicity.WORDS], mean))

    def sigma(x):
        return 1 / (1 + np.exp(-x))

    best = None
    for start in range(0, max(1, len(words) - op2_toxicity.LENGTH + op2_toxicity.STRIDE), op2_toxicity.STRIDE):
        inputs = [embedded(w) for w in words[start : start + op2_toxicity.LENGTH]]
        states = [np.zeros(0)] * len(inputs)
        for d in "fb":
            state, own = np.zeros(h), {}
            for t in range(len(inputs)) if d == "f" else reversed(range(len(inputs))):
                g, u = inputs[t] @ net.p[f"x{d}"] + net.p[f"c{d}"], state @ net.p[f"h{d}"] + net.p[f"d{d}"]
                r, z = sigma(g[:h] + u[:h]), sigma(g[h : 2 * h] + u[h : 2 * h])
                new = np.tanh(g[2 * h :] + r * u[2 * h :])
                state = (1 - z) * new + z * state
                own[t] = state
            states = [np.concatenate((s, own[t])) for t, s in enumerate(states)]
        scores = np.array([float(np.tanh(s @ net.p["a"] + net.p["k"]) @ net.p["v"]) for s in states])
        weights = np.exp(scores - scores.max())
        pooled = sum(w * s for w, s in zip(weights / weights.sum(), states, strict=True))
        odds = float(pooled @ net.p["o"] + net.p["b"][0])
        best = odds if best is None else max(best, odds)
    assert len(inputs[0]) == 2 * e
    return float(sigma(net.slope * best + net.shift))


@pytest.mark.parametrize(("module", "slow"), [(op1_quality, slow_quality), (op2_toxicity, slow_toxicity)])
def test_scores_are_those_of_brute_force(spark, module, slow):
    learned = [prose(100 + k, 90) for k in range(12)] + ["bad word " * 30 + prose(200 + k, 30) for k in range(12)]
    net = module.train(learned, np.array([1.0] * 12 + [0.0] * 12))
    docs = spark.createDataFrame(list(enumerate(TEXTS + learned[:3])), "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["p"] for r in module.scored(docs, net, name="p").collect()}
    for k, text in enumerate(TEXTS + learned[:3]):
        assert got[k] == pytest.approx(slow(net, text), rel=2e-3, abs=1e-4), k


def test_languages_are_those_of_brute_force(spark):
    import zstandard

    body = {"de": "der hund und die katze schlafen nicht ", "fr": "le chien avec une souris mange toujours ", "en": "the dog and the mouse never sleep "}
    learned = op7_language.dictionaries(spark.createDataFrame([(k, b * 20, lang) for k, (lang, b) in enumerate(body.items())], "doc_id long, text string, lang string"))
    texts = [*body.values(), "the hund avec " * 9, "", None, "12 34", "DER Hund!", "the dog " * 3000, "é"]
    rows = op7_language.predicted(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), learned).collect()
    for r in rows:
        words = " ".join("".join(c if c.isalpha() else " " for c in (texts[r["doc_id"]] or "").lower()).split())
        if not words:
            assert (r["lang_pred"], r["score"], r["rejected"]) == ("und", 0.0, True)
            continue
        sizes = {}
        for lang in sorted(learned):
            content = zstandard.ZstdCompressionDict(learned[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            own = zstandard.ZstdCompressor(level=op7_language.LEVEL, dict_data=content, write_checksum=False, write_content_size=False, write_dict_id=False)
            sizes[lang] = sum(len(own.compress(words[i : i + op7_language.PIECE].encode())) for i in range(0, len(words), op7_language.PIECE))
        least = sorted(sizes.values())
        assert sizes[r["lang_pred"]] == least[0] and r["margin"] == pytest.approx((least[1] - least[0]) / least[1])
        assert r["rejected"] == (r["margin"] < op7_language.MARGIN)
