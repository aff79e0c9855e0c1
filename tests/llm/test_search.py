"""Exact search, HTML extraction, token files."""

import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from subspan.llm import op6_extract, op8_topk, op9_token_counts, op10_token_output
from subspan.llm.tables import new_path
from subspan.llm.tokens import tokenizer_json


# --- 8 --------------------------------------------------------------------------------------
def best(rows, k=5, every=50):
    def whole(v):
        return [int(np.floor(256 * np.float64(x))) for x in v]

    usable = [(d, whole(v)) for d, v in rows if d is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q, own in ((d, v) for d, v in usable if d % every == 0):
        scores = [(-sum(a * b for a, b in zip(own, v, strict=False)), d) for d, v in usable if d != q]
        out += [(q, i + 1, d, -s) for i, (s, d) in enumerate(sorted(scores)[:k])]
    return sorted(out)


def searched(spark, rows, **options):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("x")).withColumn("pivot", F.lit(1))
    return sorted(tuple(r) for r in op8_topk.top_k(frame, F.pmod("id", F.lit(50)) == 0, **options).collect())


def test_search_is_exact(spark, monkeypatch):
    monkeypatch.setattr(op8_topk, "PIVOTS", 8)
    monkeypatch.setattr(op8_topk, "PER_PIVOT", 30)
    monkeypatch.setattr(op8_topk, "BLOCK", 16)
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((6, 12))
    rows = [(k, (centres[k % 6] + 0.3 * rng.standard_normal(12)).tolist()) for k in range(400)]
    rows += [(1000 + k, rows[50][1]) for k in range(60)]  # ties with a query, more than a block
    rows += [(2000, None), (2001, [1.0, None] + [0.0] * 10), (2002, [float("nan")] * 12), (2003, [float("inf")] + [0.0] * 11), (None, [1.0] * 12)]
    assert searched(spark, rows) == best(rows)


def test_search_of_odd_vectors(spark):
    few = [(0, [1.0, 2.0]), (1, [1.0]), (2, []), (50, [0.5, 0.5, 3.0]), (3, [1.0, 2.0])]
    padded = [(d, v + [0.0] * (3 - len(v))) for d, v in few]
    assert searched(spark, few) == best(padded)
    assert searched(spark, []) == [] and searched(spark, [(50, [1.0])]) == [] and searched(spark, [(50, None)]) == []
    twice = [(0, [1.0, 2.0]), (0, [-1.0, 5.0]), (0, [1.0, 2.0]), (1, [3.0, 1.0]), (2, [0.5, 4.0]), (50, [1.0, 1.0])]
    assert searched(spark, twice) == best(twice) and len(best(twice)) == 3 * 3 + 5
    large = [(0, [3e9, 1.0]), (1, [2e9, 1.0]), (2, [-2e9, 5.0])]
    limited = [(q, r, d, max(-(2**63), min(2**63 - 1, s))) for q, r, d, s in best(large)]
    assert searched(spark, large) == limited


# --- 6 --------------------------------------------------------------------------------------
PAGES = [
    (None, ""),
    ("", ""),
    ("plain text &amp; more", "plain text & more"),
    ("<html><body><nav><ul><li><a href='/x'>Menu</a></li></ul></nav><article><h1>Title</h1><p>A <b>b</b>c.<br>D</p><div class='ad'>buy</div><p>E&nbsp;&lt;p&gt;</p></article><footer>f</footer></body></html>", "Title\n\nA bc. D\n\nE <p>"),
    ("<script>var t='</p>';</script><style>p{}</style><p>" + "word " * 30 + "</p>", ("word " * 30).strip()),
    ("<div id='comments'><p>" + "rude " * 40 + "</p></div><div class=content><h2>H</h2><p>" + "good " * 40 + "</p></div>", "H\n\n" + ("good " * 40).strip()),
    ("<p>" + "x" * 90 + "<form><input><p>mail</p></form><p>" + "y" * 90, "x" * 90 + "\n\n" + "y" * 90),
    ("<aside>never closed <p>" + "z" * 100, "never closed\n\n" + "z" * 100),
    ("<main><p>Short.</p></main><p>" + "outside " * 40 + "</p>", "Short."),
    ("<p>tiny</p>", "tiny"),
    ("a < b <!-- <p>no</p> --> c", "a < b c"),
    ("<article><p>Broken &am", "Broken &am"),
]


def test_extraction(spark):
    for page, text in PAGES:
        assert op6_extract.extract(page) == text, page
    long = "<article>" + "".join(f"<p>{'w' * 50} {k}</p>" for k in range(20_000)) + "</article>"
    assert op6_extract.extract(long).count("\n\n") == 19_999
    rows = [(k, f"u{k}", page, 1) for k, (page, _) in enumerate(PAGES)] + [(None, None, "<p>x", 2), (0, "u0", None, 3)]
    got = op6_extract.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string, text long")).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    assert {r["page_id"]: r["text"] for r in got if r["page_id"]} == {k: t for k, (_, t) in enumerate(PAGES) if k}
    assert op6_extract.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_articles_are_a_weight():
    body = "".join(f"<p>{'body ' * 30}{k}</p>" for k in range(20))
    text = "\n\n".join("body " * 30 + str(k) for k in range(20))
    cards = "".join(f"<article><h3>Teaser {k}</h3><p>{'more ' * 12}</p></article>" for k in range(30))
    assert op6_extract.extract(f"<div>{body}</div>{cards}") == text
    comment = f"<article class='comment'><p>{'rude ' * 400}</p></article>"
    assert op6_extract.extract(f"<div>{body}</div>{comment * 3}") == text
    assert op6_extract.extract(f"<article>{body}{comment}</article>{comment}") == text
    assert op6_extract.extract(f"<article><p>{'long ' * 100}</p></article><article><p>short</p></article><p>{'aside ' * 9}</p>").endswith("\n\nshort")
    assert op6_extract.extract("<article class='widget'><p>All there is</p></article>") == "All there is"


def test_short_lines_and_links_near_a_surge_stay():
    long, links = "word " * 100, "<p><a href='/x'>link</a></p>" * 4
    page = f"<h1>{'t' * 20}</h1><p>{'a' * 30}</p><p>{'b' * 20}</p><p>{long}</p><p><a href='/y'>source</a></p><p>after</p>{links}<p>The end.</p>"
    lines = ["t" * 20, "a" * 30, "b" * 20, long.strip(), "source", "after", "The end."]
    assert op6_extract.extract(page) == "\n\n".join(lines)
    cards = "<article><p>card</p></article>" * 20
    assert op6_extract.extract(f"<p>{long}</p>{cards}<p>The end.</p>") == long.strip() + "\n\nThe end."
    assert op6_extract.extract(f"<p>Begin</p>{links}<p>{long}</p>{links * 5}<p>far</p>") == "Begin\n\n" + long.strip()
    assert op6_extract.extract(f"<p>{long}</p><nav><p>menu</p></nav><aside>x</aside><form>y</form><p>The end.</p>") == long.strip() + "\n\nThe end."


def test_wrappers_named_after_their_side_column_lose_nothing():
    article = f"<article><h1>Title</h1><p>{'word ' * 40}</p><p>{'more ' * 30}</p></article>"
    text = "\n\n".join(["Title", ("word " * 40).strip(), ("more " * 30).strip()])
    side, rude = f"<div class='sidebar'><p>{'side ' * 40}</p></div>", f"<div class='comments'><p>{'rude ' * 100}</p></div>"
    for page in (
        f"<div class='layout sidebar-right'>{article}{side}</div>",
        f"<div class='page has-sidebar'>{article}{rude}</div>",
        f"<div id=wrap class='header-fixed'>{article}</div>",
        f"<div class='comments-open'>{article}{rude}</div>",
        f"<form><div class='sidebar-left'>{side}</div>{article}<footer>x</footer></form>",
        f"<div class='widget'><div class='header-fixed'><form>{side}{article}</form></div></div>",
    ):
        assert op6_extract.extract(page) == text, page
    plain = "<p>" + "word " * 40 + "</p>"
    assert op6_extract.extract(f"<form>{plain}</form>") == ("word " * 40).strip()
    assert op6_extract.extract("<div class='cookie-notice'><p>We use cookies.</p></div><nav>menu</nav>") == ""
    assert op6_extract.extract(f"{plain}<form><p>{'mail ' * 40}</p></form>{rude}") == ("word " * 40).strip()


def test_extraction_is_linear():
    def seconds(n):
        page = "".join(f"<div class='ad'>x</div><section class='sidebar-on'><p>{'w' * 50} {k}\u0130</p></section><aside>never closed" for k in range(n))
        begin = time.process_time()
        op6_extract.extract(page)
        return time.process_time() - begin

    few, many = min(seconds(2000) for _ in range(3)), seconds(20_000)
    assert many < 30 * few


def slow_regions(sizes, elements, window, surge):
    """Line by line: sums of the windows that begin at each line; where they dive to 0, or an element stands, regions part."""
    out, begin, last = [], None, None
    for i in [*[k for k in range(len(sizes)) if sizes[k] and not elements[k]], None]:
        parted = i is None or last is None or any(elements[last:i]) or any(sum(sizes[j : j + window]) == 0 and j + window <= i for j in range(last + 1, i))
        if parted:
            if last is not None:
                own = sizes[begin : last + 1]
                out.append((begin, last + 1, any(sum(own[j : j + window]) >= surge for j in range(len(own)))))
            begin = i
        last = i
    return out


def test_regions_are_those_of_brute_force():
    rng = np.random.default_rng(2)
    for _ in range(300):
        n = int(rng.integers(1, 40))
        sizes = np.where(rng.random(n) < 0.5, 0, rng.integers(1, 60, n))
        elements = np.where(rng.random(n) < 0.15, 1, 0)
        window = int(rng.integers(1, 5))
        assert op6_extract._regions(sizes, elements, window, 86) == slow_regions(sizes.tolist(), elements.tolist(), window, 86)


# --- 9, 10 ----------------------------------------------------------------------------------
@pytest.fixture(scope="module")
def coder():
    return Tokenizer.from_str(tokenizer_json())


def ids_of(coder, text):
    return coder.encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("size", [op10_token_output.SEGMENT, 100])
def test_token_files_round_trip(spark, odd, odd_rows, coder, size):
    path = new_path(spark, "test-tokens")
    op10_token_output.write(odd.repartition(4), path, size=size)
    got = op10_token_output.read(spark, path).collect()
    digests = op10_token_output.read(spark, path, digest=True).collect()
    assert sorted((r["start"], r["n_tokens"], zlib.crc32(np.array(r["ids"], "<u4").tobytes())) for r in got) == sorted(
        (r["start"], r["n_tokens"], r["ids_crc32"]) for r in digests
    )
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == np.concatenate(([0], np.cumsum([r["n_tokens"] for r in got])[:-1])).tolist()
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda d: (d is not None, d or 0))
    want = sorted((r[0] or -1, ids_of(coder, r[1]) + [0]) for r in odd_rows)
    assert sorted((r["doc_id"] or -1, r["ids"]) for r in got) == want


def test_no_documents_make_an_empty_file(spark, no_docs):
    path = new_path(spark, "test-tokens")
    op10_token_output.write(no_docs, path)
    assert op10_token_output.read(spark, path).count() == 0


@pytest.mark.parametrize("block_bytes", [op9_token_counts.BLOCK_BYTES, 64, 2])
def test_counts_by_document(spark, odd, odd_rows, coder, block_bytes):
    small = odd.where("doc_id is null or doc_id < 6 or doc_id in (8, 9, 10, 11)").repartition(3)
    path = new_path(spark, "test-flat")
    end_id, id_bytes = op9_token_counts.write_flat(small, path, block_bytes=block_bytes)
    got = op9_token_counts.counts_by_document(spark, path, end_id, id_bytes, block_bytes).collect()
    want = [(r[0] or -1, len(ids_of(coder, r[1]))) for r in odd_rows if r[0] is None or r[0] < 6 or r[0] in (8, 9, 10, 11)]
    assert sorted((r["doc_id"] or -1, r["n_tokens"]) for r in got) == sorted(want) and all(r["ended"] for r in got)


def test_scan_of_binary_files(spark, tmp_path, no_docs):
    files = {"a.bin": [5, 9, 9, 1, 2, 3, 4, 9, 7], "b.bin": [9], "c.bin": [1, 2], "d.bin": []}
    for name, ids in files.items():
        (tmp_path / name).write_bytes(np.array(ids, "<u2").tobytes())
    for block in (1 << 20, 4):
        blocks = op9_token_counts.blocks_of(spark, str(tmp_path), block)
        got = op9_token_counts.scan(blocks, 9, 2, block).collect()
        rows = sorted((r["file"][-5], r["number"], r["start"], r["n_tokens"], r["ended"]) for r in got)
        assert rows == [("a", 0, 0, 1, True), ("a", 1, 2, 0, True), ("a", 2, 3, 4, True), ("a", 3, 8, 1, False), ("b", 0, 0, 0, True), ("c", 0, 0, 2, False)]
    path = new_path(spark, "test-flat")
    end_id, id_bytes = op9_token_counts.write_flat(no_docs, path)
    assert op9_token_counts.counts_by_document(spark, path, end_id, id_bytes).count() == 0
