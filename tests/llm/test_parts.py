"""Words, token ids and the entropy coder, without Spark."""

import re

import numpy as np
import pyarrow.parquet as pq
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from subspan.llm import rans
from subspan.llm.tokens import Encoder, tokenizer_json
from subspan.llm.words import ALPHANUMERIC, NOT_SPACE, slices, span_hashes, window_hashes, words

TEXT = st.text(alphabet=st.sampled_from(list("aAbB09 \t\n.,-_é日\x00\x7f")), max_size=40)
PATTERNS = ((NOT_SPACE, r"[^\x20\x09-\x0D]+"), (ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"))


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.none() | TEXT, max_size=6))
def test_words_are_those_of_the_pattern(texts):
    for in_word, pattern in PATTERNS:
        w = words(pa.array(texts, pa.string()), in_word)
        own = [re.findall(pattern, lowered(t)) for t in texts]
        got = [[w.text(i, i + 1).decode() for i in range(w.first[r], w.first[r + 1])] for r in range(len(texts))]
        assert got == own
        by_hash = dict(zip(span_hashes(w.data, w.starts, w.ends).tolist(), [x for r in own for x in r], strict=True))
        assert len(by_hash) == len({x for r in own for x in r})


def test_hashes_do_not_depend_on_where_a_word_stands():
    texts = ["x " * 700_000 + "tail word", "tail word", None, "word"]  # longer than a slice
    w = words(pa.array(texts), NOT_SPACE)
    h = span_hashes(w.data, w.starts, w.ends)
    assert h[w.first[1] - 2] == h[w.first[1]] and h[w.first[1] - 1] == h[w.first[1] + 1] == h[-1]
    at, pairs = window_hashes(h, w.rows, 2)
    assert pairs[-1] == pairs[at.tolist().index(int(w.first[1]) - 2)]  # and no window crosses two rows
    assert len(at) == sum(max(0, n - 1) for n in np.diff(w.first))


def test_slices_keep_rows_and_order():
    batch = pa.RecordBatch.from_pydict({"n": list(range(9)), "text": ["a" * k for k in (0, 5, 100, 0, 3, 3, 3, 50, 1)]})
    pieces = list(slices(iter([batch]), "text", 10))
    assert [x for p in pieces for x in p.column("n").to_pylist()] == list(range(9))
    assert max(p.num_rows for p in pieces) < 9 and all(p.num_rows for p in pieces)


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 60_000), max_size=300), st.integers(1, 3))
def test_coder_round_trip(some, repeats):
    ids = np.array(some * repeats, dtype=np.uint16)
    table = rans.frequencies(ids)
    assert not len(ids) or table[1].sum() == 1 << rans.SCALE
    assert np.array_equal(rans.decode(rans.encode(ids, *table), *table), ids)


def test_blocks_decode_alone_and_checksums_catch_changes():
    ids = np.minimum(np.random.default_rng(0).zipf(1.3, 3 * rans.BLOCK + 77), 50_000).astype(np.uint16)
    table = rans.frequencies(ids)
    blocks = rans.encode(ids, *table)
    assert len(blocks) == 4
    for k, b in enumerate(blocks):
        assert np.array_equal(rans.decode([b], *table), ids[k * rans.BLOCK : (k + 1) * rans.BLOCK])
    changed = bytearray(blocks[1].words)
    changed[100] ^= 1
    with pytest.raises(ValueError):
        rans.decode([blocks[1]._replace(words=bytes(changed))], *table)


@pytest.fixture(scope="module")
def coder():
    return Encoder(tokenizer_json(), special=True)


@pytest.fixture(scope="module")
def library():
    """The library's tokenizer as it comes."""
    return Tokenizer.from_str(tokenizer_json())


def same_ids(coder, library, texts):
    for t, raw in zip(texts, coder.encode(texts), strict=True):
        assert np.frombuffer(raw, coder.dtype).tolist() == library.encode(t or "", add_special_tokens=False).ids, t


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.none() | st.text(alphabet=st.sampled_from(list("abZ .,!'\t\n\x00é日12<|>\u00a0\u2003\u0120")), max_size=30), max_size=5))
def test_ids_are_those_of_the_library(coder, library, texts):
    same_ids(coder, library, texts)


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(max_size=60), max_size=8), parts=st.lists(st.sampled_from(["<|endoftext|>", " ", "word", "\n", "'s", "9"]), max_size=8))
def test_ids_of_any_characters_and_special_strings(coder, library, texts, parts):
    same_ids(coder, library, [*texts, "".join(parts), " ".join([*texts, *parts])])


def test_ids_of_the_table_are_those_of_the_library(coder, library):
    texts = pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).column("text").to_pylist()
    same_ids(coder, library, texts)


def test_special_strings_are_text_where_asked_for_and_long_pieces_are_forgotten(library):
    texts = ["a <|endoftext|> b", "x" * 500, "don't, won't.  two  spaces \n"]
    coder = Encoder(tokenizer_json())
    library = Tokenizer.from_str(tokenizer_json())
    library.encode_special_tokens = True
    same_ids(coder, library, texts)
    assert 50256 not in np.frombuffer(coder.encode(texts)[0], coder.dtype) and 50256 in np.frombuffer(Encoder(tokenizer_json(), special=True).encode(texts)[0], coder.dtype)
    assert max(map(len, coder.memo)) <= 64


def test_lines_and_marks_are_no_new_pieces(library, monkeypatch):
    """A known word is not encoded anew for the marks after it or the line feed beside it."""
    coder, asked = Encoder(tokenizer_json()), []
    learn = coder._encode_pieces
    monkeypatch.setattr(coder, "_encode_pieces", lambda pieces: (asked.extend(pieces), learn(pieces)))
    same_ids(coder, library, ["a tulip b", "tulip", "\n", "?! ,"])
    asked.clear()
    same_ids(coder, library, ["a tulip,", "b tulip?!\ntulip b\n", "tulip b?!\nb", None, "", "\n"])
    assert not [p for p in asked if "tulip" in p or ("\n" in p)], asked


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(st.text(alphabet=st.sampled_from(list("ab \n.,;:!?#$%&*'-9éÖ\u0301")), max_size=40), max_size=5))
def test_ids_of_words_between_marks_and_line_feeds(coder, library, texts):
    same_ids(coder, library, texts)
