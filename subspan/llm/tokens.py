"""Token ids of texts, from a tokenizer file of the ``tokenizers`` library."""

from __future__ import annotations

import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO_WORDS = 600_000  # pieces after which a Python worker begins a new memory; it keeps the one before: about 200 MB
_LONG = 64  # longer pieces are not remembered
_MARKS = ".,;:!?#$%&*"

_TWO_SPACES = re.compile(r"\s\s")
_ONE_SPACE = re.compile(r"(?<=\S) (?=\S)")
# One space, then anything without a space or white space at its end: in a row of such pieces each begins with a space.
_SPACED = re.compile(r" [^\s](?:[^ ]*\S)?")
_TOGETHER = 500  # of them are encoded as one text
_encoders: dict[tuple[str, bool], Encoder] = {}


def tokenizer_json(path: str | None = None) -> str:
    """The content of a tokenizer file; the public byte-level vocabulary where no path is given.

    The driver reads it and the tasks get the content, so executors need no such file.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoder(content: str, special: bool = False) -> Encoder:
    """The encoder of this Python worker, with what it remembers from earlier tasks."""
    if (content, special) not in _encoders:
        _encoders.clear()
        _encoders[content, special] = Encoder(content, special)
    return _encoders[content, special]


class Encoder:
    """Encodes texts without adding special tokens. With ``special`` their strings in a text are those tokens, as is the library's
    default; else they are ordinary text.

    A byte-level tokenizer that splits by its own pattern and normalises nothing never joins what stands on both sides of a
    space between two other characters: a token may begin with that space and doesn't cross it. So texts are
    cut there, the library encodes each distinct piece once and the pieces' ids are joined. New pieces are encoded many
    at a time as one text, whose ids are cut where a token begins with a space. Any other tokenizer gets whole texts.
    """

    def __init__(self, content: str, special: bool = False) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content)
        self.tokenizer.encode_special_tokens = not special
        self.size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        model = json.loads(content)
        split = model.get("pre_tokenizer") or {}
        self.by_piece = (
            split.get("type") == "ByteLevel"
            and not split.get("add_prefix_space")
            and split.get("use_regex", True)
            and not model.get("normalizer")
        )
        # Strings that are found before a text is split.
        self.added = [t["content"] for t in model.get("added_tokens") or ()]
        self.by_piece &= not any(re.search(r"\s", t["content"]) or t.get("lstrip") or t.get("rstrip") or t.get("single_word") for t in model.get("added_tokens") or ())
        self.begins = np.zeros(max(self.tokenizer.get_vocab().values(), default=0) + 1, dtype=bool)
        for token, k in self.tokenizer.get_vocab().items():
            self.begins[k] = token.startswith("\u0120")  # a space in the library's byte alphabet
        self.memo: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text (null: none) as little-endian numbers of ``dtype``."""
        if not self.by_piece:
            found = self.tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)
            return [np.array(e.ids, dtype=self.dtype).tobytes() for e in found]
        if len(self.memo) > MEMO_WORDS:
            self.earlier, self.memo = self.memo, {}
        # Arrow cuts the texts and numbers their distinct pieces, so Python meets a piece once a call and numpy joins the ids.
        lists = pc.split_pattern(pa.array(map(self._marked, texts), pa.large_string()), "\x00")
        numbered = lists.flatten().dictionary_encode()
        raw = self._known(numbered.dictionary.to_numpy(zero_copy_only=False).tolist())  # far faster than to_pylist
        sizes = np.fromiter(map(len, raw), np.int64, len(raw)) // self.dtype.itemsize
        firsts = np.cumsum(sizes) - sizes
        which = numbered.indices.to_numpy()
        lengths = sizes[which]
        ends = np.concatenate(([0], np.cumsum(lengths)))
        place = np.repeat(firsts[which] - ends[:-1], lengths)
        place += np.arange(len(place))
        ids = np.frombuffer(b"".join(raw), dtype=self.dtype)[place].tobytes()
        cuts = ends[np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())] * self.dtype.itemsize
        out = [ids[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist(), strict=False)]
        for i, text in enumerate(texts):
            if text and "\x00" in text:
                out[i] = self._known([text])[0]
        return out

    @staticmethod
    def _marked(text: str | None) -> str | None:
        """The text with a mark before each piece but the first; none where it is empty or holds the mark, and is one piece.

        The pattern makes a line feed without white space beside it a piece by itself.
        """
        if not text or "\x00" in text:
            return None
        if _TWO_SPACES.search(text):
            return _ONE_SPACE.sub("\x00 ", text)
        return text.replace(" ", "\x00 ").replace("\n", "\x00\n\x00")

    def _known(self, pieces: list[str]) -> list[bytes]:
        """The ids of distinct pieces; new ones are learned."""
        found = list(map(self.memo.get, pieces))
        new = [i for i, raw in enumerate(found) if raw is None]
        unknown = set()
        for i in new:
            raw = self.earlier.get(pieces[i])
            if raw is None:
                unknown.add(pieces[i])
            else:
                self.memo[pieces[i]] = raw
        self._learn(unknown)
        for i in new:
            found[i] = self.memo[pieces[i]]
        for i in new:
            if len(pieces[i]) > _LONG:
                del self.memo[pieces[i]]
        return found

    def _learn(self, new: set[str]) -> None:
        memo, words = self.memo, {}
        together = "\x00".join(new)
        if not any(t in together for t in self.added):
            # A word and marks after it are two tokens' worth of text: the pattern never joins letters and marks.
            for p in new:
                word = p.rstrip(_MARKS)
                if len(word) < len(p) <= _LONG and word[1:].isalpha():
                    words[p] = word
        plain = {p for p in new if p not in words}
        plain.update(w for w in words.values() if w not in memo)
        plain.update({p[len(w) :] for p, w in words.items()}.difference(memo))
        self._encode_pieces(plain)
        for p, word in words.items():
            memo[p] = memo[word] + memo[p[len(word) :]]

    def _encode_pieces(self, pieces: set[str]) -> None:
        spaced = list(filter(_SPACED.fullmatch, pieces))
        rest = list(pieces.difference(spaced))
        parts = [spaced[i : i + _TOGETHER] for i in range(0, len(spaced), _TOGETHER)]
        found = self.tokenizer.encode_batch_fast(["".join(part) for part in parts], add_special_tokens=False)  # without the places in the text
        for part, encoded in zip(parts, found, strict=True):
            ids = np.array(encoded.ids, dtype=self.dtype)
            cuts = np.flatnonzero(self.begins[ids])
            if len(cuts) == len(part) and cuts[0] == 0 and not any(t in piece for t in self.added if t in "".join(part) for piece in part):
                self._remember(part, ids, np.append(cuts, len(ids)))
            else:
                rest += part
        if rest:
            self._encode_apart(rest)

    def _remember(self, pieces: list[str], ids: np.ndarray, cuts: np.ndarray) -> None:
        raw, cuts = ids.tobytes(), (cuts * self.dtype.itemsize).tolist()
        for p, a, b in zip(pieces, cuts, cuts[1:], strict=False):
            self.memo[p] = raw[a:b]

    def _encode_apart(self, pieces: list[str]) -> None:
        found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
        owner = np.array(found.word_ids, dtype=np.int64)
        self._remember(pieces, np.array(found.ids, dtype=self.dtype), np.concatenate(([0], np.cumsum(np.bincount(owner, minlength=len(pieces))))))
