"""Whole texts to token ids with ready-made tokenizers, fast on text that repeats its words.

A tokenizer whose rules never look across a cut gives the same ids for a text as
for its pieces one after the other. The encoders here cut texts there, keep the
ids of recent pieces, and send only new pieces through the tokenizer library
(its merges alone where the rules before them would leave a piece as it is).
A tokenizer with other rules encodes whole texts.

Vocabulary files are read by the driver and travel with the tasks (a few MB),
so executors need not have them.
"""

from __future__ import annotations

import hashlib
import json
import re
import sys
import types
from array import array
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa

PIECES = 1 << 18   # remembered pieces, at most
LONG_PIECE = 64    # characters or bytes; longer pieces are not remembered
STRETCH = 1 << 20  # characters of text that are cut and looked up together

# The rules of a tokenizer that lower-cases and drops white space (as its file states them).
_WORD_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
_WORD_SPLIT = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

# Letters that NFC leaves alone and that lower-case one to one, digits, and ASCII signs. Apostrophes (contractions) and
# "<" (special tokens) are not among them, so the rules cut text of these characters by character class alone.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_SIGNS = "!-&(-/:;=>?@\\[-`{-~"
_ODD = re.compile(f"[^{_LETTERS}0-9{_SIGNS} \n\t\r]")
# The same in UTF-8, where all bytes from 128 on belong to letters: the kinds of bytes, and a table that lower-cases (the
# second bytes of À to Þ, too) and makes every blank a space. A part is a run of one kind, but each digit is its own.
_BLANK, _LETTER, _SIGN, _DIGIT = range(4)
_KINDS = np.array([_BLANK if b in b" \n\t\r" else _DIGIT if b in b"0123456789" else
                   _LETTER if b > 127 or chr(b).isalpha() else _SIGN for b in range(256)], np.uint8)
_LOWER = bytes(32 if b in b" \n\t\r" else b + 32 if 65 <= b <= 90 or 128 <= b <= 158 else b for b in range(256))
# What a byte-level pattern makes of text of these characters, and stretches of it that end in no blank.
SPACED_RUNS = re.compile(rf" ?[{_LETTERS}]+| ?[0-9]+| ?[{_SIGNS}]+|\s+(?!\S)|\s+")
PLAIN = re.compile(f"[{_LETTERS}0-9{_SIGNS}](?:[{_LETTERS}0-9{_SIGNS} \n]*[{_LETTERS}0-9{_SIGNS}])?")


def read_vocabulary(name: str, path: str | None = None) -> bytes:
    """The bytes of a tokenizer file: ``path``, or the installed public file called ``name``."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(name)
    return Path(path).read_bytes()


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: visible Latin-1 for itself, the rest from 256 on."""
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {b: chr(b) for b in visible}
    hidden = [b for b in range(256) if b not in letters]
    return letters | {b: chr(256 + i) for i, b in enumerate(hidden)}


def speller() -> dict[int, str]:
    """The translation of Latin-1 characters into the letters of their UTF-8 bytes."""
    letters = byte_letters()
    return {c: "".join(letters[b] for b in chr(c).encode()) for c in range(256)}


class Remembered(dict):
    """piece -> value, computed when missing; long pieces are computed each time.

    Two generations of half of ``PIECES``: when the young one is full it becomes
    the old one, and an old piece that is asked for again is young again, so
    frequent pieces stay.
    """

    def __init__(self, compute):
        super().__init__()
        self.compute, self.old = compute, {}

    def __missing__(self, piece):
        value = self.old[piece] if piece in self.old else self.compute(piece)
        if len(piece) <= LONG_PIECE:
            self[piece] = value
        return value

    def new_of(self, pieces: set[str]) -> list[str]:
        """Those of ``pieces`` that no generation holds."""
        absent = pieces.difference(self)
        for piece in absent.intersection(self.old):
            self[piece] = self.old[piece]
        return list(absent.difference(self))

    def trim(self):
        if len(self) > PIECES // 2:
            self.old = dict(self)
            self.clear()


def kept_in_worker(kind: type, *vocabularies: bytes):
    """``kind(*vocabularies)``, kept for later tasks of this Python worker: loaded tokenizers and remembered pieces.

    Only the last one is kept. It is a cache: a new worker starts without it and gets the same results.
    """
    state = sys.modules.setdefault("arrivals_worker_state", types.ModuleType("arrivals_worker_state"))
    key = kind.__name__, *(hashlib.sha256(v).hexdigest() for v in vocabularies)
    if getattr(state, "key", None) != key:
        state.value, state.key = kind(*vocabularies), key
    return state.value


class WordEncoder:
    """Texts to little-endian unsigned 32-bit ids (without special tokens added)."""

    def __init__(self, vocabulary: bytes):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(vocabulary)
        rules = json.loads(vocabulary)
        split = (rules.get("pre_tokenizer") or {}).get("pretokenizers") or [{}, {}]
        added = rules.get("added_tokens") or []
        self.by_word = (
            (rules.get("normalizer") or {}).get("normalizers") == _WORD_NORMALIZERS
            and split[0].get("pattern") == {"Regex": _WORD_SPLIT} and split[0].get("invert") is True
            and split[1].get("type") == "ByteLevel" and split[1].get("add_prefix_space") is False
            and not any(t["lstrip"] or t["rstrip"] or re.search(r"\s", t["content"]) or PLAIN.fullmatch(t["content"])
                        for t in added)
        )
        self.model, self.spelled = self.tokenizer.model, speller()
        self.words, self.parts = Remembered(lambda w: self._whole(w) if w else b""), Remembered(self._part)

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _part(self, part: bytes) -> bytes:
        if part.isspace():
            return b""
        spelled = part.decode() if part.isascii() else part.decode().translate(self.spelled)
        return _packed([t.id for t in self.model.tokenize(spelled)])

    def encode(self, text: str) -> bytes:
        return next(self.encode_each([text]))

    def encode_each(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of every text, in order; about ``STRETCH`` characters are worked on at a time."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= STRETCH:
                yield from self._encoded(held)
                held, size = [], 0
        if held:
            yield from self._encoded(held)

    def _encoded(self, texts: list[str]) -> Iterator[bytes]:
        if not self.by_word:
            yield from map(self._whole, texts)
            return
        odd = [_ODD.search(t) is not None for t in texts]
        plain = self._by_kind([t for t, is_odd in zip(texts, odd, strict=True) if not is_odd])
        for text, is_odd in zip(texts, odd, strict=True):
            yield self._by_blanks(text) if is_odd else next(plain)

    def _by_blanks(self, text: str) -> bytes:
        self.words.trim()
        blank = text.replace("\n", " ").replace("\t", " ").replace("\r", " ")
        return b"".join(map(self.words.__getitem__, blank.split(" ")))

    def _by_kind(self, texts: list[str]) -> Iterator[bytes]:
        """The ids of plain texts. A long one is cut at blanks, so the arrays stay small."""
        cut = [list(_stretches(t.encode().translate(_LOWER))) for t in texts]
        if all(len(c) == 1 for c in cut):
            yield from self._joined([c[0] for c in cut]) if cut else ()
            return
        for stretches in cut:
            yield b"".join(ids for s in stretches for ids in self._joined([s]))

    def _joined(self, texts: list[bytes]) -> Iterator[bytes]:
        """All parts of the texts in one array; every distinct part is looked up once, its ids are copied to its places."""
        data = b"".join([t + b" " for t in texts])
        kinds = _KINDS[np.frombuffer(data, np.uint8)]
        cuts = np.flatnonzero((kinds[1:] != kinds[:-1]) | (kinds[1:] == _DIGIT)) + 1
        bounds = np.concatenate(([0], cuts, [len(data)])).astype(np.int32)
        parts = pa.Array.from_buffers(
            pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(data)]).dictionary_encode()
        self.parts.trim()
        known = list(map(self.parts.__getitem__, parts.dictionary.to_pylist()))
        sizes = np.fromiter(map(len, known), np.int64, len(known)) // 4
        which = parts.indices.to_numpy()
        counts = sizes[which]
        ends = np.cumsum(counts)
        from_start = np.repeat((np.cumsum(sizes) - sizes)[which] - (ends - counts), counts)
        ids = np.frombuffer(b"".join(known), "<u4")[from_start + np.arange(len(from_start))]
        before = np.concatenate(([0], ends))
        text_ends = np.cumsum([len(t) + 1 for t in texts]) - 1
        at = 0
        for to in before[np.searchsorted(bounds[:-1], text_ends)].tolist():
            yield ids[at:to].tobytes()
            at = to


def _stretches(data: bytes) -> Iterator[bytes]:
    """``data`` cut at spaces into stretches of ``STRETCH`` bytes at most, or of one word."""
    at = 0
    while len(data) - at > STRETCH:
        to = data.rfind(b" ", at, at + STRETCH)
        to = to if to > at else data.find(b" ", at + STRETCH)
        if to < 0:
            break
        yield data[at:to]
        at = to
    yield data[at:]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()
