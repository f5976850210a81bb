"""Substring dedup by recompression: remove every word under a 13-word window that starts in an earlier document.

Texts are compressed in rounds. A round merges neighbouring symbols that are
equal (runs) or whose names fall in the left and the right half of a partition
of all names (pairs), and names the result after its content. Names and merges
are functions of the content, the same for all documents and partitions, so
equal word sequences carry the same interior symbols wherever they stand; only
symbols near their ends depend on the words around them. After two rounds
every 13-word window without long runs holds an interior symbol. The least name
among a window's interior symbols is its key; shared keys reveal long repeats
and the words of the windows verify them (see ``repeats``).

A window without interior symbol (inside a run of one word) is its own symbol.

Edge cases: a null or blank text has no words; a text shorter than a window
loses nothing; repeats within one document do not count; rows with equal
doc_id count as one document; a null doc_id is ordered last; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from arrivals.llm.repeats import SPAN, Windows, with_removed
from arrivals.llm.textbytes import U64, RangeHash, mixed, slices, word_bounds

WIDTH, ROUNDS = 13, 2


def _rounds(names: np.ndarray, text_starts: np.ndarray, content: RangeHash, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(names, context start, context end) of the symbols after the rounds.

    A symbol's context is the range of words that decide it: that of its
    parts and of the neighbours it did not merge with.
    """
    n = len(names)
    starts = np.arange(n + 1)
    left, right = starts[:-1], starts[1:]
    cut = np.zeros(n + 1, bool)
    cut[text_starts[text_starts <= n]] = True
    for k in range(rounds):
        half = (mixed(names ^ U64(0x9E3779B97F4A7C15 * (k + 1) % 2**64)) >> U64(63)).astype(bool)
        merge = ((names[1:] == names[:-1]) | (~half[:-1] & half[1:])) & ~cut[starts[1:-1]]
        first = np.flatnonzero(np.append(True, ~merge))
        last = np.append(first[1:] - 1, len(names) - 1)
        left = np.append(-1, left)[first]                 # context of the symbol before
        right = np.append(right, n + 1)[last + 1]         # and of the symbol behind
        starts = np.append(starts[first], n)
        names = mixed(content(starts[:-1], starts[1:]) + U64(k + 1))
    # A symbol at the edge of its text has a context that reaches out of it: no window holds that.
    inner = (left >= 0) & (right <= n)
    names[inner] = mixed(content(left[inner], right[inner]) + U64(rounds + 1))
    return names, left, right


def _least(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least value in each non-empty range [a, b)."""
    tables, width, most = [values], 1, int((b - a).max(initial=1))
    while 2 * width <= most:
        t = tables[-1]
        tables.append(np.minimum(t[:-width], t[width:]))
        width *= 2
    out = np.empty(len(a), U64)
    level = np.frexp((b - a).astype(np.float64))[1] - 1
    for k, t in enumerate(tables):
        at = np.flatnonzero(level == k)
        out[at] = np.minimum(t[a[at]], t[b[at] - (1 << k)])
    return out


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text + total)."""
    a, b, first = word_bounds(data, starts, ends)
    return mixed(RangeHash.of_bytes(data, seed)(a, b) + (b - a).astype(U64)), first


def word_spans(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for s in slices(data, offsets):
        words, first = _word_hashes(s.data, s.starts, s.ends)
        n = len(words) - width + 1
        if n <= 0:
            continue
        content = RangeHash(words, 3)
        names, left, right = _rounds(words, first, content, rounds)
        at = np.arange(n)
        lo = np.searchsorted(left, at, "left")
        hi = np.searchsorted(right, at + width, "right")
        key = mixed(content.all_of(width) + U64(99))
        some = np.flatnonzero(lo < hi)
        key[some] = _least(names, lo[some], hi[some])

        new = np.append(True, key[1:] != key[:-1])
        forced = np.concatenate([first[:-1], np.maximum(first[:-1], first[1:] - width + 1)])
        new[forced[forced < n]] = True
        a = np.flatnonzero(new)
        b = np.append(a[1:], n)
        doc = np.searchsorted(first[:-1], a, "right") - 1
        ok = a + width <= first[doc + 1]
        a, b, doc = a[ok], b[ok], doc[ok]
        out = np.zeros(len(a), SPAN)
        out["lead"] = out["key"] = key[a]
        out["fp"] = mixed(content(a, b - 1 + width) + (b - a).astype(U64))
        out["at"], out["n"] = a - first[doc], b - a
        yield s.rows[doc], out


def word_fingerprints(text: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for seed in (1, 2):
        words, _ = _word_hashes(text, np.array([0]), np.array([len(text)]), seed)
        out.append(mixed(RangeHash(words, seed)(at, at + width)))
    return out[0], out[1]


def _digest(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, str]:
    words = text.tobytes().split()
    removed = int((ends - starts).sum())
    total = len(words)
    for a, b in zip(starts[::-1].tolist(), ends[::-1].tolist(), strict=True):
        del words[a:b]
    return total, removed, hashlib.sha256(b" ".join(words)).hexdigest()


def remove_repeated_words(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document."""
    windows = Windows(WIDTH, word_spans, word_fingerprints, within=False)
    return with_removed(docs, windows, _digest, "doc_id long, n_words long, n_removed long, kept_sha256 string")
