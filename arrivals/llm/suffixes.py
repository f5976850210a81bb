"""Suffix-array dedup: remove every byte under a 100-byte string that also starts earlier in the corpus.

Sorting all suffixes would move the corpus hundreds of times over, so the
suffix array is sparse: of the suffixes that start in a window, the one whose
leading ``gram`` bytes have the least hash stands for the window. That choice
depends on the window's bytes alone, so equal windows have equal suffixes in
the array. Sampled splitters range-partition the suffixes by their leading
bytes; a multikey sort orders each bucket; neighbours, also across bucket
boundaries, show which windows repeat (see ``repeats``).

Edge cases: a null text is empty; a text shorter than a window loses nothing;
rows with equal doc_id and text are one document and share its result; rows
with one doc_id and different texts are ordered by a checksum of the text; a
null doc_id is ordered last; very long texts are processed in overlapping
pieces; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame

from arrivals.llm.repeats import SPAN, Windows, with_removed
from arrivals.llm.textbytes import U64, RangeHash, mixed, slices

WIDTH, GRAM = 100, 37


def _sliding(values: np.ndarray, n: int, take) -> np.ndarray:
    """The least (or greatest) of every ``n`` neighbours, by doubling."""
    done, out = 1, values
    while done < n:
        step = min(done, n - done)
        out = take(out[:len(out) - step], out[step:])
        done += step
    return out


def byte_spans(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    per_window = width - gram + 1
    for s in slices(data, offsets, overlap=width - 1):
        if len(s.data) < width:
            continue
        ranges = RangeHash.of_bytes(s.data)
        h = mixed(ranges.all_of(gram))
        least = _sliding(h, per_window, np.minimum)
        # The positions that stand for some window.
        padded = np.concatenate([np.zeros(per_window - 1, U64), least, np.zeros(per_window - 1, U64)])
        chosen = np.flatnonzero(h == _sliding(padded, per_window, np.maximum))
        value = h[chosen]

        forced = np.concatenate([s.starts, np.maximum(s.starts, s.ends - width + 1)])
        forced = forced[forced < len(least)]
        new = np.append(True, least[1:] != least[:-1])
        new[forced] = True
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(least))  # windows [a, b)
        doc = np.searchsorted(s.starts, a, "right") - 1
        # Texts without bytes share their start with the next text: take the one that holds the window.
        ok = a + width <= s.ends[doc]
        a, b, doc = a[ok], b[ok], doc[ok]
        if not len(a):
            continue
        key = least[a]
        at = np.searchsorted(chosen, a)
        while len(wrong := np.flatnonzero(value[at] != key)):
            at[wrong] += 1
        anchor = chosen[at]
        after = np.minimum(at + 1, len(chosen) - 1)
        repeats = (value[after] == key) & (after > at) & (chosen[after] <= b - 1 + per_window - 1)
        lead = np.zeros(len(a), U64)
        for i in range(8):
            lead = (lead << U64(8)) | s.data[anchor + i].astype(U64)
        out = np.zeros(len(a), SPAN)
        out["lead"], out["key"] = lead, key
        out["fp"] = mixed(ranges(a, b - 1 + width) + (b - a).astype(U64))
        out["at"] = a - s.starts[doc] + s.first_unit
        out["n"], out["own"] = b - a, repeats
        yield s.rows[doc], out


def byte_fingerprints(text: np.ndarray, at: np.ndarray, width: int = WIDTH) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for seed in (1, 2):
        r = RangeHash.of_bytes(text, seed)
        out.append(mixed(r(at, at + width)))
    return out[0], out[1]


def _digest(text: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, int, str]:
    digest, at, view = hashlib.sha256(), 0, memoryview(text)
    for a, b in zip(starts.tolist(), ends.tolist(), strict=True):
        digest.update(view[at:a])
        at = b
    digest.update(view[at:])
    return len(text), int((ends - starts).sum()), len(starts), digest.hexdigest()


def remove_repeated_bytes(docs: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) of every document."""
    windows = Windows(WIDTH, byte_spans, byte_fingerprints, within=True)
    return with_removed(docs, windows, _digest,
                        "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
