"""License scans: MinHash bands over overlapping text windows retrieve templates, exact shingle containment verifies.

A template is a notice of a few words up to a whole license text. Words are
lower case in ASCII, without punctuation; shingles are runs of ``shingle`` words (a shorter
template is one shingle). Templates are grouped by size class c (their number
of shingles, rounded up to a power of two). A text is cut into windows of 2c
shingles at every c shingles, so a template that stands in the text lies whole
in one window and makes up more than a quarter of its shingles. Each band is one
MinHash value: with ``containment`` of a template present, the window's
similarity to it is at least s = containment / 4, and all bands miss with
probability (1 - s)^bands: below 1e-6 for 64 bands and s = 0.2. Window minima of
one class come from those of the class below by pairwise minima.

A retrieved template is verified exactly: the share of its distinct shingles
that the window's region holds must reach ``containment``.

The template set is given by the caller and bounded by ``max_templates``; it is
the only thing sent to all tasks. Documents are scanned whole, in their scan
task, without a shuffle.

Edge cases: a null or empty text holds no license; templates without words are
ignored; a template with the same words as another reports both names; texts
shorter than a template can still contain enough of it; repeated rows give
repeated results; very long texts are scanned whole; an empty table gives an
empty result; only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty
from arrivals.llm.textbytes import U64, RangeHash, Slice, mixed, slices, text_column

# Short public license notices by SPDX name.
NOTICES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0",
    "Apache-2.0-header": (
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at"),
    "BSD-3-Clause": (
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"),
    "CC-BY-4.0": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0",
    "GPL-3.0": "licensed under the GNU General Public License, version 3",
    "GPL-2.0-header": (
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General "
        "Public License as published by the Free Software Foundation"),
    "ISC": (
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
        "hereby granted"),
    "MIT": "Released under the MIT License",
    "MIT-header": (
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files"),
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "Proprietary": "All rights reserved",
}

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@dataclass(frozen=True)
class LicenseParams:
    shingle: int = 5
    bands: int = 64
    containment: float = 0.8
    max_templates: int = 10_000


def _words(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text + total)."""
    inside = np.zeros(len(s.data) + 2, bool)
    inside[1:-1] = _IN_WORD[s.data]
    a, b = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = s.starts[(s.starts > 0) & (s.starts < len(s.data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    a[cuts] = b[cuts] = True
    a, b = np.flatnonzero(a), np.flatnonzero(b)
    return (mixed(RangeHash.of_bytes(_LOWER[s.data], 31)(a, b) + (b - a).astype(U64)),
            np.append(np.searchsorted(a, s.starts), len(a)))


def _shingles(words: np.ndarray, k: int) -> np.ndarray:
    return mixed(RangeHash(words, 33).all_of(k) + U64(k)) if len(words) >= k else np.zeros(0, U64)


@dataclass
class Template:
    name: str
    k: int                 # words of a shingle: fewer in a very short template
    shingles: np.ndarray   # distinct, sorted
    size: int              # class: a power of two


def _templates(notices: dict[str, str], p: LicenseParams) -> list[Template]:
    if len(notices) > p.max_templates:
        raise ValueError(f"{len(notices)} templates; max_templates is {p.max_templates}")
    out = []
    for name, text in sorted(notices.items()):
        data = np.frombuffer(text.encode(), np.uint8)
        if not len(data):
            continue
        words, _ = _words(Slice(data, np.array([0]), np.array([len(data)]), np.array([0])))
        if len(words):
            k = min(p.shingle, len(words))
            s = _shingles(words, k)
            out.append(Template(name, k, np.unique(s), 1 << int(len(s) - 1).bit_length()))
    return out


def _hashed(shingles: np.ndarray, band: int) -> np.ndarray:
    """The values whose minimum is one MinHash band (multiply-shift of scrambled shingles)."""
    return shingles * U64((0x9E3779B97F4A7C15 * (2 * band + 1)) % 2**64 | 1) >> U64(16)


def _windows(first: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks of ``size`` shingles and their ends."""
    a = np.arange(0, n, size)
    return a, np.minimum(a + size, n)


def _scan(templates: list[Template], p: LicenseParams):
    by_class: dict[tuple[int, int], list[int]] = {}
    for i, t in enumerate(templates):
        by_class.setdefault((t.k, t.size), []).append(i)
    # Per class and band: the templates' minima in order.
    minima = {}
    for key, members in by_class.items():
        for band in range(p.bands):
            values = np.array([_hashed(templates[i].shingles, band).min() for i in members])
            order = np.argsort(values, kind="stable")
            minima[key, band] = values[order], np.array(members)[order]

    def candidates(shingles: np.ndarray) -> dict[int, set[tuple[int, int]]]:
        """Template -> (block, size) of the windows that share a band with it."""
        found: dict[int, set[tuple[int, int]]] = {}
        for k in {k for k, _ in by_class}:
            s = shingles[k]
            if not len(s):
                continue
            sizes = sorted(size for kk, size in by_class if kk == k)
            for band in range(p.bands):
                low, size = _hashed(s, band), 1
                while True:
                    if size in sizes:
                        window = np.minimum(low, np.append(low[1:], low[-1]))   # two neighbouring blocks
                        values, members = minima[(k, size), band]
                        lo, hi = np.searchsorted(values, window, "left"), np.searchsorted(values, window, "right")
                        for at in np.flatnonzero(lo < hi):
                            for j in range(lo[at], hi[at]):
                                found.setdefault(int(members[j]), set()).add((int(at), size))
                    if size >= sizes[-1]:
                        break
                    if len(low) % 2:
                        low = np.append(low, low[-1])
                    low, size = np.minimum(low[::2], low[1::2]), size * 2
        return found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths = sorted({t.k for t in templates})
        for batch in batches:
            rows, names, shares, starts = [], [], [], []
            for s in slices(*text_column(batch)):
                words, first = _words(s)
                shingles = {k: _shingles(words, k) for k in lengths}
                best: dict[tuple[int, int], tuple[float, int]] = {}
                for i, windows in candidates(shingles).items():
                    t = templates[i]
                    for block, size in windows:
                        a, b = block * size, (block + 2) * size     # shingles of the window
                        # The window may run over several texts: verify in each on its own.
                        texts = range(int(np.searchsorted(first, a, "right")) - 1,
                                      int(np.searchsorted(first[:-1], min(b, len(words)), "left")))
                        for d in texts:
                            lo, hi = max(a - size, first[d]), min(b + size, first[d + 1] - t.k + 1)
                            if hi <= lo:
                                continue
                            held = np.isin(shingles[t.k][lo:hi], t.shingles)
                            share = len(np.unique(shingles[t.k][lo:hi][held])) / len(t.shingles)
                            if share >= p.containment:
                                at = int(lo + np.flatnonzero(held)[0] - first[d])
                                old = best.get((d, i), (0.0, at))
                                best[d, i] = max(old[0], share), min(old[1], at)
                for (d, i), (share, at) in sorted(best.items()):
                    rows.append(int(s.rows[d]))
                    names.append(templates[i].name)
                    shares.append(share)
                    starts.append(at)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(names, pa.string()),
                 pa.array(shares, pa.float64()), pa.array(starts, pa.int64())],
                ["doc_id", "license", "containment", "first_word"])

    return run


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, p: LicenseParams = LicenseParams()) -> DataFrame:
    """(doc_id, license, containment, first_word): every template that a document contains, once per document."""
    templates = _templates(NOTICES if notices is None else notices, p)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    return rows.mapInArrow(_scan(templates, p), "doc_id long, license string, containment double, first_word long")
