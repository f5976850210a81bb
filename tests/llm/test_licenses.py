"""op4 against exact containment over whole texts."""

import random
import re

from arrivals.llm.licenses import NOTICES, scan_licenses
from tests.llm.cases import edge_docs, edge_rows, empty_docs, words


def tokens(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", low)


def shingles(w, k):
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)}


def brute(text, notices):
    w = tokens(text)
    out = set()
    for name, notice in notices.items():
        t = tokens(notice)
        k = min(5, len(t))
        if t and len(shingles(t, k) & shingles(w, k)) >= 0.8 * len(shingles(t, k)):
            out.add(name)
    return out


def test_planted_notices(spark):
    rng = random.Random(6)
    long = {"long": " ".join(words(rng, 400)), "longer": " ".join(words(rng, 3000)), "blank": " - "}
    notices = NOTICES | long
    names = sorted(notices)
    rows = []
    for i in range(120):
        w = words(rng, rng.randint(0, 900))
        if i % 2:
            x = notices[rng.choice(names)].split()
            if i % 4 == 1 and len(x) > 60:
                x[20] = x[21] = "changed"
            at = rng.randint(0, len(w))
            w[at:at] = x
        rows.append((i, " ".join(w)))
    want = {(i, n) for i, t in rows for n in brute(t, notices)}
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.license) for r in scan_licenses(docs, notices).collect()}
    assert got == want and len(want) > 50


def test_odd_rows(spark):
    docs = edge_docs(spark, ("license", "containment"))
    assert {(r.doc_id, r.license) for r in scan_licenses(docs).collect()} == {
        (r[0], n) for r in edge_rows() for n in brute(r[1], NOTICES)}
    assert scan_licenses(empty_docs(spark)).collect() == []
    assert scan_licenses(docs, {}).collect() == []
    twice = spark.createDataFrame([(1, "Released under the MIT License.")] * 2, "doc_id long, text string")
    assert [(r.doc_id, r.license, r.first_word) for r in scan_licenses(twice).collect()] == [(1, "MIT", 0)] * 2
