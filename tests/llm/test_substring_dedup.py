"""op5 and op10 against brute force over all windows."""

import hashlib
import zlib

import numpy as np
import pytest

from arrivals.llm import recompression, suffixes
from arrivals.llm.repeats import (
    COVERED, OPEN, PACKED, PLACE, SPAN, Windows, _home, _home_column, _span_batches, multikey_order, unpack)
from arrivals.llm.textbytes import slices
from tests.llm.cases import edge_docs, edge_rows, empty_docs

LAST = 2**63 - 1


def brute_bytes(rows, width=100):
    """Rows with equal (doc_id, text) are one document; one doc_id's texts are ordered by checksum."""
    import zlib

    docs = sorted({(LAST if d is None else d, zlib.crc32((t or "").encode()), (t or "").encode()) for d, t in rows})
    seen, out = set(), {}
    for d, _, b in docs:
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - width + 1):
            w = b[p:p + width]
            if w in seen:
                gone[p:p + width] = True
            seen.add(w)
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[d, b] = (len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def brute_words(rows, width=13):
    docs = [(LAST if d is None else d, (t or "").encode()) for d, t in rows]
    first = {}
    for d, b in docs:
        w = b.split()
        for p in range(len(w) - width + 1):
            k = tuple(w[p:p + width])
            first[k] = min(first.get(k, LAST), d)
    out = {}
    for d, b in docs:
        w = b.split()
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if first[tuple(w[p:p + width])] < d:
                gone[p:p + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g)
        out[d, b] = (len(w), sum(gone), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize(
    "operator, brute", [(suffixes.remove_repeated_bytes, brute_bytes), (recompression.remove_repeated_words, brute_words)])
def test_matches_brute_force_on_odd_rows(spark, operator, brute):
    rows = [(r[0], r[1]) for r in edge_rows()]
    want = brute(rows)
    expected = sorted((LAST if d is None else d, *want[LAST if d is None else d, (t or "").encode()]) for d, t in rows)
    docs = edge_docs(spark, ("bucket", "kind", "blob", "hash"))
    got = sorted((LAST if r[0] is None else r[0], *r[1:]) for r in operator(docs.repartition(3)).collect())
    assert got == expected
    assert sum(r[2] for r in got) > 1000  # repeats were found


@pytest.mark.parametrize("operator", [suffixes.remove_repeated_bytes, recompression.remove_repeated_words])
def test_empty_table(spark, operator):
    assert operator(empty_docs(spark)).collect() == []


def test_long_texts_in_pieces_give_the_same_spans():
    rng = np.random.default_rng(0)
    text = rng.integers(97, 101, 5000).astype(np.uint8)
    text[3000:3300] = text[500:800]
    offsets = np.array([0, len(text)])

    def windows(limit):
        out = {}
        for s in slices(text, offsets, limit, overlap=99):
            piece = s.data
            for p in range(len(piece) - 99):
                out.setdefault(s.first_unit + p, bytes(piece[p:p + 100]))
        return out

    assert windows(1 << 20) == windows(700)


def test_multikey_order_sorts_like_tuples():
    rng = np.random.default_rng(1)
    words = [rng.integers(0, 4, 500).astype(np.uint64) for _ in range(3)]
    order = multikey_order(words)
    rows = list(zip(*words))
    assert [rows[i] for i in order] == sorted(rows)


def test_a_hot_passage_in_every_document(spark):
    passage = " ".join(f"hot{i}" for i in range(30))
    rows = [(i, " ".join(f"u{i}x{j}" for j in range(20)) + " " + passage + f" end{i}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    got = {r.doc_id: r.n_removed for r in recompression.remove_repeated_words(docs).collect()}
    assert got == {i: 0 if i == 0 else 30 for i in range(300)}
    want = brute_bytes(rows)
    got = {r.doc_id: r.n_removed for r in suffixes.remove_repeated_bytes(docs).collect()}
    assert got == {i: want[i, t.encode()][1] for i, t in rows}


def test_equal_spans_travel_once_a_flush(spark):
    text = "".join(f"{i * i * 7919:x} " for i in range(120))
    docs = spark.createDataFrame([(i, text) for i in range(300)] + [(7, text)], "doc_id long, text string").coalesce(1)
    w = Windows(100, suffixes.byte_spans, suffixes.byte_fingerprints, within=True)
    rows = docs.mapInArrow(_span_batches(w, np.zeros((0, 3), np.uint64), 5), PACKED).collect()
    spans = unpack([bytes(r.blob) for r in rows if r.kind == OPEN], SPAN)
    places = [(r.bucket, x) for r in rows if r.kind == COVERED for x in unpack([bytes(r.blob)], PLACE)]
    assert set(spans["doc"]) == {0}
    assert sum(int(x["n"]) for _, x in places) == 299 * int(spans["n"].sum())


def test_texts_without_an_id_are_dealt_over_all_buckets(spark):
    rows = [(None, f"text {i}") for i in range(400)] + [(-i, f"é {i}") for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("bucket", _home_column(8))
    got = {(r.doc_id, r.text): r.bucket for r in docs.collect()}
    assert {got[None, f"text {i}"] for i in range(400)} == set(range(8))
    for (doc, text), bucket in got.items():
        r = np.zeros(1, PLACE)
        r["doc"], r["tag"] = LAST if doc is None else doc, zlib.crc32(text.encode())
        assert _home(r, 8)[0] == bucket
