"""op7: gradients, windows, and held-out accuracy."""

import zlib

import numpy as np
import pytest

from arrivals.llm.language import (
    NetParams, _gradients, _softmax, fit, identify_languages, sampled, text_probabilities, train)
from tests.llm.cases import edge_docs, empty_docs


def small_net():
    return train([(b"ab", "a"), (b"cd", "b"), (b"ce", "c")], NetParams(hidden=3, steps=0))


def test_gradients_match_differences():
    net, rng = small_net(), np.random.default_rng(0)
    x, y = rng.integers(0, 256, (7, 5)).astype(np.uint8), rng.integers(0, 3, 5)
    _, grads = _gradients(net, x, y)
    for w, g in zip((net.inputs, net.step, net.out, net.bias), grads):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        w[at] += 1e-5
        up = _gradients(net, x, y)[0]
        w[at] -= 2e-5
        down = _gradients(net, x, y)[0]
        w[at] += 1e-5
        assert g[at] == pytest.approx((up - down) / 2e-5, rel=1e-4)


def plain(net, text, window):
    """Every position's probabilities by the plain equations, averaged."""
    h, total = net.step.shape[1], np.zeros(len(net.languages))
    for at in range(0, len(text), window):
        piece, outs = text[at:at + window], []
        for d in range(2):
            s, states = np.zeros(h), {}
            for t in range(len(piece)) if d == 0 else range(len(piece) - 1, -1, -1):
                a, g = net.inputs[d][piece[t]], s @ net.step[d]
                z, r = (1 / (1 + np.exp(-(a + g)[k * h:(k + 1) * h])) for k in (0, 1))
                c = np.tanh(a[2 * h:] + r * g[2 * h:])
                s = (1 - z) * c + z * s
                states[t] = s
            outs.append(states)
        for t in range(len(piece)):
            total += _softmax(outs[0][t] @ net.out[0] + outs[1][t] @ net.out[1] + net.bias)
    return total / max(1, len(text))


def test_windows_cover_every_byte_of_every_text():
    net, p = small_net(), NetParams(hidden=3, window=16, at_once=4)
    texts = [b"", b"a", b"hello world, this is longer than a window", "é".encode() * 20, b"x" * 16, b"y" * 33]
    data = np.frombuffer(b"".join(texts), np.uint8)
    ends = np.cumsum([len(t) for t in texts])
    got = text_probabilities(net, data, np.append(0, ends[:-1]), ends, p)
    for t, g in zip(texts, got):
        assert g == pytest.approx(plain(net, t, 16), abs=1e-4)


def test_held_out_accuracy_and_odd_rows(spark):
    rng = np.random.default_rng(2)
    parts = {"aa": ["the", "ing", "th"], "bb": ["ção", "des", "ó"], "cc": ["sch", "ung", "ei"]}
    rows = [(i, " ".join("".join(rng.choice(parts[k], 3)) for _ in range(rng.integers(3, 60))), k)
            for i, k in ((i, sorted(parts)[i % 3]) for i in range(300))]
    rows += [(900, None, "aa"), (901, "", "bb"), (902, "123 456 ...", "cc"), (None, "thing thethe inging", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    out = identify_languages(docs.repartition(3), NetParams(steps=80, sample=100)).collect()
    by = {r.doc_id: r for r in out}
    assert len(out) == len(rows)
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3
    assert by[None].lang_pred == "aa"
    held = [r for r in out if r.held_out and r.doc_id is not None and r.doc_id < 900]
    truth = {r[0]: r[2] for r in rows}
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in out if r.doc_id is not None)
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in out)


def test_every_language_is_learned(spark):
    rows = [(i, f"common words number {i}", ("aa", "bb")[i % 2]) for i in range(4000)]
    rows += [(10_000 + i, f"rare words {i}", f"r{i}") for i in range(20)]
    docs = spark.createDataFrame(rows + [(None, "12 34", "none")], "doc_id long, text string, lang string")
    for n in (10, 200):
        found = fit(docs, NetParams(steps=0, sample=n)).languages
        assert found == sorted({r[2] for r in rows})
    assert sampled(docs, 200).count() < 400
    assert sampled(docs, 5000).count() == len(rows)


def test_empty_table_and_no_labels(spark):
    p = NetParams(steps=5, sample=10)
    assert identify_languages(empty_docs(spark), p).collect() == []
    unlabelled = edge_docs(spark, ("score",)).selectExpr("doc_id", "text", "cast(null AS string) AS lang", "score")
    assert {r.lang_pred for r in identify_languages(unlabelled, p).collect()} == {"und"}
