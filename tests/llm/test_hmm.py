"""op2: counts and base score against plain Python, likelihoods against the plain recursion."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from arrivals.llm.hmm import HmmParams, Model, expected_counts, language_model_scores, text_scores
from tests.llm.cases import edge_docs, edge_rows, empty_docs


def share(x):
    return x / x.sum(axis=-1, keepdims=True)


def model(seed=0):
    rng = np.random.default_rng(seed)
    return Model(share(rng.random(3)), share(rng.random(3)), share(rng.random((3, 3))), share(rng.random((3, 10))).T.copy())


SMALL = HmmParams(states=3, frequent=5, suffixes=4, segment=4, at_once=8)


def test_forward_recursion_is_exact():
    m, rng = model(), np.random.default_rng(1)
    texts = [rng.integers(0, 9, n).astype("<u2") for n in (0, 1, 3, 4, 5, 17, 40, 200)]
    for x, got in zip(texts, text_scores([t.tobytes() for t in texts], m, SMALL)):
        kinds, log = [*x, 9], 0.0
        a = m.start * m.emit[kinds[0]]
        for c in kinds[1:]:
            log, a = log + math.log(a.sum()), share(a) @ m.step * m.emit[c]
        assert got == pytest.approx(log + math.log(a.sum()), abs=1e-9)


def test_probabilities_of_all_short_texts_sum_below_one():
    m = model(4)
    total = sum(math.exp(s) for n in range(4) for s in text_scores(
        [np.array(np.unravel_index(i, (9,) * n), "<u2").tobytes() for i in range(9**n)], m, SMALL))
    assert 0.1 < total < 1


def test_expected_counts_match_sums_over_paths():
    m = model(2)
    x = np.array([[1, 3, 9, -1]], np.int32)
    emitted, steps, start, later, _ = expected_counts(x, np.array([3]), np.array([True]), m)
    weight = {}
    for p in np.ndindex(3, 3, 3):
        w = m.start[p[0]] * m.emit[1, p[0]]
        for a, b, c in ((p[0], p[1], 3), (p[1], p[2], 9)):
            w *= m.step[a, b] * m.emit[c, b]
        weight[p] = w
    total = sum(weight.values())
    for s in range(3):
        assert start[s] == pytest.approx(sum(w for p, w in weight.items() if p[0] == s) / total, rel=1e-4)
        assert emitted[3, s] == pytest.approx(sum(w for p, w in weight.items() if p[1] == s) / total, rel=1e-4)
        for t in range(3):
            want = sum(w * ((p[0] == s) * (p[1] == t) + (p[1] == s) * (p[2] == t)) for p, w in weight.items()) / total
            assert steps[s, t] == pytest.approx(want, rel=1e-4)
    assert later.sum() == 0


def test_base_scores_on_odd_rows(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    toks = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) for _, t in rows]
    held = [zlib.crc32(("" if d is None else str(d)).encode()) % 7 == 2 for d, _ in rows]
    count = Counter(w for x, h in zip(toks, held) if not h for w in x)
    ends = held.count(False)
    n, v = sum(count.values()) + ends, len(count) + 1
    want = sorted(
        ((-1 if d is None else d), h, len(x) + 1, sum(w in count for w in x) + 1, n,
         round(sum(math.log10((count[w] + 1) / (n + v + 1)) for w in x) + math.log10((ends + 1) / (n + v + 1)), 6))
        for (d, _), x, h in zip(rows, toks, held))
    p = HmmParams(frequent=50, iterations=2)
    got = language_model_scores(edge_docs(spark, ("row", "bucket", "score")).repartition(3), p).collect()
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6))
                  for r in got) == want
    assert all(np.isfinite(r.score) and r.score < 0 for r in got)


def test_states_beat_the_base_on_two_languages(spark):
    rng = np.random.default_rng(0)
    rows = [(i, " ".join(f"{'ab'[i % 2]}{x}" for x in rng.integers(0, 40, 60))) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = language_model_scores(docs, HmmParams(frequent=200)).filter("held_out").collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got) + 0.2 * sum(r.n_tokens for r in got)


def test_empty_table_and_no_training_rows(spark):
    assert language_model_scores(empty_docs(spark)).collect() == []
    only = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    r = language_model_scores(spark.createDataFrame([(only, "a b")], "doc_id long, text string")).first()
    assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) == (True, 3, 0, 0, 0.0)
