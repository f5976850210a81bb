"""op1 against all pairs, and the signature against the similarity it estimates."""

import random
from collections import Counter

import numpy as np

from arrivals.llm.near_dedup import bag_signatures, near_duplicates, near_stage
from arrivals.llm.textbytes import mixed
from tests.llm.cases import SCHEMA, edge_docs, edge_rows, empty_docs, words


def bag(text):
    w = (text or "").split()
    return Counter(tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))) if w else Counter()


def brute_classes(rows):
    """Class number per row: components of similarity >= 0.8, equal words, and texts without words."""
    bags = [bag(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            a, b = bags[i], bags[j]
            if (not a and not b) or sum((a & b).values()) >= 0.8 * sum((a | b).values()) > 0:
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    return label


def check(spark, rows, docs):
    label = brute_classes(rows)
    least = {}
    for (d, _), x in zip(rows, label):
        least[x] = min(least.get(x, (1, 0)), (d is None, d or 0))
    expected = Counter((d, None if least[x][0] else least[x][1]) for (d, _), x in zip(rows, label))
    got = Counter((r.doc_id, r.class_id) for r in near_duplicates(docs).collect())
    assert got == expected


def test_odd_rows(spark):
    check(spark, [(r[0], r[1]) for r in edge_rows()], edge_docs(spark, ("id", "n", "bands", "label")))


def test_chains_and_a_large_near_group(spark):
    rng = random.Random(4)
    rows, start = [], words(rng, 120)
    for i in range(60):                       # each a small change away from one text
        w = list(start)
        w[rng.randrange(120)] = f"z{i}"
        rows.append((i, " ".join(w)))
    chain = words(rng, 100)
    for i in range(8):                        # neighbours alike, ends not
        rows.append((100 + i, " ".join(chain)))
        chain = chain[:90 - 6 * i] + [f"c{i}x{k}" for k in range(6)] + chain[96 - 6 * i:]
    rows += [(200 + i, " ".join(words(rng, 80))) for i in range(40)]
    check(spark, rows, spark.createDataFrame(rows, "doc_id long, text string").repartition(4))


def test_empty_table_and_stage(spark):
    assert near_duplicates(empty_docs(spark)).collect() == []
    rows = [(r[0], r[1]) for r in edge_rows()]
    label = brute_classes(rows)
    docs = edge_docs(spark, ("__mine",))
    kept = near_stage(docs)
    assert kept.columns == docs.columns
    rows_kept = [(r.doc_id, r.text) for r in kept.collect()]
    assert len(rows_kept) == len(set(label))
    assert Counter(label[rows.index(x)] for x in rows_kept) == Counter(set(label))
    assert near_stage(spark.createDataFrame([], SCHEMA)).count() == 0


def test_signature_is_unbiased_for_weighted_jaccard():
    rng = np.random.default_rng(3)
    value = mixed(np.arange(300, dtype=np.uint64))
    w1 = rng.integers(1, 40, 300)
    w2 = np.maximum(1, w1 + rng.integers(-9, 10, 300))
    true = np.minimum(w1, w2).sum() / np.maximum(w1, w2).sum()
    s = bag_signatures(np.repeat([0, 1], 300), np.concatenate([value, value]), np.concatenate([w1, w2]), 2, 8000)
    assert abs((s[0] == s[1]).mean() - true) < 0.02
