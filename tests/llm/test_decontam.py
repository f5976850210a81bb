"""op6: planted passages are found, others left alone, and the parts against plain versions."""

import random

import numpy as np

from arrivals.llm.decontam import LeakParams, common_subsequence, decontamination_stage, leak_pairs
from tests.llm.cases import edge_docs, empty_docs, prose, words

rng = random.Random(11)
ITEMS = [(i, prose(rng, rng.randint(8, 70))) for i in range(40)] + [(40, None), (41, ""), (7, "a second text of item seven is here")]


def planted():
    r = random.Random(12)
    rows, want = [], set()
    for i in range(60):
        w = words(r, r.randint(30, 300))
        if i % 3 == 0:
            item = r.randrange(40)
            at = r.randrange(len(w))
            x = ITEMS[item][1].split()
            if i % 2 and len(x) > 12:                # a few words changed
                for k in range(3, len(x), 9):
                    x[k] = "other"
            w[at:at] = x
            want.add((i, item))
        rows.append((i, " ".join(w)))
    return rows, want


def benchmark(spark):
    return spark.createDataFrame(ITEMS, "item_id long, text string")


def test_planted_passages(spark):
    rows, want = planted()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {(r.doc_id, r.item_id) for r in leak_pairs(docs, benchmark(spark)).collect()}
    assert got == want
    blocks = {(r.doc_id, r.item_id) for r in leak_pairs(docs, benchmark(spark), LeakParams(block_items=9)).collect()}
    assert blocks == want


def test_answer_decides_on_paraphrases(spark):
    r = random.Random(3)
    head, tail = words(r, 30), words(r, 8)
    item = [(1, " ".join(head) + ".", " ".join(tail))]
    half = " ".join(head[:18] + words(r, 20))
    docs = spark.createDataFrame([(1, half), (2, half + " " + " ".join(tail))], "doc_id long, text string")
    bench = spark.createDataFrame(item, "item_id long, text string, answer string")
    assert [x.doc_id for x in leak_pairs(docs, bench).collect()] == [2]


def test_quoted_passages_of_a_long_item(spark):
    r = random.Random(21)
    item, other = words(r, 200), words(r, 64)
    rows = [(1, words(r, 90) + item[20:140] + words(r, 70)),       # 120 of 200 words, not the last sentence
            (2, words(r, 50) + item[100:164] + words(r, 50)),      # one passage's length, across two passages
            (3, words(r, 50) + item[60:80] + words(r, 50)),        # 20 words only
            (4, item[136:] + words(r, 40)), (5, words(r, 300)), (6, other)]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in rows], "doc_id long, text string")
    bench = spark.createDataFrame(
        [(1, " ".join(item[:190]) + ". " + " ".join(item[190:])), (2, " ".join(other))], "item_id long, text string")
    got = {(x.doc_id, x.item_id) for x in leak_pairs(docs, bench).collect()}
    assert got == {(1, 1), (2, 1), (4, 1), (6, 2)}


def test_odd_rows_and_stage(spark):
    docs = edge_docs(spark, ("hash", "item_id", "doc_hash"))
    assert leak_pairs(empty_docs(spark), benchmark(spark)).collect() == []
    nothing = spark.createDataFrame([], "item_id long, text string")
    assert leak_pairs(docs, nothing).collect() == []
    clean = decontamination_stage(docs, benchmark(spark))
    assert clean.columns == docs.columns and clean.count() == docs.count()
    own = spark.createDataFrame([(1, docs.filter("doc_id = 4").first().text)], "item_id long, text string")
    gone = decontamination_stage(docs, own)
    assert {r.doc_id for r in gone.collect()} == {r.doc_id for r in docs.collect()} - {4, 40}


def test_common_subsequence():
    r = random.Random(1)
    for _ in range(200):
        a, b = ([r.randrange(5) for _ in range(r.randrange(12))] for _ in range(2))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1, j + 1] = table[i, j] + 1 if x == y else max(table[i, j + 1], table[i + 1, j])
        assert common_subsequence(a, b) == table[-1, -1]
