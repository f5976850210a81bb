"""op3 against all pairs of lines."""

import random

import pytest
from pyspark.sql import functions as F

from arrivals.llm.common import written
from arrivals.llm.lines import LineParams, candidate_pairs, dedup_lines, distinct_lines, line_stage, within_edits
from tests.llm.cases import edge_docs, edge_rows, empty_docs


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def edited(rng, line, n):
    chars = list(line)
    for _ in range(n):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars.insert(at, rng.choice("xyzé"))
        elif kind == 1:
            chars.pop(at)
        else:
            chars[at] = rng.choice("xyzé")
    return "".join(chars)


def line_table(seed=5):
    rng = random.Random(seed)
    lines = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(28, 60))).strip() + "." for _ in range(40)]
    stem = "every page begins with these very words and number "
    out = [(d, "\n".join(edited(rng, rng.choice(lines), rng.randint(0, 4)) for _ in range(4))) for d in range(40)]
    return out + [(100 + d, stem + "".join(rng.choice("0123456789") for _ in range(20))) for d in range(30)]


def brute(rows, p):
    """Kept text per row; places are (doc_id, line number)."""
    first = {}
    for d, t in rows:
        for i, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                place = (2**63 - 1 if d is None else d, i)
                first[line] = min(first.get(line, place), place)
    long = [x for x in first if len(x) >= p.min_fuzzy]
    linked = {a for a in long for b in long if a != b and first[b] < first[a] and abs(len(a) - len(b)) <= p.threshold
              and distance(a, b) <= p.threshold}
    out = []
    for d, t in rows:
        kept = [line for i, line in enumerate((t or "").split("\n")) if not line.strip(" \t\n\x0b\x0c\r")
                or (line not in linked and first[line] == (2**63 - 1 if d is None else d, i))]
        out.append((d, "\n".join(kept)))
    return out


def order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


@pytest.mark.parametrize("hot", [256, 4])
def test_edit_join_matches_all_pairs(spark, hot):
    p, rows = LineParams(hot_pairs=hot), line_table()
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = [(r.doc_id, r.kept_text) for r in dedup_lines(docs, p).collect()]
    assert order(got) == order(brute(rows, p))


def test_hot_segments_lose_no_pair(spark):
    lines = written(distinct_lines(spark.createDataFrame(line_table(9), "doc_id long, text string")), "t")
    text = {r.lid: r.line for r in lines.collect()}
    for hot in (1, 9):
        found = {(r.a, r.b) for r in candidate_pairs(lines, LineParams(hot_pairs=hot)).collect()}
        for a in text:
            for b in text:
                if a < b and min(len(text[a]), len(text[b])) >= 30 and distance(text[a], text[b]) <= 2:
                    assert (a, b) in found


@pytest.mark.parametrize("doc_id", [None, 7])
def test_texts_that_share_a_doc_id(spark, doc_id):
    near = "a line long enough for the edit join, version one"
    other = "an entirely unique line that nobody else has written"
    rows = [(1, "the opening line of the very first document here"),
            (doc_id, other), (doc_id, "the opening line of the very first document her"),   # only the second has a near line
            (doc_id, "x\n" + near), (doc_id, "y\n" + near[:-1] + "a"),                       # near lines at one place
            (doc_id, "p\nq\nthe same"), (doc_id, "r\ns\nthe same"), (doc_id, "t\nu\nthe same")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = [line for r in dedup_lines(docs).collect() for line in r.kept_text.split("\n") if line]
    assert kept.count(other) == 1
    assert sum(line.startswith("the opening") for line in kept) == 1
    assert sum(line.startswith("a line long enough") for line in kept) == 1
    assert kept.count("the same") == 1
    assert all(kept.count(x) == 1 for x in "xypqrstu")


def test_odd_rows_and_clashing_columns(spark):
    rows = [(r[0], r[1]) for r in edge_rows()]
    docs = edge_docs(spark, ("line", "pos", "n_removed", "lid"))
    out = dedup_lines(docs)
    assert out.columns == [c for c in docs.columns if c != "n_removed"] + ["n_lines", "n_removed", "kept_text"]
    assert order([(r.doc_id, r.kept_text) for r in out.collect()]) == order(brute(rows, LineParams()))
    assert dedup_lines(empty_docs(spark)).collect() == []
    assert line_stage(docs).columns == docs.columns
    assert all(r.text.strip() and r.n_chars == len(r.text) for r in line_stage(docs).collect())


def test_automaton_agrees_with_edit_distance(spark):
    rng = random.Random(2)
    pairs = []
    for _ in range(300):
        a = "".join(rng.choice("abé") for _ in range(rng.randint(1, 14)))
        pairs.append((a, edited(rng, a + "z", rng.randint(0, 4))))
    df = spark.createDataFrame(pairs, "a string, b string")
    for k in (1, 2, 3):
        assert df.filter(within_edits(F.col("a"), F.col("b"), k) != (F.levenshtein("a", "b") <= k)).count() == 0


def test_the_bitmap_of_ids_loses_no_line(spark):
    from arrivals.llm.lines import _with_ids

    lines = spark.range(-5000, 5000).select(F.xxhash64("id").alias("lid"), F.col("id").cast("string").alias("line"))
    for n in (0, 1, 3000):
        ids = lines.limit(n).select("lid")
        want = {r.lid for r in ids.collect()}
        for most_bits in (1 << 15, 1 << 29):
            assert {r.lid for r in _with_ids(lines, ids, most_bits).collect()} == want


def test_texts_meet_the_bitmap_before_they_move(spark):
    """Only lines that pass the bitmap may reach the join with the ids, also where the ids are too many for a broadcast."""
    from arrivals.llm.lines import _with_ids

    lines = spark.range(3000).select(F.xxhash64("id").alias("lid"), F.col("id").cast("string").alias("line"))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = _with_ids(lines, lines.limit(100).select("lid"))
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert found.count() == 100
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    joins = [x for x in plan.splitlines() if "Join" in x]
    assert len(joins) == 2 and "lid#" in joins[0] and "part#" in joins[1]


def test_pieces_are_cut_by_characters(spark):
    """Characters of one to four bytes, and bytes that are no text, stand in the pieces as one character each."""
    stem = "a line of ordinary letters with é, 日本 and 👍🏽 in the middle of it"
    rows = [(0, stem), (1, stem.replace("é", "e")), (2, stem.replace("👍", "")), (3, "𝄞" + stem), (4, stem[:-1] + "日"),
            (5, stem.replace("日本", "xy")), (6, stem.replace("日本", "xyz")), (7, "👍" * 40), (8, "👍" * 38)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert order([(r.doc_id, r.kept_text) for r in dedup_lines(docs).collect()]) == order(brute(rows, LineParams()))
    broken = spark.sql("select 1L as doc_id, cast(unhex(repeat('C328', 40)) as string) as text")
    assert [r.n_removed for r in dedup_lines(broken).collect()] == [0]
