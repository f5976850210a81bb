"""op9: targets against plain water filling, rounding against its bounds."""

from collections import defaultdict

import pytest

from arrivals.llm.mixing import mix, mixing_stage
from tests.llm.cases import edge_docs, empty_docs


def targets(sizes, most=3.0):
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        free = [s for s in order if s not in capped]
        left = total - sum(most * sizes[s] for s in capped)
        unit = left / sum(weight[s] for s in free) if free else 0
        above = {s for s in free if weight[s] * unit > most * sizes[s]}
        if not above:
            return {s: most * sizes[s] if s in capped else weight[s] * unit for s in order}
        capped |= above


def check(rows, slack):
    sizes, taken, seen = defaultdict(int), defaultdict(int), {}
    for r in rows:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        seen[r.source] = (r.source_size, r.target)
        assert r.taken <= 3 * r.size and (r.size == 0 or r.taken % r.size == 0)
    for s, t in targets(sizes).items():
        assert seen[s][0] == sizes[s]
        assert seen[s][1] == pytest.approx(t)
        assert abs(taken[s] - t) <= slack(s)


def test_targets_and_rounding(spark):
    rows = []
    for s, n in (("a", 400), ("b", 60), ("c", 3), (None, 200), ("d", 150)):
        rows += [(len(rows) + i, "w " * (1 + (i * 7919) % 97), s) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = mix(docs.repartition(4))
    first = out.select("doc_id", "source", "size", "source_size", "target", "taken").collect()
    check(first, lambda s: 97 if s == "c" else 5)
    again = mix(docs.repartition(7)).select("doc_id", "taken").collect()
    assert sorted((r.doc_id, r.taken) for r in first) == sorted((r.doc_id, r.taken) for r in again)


def test_a_hot_cell_of_equal_documents(spark):
    rows = [(i, "same words here", "hot" if i % 3 else f"s{i % 5}") for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    check(mix(docs).collect(), lambda s: 3)


def test_odd_rows_clashes_and_empty_table(spark):
    docs = edge_docs(spark, ("size", "target", "__note"))
    out = mix(docs)
    assert out.columns == [c for c in docs.columns if c not in ("size", "target")] + [
        "size", "source_size", "target", "rate", "copies", "taken"]
    assert out.count() == docs.count()
    assert mix(empty_docs(spark)).collect() == []
    assert mixing_stage(empty_docs(spark)).collect() == []
    stage = mixing_stage(docs)
    assert stage.columns == docs.columns
    assert stage.count() == out.selectExpr("sum(copies) AS n").first().n


def test_no_python_in_the_plan(spark):
    plan = mix(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
