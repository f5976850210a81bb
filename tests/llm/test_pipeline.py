"""The pipeline's stages, each against a plain version on its own input, and the registered queries."""

import random
from collections import Counter

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from tests.llm import test_lines, test_near_dedup, test_quality
from tests.llm.cases import SCHEMA, edge_docs, prose, words
from tests.oracle_util import compare, duck
from arrivals.llm.lines import LineParams

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def corpus():
    rng = random.Random(21)
    item = prose(rng, 40)
    rows = [(i, prose(rng, rng.randint(60, 200))) for i in range(40)]
    near = rows[5][1].split(" ")
    near[30] = "changed"
    rows += [
        (50, rows[3][1]), (51, " ".join(near)), (52, "Home | About | News\n" * 50),
        (53, rows[7][1] + "\n" + item), (54, " ".join(words(rng, 40))), (55, None), (56, rows[8][1] + "\n" + rows[9][1]),
    ]
    return [(d, t, "en", f"src{d % 3}", None if t is None else len(t)) for d, t in rows], item


def test_every_stage_on_its_own_input(spark, tmp_path):
    rows, item = corpus()
    docs = spark.createDataFrame(rows, SCHEMA)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "line_dedup", "near_dedup", "decontamination", "mixing"]
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == COLUMNS
        path = f"{tmp_path}/{name}"
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        after = [(r.doc_id, r.text) for r in docs.collect()]
        assert all(r.n_chars == len(r.text) for r in docs.collect())
        seen[name] = before, after

    before, after = seen["quality_rules"]
    verdicts = {d: test_quality.brute(t) for d, t in before}
    assert dict(after) == {d: v[-1] for d, v in verdicts.items() if v[-2]}
    assert {52, 54, 55}.isdisjoint(dict(after)) and len(after) == 44

    before, after = seen["line_dedup"]
    assert dict(after) == {d: t for d, t in test_lines.brute(before, LineParams()) if t.strip()}

    before, after = seen["near_dedup"]
    label = test_near_dedup.brute_classes(before)
    least = {}
    for (d, _), x in zip(before, label):
        least[x] = min(least.get(x, d), d)
    assert {d for d, _ in after} == set(least.values())

    before, after = seen["decontamination"]
    assert dict(before).keys() - dict(after).keys() == {53}

    before, after = seen["mixing"]
    copies = Counter(d for d, _ in after)
    assert max(copies.values()) <= 3 and set(copies) <= set(dict(before))
    assert all(dict(before)[d] == t for d, t in after)


def test_run_is_repeatable_on_the_driver_tables(spark):
    one = sorted((r.doc_id, r.text) for r in corpus_pipeline.run(spark, SF).collect())
    assert one == sorted((r.doc_id, r.text) for r in entry.queries()["pipeline"](spark, SF).collect())
    assert len(one) > 50


def test_ten_operators_are_registered():
    names = {k.split("_")[0] for k in entry.queries() if k.startswith("op")}
    assert names == {f"op{i}" for i in range(1, 11)}
    assert "pipeline" in entry.queries()


@pytest.mark.parametrize("name", ["op8_quality_rules", "op9_mixing"])
def test_sql_on_the_driver_tables(spark, name):
    ok, message = compare(entry.queries()[name](spark, SF), duck(SF), entry.oracle_sql()[name])
    assert ok, message


def test_stages_on_odd_and_empty_tables(spark, tmp_path):
    spark.createDataFrame([(1, None), (None, "a b c")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    odd = edge_docs(spark, ("size", "kept", "class_id", "item_id", "copies", "bucket", "line", "hash"))
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, odd.limit(0)):
            out = stage(spark, docs, str(tmp_path))
            assert out.columns == odd.columns, name
            rows = out.collect()
            assert len(rows) <= 3 * odd.count() and (docs is odd or not rows), name
