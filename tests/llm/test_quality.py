"""op8 against a plain Python version, and its SQL on the driver tables."""

import re
from collections import Counter

from arrivals.llm.quality import BOILERPLATE, NAVIGATION, SYMBOLS, clean_lines, quality_stage
from tests.llm.cases import edge_docs, edge_rows, empty_docs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def fails(line):
    n, low = len(WORD.findall(line)), line.lower()
    if not n:
        return False
    return (
        (n < 6 and not re.search(r"[.!?:;…]['\")\]”»]*[ \t\r]*$", line))
        or sum(c in "!?" for c in line) > 0.5 * n
        or sum(c in "|>" for c in line) >= 2
        or any(x in low for x in NAVIGATION + BOILERPLATE)
    )


def brute(text):
    text = text or ""
    words, lines = WORD.findall(text), text.split("\n")
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(windows)
    repeated = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(3)}
    worded = [x for x in lines if WORD.search(x)]
    good = [x for x in lines if not fails(x)]
    chars = sum(map(len, words))
    kept_chars = sum(len(w) for x in good for w in WORD.findall(x))
    failed = len(words) < 50 or 100 * len(repeated) > 50 * len(words)
    return (len(words), chars, sum(c in SYMBOLS for c in text), len(worded) - len(set(worded)), len(repeated), failed,
            not failed and chars - kept_chars <= 0.5 * chars, "\n".join(good))


COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "cleaned_text")
LONG = "".join(f"Sentence {i} of page{i} holds{i} some{i} handful{i} of{i} words{i}, ended{i} well.\n" for i in range(12))
TEXTS = [
    LONG, "Home | About | Contact\n" * 40, LONG + "Click here for more of this\nAll rights reserved.\n",
    "a b c " * 60, "\n".join(f"word{i} and more text of line {i}." for i in range(30)), "WHAT!! NOW!! " * 40,
    "menu\n" * 70 + LONG, "Tabs\tand\x0bother\x0cblanks\rcount # * $ % & | < >.", LONG + "“Quoted end.”\nshort\n",
]


def test_matches_plain_python(spark):
    texts = TEXTS + [r[1] for r in edge_rows()]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: tuple(r[c] for c in COLUMNS) for r in clean_lines(docs).collect()}
    assert got == {i: brute(t) for i, t in enumerate(texts)}


def test_clashing_columns_nulls_and_empty_table(spark):
    docs = edge_docs(spark, ("kept", "n_words", "__other"))
    out = clean_lines(docs)
    assert out.schema["kept"].dataType.simpleString() == "boolean"
    assert out.count() == docs.count()
    assert clean_lines(empty_docs(spark)).collect() == []


def test_stage_keeps_clean_documents_whole(spark):
    docs = spark.createDataFrame(
        [(i, t, "en", "s", len(t)) for i, t in enumerate(TEXTS)], "doc_id long, text string, lang string, source string, n_chars long")
    out = {r.doc_id: r for r in quality_stage(docs).collect()}
    assert quality_stage(docs).columns == docs.columns
    assert out[0].text == LONG and out[0].n_chars == len(LONG)
    assert 1 not in out and 3 not in out and 5 not in out
    assert "Click here" not in out[2].text and out[2].n_chars == len(out[2].text)


def test_no_python_in_the_plan(spark):
    plan = clean_lines(edge_docs(spark))._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
    assert "Exchange" not in plan
