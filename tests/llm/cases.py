"""Small document tables for the llm tests: planted repeats and every odd row."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def words(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(n)]


def prose(rng: random.Random, n: int) -> str:
    out, line = [], []
    for w in words(rng, n):
        line.append(w)
        if len(line) == 12:
            out.append(" ".join(line).capitalize() + ".")
            line = []
    if line:
        out.append(" ".join(line).capitalize() + ".")
    return "\n".join(out)


def edge_rows(seed: int = 1) -> list[tuple]:
    """Clean prose, exact and near copies, a shared passage, and null, blank, repeated, clashing and long rows."""
    rng = random.Random(seed)
    base = [prose(rng, n) for n in (60, 80, 120, 200, 55, 300)]
    passage = prose(rng, 70)
    near = base[3].split(" ")
    near[50] = "changed"
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [
        (10, base[3]), (11, " ".join(near)), (12, base[3]),            # copies, exact and near
        (20, base[0] + "\n" + passage), (21, passage + " " + base[1]),  # a passage in two documents
        (30, None), (31, ""), (32, " \n\t "), (33, "one"), (34, "Été ß ñ ünï 日本語 ✓"),
        (40, base[4]), (40, base[4]),                                  # a repeated row
        (41, base[5][:400]), (41, base[5][200:]),                      # one id, two texts
        (None, base[2]), (None, None),
        (50, "ab " * 400), (51, "x" * 700),                            # runs
        (60, prose(rng, 5000)),                                        # long
    ]
    out = []
    for i, (doc_id, text) in enumerate(rows):
        out.append((doc_id, text, None if i % 7 == 3 else ("en", "fr")[i % 2], None if i % 5 == 4 else f"src{i % 3}",
                    None if text is None else len(text)))
    return out


def edge_docs(spark, extra: tuple[str, ...] = ()):
    """The odd rows as a table, with further string columns of the given (clashing) names."""
    from pyspark.sql import functions as F

    df = spark.createDataFrame(edge_rows(), SCHEMA)
    return df.withColumns({c: F.lit("own") for c in extra}) if extra else df


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
