"""Quality rules, line first, in built-in column functions only.

Each line is judged on its own (punctuation, navigation, boilerplate); failing
lines are removed, and a document that loses too much of its text is rejected.
A few document-level base statistics are computed beside it.

Edge cases: a null text counts as empty; an empty or blank text has no words,
so it fails the base rule; repeated rows are judged one by one alike; an empty
table gives an empty result. Only ``text`` is read, so nulls and clashing names
in other columns do not matter (the columns this operator adds replace
same-named ones of the input).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import bind, text_or_empty, words

SYMBOLS = "#*$%&|<>"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
ADDED = ("cleaned_text", *COUNTS, "base_failed", "lost_share", "kept")

# Fixed phrases of page furniture, lower case.
NAVIGATION = ("click here", "read more", "sign in", "log in", "sign up", "next page", "previous page", "back to top",
              "skip to", "main menu", "site map", "share this")
BOILERPLATE = ("cookie", "privacy policy", "terms of use", "terms of service", "all rights reserved", "javascript",
               "lorem ipsum", "powered by", "subscribe to", "newsletter", "copyright", "licensed under",
               "released under the")
SENTENCE_END = r"[.!?:;\x{2026}]['\")\]\x{201d}\x{00bb}]*[ \t\r]*$"


@dataclass(frozen=True)
class LineRules:
    """Thresholds of the line rules and of the document verdict."""

    short_words: int = 6        # a line with fewer words must end a sentence
    max_separators: int = 2     # as many '|' or '>' or more make a line navigation
    max_shouts_per_word: float = 0.5  # '!' and '?' per word
    max_lost: float = 0.5       # share of word characters a document may lose
    min_words: int = 50
    max_repeat_share: float = 0.5


def _count(text: Column, chars: str) -> Column:
    """Occurrences of the given ASCII characters (chained replaces are byte scans)."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def _any_phrase(text: Column, phrases: tuple[str, ...]) -> Column:
    return reduce(or_, (F.contains(text, F.lit(p)) for p in phrases))


def word_chars(tokens: Column) -> Column:
    """Code points in a list of words."""
    return F.aggregate(tokens, F.lit(0).cast("long"), lambda n, w: n + F.length(w))


def judged_line(line: Column) -> Column:
    """A line with its words and its lower-case form, computed once for all rules."""
    return F.struct(line.alias("line"), words(line).alias("words"), F.lower(line).alias("low"))


def line_fails(x: Column, rules: LineRules = LineRules()) -> Column:
    """True for a judged line with words that breaks the punctuation, navigation or boilerplate rule."""
    n = F.size(x["words"])
    punctuation = ((n < rules.short_words) & ~x["line"].rlike(SENTENCE_END)) | (
        _count(x["line"], "!?") > rules.max_shouts_per_word * n
    )
    navigation = (_count(x["line"], "|>") >= rules.max_separators) | _any_phrase(x["low"], NAVIGATION)
    return (n > 0) & (punctuation | navigation | _any_phrase(x["low"], BOILERPLATE))


def repeated_words(tokens: Column, n: int = 3) -> Column:
    """Words covered by an ``n``-word window that occurs twice or more in the same text.

    Windows are compared by 64-bit hash. Texts without a repeated window (seen
    by counting distinct hashes) stop there; otherwise (hash, start) pairs are
    sorted, equal neighbours give the repeated starts, and the covered words
    are summed over the sorted starts: linear memory and n log n time for any
    text.
    """
    count = F.size(tokens)
    hashes = F.transform(
        F.sequence(F.lit(0), count - n),
        lambda i: F.xxhash64(*[F.get(tokens, i + j) for j in range(n)]),
    )

    def covered(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        starts = bind(pairs, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda p, k: (p["h"] == F.get(s, k - 1)["h"]) | (p["h"] == F.get(s, k + 1)["h"])),
            lambda p: p["i"])))
        return F.aggregate(
            starts,
            F.struct(F.lit(0).alias("covered"), F.lit(-n).alias("last")),
            lambda a, s: F.struct(
                (a["covered"] + F.least(F.lit(n), s - a["last"])).alias("covered"), s.alias("last")),
            lambda a: a["covered"],
        )

    return F.when(count < n, F.lit(0)).otherwise(bind(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)),
    )).cast("long")


def document_verdict(text: Column, rules: LineRules = LineRules()) -> Column:
    """A struct with the cleaned text, the base statistics and the verdict of one text.

    It is one self-contained expression: lines and words are bound once, so a
    filter pushed below a projection repeats the verdict, never its parts.
    """

    def verdict(lines: Column, tokens: Column) -> Column:
        good = F.filter(lines, lambda x: ~line_fails(x, rules))
        worded = F.transform(F.filter(lines, lambda x: F.size(x["words"]) > 0), lambda x: x["line"])
        return bind(
            F.struct(
                F.array_join(F.transform(good, lambda x: x["line"]), "\n").alias("cleaned_text"),
                F.size(tokens).cast("long").alias("n_words"),
                word_chars(tokens).alias("word_chars"),
                _count(text, SYMBOLS).cast("long").alias("n_symbols"),
                bind(worded, lambda w: F.size(w) - F.size(F.array_distinct(w))).cast("long").alias("n_dup_lines"),
                repeated_words(tokens).alias("n_repeat_words"),
                F.aggregate(good, F.lit(0).cast("long"), lambda n, x: n + word_chars(x["words"])).alias("kept_chars"),
            ),
            decided,
        )

    def decided(s: Column) -> Column:
        failed = (s["n_words"] < rules.min_words) | (
            s["n_repeat_words"] > rules.max_repeat_share * s["n_words"])
        lost = s["word_chars"] - s["kept_chars"]
        return F.struct(
            *[s[c].alias(c) for c in ("cleaned_text", *COUNTS)],
            failed.alias("base_failed"),
            F.when(s["word_chars"] > 0, lost / s["word_chars"]).otherwise(F.lit(0.0)).alias("lost_share"),
            (~failed & (lost <= rules.max_lost * s["word_chars"])).alias("kept"),
        )

    lines = F.transform(F.split(text, "\n"), judged_line)
    return bind(lines, lambda ls: bind(
        F.flatten(F.transform(ls, lambda x: x["words"])), lambda tokens: verdict(ls, tokens)))


def clean_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """``docs`` plus ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (long), ``base_failed``,
    ``cleaned_text`` (failing lines removed), ``lost_share`` and ``kept``.

    One narrow stage: no shuffle and no Python, so documents of any length and
    any skew stay in their scan task.
    """
    df = docs.withColumn("__llm_q", document_verdict(text_or_empty(F.col("text")), rules))
    return df.withColumns({c: F.col("__llm_q")[c] for c in ADDED}).drop("__llm_q")


def quality_stage(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The documents that pass, with their failing lines removed and ``n_chars`` (if present) of the new text."""
    columns = docs.columns
    # Each text is judged once: a filter beside a projection would repeat the verdict, a list of none or one does not.
    verdict = F.filter(F.array(document_verdict(text_or_empty(F.col("text")), rules)), lambda v: v["kept"])
    kept = docs.select("*", F.explode(verdict).alias("__llm_q")).withColumn("text", F.col("__llm_q")["cleaned_text"])
    if "n_chars" in columns:
        kept = kept.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return kept.select(*columns)
