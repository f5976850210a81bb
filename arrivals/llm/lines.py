"""Line dedup: a segment-partition edit-distance join over the corpus' distinct lines, in DataFrame operations only.

A line is a run between newlines that has a word. An occurrence of a line is
removed if the same line occurs earlier (smaller doc_id, or smaller line number
in texts of one doc_id, or smaller hash of the text), or if a different line
within ``threshold`` edits of it first occurs earlier. Lines shorter than ``min_fuzzy`` characters are compared exactly only
(a few edits change a short line's meaning).

Method: distinct lines are cut into ``threshold + 1`` segments. Within
``threshold`` edits one segment stays whole, so segments are indexed by
(length, segment number, content) and every line probes, for each length it
may match, the few substrings that the multi-match-aware windows allow. The
surviving pairs are verified by a banded bit-parallel edit automaton.

A segment shared by many lines (a template) pairs them all. Every line has a
profile, its counts of common letters: an edit changes them by at most two in
sum, so the profiles of lines within ``threshold`` edits differ by at most
``2 * threshold``. For crowded keys that test is part of the join, so only
pairs that pass it leave the join; for all others it comes before the
verification. It never drops a true pair.

Edge cases: a null or blank text has no lines; rows with equal doc_id and text
are one document and share its result; a null doc_id counts as the largest;
an empty table gives an empty result; only doc_id and text are read, so nulls
and clashing names in other columns do not matter.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import BLANKS, bind, text_or_empty, written
from arrivals.operators.key_index import bit_of


# Letters whose counts make the profile: common ones of the Latin alphabet, and the blank.
LETTERS = " etaoinshrdlucmg"


@dataclass(frozen=True)
class LineParams:
    threshold: int = 2
    min_fuzzy: int = 30     # characters
    hot_pairs: int = 256    # pairs of one key's lines beyond which the profile joins in


def _place(doc_id: Column, pos: Column, doc_hash: Column) -> Column:
    """Where a line stands, as one number (a decimal keeps the aggregation hash-based): the document's id, the
    line's number, and 30 bits of the text's hash, as different texts may share an id."""
    doc = F.coalesce(doc_id.cast("long"), F.lit(2**63 - 1)).cast("decimal(19,0)")
    within = F.shiftleft(pos.cast("long"), 30).bitwiseOR(F.shiftrightunsigned(doc_hash, 34))
    return (doc * F.lit(2**61).cast("decimal(19,0)") + within.cast("decimal(19,0)")).cast("decimal(38,0)")


def _has_word(text: Column) -> Column:
    return F.ltrim(text, F.lit(BLANKS)) != ""  # unlike trim, it stops at the first other character


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, doc_hash, pos, line) of every line with a word."""
    text = text_or_empty(F.col("text"))
    rows = docs.select("doc_id", F.xxhash64(text).alias("doc_hash"), F.posexplode(F.split(text, "\n")).alias("pos", "line"))
    return rows.filter(_has_word(F.col("line")))


def distinct_lines(docs: DataFrame) -> DataFrame:
    """(line, first, holder, n, lid, len): each distinct line with its first place, the hash of the one text there
    that holds it (should two texts share a place's 30 bits, either of them), and how often it occurs."""
    place = _place(F.col("doc_id"), F.col("pos"), F.col("doc_hash")).alias("place")
    return (
        occurrences(docs).select("line", "doc_hash", place)
        .groupBy("line").agg(F.min("place").alias("first"), F.min_by("doc_hash", "place").alias("holder"), F.count("*").alias("n"))
        .select("line", "first", "holder", "n", F.xxhash64("line").alias("lid"), F.length("line").alias("len"))
    )


def _second_id(line: Column) -> Column:
    return F.xxhash64(F.lit(7), line)


def _index_shapes(threshold: int) -> list[tuple[int, int, int]]:
    """(segment, characters the other line is shorter, shift) of what a line is indexed under."""
    return [(i, 0, 0) for i in range(threshold + 1)]


def _probe_shapes(threshold: int) -> list[tuple[int, int, int]]:
    """The same of what it probes: the multi-match-aware windows of each segment of lines no longer than it."""
    out = []
    for shorter in range(threshold + 1):
        for i in range(threshold + 1):
            low = max(-i, shorter - (threshold - i))
            high = min(i, shorter + (threshold - i))
            out += [(i, shorter, shift) for shift in range(low, high + 1)]
    return out


def profile(line: Column) -> Column:
    """How often each of the common letters stands in the line (byte scans, far cheaper than a pass by character)."""
    size = F.octet_length(line)
    return F.struct(*[
        (size - F.octet_length(F.replace(line, F.lit(c), F.lit("")))).alias(f"n{i}") for i, c in enumerate(LETTERS)])


def _may_be_near(a: Column, b: Column, threshold: int) -> Column:
    apart = reduce(add, [F.abs(a[f"n{i}"] - b[f"n{i}"]) for i in range(len(LETTERS))])
    return apart <= 2 * threshold


def _with_ids(lines: DataFrame, ids: DataFrame, most_bits: int = 1 << 29) -> DataFrame:
    """``lines`` whose lid is among the distinct ``ids``: a bitmap of hashed ids drops nearly all other lines before the
    join moves any text. It has 16 bits an id, 64 MB at most (beyond, it lets more lines pass), and is broadcast."""
    bits = 1 << 15
    while bits < min(16 * ids.count(), most_bits):
        bits *= 2
    slot = lambda lid: F.pmod(F.xxhash64(F.lit(3), lid), F.lit(bits))
    bitmap = ids.select(slot(F.col("lid")).alias("slot")).groupBy(F.expr("slot div 32768").alias("part")).agg(
        F.bitmap_construct_agg(F.col("slot") % 32768).alias("bitmap"))
    slotted = lines.withColumn("slot", slot(F.col("lid")))
    maybe = slotted.join(F.broadcast(bitmap), F.expr("slot div 32768") == F.col("part")).filter(
        bit_of(F.col("bitmap"), F.col("slot") % 32768))
    # An inner join: Spark would push a semi-join below the bitmap, and every text would move.
    return maybe.select(*lines.columns).join(ids, "lid")


def _pieces(rows: DataFrame, shapes: list[tuple[int, int, int]], parts: int) -> DataFrame:
    """(lid, chars, target, i, start, size) from rows (lid, chars, len): one row per line and shape, not yet cut.

    A segment is an even share of the line; the last ``length mod parts`` segments are one character longer.
    """
    listed = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(d).alias("shorter"), F.lit(s).alias("shift")) for i, d, s in shapes])
    df = rows.withColumn("shape", F.explode(listed)).select("lid", "chars", "len", "shape.*")
    df = df.withColumn("target", F.col("len") - F.col("shorter"))
    longer = F.col("target") % parts
    base = F.expr(f"target div {parts}").cast("int")
    start = base * F.col("i") + F.greatest(F.lit(0), longer + F.col("i") - parts) + F.col("shift")
    size = base + (longer >= parts - F.col("i")).cast("int")
    df = df.withColumns({"start": start, "size": size})
    df = df.filter((F.col("target") >= parts) & (F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("len")))
    return df.select("lid", "chars", "target", "i", "start", "size")


def _keyed(pieces: DataFrame) -> DataFrame:
    """(lid, target, i, key): the pieces cut and hashed."""
    piece = F.substring("chars", 4 * F.col("start") + 1, 4 * F.col("size"))
    return pieces.select("lid", "target", "i", F.xxhash64("target", "i", piece).alias("key"))


def _paired(index: DataFrame, probes: DataFrame, near: Column) -> DataFrame:
    a, b = (x.select("key", *[F.col(c).alias(f"{c}_{side}") for c in x.columns if c != "key"])
            for x, side in ((index, "a"), (probes, "b")))
    pairs = a.join(b, (a["key"] == b["key"]) & (F.col("lid_a") != F.col("lid_b")) & near)
    return pairs.select(F.least("lid_a", "lid_b").alias("a"), F.greatest("lid_a", "lid_b").alias("b")).distinct()


def candidate_pairs(lines: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """Distinct (a, b) line ids that share an indexed segment (and, on hot segments, have near profiles)."""
    # Four bytes a character: a piece is a slice of bytes, where a string would be searched for its start.
    rows = lines.filter(F.col("len") >= p.min_fuzzy).select("lid", F.encode("line", "UTF-32").alias("chars"), "len")
    pieces = [_pieces(rows, shapes(p.threshold), p.threshold + 1) for shapes in (_index_shapes, _probe_shapes)]
    index, probes = (_keyed(x).select("lid", "key") for x in pieces)
    crowded = F.col("count") * F.col("count") > p.hot_pairs
    hot = written(_keyed(pieces[0]).groupBy("key", "target", "i").count().filter(crowded).drop("count"), "lines-hot")
    if hot.isEmpty():
        return _paired(index, probes, F.lit(True))
    cold = _paired(*[x.join(hot, "key", "left_anti") for x in (index, probes)], F.lit(True))
    # Only pieces of a crowded length and segment are cut again.
    spots = hot.select("target", "i").distinct()
    hot_rows = [
        written(_keyed(x.join(spots, ["target", "i"], "left_semi")).join(hot, "key", "left_semi").select("lid", "key"),
                "lines-hot-rows") for x in pieces]
    ids = written(hot_rows[0].select("lid").union(hot_rows[1].select("lid")).distinct(), "lines-hot-ids")
    signed = written(_with_ids(lines, ids).select("lid", profile(F.col("line")).alias("profile")), "lines-signed")
    near = _may_be_near(F.col("profile_a"), F.col("profile_b"), p.threshold)
    return cold.union(_paired(*[x.join(signed, "lid") for x in hot_rows], near)).distinct()


def within_edits(a: Column, b: Column, threshold: int) -> Column:
    """True if two strings are within ``threshold`` edits.

    Row ``e`` of the automaton is a bit mask over the diagonals of the band:
    bit ``d + threshold`` is set when the first ``j`` characters of ``b`` align
    with the first ``j + d`` of ``a`` at no more than ``e`` edits. One step per
    character of ``b`` updates all diagonals of a row at once.
    """
    width = 2 * threshold + 1
    full = (1 << width) - 1

    def insertions(r: list[Column]) -> list[Column]:
        for e in range(1, threshold + 1):  # skipping a character of `a` raises the diagonal
            r[e] = r[e].bitwiseOR(F.shiftleft(r[e - 1], 1)).bitwiseAND(F.lit(full))
        return r

    def states(r: list[Column]) -> Column:
        return F.struct(*[x.alias(f"r{e}") for e, x in enumerate(r)])

    def run(x: Column, y: Column) -> Column:
        def step(acc: Column, j: Column) -> Column:
            c = F.get(y, j)
            match = F.lit(0)
            for d in range(-threshold, threshold + 1):
                same = (j + d >= 0) & F.coalesce(F.get(x, j + d) == c, F.lit(False))
                match = match.bitwiseOR(F.when(same, F.lit(1 << (d + threshold))).otherwise(F.lit(0)))

            def advance(m: Column) -> Column:
                old = [acc[f"r{e}"] for e in range(threshold + 1)]
                new = [old[0].bitwiseAND(m)]
                for e in range(1, threshold + 1):
                    new.append(
                        old[e].bitwiseAND(m).bitwiseOR(old[e - 1]).bitwiseOR(F.shiftright(old[e - 1], 1)))
                return states(insertions(new))

            return bind(match, advance)

        start = states(insertions([F.lit(1 << threshold)] + [F.lit(1 << threshold)] * threshold))
        diagonal = F.size(x) - F.size(y) + threshold
        return F.aggregate(
            F.sequence(F.lit(0), F.size(y) - 1), start, step,
            lambda acc: F.shiftright(F.lit(0) + acc[f"r{threshold}"], 0).bitwiseAND(
                F.pow(F.lit(2), diagonal).cast("int")) != 0)

    close = F.abs(F.length(a) - F.length(b)) <= threshold
    chars = F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"))
    return close & F.when(F.length(b) == 0, close).otherwise(bind(chars, lambda s: run(s["x"], s["y"])))


def line_links(lines: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """(lid, lid2): the lines with a different line within the threshold before them (at one place: of a smaller id)."""
    pairs = written(candidate_pairs(lines, p), "lines-candidates")
    ids = written(pairs.select(F.explode(F.array("a", "b")).alias("lid")).distinct(), "lines-paired")
    texts = _with_ids(lines, ids).select("lid", "line", "first", profile(F.col("line")).alias("profile"))
    texts = written(texts, "lines-texts")
    a, b = (texts.select(F.col("lid").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in ("line", "first", "profile")])
            for c in ("a", "b"))
    close = _may_be_near(F.col("profile_a"), F.col("profile_b"), p.threshold)
    near = pairs.join(a, "a").join(b, "b").filter(
        close & F.when(close, within_edits(F.col("line_a"), F.col("line_b"), p.threshold)))
    b_later = F.col("first_a") <= F.col("first_b")
    later = F.when(b_later, F.col("line_b")).otherwise(F.col("line_a"))
    return near.select(F.when(b_later, F.col("b")).otherwise(F.col("a")).alias("lid"), _second_id(later).alias("lid2"))


def dedup_lines(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """``docs`` plus ``n_lines, n_removed`` (long, lines with a word) and ``kept_text``."""
    lines = written(distinct_lines(docs), "lines-distinct")
    linked = line_links(lines, p).distinct().withColumn("linked", F.lit(True))
    # A line that occurs once and has no near line before it stays: most lines need no verdict.
    verdicts = written(
        lines.select("lid", _second_id(F.col("line")).alias("lid2"), "first", "holder", "n").join(linked, ["lid", "lid2"], "left")
        .withColumn("linked", F.coalesce("linked", F.lit(False))).filter("linked or n > 1").drop("n"),
        "lines-verdicts")
    seen = occurrences(docs).select(
        F.col("doc_id").alias("__llm_doc"), F.col("doc_hash").alias("__llm_hash"), "pos",
        F.xxhash64("line").alias("lid"), _second_id(F.col("line")).alias("lid2"))
    place = _place(F.col("__llm_doc"), F.col("pos"), F.col("__llm_hash"))
    gone = (
        seen.join(verdicts, ["lid", "lid2"])
        .filter(F.col("linked") | (place != F.col("first")) | (F.col("__llm_hash") != F.col("holder")))
        .select("__llm_doc", "__llm_hash", "pos").distinct()
        .groupBy("__llm_doc", "__llm_hash").agg(F.sort_array(F.collect_list("pos")).alias("__llm_gone"))
    )
    keyed = docs.withColumn("__llm_text", text_or_empty(F.col("text"))).withColumn("__llm_own", F.xxhash64("__llm_text"))
    joined = keyed.join(gone, F.col("doc_id").eqNullSafe(F.col("__llm_doc")) & (F.col("__llm_own") == F.col("__llm_hash")), "left")

    def flags(positions: Column) -> Column:
        return F.flatten(F.transform(positions, lambda p, k: F.concat(
            F.array_repeat(F.lit(False), p - F.coalesce(F.get(positions, k - 1), F.lit(-1)) - 1), F.array(F.lit(True)))))

    kept = F.when(F.col("__llm_gone").isNull(), F.col("__llm_text")).otherwise(bind(
        flags(F.col("__llm_gone")),
        lambda removed: F.array_join(
            F.filter(F.split("__llm_text", "\n"), lambda _, i: ~F.coalesce(F.get(removed, i), F.lit(False))), "\n")))
    n_lines = F.size(F.filter(F.split("__llm_text", "\n"), _has_word))
    own = [c for c in docs.columns if c not in ("n_lines", "n_removed", "kept_text")]
    return joined.select(
        *own, n_lines.cast("long").alias("n_lines"),
        F.coalesce(F.size("__llm_gone"), F.lit(0)).cast("long").alias("n_removed"), kept.alias("kept_text"))


def line_stage(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """The documents with duplicate lines removed; a document left without any word goes."""
    out = dedup_lines(docs, p).withColumn("text", F.col("kept_text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.filter(_has_word(F.col("text"))).select(*docs.columns)
