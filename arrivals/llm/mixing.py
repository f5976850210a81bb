"""Mixing sources to target weights by entropy balancing, in DataFrame operations only.

Sources share the corpus' words in proportion to their weights, none above
``max_repeat`` times its own size. The document rates that meet these word
constraints while staying closest (in relative entropy over words) to the
corpus are exponential tilts ``r = exp(lambda_source)``; the multipliers are
found by Newton's method on the convex dual, each step aggregating gradient
and curvature from the corpus. Rates are then rounded into whole copies.

Rounding: a document gets ``floor(r)`` copies and some documents one more.
Documents are viewed as cells of equal (source, size). Going down the sizes,
each cell gets its systematic share of extra copies; the remaining word error of
a source is then reduced by a few single-document corrections, each taking
(or giving back) the largest document that still fits the error. Within a
cell the documents that come first by MD5 of doc_id are taken.

Edge cases: a null or blank text has size 0 and is taken 0 words; a null source
is a source of its own, ordered last; a null doc_id hashes like a value;
repeated rows are separate rows (which of two equal rows is taken does not
matter); an empty table gives an empty result; columns of the input that clash
with the added ones are replaced. Hot sources cost nothing extra: only counts
per (source, size) cross the shuffle for the rates, and ranks are taken within
(source, size, salt) groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty, words, written



def source_targets(sizes: DataFrame, max_repeat: float = 3.0) -> DataFrame:
    """(source, s_size, target) from one row per source: weights 1, 2, 3 repeating in source order.

    The shares level out like water: a source is capped if its cap is met
    below the common level. In the order of cap per weight, a source is capped
    iff its cap is at most its share of what the sources before it left.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    df = sizes.withColumn("weight", (F.row_number().over(order) - 1) % 3 + 1)
    df = df.withColumn("cap", max_repeat * F.col("s_size"))
    every = Window.partitionBy()
    before = (
        Window.orderBy((F.col("cap") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    left = F.sum("s_size").over(every) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weights = F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    df = df.withColumn("capped", F.col("cap") <= F.col("weight") * left / weights)
    taken = F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(every), F.lit(0.0))
    rest = F.sum(F.when(~F.col("capped"), F.col("weight"))).over(every)
    level = (F.sum("s_size").over(every) - taken) / rest
    target = F.when(F.col("capped"), F.col("cap")).otherwise(F.col("weight") * level)
    return df.select("source", "s_size", target.cast("double").alias("target"))


def entropy_rates(cells: DataFrame, targets: DataFrame, max_steps: int = 60, tolerance: float = 1e-12) -> DataFrame:
    """(source, s_size, target, rate): Newton iterations on the dual, one multiplier per source.

    ``cells`` has (source, size, n). Each step sums words x exp(lambda) over the
    cells (the curvature, and with the target the gradient) and moves every
    multiplier by gradient / curvature. A table is written per step, so steps
    neither nest plans nor repeat work after a lost executor.
    """
    live = targets.filter("target > 0")
    state = written(live.withColumn("lam", F.lit(0.0)), "mix-step")
    for _ in range(max_steps):
        tilted = (
            cells.join(state.select(F.col("source").alias("g"), "lam"), F.col("source").eqNullSafe(F.col("g")))
            .groupBy("source").agg(F.sum(F.col("n") * F.col("size") * F.exp("lam")).alias("curvature"))
            .withColumnRenamed("source", "g")
        )
        gradient = F.col("target") - F.col("curvature")
        state = written(
            state.join(tilted, F.col("source").eqNullSafe(F.col("g"))).select(
                "source", "s_size", "target", (F.col("lam") + gradient / F.col("curvature")).alias("lam"),
                (F.abs(gradient) / F.col("target")).alias("error")),
            "mix-step")
        worst = state.agg(F.max("error")).first()[0]
        if worst is None or worst <= tolerance:
            break
        state = state.drop("error")
    rates = state.select(F.col("source").alias("g"), F.round(F.exp("lam"), 9).alias("rate"))
    return (
        targets.join(rates, F.col("source").eqNullSafe(F.col("g")), "left")
        .select("source", "s_size", "target", F.coalesce("rate", F.lit(0.0)).alias("rate"))
    )


def rounded_cells(cells: DataFrame, rates: DataFrame, corrections: int = 4) -> DataFrame:
    """(source, size, n, s_size, target, rate, extra): how many documents of each cell get one copy more."""
    r = rates.withColumnRenamed("source", "g")
    df = cells.join(r, F.col("source").eqNullSafe(F.col("g"))).drop("g")
    share = F.col("rate") - F.floor("rate")
    down = Window.partitionBy("source").orderBy(F.col("size").desc())
    upto = F.sum("n").over(down.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    df = df.withColumn("upto", F.floor(share * upto + 0.5))
    df = df.withColumn("extra", F.col("upto") - F.coalesce(F.lag("upto").over(down), F.lit(0))).drop("upto")
    own = Window.partitionBy("source")
    for _ in range(corrections):
        words_off = F.sum((share * F.col("n") - F.col("extra")) * F.col("size")).over(own)
        df = df.withColumn("off", words_off)
        fits = (F.col("size") > 0) & (F.col("size") <= F.abs("off")) & (
            F.when(F.col("off") > 0, F.col("extra") < F.col("n")).otherwise(F.col("extra") > 0))
        best = F.max(F.when(fits, F.col("size"))).over(own)
        step = F.when(F.col("size") == best, F.signum("off").cast("long")).otherwise(F.lit(0))
        df = df.withColumn("extra", F.col("extra") + step)
    return df.select("source", "size", "n", "s_size", "target", "rate", F.col("extra").cast("long").alias("extra"))


def _order(doc_id: Column) -> Column:
    return F.md5(F.coalesce(doc_id.cast("string"), F.lit("")))


def _salt(doc_id: Column) -> Column:
    """One of 4096 sub-groups of a cell: the leading digits of the order, so sub-groups keep the order."""
    return F.substring(_order(doc_id), 1, 3)


def _mixed(docs: DataFrame, max_repeat: float) -> DataFrame:
    """``docs`` plus the added columns under private names."""
    sized = docs.withColumns({
        "__llm_size": F.size(words(text_or_empty(F.col("text")))).cast("long"), "__llm_salt": _salt(F.col("doc_id"))})
    salted = written(
        sized.groupBy("source", F.col("__llm_size").alias("size"), F.col("__llm_salt").alias("salt"))
        .agg(F.count("*").alias("n")), "mix-salted")
    cells = written(salted.groupBy("source", "size").agg(F.sum("n").alias("n")), "mix-cells")
    by_source = cells.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("s_size"))
    rates = written(entropy_rates(cells, written(source_targets(by_source, max_repeat), "mix-targets")), "mix-rates")
    plan = written(rounded_cells(cells, rates), "mix-plan")

    # The first `extra` documents of a cell in MD5 order: split them over the salts, then rank.
    before = Window.partitionBy("source", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    per_salt = (
        salted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .select(F.col("source").alias("__llm_c_source"), F.col("size").alias("__llm_c_size"), F.col("salt").alias("__llm_c_salt"),
                "before")
        .join(plan, F.col("__llm_c_source").eqNullSafe(F.col("source")) & (F.col("__llm_c_size") == F.col("size")))
        .select("__llm_c_source", "__llm_c_size", "__llm_c_salt", F.col("s_size").alias("__llm_source_size"),
                F.col("target").alias("__llm_target"), F.col("rate").alias("__llm_rate"),
                (F.col("extra") - F.col("before")).alias("__llm_extra"))
    )
    group = Window.partitionBy("source", "__llm_size", "__llm_salt").orderBy(_order(F.col("doc_id")), "doc_id")
    ranked = sized.withColumn("__llm_rank", F.row_number().over(group)).join(
        per_salt, F.col("source").eqNullSafe(F.col("__llm_c_source")) & (F.col("__llm_size") == F.col("__llm_c_size"))
        & (F.col("__llm_salt") == F.col("__llm_c_salt")))
    copies = F.when(F.col("__llm_size") == 0, F.lit(0)).otherwise(
        F.floor("__llm_rate") + (F.col("__llm_rank") <= F.col("__llm_extra")).cast("long"))
    return ranked.withColumn("__llm_copies", copies.cast("long"))


def mix(docs: DataFrame, max_repeat: float = 3.0) -> DataFrame:
    """``docs`` plus ``size, source_size`` (long), ``target, rate`` (double), ``copies, taken`` (long)."""
    added = {"size": "__llm_size", "source_size": "__llm_source_size", "target": "__llm_target", "rate": "__llm_rate",
             "copies": "__llm_copies"}
    return _mixed(docs, max_repeat).select(
        *[c for c in docs.columns if c not in (*added, "taken")],
        *[F.col(v).alias(k) for k, v in added.items()],
        (F.col("__llm_copies") * F.col("__llm_size")).alias("taken"))


def mixing_stage(docs: DataFrame, max_repeat: float = 3.0) -> DataFrame:
    """Every document repeated by its copies; documents with no copy go."""
    taken = _mixed(docs, max_repeat).filter("__llm_copies > 0")
    return taken.withColumn("__llm_copy", F.explode(F.sequence(F.lit(1), F.col("__llm_copies")))).select(*docs.columns)
