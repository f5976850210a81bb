"""A4/Q3/S5 as mergeable column profiles.

A profile is kept as *state*: one row per (part, column) whose counts, extremes
and distinct sketch merge by a small aggregate, so the profile of many months
(or files) comes from their stored states without reading the data again. Counts
and extremes are exact; the number of distinct values is a HyperLogLog estimate.

The state counts how many values of a text column each type can hold. Types are
then picked from the merged counts, the narrowest that holds every value, so
the result does not depend on partitioning, files or their order.

The columns are stood up as rows, and every different value of a part is judged
once with its count: one narrow aggregate does for any number of columns. Values
are combined map-side, so codes, labels and dates shuffle few rows; a column of
unique values shuffles each of them once.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The lattice, narrowest first; a column of no value is text. An int is a long, a decimal and a double, a date a timestamp.
LATTICE: dict[str, T.DataType] = {
    "int": T.IntegerType(), "long": T.LongType(), "integral": T.DecimalType(38, 0), "double": T.DoubleType(),
    "date": T.DateType(), "timestamp": T.TimestampType(), "boolean": T.BooleanType(),
}
_COUNTS = ["n_rows", "n_null", *[f"n_{t}" for t in LATTICE]]


# What a text must look like before a cast is tried. A cast that fails raises and catches an exception in the
# task, which costs far more than the match; a text that matches none of these is refused by the cast in every case.
_BLANK = r"[\x00-\x20\x7F]*"  # what casts to a number trim
_WHOLE = rf"\A{_BLANK}[+-]?[0-9]+{_BLANK}\z"
_FITS_LONG = rf"\A{_BLANK}[+-]?0*[0-9]{{1,18}}{_BLANK}\z"
_SHORT = rf"\A{_BLANK}[+-]?0*[0-9]{{1,38}}{_BLANK}\z"
_FLOAT = (
    rf"\A{_BLANK}[+-]?(?:(?:(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
    r"|0[xX][0-9a-fA-F]*\.?[0-9a-fA-F]*[pP][+-]?[0-9]+)[fFdD]?|(?i:nan|inf|infinity))"
    rf"{_BLANK}\z"
)


def _as_long(c: Column) -> Column:
    """``c.try_cast("long")`` without a failing cast: a text beyond 18 digits goes through a decimal."""
    wide = F.when(c.rlike(_SHORT), c.try_cast(T.DecimalType(38, 0)))
    in_range = wide.between(F.lit(-(1 << 63)), F.lit((1 << 63) - 1))
    return F.when(c.rlike(_FITS_LONG), c.try_cast("long")).when(in_range, wide.cast("long"))


def _holds(c: Column, kind: str) -> Column:
    """Whether a text value can be read as a type (a null: no)."""
    if kind == "boolean":
        return F.coalesce(F.lower(c).isin("true", "false"), F.lit(False))
    if kind == "integral":  # not by cast, which would round fractions
        return F.coalesce(c.rlike(r"^\s*[+-]?\d{1,38}\s*$"), F.lit(False))
    if kind == "long":
        return _as_long(c).isNotNull()
    if kind == "int":
        return F.coalesce(_as_long(c).between(-(1 << 31), (1 << 31) - 1), F.lit(False))
    if kind == "double":
        return F.when(c.rlike(_FLOAT), c.try_cast("double")).isNotNull()
    held = c.try_cast(LATTICE[kind]).isNotNull()
    if kind == "date":  # the cast would drop a time of day
        return held & c.rlike(r"^\s*[+-]?\d{4,}(-\d{1,2}){0,2}\s*$")
    return held


def _stood_up(df: DataFrame, by: list[str], names: list[str]) -> DataFrame:
    """One row per row and column: by..., __i (the column's place in ``names``), __value as text."""
    pairs = [x for i, n in enumerate(names) for x in (F.lit(i), F.col(f"`{n}`").cast("string"))]
    return df.select(*[F.col(f"`{c}`") for c in by], F.stack(F.lit(len(names)), *pairs).alias("__i", "__value"))


def _judged(values: DataFrame) -> DataFrame:
    """With __kinds: a bit per type of the lattice that holds the value."""
    bits = [F.when(_holds(F.col("__value"), t), F.lit(1 << k)).otherwise(F.lit(0)) for k, t in enumerate(LATTICE)]
    return values.withColumn("__kinds", reduce(lambda a, b: a.bitwiseOR(b), bits))


def _kind_counts(n: Column) -> list[Column]:
    """Per type, the sum of ``n`` over the values it holds."""
    zero = F.lit(0).cast("long")
    return [F.sum(F.when(F.col("__kinds").bitwiseAND(F.lit(1 << k)) != 0, n).otherwise(zero)).alias(f"n_{t}")
            for k, t in enumerate(LATTICE)]


def profile_state(df: DataFrame, by: Iterable[str] = (), columns: Iterable[str] | None = None) -> DataFrame:
    """One row per part (the values of ``by``) and column:

    ``by..., column_name, n_rows, n_null, n_int, ..., n_boolean, least, greatest, sketch``. Values are compared as text.
    """
    by = list(by)
    names = list(columns) if columns is not None else [c for c in df.columns if c not in by]
    parts, n = [F.col(f"`{c}`") for c in by], F.col("__n")
    values = _stood_up(df, by, names).groupBy(*parts, "__i", "__value").agg(F.count(F.lit(1)).alias("__n"))
    if not by:  # the whole is a part even without a row
        values = values.unionByName(df.sparkSession.range(len(names)).select(
            F.col("id").cast("int").alias("__i"), F.lit(None).cast("string").alias("__value"),
            F.lit(0).cast("long").alias("__n")))
    zero = F.lit(0).cast("long")
    states = _judged(values).groupBy(*parts, "__i").agg(
        F.sum(n).alias("n_rows"), F.sum(F.when(F.col("__value").isNull(), n).otherwise(zero)).alias("n_null"),
        *_kind_counts(n), F.min("__value").alias("least"), F.max("__value").alias("greatest"),
        F.hll_sketch_agg("__value").alias("sketch"))
    name = F.element_at(F.array(*[F.lit(c) for c in names]), F.col("__i") + 1).alias("column_name")
    return states.select(*parts, name, *_COUNTS, "least", "greatest", "sketch")


def merge_states(states: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """States of the same columns merged into one per part of ``by`` and column."""
    return states.groupBy(*by, "column_name").agg(
        *[F.sum(c).alias(c) for c in _COUNTS], F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("sketch").alias("sketch"))


def column_profile(states: DataFrame, by: Iterable[str] = ()) -> DataFrame:
    """The profile itself: by..., column_name, n_rows, n_null, least, greatest, n_distinct (an estimate), narrowest_type."""
    merged = merge_states(states, by)
    n_values = F.col("n_rows") - F.col("n_null")
    narrowest = F.lit("string")
    for kind in reversed(LATTICE):
        narrowest = F.when((n_values > 0) & (F.col(f"n_{kind}") == n_values), F.lit(LATTICE[kind].simpleString())).otherwise(
            narrowest)
    return merged.select(*by, "column_name", "n_rows", "n_null", "least", "greatest",
                         F.hll_sketch_estimate("sketch").alias("n_distinct"), narrowest.alias("narrowest_type"))


def infer_types(df: DataFrame, columns: Iterable[str] | None = None) -> T.StructType:
    """The narrowest type of every text column of ``df``, in one pass (one small row per column comes back)."""
    names = list(columns) if columns is not None else df.columns
    one = F.lit(1).cast("long")
    judged = _judged(_stood_up(df, [], names)).groupBy("__i").agg(F.count("__value").alias("n"), *_kind_counts(one))
    found = {r["__i"]: r for r in judged.collect()}
    fields = []
    for i, name in enumerate(names):
        row = found.get(i)
        kind = next((t for t in LATTICE if row and row["n"] and row[f"n_{t}"] == row["n"]), None)
        fields.append(T.StructField(name, LATTICE[kind] if kind else T.StringType()))
    return T.StructType(fields)
