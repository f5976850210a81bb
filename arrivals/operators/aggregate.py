"""Aggregations (A1-A4).

All are single ``groupBy``/``agg`` plans: Spark combines map-side (partial
aggregate) before the exchange, so a group holding a third of the rows sends
one partial row per map task across the network, not its rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.functions.columns import text_to_double
from arrivals.schemas import sql_string


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def group_avg_first(
    df: DataFrame,
    group: str,
    value: str,
    first: Iterable[str],
    *,
    out_group: str | None = None,
    out_value: str | None = None,
    upper_group: bool = True,
) -> DataFrame:
    """A1: per group, the mean of ``value`` and one representative tuple of ``first``.

    ``value`` may be text (converted, bad text skipped like a null). The
    group key is upper-cased *before* grouping, so case variants of one name
    form one group. The representative tuple is the smallest one whose first
    column is not null: deterministic, and all columns come from the same row
    (a per-column ``first`` has no defined row and may mix rows).
    """
    firsts, g, v = list(first), out_group or group, out_value or value
    key = F.upper(_c(group)) if upper_group else _c(group)
    number = text_to_double(_c(value))
    # Two levels: hashed sums per distinct tuple first (a least struct can only be
    # aggregated by sorting, which then meets the few grouped rows only).
    names = [f"__f{i}" for i in range(len(firsts))]
    tuples = df.groupBy(key.alias(g), *[_c(f).alias(n) for f, n in zip(firsts, names, strict=True)]).agg(
        F.sum(number).alias("__sum"), F.count(number).alias("__n"))
    rep = F.min(F.when(F.col(names[0]).isNotNull(), F.struct(*[F.col(n) for n in names])))
    agg = tuples.groupBy(g).agg((F.sum("__sum") / F.nullif(F.sum("__n"), F.lit(0))).alias(v), rep.alias("__rep"))
    return agg.select(g, v, *[F.col("__rep")[n].alias(f) for f, n in zip(firsts, names, strict=True)])


def row_count(df: DataFrame, out: str = "row_count") -> DataFrame:
    """A2: one row, the number of rows."""
    return df.agg(F.count(F.lit(1)).alias(out))


def aggregate_by_state(
    df: DataFrame,
    state: str,
    city: Iterable[str],
    measures: Mapping[str, str],
    n_cities: str = "n_cities",
) -> DataFrame:
    """A3: city-grain measures summed to the state grain.

    City-level measures repeat on every race row of a city, so they are first
    reduced to one value per city (``max``: equal values, deterministic even
    when a producer repeats a city with a different value) and then summed
    per state. Both steps are partial aggregations; the second one only sees
    one row per city.
    """
    city_cols = list(city)
    per_city = df.groupBy(_c(state), *[_c(c) for c in city_cols]).agg(
        *[F.max(_c(src)).alias(out) for out, src in measures.items()]
    )
    return per_city.groupBy(_c(state)).agg(
        F.count(F.lit(1)).alias(n_cities),
        *[F.sum(_c(out)).alias(out) for out in measures],
    )


def sum_by_state_and_group(df: DataFrame, state: str, group: str, value: str, out: str | None = None) -> DataFrame:
    """A3 (race part): a row-grain count summed per (state, race)."""
    return df.groupBy(_c(state), _c(group)).agg(F.sum(_c(value)).alias(out or value))


def null_profile(df: DataFrame, columns: Iterable[str] | None = None) -> DataFrame:
    """A4: nulls per column as rows (column_name, null_count, row_count).

    One pass over the data: every count is a conditional count inside a
    single aggregate; the wide result row is then unpivoted.
    """
    cols = list(columns) if columns is not None else df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__rows"),
        *[F.count_if(_c(c).isNull()).alias(f"__n{i}") for i, c in enumerate(cols)],
    )
    pairs = ", ".join(f"{sql_string(c)}, __n{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {pairs}) AS (column_name, null_count)", "__rows AS row_count")


# Mergeable means: numbers are taken to 10 decimals below 10^18, so sums are exact and their order does not matter.
_EXACT = "decimal(28,10)"


def mean_states(
    df: DataFrame, group: str, value: str, first: Iterable[str], *, out_group: str | None = None, upper_group: bool = True
) -> DataFrame:
    """A1 as state: per group the exact sum, the number of values, and the least tuple of ``first``.

    ``(group, total decimal, n, rep struct)``. States of drops merge
    (``merge_means``) without rereading the drops. ``value`` may be text; bad
    text, and a number of 10^18 or more, is skipped like a null.
    """
    firsts, g = list(first), out_group or group
    key = F.upper(_c(group)) if upper_group else _c(group)
    number = _c(value).cast("string").try_cast(_EXACT)
    names = [f"__f{i}" for i in range(len(firsts))]
    # Two levels, as in group_avg_first: the least struct meets the distinct tuples only.
    tuples = df.groupBy(key.alias(g), *[_c(f).alias(n) for f, n in zip(firsts, names, strict=True)]).agg(
        F.sum(number).alias("__sum"), F.count(number).alias("__n"))
    rep = F.min(F.when(F.col(names[0]).isNotNull(), F.struct(*[F.col(n).alias(f) for f, n in zip(firsts, names, strict=True)])))
    return tuples.groupBy(g).agg(F.sum("__sum").cast("decimal(38,10)").alias("total"), F.sum("__n").alias("n"), rep.alias("rep"))


def merge_means(states: DataFrame, group: str) -> DataFrame:
    """One state per group from the states of any number of drops."""
    return states.groupBy(_c(group)).agg(
        F.sum("total").cast("decimal(38,10)").alias("total"), F.sum("n").alias("n"), F.min("rep").alias("rep"))


def means(states: DataFrame, group: str, out_value: str) -> DataFrame:
    """(group, mean, columns of the least tuple): bit-equal however the rows were dealt over drops and partitions."""
    merged = merge_means(states, group)
    first = [f.name for f in states.schema["rep"].dataType.fields]
    mean = F.col("total").cast("double") / F.nullif(F.col("n"), F.lit(0))
    return merged.select(_c(group), mean.alias(out_value), *[F.col("rep")[c].alias(c) for c in first])
