"""Star links between the fact table and its dimensions.

A dimension is first brought to the grain of the link (one row per state or
country), otherwise a city-grain dimension would multiply every fact row. The
reduced side is broadcast when its size is checked to be small, and the fact
table is then never shuffled for the link.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.operators.decode import MAX_BROADCAST_ROWS, checked_broadcast


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def to_link_grain(dim: DataFrame, key: str | Column, aggs: Mapping[str, Column], key_name: str = "link_key") -> DataFrame:
    """Aggregate a dimension to one row per link key."""
    k = _c(key) if isinstance(key, str) else key
    return dim.groupBy(k.alias(key_name)).agg(*[expr.alias(name) for name, expr in aggs.items()])


def count_per_key(dim: DataFrame, key: str | Column, out: str = "n", key_name: str = "link_key") -> DataFrame:
    """J7 helper: number of dimension rows per link key (airports per state)."""
    return to_link_grain(dim, key, {out: F.count(F.lit(1))}, key_name)


def star_link(
    fact: DataFrame,
    fact_key: str | Column,
    dim: DataFrame,
    dim_key: str = "link_key",
    *,
    normalise: str | None = None,
    keep_dim_key: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    size_source: DataFrame | None = None,
) -> DataFrame:
    """Left join a link-grain dimension onto the fact table: exactly the fact's rows come out.

    ``normalise="upper"`` compares upper-cased text on both sides (country
    names). Keys that become equal by that are one key: the dimension is
    reduced again, to the least of their rows. Otherwise it must already be
    unique on ``dim_key`` (``to_link_grain``). ``size_source`` is a frame with
    at least as many rows as ``dim`` (the small table it was aggregated from):
    the bound is then checked on it and ``dim`` is not counted.
    """
    tag = uuid.uuid4().hex[:8]
    k = f"__dk_{tag}"
    fk = _c(fact_key) if isinstance(fact_key, str) else fact_key
    others = [c for c in dim.columns if c != dim_key]
    side = dim.select(_c(dim_key).alias(k), *[_c(c) for c in others])
    if normalise == "upper":
        fk = F.upper(fk)
        least = F.min(F.struct(*[_c(c) for c in others])).alias("s")
        side = dim.groupBy(F.upper(_c(dim_key)).alias(k)).agg(least).select(k, *[F.col("s")[c].alias(c) for c in others])
    side = checked_broadcast(side, max_broadcast_rows, size_source=size_source, own_exchange=True)
    out = fact.join(side, fk == F.col(k), "left")
    return out.withColumnRenamed(k, dim_key) if keep_dim_key else out.drop(k)
