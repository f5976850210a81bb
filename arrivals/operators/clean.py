"""Projections and filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.schemas import field_type


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename; names that are not present are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop; names that are not present are ignored."""
    return df.drop(*list(names))


def select_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep only these columns (they become the scan's ReadSchema)."""
    return df.select(*[F.col(f"`{n}`") for n in names])


def preview(df: DataFrame, n: int = 10, order_by: Iterable[str | Column] = ()) -> DataFrame:
    """P5: first ``n`` rows; with an order it is a deterministic top-n
    (TakeOrderedAndProject: each task keeps n rows, no full sort)."""
    keys = list(order_by)
    return (df.orderBy(*keys) if keys else df).limit(n)


def _present(df: DataFrame, name: str, nan_is_missing: bool) -> Column:
    col = F.col(f"`{name}`")
    cond = col.isNotNull()
    if nan_is_missing:
        dtype = field_type(df.schema, name)
        if isinstance(dtype, (T.DoubleType, T.FloatType)):
            cond = cond & ~F.isnan(col)
    return cond


def drop_missing(df: DataFrame, columns: Iterable[str], nan_is_missing: bool = True) -> DataFrame:
    """drop rows that are null in any of ``columns``.

    Written as a conjunction of ``IS NOT NULL`` (plus ``NOT isnan`` on
    floating columns, which is what ``na.drop`` also removes) so the
    predicate reaches the parquet scan as PushedFilters; ``na.drop`` plans
    an opaque ``atleastnnonnulls`` that is never pushed.
    """
    cols = list(columns)
    if not cols:
        return df
    cond = None
    for c in cols:
        p = _present(df, c, nan_is_missing)
        cond = p if cond is None else cond & p
    return df.where(cond)


def filter_equals(df: DataFrame, column: str, value: object) -> DataFrame:
    """keep rows equal to a literal; null never matches."""
    return df.where(F.col(f"`{column}`") == F.lit(value))
