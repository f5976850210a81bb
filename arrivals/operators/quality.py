"""Data-quality reports (Q1-Q4).

Each check is a distributed aggregate returning a small report DataFrame;
only ``require`` pulls a report (a handful of rows, one per table or column)
to the driver to raise.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.schemas import Contract, sql_string


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def non_empty_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Q1: (table_name, row_count, passed) for each named table."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("row_count") > 0).alias("passed")
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, parts)


def require(report: DataFrame, flag: str = "passed", name: str = "table_name") -> DataFrame:
    """Raise naming every failed entry of a (small) report; return it otherwise."""
    failed = [r[name] for r in report.where(~F.coalesce(_c(flag), F.lit(False))).select(name).collect()]
    if failed:
        raise ValueError(f"Data quality check failed for: {', '.join(map(str, failed))}")
    return report


def duplicate_keys(df: DataFrame, keys: Iterable[str], out: str = "n_rows") -> DataFrame:
    """Q2: every key value held by more than one row, with its row count."""
    ks = list(keys)
    return df.groupBy(*[_c(k) for k in ks]).agg(F.count(F.lit(1)).alias(out)).where(F.col(out) > 1)


def key_summary(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Q2 summary: rows, rows with a null key part, distinct keys, keys repeated."""
    ks = list(keys)
    null_key = reduce(lambda a, b: a | b, [_c(k).isNull() for k in ks])
    per_key = df.groupBy(*[_c(k) for k in ks]).agg(
        F.count(F.lit(1)).alias("n"), F.max(null_key.cast("int")).alias("has_null")
    )
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("has_null") == 1, F.col("n"))), F.lit(0)).cast("long").alias("n_null_key_rows"),
        F.count(F.lit(1)).alias("n_distinct_keys"),
        F.count_if(F.col("n") > 1).alias("n_duplicate_keys"),
    )


def contract_key_report(tables: Mapping[str, DataFrame], keys: Mapping[str, Iterable[str]]) -> DataFrame:
    """Q2 over several tables: one ``key_summary`` row per table, for the key
    its contract declares (keys are declared, not enforced, by the warehouse)."""
    parts = [
        key_summary(tables[name], list(keys[name])).select(F.lit(name).alias("table_name"), "*")
        for name in tables
    ]
    return reduce(DataFrame.unionAll, parts)


# How the code books begin the label of a code that names no real value.
INVALID_LABELS = ("invalid", "collapsed", "no country code", "no port code")


def invalid_label(label: Column, beginnings: Iterable[str] = INVALID_LABELS) -> Column:
    """True where a label begins like that of an invalid code (case and outer blanks ignored)."""
    low = F.lower(F.trim(label.cast("string")))
    return reduce(lambda a, b: a | b, [low.startswith(x.lower()) for x in beginnings])


def unmatched_codes(
    df: DataFrame, pairs: Mapping[str, str] | Iterable[tuple[str, str]], invalid: Iterable[str] = INVALID_LABELS
) -> DataFrame:
    """Q4: per decoded column (column_name, n_rows, n_null_code, n_unmatched, n_invalid).

    ``pairs`` maps a code column to the label column its decode produced
    (keep the code with ``decode(..., keep_code=True)``). Unmatched means a
    code was present but no label was found; invalid means the code book
    itself labels the code as invalid.
    """
    pairs = list(pairs.items()) if isinstance(pairs, Mapping) else list(pairs)
    aggs = [F.count(F.lit(1)).alias("__rows")]
    for i, (code, label) in enumerate(pairs):
        aggs += [
            F.count_if(_c(code).isNull()).alias(f"__nc{i}"),
            F.count_if(_c(code).isNotNull() & _c(label).isNull()).alias(f"__nu{i}"),
            F.count_if(invalid_label(_c(label), invalid)).alias(f"__ni{i}"),
        ]
    wide = df.agg(*aggs)
    parts = ", ".join(f"{sql_string(label)}, __nc{i}, __nu{i}, __ni{i}" for i, (code, label) in enumerate(pairs))
    return wide.selectExpr(
        f"stack({len(pairs)}, {parts}) AS (column_name, n_null_code, n_unmatched, n_invalid)",
        "__rows AS n_rows",
    ).select("column_name", "n_rows", "n_null_code", "n_unmatched", "n_invalid")


def unmatched_code_list(df: DataFrame, code: str, label: str, out: str = "n_rows") -> DataFrame:
    """Q4 detail: each present code that found no label, with its row count."""
    return (
        df.where(_c(code).isNotNull() & _c(label).isNull())
        .groupBy(_c(code))
        .agg(F.count(F.lit(1)).alias(out))
    )


def schema_report(df: DataFrame, contract: Contract | T.StructType, convert=None) -> DataFrame:
    """Q3: per contract column (column_name, actual_type, expected_type, type_ok,
    n_values, n_bad_values).

    ``n_bad_values`` counts values present in ``df`` that would become null
    when conformed to the contract type (one pass, all columns together).
    """
    from arrivals.sources.sinks import _convert

    schema = contract.schema if isinstance(contract, Contract) else contract
    have = {f.name.lower(): f for f in df.schema.fields}
    aggs = []
    meta = []
    for i, field in enumerate(schema.fields):
        src = have.get(field.name.lower())
        if src is None:
            aggs += [F.lit(0).cast("long").alias(f"__v{i}"), F.lit(0).cast("long").alias(f"__b{i}")]
            meta.append((field.name, None, field.dataType.simpleString()))
            continue
        col = _c(src.name)
        converted = _convert(col, src.dataType, field.dataType)
        aggs += [
            F.count(col).alias(f"__v{i}"),
            F.count_if(col.isNotNull() & converted.isNull()).alias(f"__b{i}"),
        ]
        meta.append((field.name, src.dataType.simpleString(), field.dataType.simpleString()))
    wide = df.agg(*aggs)

    def lit(v):
        return "NULL" if v is None else sql_string(v)

    parts = ", ".join(
        f"{lit(n)}, CAST({lit(a)} AS STRING), {lit(e)}, __v{i}, __b{i}" for i, (n, a, e) in enumerate(meta)
    )
    out = wide.selectExpr(
        f"stack({len(meta)}, {parts}) AS (column_name, actual_type, expected_type, n_values, n_bad_values)"
    )
    return out.select(
        "column_name",
        "actual_type",
        "expected_type",
        F.coalesce(F.col("actual_type") == F.col("expected_type"), F.lit(False)).alias("type_ok"),
        "n_values",
        "n_bad_values",
    )
