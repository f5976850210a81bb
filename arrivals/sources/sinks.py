"""Sinks and loads.

Writes go through Spark's file commit protocol, so a lost executor only means
its task is retried; nothing is staged on a machine-local disk.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.functions.columns import text_to_double, text_to_int
from arrivals.schemas import Contract
from arrivals.session import scratch_path


def write_parquet(
    df: DataFrame, path: str, mode: str = "overwrite", partition_by: Iterable[str] = (), partition_mode: str = "static"
) -> None:
    """Parquet, overwrite by default (with ``partition_mode="dynamic"`` only the partitions that ``df`` has)."""
    writer = df.write.mode(mode).option("partitionOverwriteMode", partition_mode)
    cols = list(partition_by)
    if cols:
        writer = writer.partitionBy(*cols)
    writer.parquet(path)


def _convert(col: Column, source: T.DataType, target: T.DataType) -> Column:
    """Convert one column to a contract type without ever failing the job.

    Widening casts are plain casts; anything that can fail (text -> number,
    text -> date, narrowing) becomes null on bad input.
    """
    if source == target:
        return col
    if isinstance(source, T.StringType):
        if isinstance(target, (T.IntegerType, T.ShortType, T.ByteType)):
            return text_to_int(col).try_cast(target)
        if isinstance(target, T.LongType):
            # Integer text converts exactly (beyond double precision); decimal
            # text such as "15.0" falls back to the double route.
            return F.coalesce(col.try_cast("long"), text_to_double(col).try_cast("long"))
        if isinstance(target, (T.DoubleType, T.FloatType)):
            return text_to_double(col).try_cast(target)
        return col.try_cast(target)
    if isinstance(target, T.StringType):
        return col.cast("string")
    return col.try_cast(target)


def conform(
    df: DataFrame,
    contract: Contract | T.StructType,
    renames: Mapping[str, str] | None = None,
    strict: bool = False,
) -> DataFrame:
    """Map a DataFrame onto a contract by column name.

    Applies renames, orders columns as the contract does, converts types
    (null on bad values), adds contract columns that are missing as nulls and
    drops columns the contract does not list. ``strict`` raises on a missing
    column instead.
    """
    schema = contract.schema if isinstance(contract, Contract) else contract
    if renames:
        df = df.withColumnsRenamed(dict(renames))
    by_lower = {f.name.lower(): f for f in df.schema.fields}
    cols = []
    for field in schema.fields:
        src = by_lower.get(field.name.lower())
        if src is None:
            if strict:
                raise ValueError(f"column {field.name!r} missing; have {df.columns}")
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
        else:
            cols.append(_convert(F.col(f"`{src.name}`"), src.dataType, field.dataType).alias(field.name))
    return df.select(*cols)


def append_by_name(df: DataFrame, table: str) -> None:
    """Append into an existing table, matching columns by name.

    The rows are conformed to the table's own schema first, so a reordered or
    partly missing input can never land in the wrong column.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    conform(df, target).write.mode("append").saveAsTable(table)


def replace_table(df: DataFrame, table: str, path: str | None = None, fmt: str = "parquet") -> None:
    """Drop-and-create a table with the DataFrame's rows.

    With ``path`` the table is external at that location (a shared folder).
    """
    writer = df.write.mode("overwrite").format(fmt)
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)


def create_table(spark: SparkSession, table: str, contract: Contract | T.StructType, path: str | None = None) -> None:
    """Create an empty table for a contract (the DDL step)."""
    schema = contract.schema if isinstance(contract, Contract) else contract
    empty = spark.createDataFrame([], schema)
    replace_table(empty, table, path)


def rejects_path(path: str) -> str:
    """Where ``refresh_months`` keeps the rows of a table that have no month."""
    return path.rstrip("/") + "_rejects"


# Characters that Spark writes as %XX in the name of a partition folder.
_ESCAPED = set("\"#%'*/:=?\\\x7f{[]^") | {chr(c) for c in range(1, 32)}


def partition_folder(column: str, value: str) -> str:
    """``column=value`` as Spark names the folder of a partition."""
    return f"{column}=" + "".join(f"%{ord(c):02X}" if c in _ESCAPED else c for c in value)


def write_rejects(rejects: DataFrame, path: str, load: str, replace: bool = False) -> None:
    """Replace the rejects of ``load`` beside the table at ``path``, also when there are none now.

    ``replace`` removes those of all other loads too.
    """
    if replace:  # an empty frame empties the whole folder
        nothing = rejects.where(F.lit(False)).withColumn("load", F.lit(load))
        nothing.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("load").parquet(
            rejects_path(path))
    rejects.write.mode("overwrite").parquet(f"{rejects_path(path)}/{partition_folder('load', load)}")


def refresh_months(
    df: DataFrame,
    path: str,
    partition_cols: Iterable[str] = ("year", "month"),
    rebalance: bool = True,
    load: str | None = None,
    replace: bool = False,
) -> None:
    """Idempotent refresh of the months present in ``df``.

    Dynamic partition overwrite replaces exactly the ``year=/month=``
    directories the new rows touch and leaves every other month alone, so a
    re-run of a month never duplicates it. ``replace`` replaces the whole
    table instead (a corrected full load: months it lacks go).

    Rows without a year or month belong to no month. They are kept beside the
    table (``rejects_path``) in a partition per ``load``, a name for this input:
    repeating a load replaces its own rejects, also when it has none any more, and
    no load replaces another's. Both writes read ``df``: give a stored frame
    (``staged``) if computing it is expensive.

    With ``rebalance`` (default) the rows are clustered by month through the
    ``REBALANCE`` hint before writing: AQE sizes the writer partitions to the
    advisory partition size and splits a month that holds far more rows than
    the others, so each month is written as a few well-sized files instead of
    one file per (task, month) pair, and a hot month never lands in a single
    task.
    """
    cols = list(partition_cols)
    bad = reduce(lambda a, b: a | b, [F.col(f"`{c}`").isNull() for c in cols])
    good = df.where(~bad)
    if rebalance:
        good = good.hint("rebalance", *cols)
    mode = "static" if replace else "dynamic"
    good.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*cols).parquet(path)
    write_rejects(df.where(bad), path, load or uuid.uuid4().hex, replace)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back, for work that needs it several times."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_rejects(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of a month-wise table that have no month, with the ``load`` they came from."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("load", T.StringType())])).parquet(rejects_path(path))
