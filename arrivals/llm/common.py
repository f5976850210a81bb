"""Shared Spark expressions of the llm operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

# A word is a run of characters other than these six blanks.
BLANKS = " \t\n\x0b\x0c\r"


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def words(text: Column) -> Column:
    """The words of a text, in order (an empty array for a null or blank text)."""
    spaced = text_or_empty(text)
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))  # a byte scan; translate() maps every character
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def bind(value: Column, use) -> Column:
    """``use(value)`` with the value computed once per row, also inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to a fresh folder under the shared scratch root and read it back.

    This cuts the lineage: a lost executor costs a re-read, never the work
    before it.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")  # the shuffle files of this write are of no use after it
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(_CLEANUP) if before is None else spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, by: list[str], expected: int, total: int) -> DataFrame:
    """About ``expected`` of ``total`` rows, those of a low hash: the same rows in every run, picked in the scan.

    (An ordered limit would send that many rows of every partition to one place.)
    """
    if expected >= total:
        return df
    return df.filter(F.pmod(F.xxhash64(F.lit(41), *by), F.lit(1 << 40)) < int(expected / total * (1 << 40)))
