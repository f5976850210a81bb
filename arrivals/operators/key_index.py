"""Q2 across months: an exact index of the integer keys that every month holds.

A month's keys are kept as bitmaps: one row per (month, range of 32,768 keys)
with the bitmap of the keys that occur. The index of a load is built from the
load's own rows; whether it shares a key with any stored month is then decided
range by range from the bitmaps alone, without reading the fact: over sets that
do not overlap, the key counts add up to the size of their union. Bitmaps merge
by OR, so months can be indexed by any number of loads.

Null keys are not in the index (``key_summary`` counts them). A key that a third
of the rows hold is combined map-side before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MONTH = ("year", "month")
INDEX = "year int, month int, bucket long, bitmap binary, n_keys long, n_rows long"
_BITS = 32768  # keys per row: the size of Spark's bitmaps


def key_index(df: DataFrame, key: str, months: Iterable[str] = MONTH) -> DataFrame:
    """(year, month, bucket, bitmap, n_keys, n_rows) of the rows of ``df`` that have a month and a key."""
    year, month = months
    per_key = (
        df.select(F.col(f"`{year}`").cast("int").alias("year"), F.col(f"`{month}`").cast("int").alias("month"),
                  F.col(f"`{key}`").cast("long").alias("key"))
        .where("year IS NOT NULL AND month IS NOT NULL AND key IS NOT NULL")
        .groupBy("year", "month", "key").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("bucket", F.bitmap_bucket_number("key"))
    )
    # Dealt by range first, so that no task holds a bitmap of every range.
    return per_key.repartition("year", "month", "bucket").groupBy("year", "month", "bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("key")).alias("bitmap"),
        F.count(F.lit(1)).alias("n_keys"), F.sum("n").alias("n_rows"))


def write_key_index(index: DataFrame, path: str, replace: bool = False) -> None:
    """Replace the months of ``index`` in the stored index (all months with ``replace``)."""
    mode = "static" if replace else "dynamic"
    index.write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy(*MONTH).parquet(path)


def read_key_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(INDEX).parquet(path)


def _union(index: DataFrame, name: str) -> DataFrame:
    """Per range, the number of different keys of all months, and their bitmap."""
    return index.groupBy("bucket").agg(F.bitmap_or_agg("bitmap").alias(name))


def shared_key_count(new: DataFrame, stored: DataFrame) -> DataFrame:
    """One row, ``n_shared``: the keys of ``new`` that a month of ``stored`` holds too (|A| + |B| - |A or B|, per range)."""
    both = _union(new, "bitmap").withColumn("is_new", F.lit(True)).unionByName(
        _union(stored, "bitmap").withColumn("is_new", F.lit(False)))
    per_range = both.groupBy("bucket").agg(
        F.sum(F.bitmap_count("bitmap")).alias("n"), F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n_union"),
        F.count(F.lit(1)).alias("sides")).where("sides = 2")
    return per_range.agg(F.coalesce(F.sum(F.col("n") - F.col("n_union")), F.lit(0)).alias("n_shared"))


def bit_of(bitmap: Column, position: Column) -> Column:
    """The bit of a bitmap at a position (bit 0 is the lowest of the first byte)."""
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(position / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (position % 8).cast("int")) == 1


def keys_of(index: DataFrame) -> DataFrame:
    """(year, month, key): the index unpacked."""
    position = F.explode(F.sequence(F.lit(0), F.lit(_BITS - 1))).alias("position")
    rows = index.select(*MONTH, "bucket", "bitmap", position).where(bit_of(F.col("bitmap"), F.col("position")))
    # Inverse of bitmap_bucket_number and bitmap_bit_position: keys above 0 start at 1, the others count down.
    key = F.when(F.col("bucket") > 0, (F.col("bucket") - 1) * _BITS + F.col("position") + 1).otherwise(
        F.col("bucket") * _BITS - F.col("position"))
    return rows.select(*MONTH, key.alias("key"))


def keys_across_months(index: DataFrame) -> DataFrame:
    """(key, n_months, first_month, last_month) of every key that more than one month holds.

    Only ranges whose months overlap are unpacked; months are given as
    ``100 * year + month``.
    """
    overlaps = (
        index.groupBy("bucket").agg(F.sum("n_keys").alias("n"), F.bitmap_count(F.bitmap_or_agg("bitmap")).alias("n_union"))
        .where("n > n_union").select("bucket")
    )
    when = 100 * F.col("year") + F.col("month")
    return (
        keys_of(index.join(overlaps, "bucket", "left_semi"))
        .groupBy("key").agg(F.count(F.lit(1)).alias("n_months"), F.min(when).alias("first_month"),
                            F.max(when).alias("last_month"))
        .where("n_months > 1")
    )
