"""Raw-shaped inputs derived from the driver tables.

The warehouse builds expect the raw arrivals / demographics / temperature /
airport files (all text, header names). For checks at any scale these are
derived here from the driver tables with Spark expressions, so the builds run
over whole tables and their work grows with the data. The SQL in
``arrivals.plans.oracle`` derives the same rows.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.operators.decode import checked_broadcast

EPOCH = _dt.date(1960, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def raw_arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders (+ customer) -> raw arrivals rows, every column text."""
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey, "left")
    day = F.datediff(F.col("o_orderdate").cast("date"), F.lit(EPOCH))
    return j.select(
        F.concat(_s(F.col("o_orderkey")), F.lit(".0")).alias("cicid"),
        F.concat(_s(F.year("o_orderdate")), F.lit(".0")).alias("i94yr"),
        F.concat(_s(F.month("o_orderdate")), F.lit(".0")).alias("i94mon"),
        F.concat(_s(F.col("c_nationkey")), F.lit(".0")).alias("i94cit"),
        _s(F.col("c_custkey") % 30).alias("i94res"),
        F.col("o_orderpriority").alias("i94port"),
        F.concat(_s(day), F.lit(".0")).alias("arrdate"),
        F.concat(_s(F.col("o_custkey") % 5), F.lit(".0")).alias("i94mode"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("S"), _s(F.col("c_nationkey")))).alias("i94addr"),
        F.when(F.col("o_orderstatus") == "O", F.lit(None).cast("string"))
        .otherwise(_s(day + F.col("o_orderkey") % 20)).alias("depdate"),
        _s(F.col("c_nationkey") + 20).alias("i94bir"),
        F.concat(_s(F.col("o_orderkey") % 3 + 1), F.lit(".0")).alias("i94visa"),
        F.lit("1.0").alias("count"),
        _s(F.col("o_orderkey") * 7).alias("admnum"),
        _s(F.year("o_orderdate") - F.col("c_nationkey") - 20).alias("biryear"),
        F.when(F.col("o_orderkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.substring("o_orderpriority", 1, 1).alias("airline"),
        F.col("o_orderstatus").alias("visatype"),
    )


def raw_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """part -> raw city demographics rows (text, header names with blanks)."""
    p = table(spark, sf_dir, "part")
    size = F.col("p_size")
    return p.select(
        F.col("p_name").alias("City"),
        F.col("p_type").alias("State"),
        F.concat(_s(size), F.lit(".5")).alias("Median Age"),
        F.concat(_s(size * 100), F.lit(".0")).alias("Male Population"),
        _s(size * 110).alias("Female Population"),
        _s(size * 210).alias("Total Population"),
        F.when(size % 7 == 0, F.lit(None).cast("string")).otherwise(_s(size * 3)).alias("Number of Veterans"),
        F.when(size % 11 == 0, F.lit("x")).otherwise(_s(size * 5)).alias("Foreign-born"),
        F.when(size % 13 == 0, F.lit(None).cast("string")).otherwise(F.col("p_brand")).alias("Average Household Size"),
        F.substring("p_type", 1, 2).alias("State Code"),
        F.col("p_brand").alias("Race"),
        F.concat(_s(F.col("p_partkey")), F.lit(".0")).alias("Count"),
    )


def raw_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    """customer (+ nation) -> raw temperature rows with case variants of names."""
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    j = c.join(checked_broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.when(F.col("c_custkey") % 2 == 0, F.lower("n_name")).otherwise(F.col("n_name")).alias("Country"),
        F.when(F.col("c_custkey") % 9 == 0, F.lit(None).cast("string"))
        .otherwise(_s(F.col("c_acctbal"))).alias("AverageTemperature"),
        F.col("c_name").alias("Latitude"),
        F.col("c_mktsegment").alias("Longitude"),
    )


def raw_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """supplier (+ nation) -> raw airport rows; region 1 plays the US."""
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    j = s.join(checked_broadcast(n), s.s_nationkey == n.n_nationkey, "left")
    return j.select(
        _s(F.col("s_suppkey")).alias("ident"),
        F.lit("small_airport").alias("type"),
        F.col("s_name").alias("name"),
        _s(F.col("s_nationkey")).alias("elevation_ft"),
        F.lit("NA").alias("continent"),
        F.when(F.col("n_regionkey") == 1, F.lit("US"))
        .when(F.col("n_regionkey") == 2, F.lit(None).cast("string"))
        .otherwise(F.lit("CA")).alias("iso_country"),
        F.when(F.col("s_suppkey") % 10 == 0, F.lit("US"))
        .otherwise(F.concat(F.lit("US-"), F.col("n_name"))).alias("iso_region"),
        F.col("n_name").alias("municipality"),
        F.concat(F.lit("K"), _s(F.col("s_suppkey"))).alias("gps_code"),
        F.lit(None).cast("string").alias("iata_code"),
        _s(F.col("s_suppkey")).alias("local_code"),
        F.concat(_s(F.col("s_suppkey")), F.lit(", "), _s(F.col("s_nationkey"))).alias("coordinates"),
    )


def country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """nation as the country code book (code, label)."""
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("label")
    )


# Codes whose label the marked books replace by one of each invalid class.
MARKED_COUNTRIES = {"3": "INVALID: STATELESS", "5": "Collapsed (MEXICO)", "7": "No Country Code (7)"}
MARKED_PORTS = {"1-URGENT": "URGENT, AK", "2-HIGH": "Collapsed (HIGH)", "3-MEDIUM": "No PORT Code (3)"}


def _book(spark: SparkSession, rows: dict[str, str]) -> DataFrame:
    return spark.createDataFrame(list(rows.items()), "code string, label string")


def marked_country_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country book with labels of every invalid class."""
    label = F.col("label")
    for code, marked in MARKED_COUNTRIES.items():
        label = F.when(F.col("code") == code, F.lit(marked)).otherwise(label)
    return country_lookup(spark, sf_dir).select("code", label.alias("label"))


def port_lookup(spark: SparkSession) -> DataFrame:
    """Three of the five order priorities as ports: one valid, two of invalid classes."""
    return _book(spark, MARKED_PORTS)


def state_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as states: code S<key> and a full name; nations above 20 are missing."""
    n = table(spark, sf_dir, "nation").where("n_nationkey <= 20")
    return n.select(F.concat(F.lit("S"), _s(F.col("n_nationkey"))).alias("code"), F.initcap("n_name").alias("label"))


def star_demographics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw demographics whose states are those of the arrivals (code and, in mixed case, name)."""
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("__part"), (F.col("p_size") % 25).alias("__key"))
    d = raw_demographics(spark, sf_dir).withColumn("__part", F.expr("CAST(CAST(Count AS DOUBLE) AS BIGINT)"))
    j = d.drop("State", "State Code").join(p, "__part").join(checked_broadcast(n), F.col("__key") == F.col("n_nationkey"))
    return j.select(
        *[F.col(f"`{c}`") for c in d.columns if c not in ("State", "State Code", "__part")],
        F.when(F.col("__part") % 2 == 0, F.upper("n_name")).otherwise(F.initcap("n_name")).alias("State"),
        F.concat(F.lit("S"), _s(F.col("__key"))).alias("State Code"))


def star_airports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw airports, all in the US, in the arrivals' states."""
    return raw_airports(spark, sf_dir).withColumns({
        "iso_country": F.lit("US"), "iso_region": F.concat(F.lit("US-S"), F.col("elevation_ft"))})
