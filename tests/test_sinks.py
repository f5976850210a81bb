import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.schemas import ARRIVALS
from arrivals.session import unique_table_name
from arrivals.sources import append_by_name, conform, refresh_months, replace_table, write_parquet
from arrivals.sources.sinks import create_table


def test_conform_by_name_types_and_missing(spark):
    df = spark.createDataFrame([("Air", "4.0", "x", "2016.0", "1")], "Mode string, month string, junk string, year string, ID string")
    out = conform(df, ARRIVALS)
    assert out.columns == ARRIVALS.columns
    assert [f.dataType for f in out.schema.fields] == [f.dataType for f in ARRIVALS.schema.fields]
    r = out.first()
    assert (r.ID, r.year, r.month, r.Mode, r.visa) == (1, 2016, 4, "Air", None)


def test_conform_bad_values_become_null(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("d", T.DateType())])
    df = spark.createDataFrame([("12345678901234567", "2020-01-02"), ("bad", "nope"), ("15.0", None)], "n string, d string")
    assert [tuple(r) for r in conform(df, schema).collect()] == [
        (12345678901234567, dt.date(2020, 1, 2)), (None, None), (15, None)
    ]


def test_append_by_name_with_reordered_columns(spark, tmp_path):
    name = unique_table_name("t_append")
    create_table(spark, name, T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())]),
                 path=str(tmp_path / name))
    append_by_name(spark.createDataFrame([(1, "x")], "a int, b string"), name)
    append_by_name(spark.createDataFrame([("y", 2)], "b string, a int"), name)
    assert sorted(tuple(r) for r in spark.table(name).collect()) == [(1, "x"), (2, "y")]


def test_replace_table(spark, tmp_path):
    name = unique_table_name("t_replace")
    replace_table(spark.range(5), name, str(tmp_path / name))
    replace_table(spark.range(2), name, str(tmp_path / name))
    assert spark.table(name).count() == 2


def test_refresh_months_is_idempotent_and_leaves_other_months(spark, tmp_path):
    path = str(tmp_path / "fact")
    base = spark.createDataFrame([(1, 2016, 4, 1.0), (2, 2016, 5, 1.0), (3, 2016, 5, 1.0)], "ID int, year int, month int, v double")
    refresh_months(base, path)
    may = spark.createDataFrame([(2, 2016, 5, 9.0)], "ID int, year int, month int, v double")
    refresh_months(may, path)
    refresh_months(may, path)
    got = sorted(tuple(r) for r in spark.read.parquet(path).select("ID", "year", "month", "v").collect())
    assert got == [(1, 2016, 4, 1.0), (2, 2016, 5, 9.0)]


def test_write_parquet_overwrite(spark, tmp_path):
    path = str(tmp_path / "w")
    write_parquet(spark.range(10), path)
    write_parquet(spark.range(3), path)
    assert spark.read.parquet(path).count() == 3
    write_parquet(spark.range(3).withColumn("p", F.col("id") % 2), str(tmp_path / "wp"), partition_by=["p"])
    assert spark.read.parquet(str(tmp_path / "wp")).where("p = 1").count() == 1
