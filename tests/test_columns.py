import datetime as dt

from pyspark.sql import functions as F

from arrivals.functions import (
    day_number_to_date,
    normalise_text,
    parse_date,
    recode,
    substring_from,
    text_to_double,
    text_to_int,
    upper_case,
)


def test_text_to_int_edge_cases(spark):
    rows = [("4.0",), ("-4.7",), ("4.7",), ("x",), ("",), (None,), ("NaN",), ("3000000000",), ("17",)]
    df = spark.createDataFrame(rows, "s string")
    got = [r[0] for r in df.select(text_to_int("s")).collect()]
    assert got == [4, -4, 4, None, None, None, None, None, 17]


def test_text_to_double(spark):
    df = spark.createDataFrame([("1.5",), ("bad",), (None,)], "s string")
    assert [r[0] for r in df.select(text_to_double("s")).collect()] == [1.5, None, None]


def test_day_number_to_date(spark):
    df = spark.createDataFrame([("0",), ("20566.0",), (None,), ("x",), ("-1",)], "s string")
    got = [r[0] for r in df.select(day_number_to_date("s")).collect()]
    assert got == [dt.date(1960, 1, 1), dt.date(2016, 4, 22), None, None, dt.date(1959, 12, 31)]


def test_parse_date_pattern(spark):
    df = spark.createDataFrame([("01/01/1960",), ("13/45/2020",), (None,)], "s string")
    assert [r[0] for r in df.select(parse_date("s")).collect()] == [dt.date(1960, 1, 1), None, None]


def test_substring_from(spark):
    df = spark.createDataFrame([("US-CA",), ("US",), (None,), ("US-NYC-EXTRA-LONG",)], "s string")
    assert [r[0] for r in df.select(substring_from("s", 4, 10)).collect()] == ["CA", "", None, "NYC-EXTRA-"]


def test_upper_case(spark):
    df = spark.createDataFrame([("Côte d'Ivoire",), (None,)], "s string")
    assert [r[0] for r in df.select(upper_case("s")).collect()] == ["CÔTE D'IVOIRE", None]


def test_recode_keeps_unmapped(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (5.0,), (None,)], "m double")
    got = [r[0] for r in df.select(recode("m", {1.0: "air", 2.0: "see"})).collect()]
    assert got == ["air", "see", "5.0", None]


def test_normalise_text_no_break_space(spark):
    df = spark.createDataFrame([("\u00a0NEW\u00a0YORK\u00a0 ",), ("ALC ",), (None,)], "s string")
    got = [r[0] for r in df.select(normalise_text("s")).collect()]
    assert got == ["NEW YORK", "ALC", None]
    # plain trim keeps the no-break spaces
    assert df.select(F.trim("s")).first()[0] == "\u00a0NEW\u00a0YORK\u00a0"


def test_recode_compares_text_codes_as_numbers(spark):
    from arrivals.plans.codebooks import MODE_RECODE

    df = spark.createDataFrame([("1.0",), ("2",), ("x",), ("",), (None,), ("4.0",)], "c string")
    assert [r[0] for r in df.select(recode("c", MODE_RECODE)).collect()] == ["air", "see", "x", "", None, "4.0"]
