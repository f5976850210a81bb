import pytest
from pyspark.sql import types as T

from arrivals.operators.quality import (
    duplicate_keys,
    key_summary,
    non_empty_report,
    require,
    schema_report,
    unmatched_code_list,
    unmatched_codes,
)


def test_non_empty_report_and_require(spark):
    full = spark.range(3)
    empty = spark.range(3).where("id < 0")
    report = non_empty_report({"immigration": full, "airports": empty})
    got = {r.table_name: (r.row_count, r.passed) for r in report.collect()}
    assert got == {"immigration": (3, True), "airports": (0, False)}
    with pytest.raises(ValueError, match="airports"):
        require(report)
    require(non_empty_report({"immigration": full}))


def test_duplicate_keys_and_summary(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 3), (None, 3)], "k1 int, k2 int")
    assert sorted(tuple(r) for r in duplicate_keys(df, ["k1", "k2"]).where("k1 IS NOT NULL").collect()) == [(1, 1, 2)]
    s = key_summary(df, ["k1", "k2"]).first()
    assert (s.n_rows, s.n_null_key_rows, s.n_distinct_keys, s.n_duplicate_keys) == (5, 2, 3, 2)


def test_unmatched_codes(spark):
    df = spark.createDataFrame(
        [("582", "MEXICO"), ("999", None), (None, None), ("700", "INVALID: STATELESS")], "code string, label string"
    )
    r = unmatched_codes(df, {"code": "label"}).first()
    assert (r.column_name, r.n_rows, r.n_null_code, r.n_unmatched, r.n_invalid) == ("label", 4, 1, 1, 1)
    assert [tuple(x) for x in unmatched_code_list(df, "code", "label").collect()] == [("999", 1)]


def test_schema_report_counts_bad_values(spark):
    raw = spark.createDataFrame([("1", "4.0"), ("x", "2")], "ID string, year string")
    contract = T.StructType([
        T.StructField("ID", T.IntegerType()), T.StructField("year", T.IntegerType()), T.StructField("gender", T.StringType()),
    ])
    got = {r.column_name: (r.actual_type, r.expected_type, r.type_ok, r.n_values, r.n_bad_values)
           for r in schema_report(raw, contract).collect()}
    assert got == {
        "ID": ("string", "int", False, 2, 1),
        "year": ("string", "int", False, 2, 0),
        "gender": (None, "string", False, 0, 0),
    }


def test_every_class_of_invalid_label_is_counted(spark):
    labels = ["INVALID: X", "Collapsed (MIA)", "No Country Code (7)", "No PORT Code (ZZ)", "MEXICO", None]
    df = spark.createDataFrame(list(enumerate(labels)), "code int, label string")
    r = unmatched_codes(df, {"code": "label"}).first()
    assert (r.n_rows, r.n_unmatched, r.n_invalid) == (6, 1, 4)
