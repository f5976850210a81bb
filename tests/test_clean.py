from arrivals.operators.clean import (
    drop_columns,
    drop_missing,
    filter_equals,
    preview,
    rename_columns,
    select_columns,
)
from tests.conftest import plan_text


def test_rename_and_drop_ignore_absent_names(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert rename_columns(df, {"a": "x", "nope": "y"}).columns == ["x", "b"]
    assert drop_columns(df, ["b", "nope"]).columns == ["a"]
    assert select_columns(df, ["b"]).columns == ["b"]


def test_drop_missing_any_and_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (None, 2.0), (3, float("nan")), (4, None)], "a int, d double")
    assert [r.a for r in drop_missing(df, ["a"]).collect()] == [1, 3, 4]
    assert [r.a for r in drop_missing(df, ["a", "d"]).collect()] == [1]
    assert [r.a for r in drop_missing(df, ["a", "d"], nan_is_missing=False).collect()] == [1, 3]


def test_null_filter_reaches_parquet_scan(spark, tmp_path):
    spark.createDataFrame([(1, "CA"), (2, None)], "id int, st string").write.parquet(str(tmp_path / "p"))
    df = drop_missing(spark.read.parquet(str(tmp_path / "p")), ["st"])
    assert "PushedFilters: [IsNotNull(st)]" in plan_text(df)
    eq = filter_equals(spark.read.parquet(str(tmp_path / "p")), "st", "CA")
    assert "EqualTo(st,CA)" in plan_text(eq)
    assert [r.id for r in eq.collect()] == [1]


def test_preview_is_deterministic_top_n(spark):
    df = spark.range(100).selectExpr("100 - id AS k")
    assert [r.k for r in preview(df, 3, ["k"]).collect()] == [1, 2, 3]


def test_names_resolve_case_insensitively(spark):
    df = spark.createDataFrame([(1, float("nan")), (2, 1.0)], "a int, D double")
    assert [r.a for r in drop_missing(df, ["d"]).collect()] == [2]
