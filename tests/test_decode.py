from pyspark.sql import functions as F

from arrivals.operators.decode import decode, decode_roles, fits_broadcast
from arrivals.plans.codebooks import mode_lookup
from tests.conftest import plan_text


def test_decode_int_key_from_decimal_text(spark):
    fact = spark.createDataFrame([(1, "1.0"), (2, "2"), (3, "4.0"), (4, None), (5, "x")], "id int, mode string")
    out = decode(fact, "mode", mode_lookup(spark), "Mode")
    assert out.columns == ["id", "Mode"]
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[0]) == [
        (1, "Air"), (2, "Sea"), (3, None), (4, None), (5, None)
    ]


def test_decode_never_multiplies_rows(spark):
    fact = spark.createDataFrame([(1, "7")], "id int, c string")
    book = spark.createDataFrame([("7", "b"), ("7", "a"), ("7.0", "c")], "code string, label string")
    out = decode(fact, "c", book, "label")
    assert [tuple(r) for r in out.collect()] == [(1, "a")]


def test_decode_string_key_keeps_leading_zero_and_default(spark):
    fact = spark.createDataFrame([("060",), ("60",), ("ZZZ",)], "port string")
    book = spark.createDataFrame([("060", "PORT A"), ("60", "PORT B")], "code string, label string")
    out = decode(fact, "port", book, "name", key_type="string", default="other", keep_code=True)
    assert sorted(tuple(r) for r in out.collect()) == [("060", "PORT A"), ("60", "PORT B"), ("ZZZ", "other")]


def test_role_playing_decode(spark):
    fact = spark.createDataFrame([(1, "101.0", "582"), (2, "999", "101")], "id int, i94cit string, i94res string")
    book = spark.createDataFrame([("582", "MEXICO"), ("101", "ALBANIA")], "code string, label string")
    out = decode_roles(fact, book, {"i94cit": "native_country", "i94res": "residence_country"})
    assert out.columns == ["id", "native_country", "residence_country"]
    assert sorted((tuple(r) for r in out.collect()), key=lambda r: r[0]) == [(1, "ALBANIA", "MEXICO"), (2, None, "ALBANIA")]


def test_small_lookup_is_broadcast(spark):
    fact = spark.range(100).select(F.col("id").cast("string").alias("c"))
    out = decode(fact, "c", mode_lookup(spark), "Mode")
    assert "BroadcastHashJoin" in plan_text(out)


def test_lookup_over_bound_is_not_hinted_and_still_correct(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fact = spark.createDataFrame([("1",), ("3",), ("5",)], "c string")
        out = decode(fact, "c", mode_lookup(spark), "Mode", max_broadcast_rows=2)
        plan = plan_text(out)
        assert "BroadcastHashJoin" not in plan or "isFinalPlan=true" in plan
        got = sorted((r.Mode for r in out.collect()), key=lambda v: (v is None, v or ""))
        assert got == ["Air", "Land", None]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fits_broadcast(spark):
    assert fits_broadcast(spark.range(10), 10)
    assert not fits_broadcast(spark.range(11), 10)


def test_int_keys_beyond_int_range(spark):
    fact = spark.createDataFrame([(1, 5_000_000_000), (2, 7)], "id int, code long")
    book = spark.createDataFrame([("5000000000.0", "big"), ("7", "small")], "code string, label string")
    out = decode(fact, "code", book, "label")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "big"), (2, "small")]
