"""Mergeable states: profiles, exact means, per-month star counts; hybrid decode; the load step."""

import random

import pytest
from pyspark.sql import functions as F

from arrivals.operators.aggregate import mean_states, means, merge_means
from arrivals.operators.decode import decode, decode_hybrid, frequent_codes
from arrivals.operators.profile import column_profile, infer_types, merge_states, profile_state
from arrivals.plans.builds import publish
from arrivals.plans.load import load_tables
from arrivals.plans.month_states import published_profile, published_state_month, state_path
from arrivals.plans.star_views import arrivals_by_state_month, enriched_arrivals
from arrivals.session import unique_table_name
from tests.conftest import plan_text

VALUES = [None, "", " 7 ", "1", "-3", "3000000000", "99999999999999999999", "1.5", "1e3", "NaN", "true", "False", "x",
          "2020-01-02", "2020-01-02 03:04:05", "2020-13-01", "a|b"]


def rows(df, *columns):
    return sorted((tuple(r[c] for c in columns or df.columns) for r in df.collect()), key=str)


EXACT = ("column_name", "n_rows", "n_null", "least", "greatest", "narrowest_type")


def test_merged_profiles_equal_a_full_pass(spark):
    rng = random.Random(2)
    data = [(rng.choice("abc"), rng.choice(VALUES), str(rng.randrange(50)), None) for _ in range(400)]
    df = spark.createDataFrame(data, "part string, v string, n string, nothing string").repartition(9)
    states = profile_state(df, ["part"])
    assert states.count() == 9
    full, merged = column_profile(profile_state(df, [], ["v", "n", "nothing"])), column_profile(states)
    assert rows(full, *EXACT) == rows(merged, *EXACT)
    assert rows(column_profile(merge_states(states)), *EXACT) == rows(full, *EXACT)
    by_name = {r.column_name: r for r in merged.collect()}
    assert by_name["n"].narrowest_type == "int" and by_name["nothing"].narrowest_type == "string"
    assert abs(by_name["n"].n_distinct - 50) <= 2 and by_name["v"].n_null == sum(d[1] is None for d in data)
    per_part = {(r.part, r.column_name): r.n_rows for r in column_profile(states, ["part"]).collect()}
    assert per_part["a", "v"] == sum(d[0] == "a" for d in data)
    assert column_profile(profile_state(df.where("false"), ["part"])).count() == 0


def test_a_profile_has_one_aggregate_for_any_number_of_columns(spark):
    """A wide aggregate, with its dozen expressions per column, is neither compiled as a whole nor cheap per row."""
    before = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "5000")
    try:
        counts = []
        for n in (2, 20):
            df = spark.range(3).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(n)], "id")
            plan = profile_state(df, ["id"])._jdf.queryExecution().optimizedPlan().toString().lower()
            counts.append(plan.replace("_", "").count("hllsketchagg("))
        assert counts[0] == counts[1] > 0
    finally:
        spark.conf.set("spark.sql.debug.maxToStringFields", before)


def test_casts_that_would_fail_are_not_tried_and_hold_the_same(spark):
    odd = [*VALUES[1:], "+5", "--1", "1.", ".5", "1e", "1L", "0x1p3", "0x1.8P-2d", "2F", "+nan", "-INF", "Infinity", "infin",
           "2147483647", "2147483648", "-2147483648", "-2147483649", "9223372036854775807", "9223372036854775808",
           "-9223372036854775808", "-9223372036854775809", "9" * 18, "1" + "0" * 18, "0" * 30 + "12", "1" * 39, "0" * 50,
           "\t-7\n", "\x001", "1\x7f", "1\u00a0", "\u0661", "1 2", "12:30", "1995", "-1995", "99999"]
    df = spark.createDataFrame([(v,) for v in odd], "v string")
    tried = {r.v: r for r in df.select("v", *[
        F.col("v").try_cast(t).isNotNull().cast("int").alias(t) for t in ("int", "long", "double")]).collect()}
    got = {r.v: r for r in profile_state(df.withColumn("w", F.col("v")), ["v"]).collect()}
    for v in odd:
        assert [got[v][f"n_{t}"] for t in ("int", "long", "double")] == [tried[v][t] for t in ("int", "long", "double")], repr(v)


def test_a_profile_of_no_rows(spark):
    empty = spark.createDataFrame([], "v string, n int")
    assert rows(column_profile(profile_state(empty)), *EXACT) == [
        ("n", 0, 0, None, None, "string"), ("v", 0, 0, None, None, "string")]
    assert [f.dataType.simpleString() for f in infer_types(empty.select("v")).fields] == ["string"]


def test_types_climb_the_lattice(spark):
    cases = {"int": ["1", "-2"], "bigint": ["1", "3000000000"], "decimal(38,0)": ["1", "99999999999999999999"],
             "double": ["1", "1.5"], "date": ["2020-01-02"], "timestamp": ["2020-01-02", "2020-01-02 03:04:05"],
             "boolean": ["true", "FALSE"], "string": ["1", "x"]}
    for kind, values in cases.items():
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v string")
        assert infer_types(df).fields[0].dataType.simpleString() == kind
    assert infer_types(spark.createDataFrame([(None,)], "v string")).fields[0].dataType.simpleString() == "string"


def test_means_are_bit_equal_on_any_partitioning(spark):
    rng = random.Random(7)
    data = [(rng.choice(["Peru", "PERU", "Chad", None]), rng.choice([f"{rng.uniform(-50, 50):.6f}", "0.1", "x", None, "1e30"]),
             rng.choice(["1N", "2N", None]), str(i)) for i in range(3000)]
    df = spark.createDataFrame(data, "country string, t string, lat string, lon string")
    one, many = (means(mean_states(df.repartition(n), "country", "t", ["lat", "lon"]), "country", "mean") for n in (1, 200))
    assert rows(one) == rows(many)
    # Drops merge from their states alone, in any order.
    parts = [df.where(F.col("lon").cast("int") % 3 == i) for i in (2, 0, 1)]
    states = [mean_states(p, "country", "t", ["lat", "lon"]) for p in parts]
    merged = merge_means(states[0].unionByName(states[1]), "country").unionByName(states[2])
    assert rows(means(merged, "country", "mean")) == rows(one)
    exact = {}
    for c, t, _, _ in data:
        if t not in (None, "x", "1e30"):
            exact.setdefault(c.upper() if c else None, []).append(round(float(t) * 10**6))
    got = {r.country: r["mean"] for r in one.collect()}
    assert {c: sum(v) / len(v) / 10**6 for c, v in exact.items()} == pytest.approx(got)


def _hot_fact(spark, n=3000):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("7.0")).when(F.col("id") % 50 == 1, F.lit(None))
        .when(F.col("id") % 50 == 2, F.lit("bad")).otherwise((F.col("id") % 900).cast("string")).alias("code")).repartition(6)


def test_hot_codes_are_decoded_without_a_shuffle(spark):
    book = spark.range(400).select(F.concat(F.col("id").cast("string"), F.lit(".0")).alias("code"),
                                   F.concat(F.lit("label "), F.col("id")).alias("label"))
    book = book.unionByName(spark.createDataFrame([("7", "a label of 7")], "code string, label string"))
    fact = _hot_fact(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for default in (None, "other"):
            want = decode(fact, "code", book, "label", default=default, keep_code=True)
            got = decode_hybrid(fact, "code", book, "label", default=default, keep_code=True, max_broadcast_rows=100)
            assert got.columns == want.columns and rows(got) == rows(want)
        plan = plan_text(decode_hybrid(fact, "code", book, "label", max_broadcast_rows=100))  # not run yet: one plan
        assert plan.count("BroadcastHashJoin") == 1 and "SortMergeJoin" in plan
        hot = plan[:plan.index("BroadcastExchange")]
        assert "hashpartitioning" not in hot  # the hot rows' branch comes first and has no shuffle of the fact
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert frequent_codes(fact, F.expr("TRY_CAST(TRY_CAST(code AS DOUBLE) AS BIGINT)"), 0.2) == [7]


def test_hybrid_decode_of_small_books_empty_facts_and_facts_without_hot_codes(spark):
    book = spark.createDataFrame([("1", "one"), ("2", "two"), ("3", "three")], "code string, label string")
    even = spark.range(600).select(F.col("id").cast("string").alias("code"))
    for fact in (even, even.where("false"), spark.createDataFrame([(None,), ("1",)], "code string")):
        for bound in (100, 2):
            got = decode_hybrid(fact, "code", book, "label", max_broadcast_rows=bound)
            assert rows(got) == rows(decode(fact, "code", book, "label"))


FACT = "ID int, year int, month int, arrival_state string, residence_country string"


def _fact(spark, first, n, month, state="NY"):
    return spark.createDataFrame(
        [(first + i, 2016, month, state if i % 3 else "CA", "MEXICO" if i % 2 else None) for i in range(n)], FACT)


def test_star_counts_and_profiles_follow_a_refresh(spark, tmp_path):
    root = str(tmp_path / "out")
    demo = spark.createDataFrame(
        [("Oakton", "NY", 50, 40, 90, 1, 2, "White", 70), ("LA", "CA", 5, 5, 10, 0, 1, "White", 10)],
        "City string, State_code string, Male_population int, Female_population int, Total_population int, "
        "Number_veterans int, Foreign_born int, Race string, Count int")
    airports = spark.createDataFrame([("01A", "NY"), ("02A", "NY")], "ident string, state string")
    temperature = spark.createDataFrame([("MEXICO", 20.0)], "Country string, Temperature double")
    april, may, fixed = _fact(spark, 0, 30, 4), _fact(spark, 100, 40, 5), _fact(spark, 0, 20, 4, state="TX")
    for df in (april, may, fixed):
        publish(spark, {"immigration": df}, root, states=True)
    stored = may.unionByName(fixed)
    full = arrivals_by_state_month(enriched_arrivals(stored, demo, airports, temperature))
    assert rows(published_state_month(spark, root, demo, airports), *full.columns) == rows(full)
    columns = ["ID", "arrival_state", "residence_country"]
    want = column_profile(profile_state(stored, [], columns))
    got = published_profile(spark, root).where(F.col("column_name").isin(columns))
    assert rows(got, *EXACT) == rows(want, *EXACT)
    # A refresh replaces the states of its own months only.
    months = spark.read.parquet(state_path(root, "immigration", "star")).groupBy("month").agg(F.sum("n_arrivals").alias("n"))
    assert {r.month: r.n for r in months.collect()} == {4: 20, 5: 40}
    publish(spark, {"immigration": april}, root, states=True, replace_fact=True)
    assert {r.month for r in spark.read.parquet(state_path(root, "immigration", "star")).collect()} == {4}


def test_load_step_appends_and_checks_by_table_name(spark, tmp_path):
    root = str(tmp_path / "out")
    tables = {
        "immigration": _fact(spark, 0, 10, 4),
        "demographics": spark.createDataFrame([("Oakton", "NY", "White")], "City string, State_code string, Race string"),
        "temperature": spark.createDataFrame([("MEXICO", 20.0)], "Country string, Temperature double"),
        "airports": spark.createDataFrame([("01A", "NY")], "ident string, state string"),
    }
    publish(spark, tables, root)
    database = unique_table_name("loads")
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    try:
        first = {r.table_name: r.row_count for r in load_tables(spark, root, database=database).collect()}
        again = {r.table_name: r.row_count for r in load_tables(spark, root, database=database).collect()}
        assert again == {t: 2 * n for t, n in first.items()} and first[f"{database}.immigration"] == 10
        replaced = load_tables(spark, root, database=database, replace=True)
        assert {r.table_name: r.row_count for r in replaced.collect()} == first
        spark.sql(f"TRUNCATE TABLE {database}.airports")
        publish(spark, tables | {"airports": tables["airports"].where("false")}, root, check=False)
        with pytest.raises(ValueError, match=f"{database}.airports"):
            load_tables(spark, root, database=database)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")


def test_original_keyword_and_drop_loader_command(spark, write_text, tmp_path):
    from arrivals.plans.run import process_temperature
    from arrivals.streaming.monthly import main
    from tests.test_builds import ARRIVALS_CSV, COUNTRY_CSV, TEMPERATURE_CSV

    process_temperature(spark, write_text("t.csv", TEMPERATURE_CSV), str(tmp_path / "t"), imput_format="csv")
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3
    (tmp_path / "drops").mkdir()
    (tmp_path / "drops" / "2016_04.csv").write_text(ARRIVALS_CSV)
    args = ["--drops", str(tmp_path / "drops"), "--target", str(tmp_path / "fact"), "--checkpoint", str(tmp_path / "c"),
            "--country-lookup", write_text("country.csv", COUNTRY_CSV)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes")}
    try:
        main(args)
        main(args)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert spark.read.parquet(str(tmp_path / "fact")).count() == 3
