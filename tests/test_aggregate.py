from arrivals.operators.aggregate import (
    aggregate_by_state,
    group_avg_first,
    null_profile,
    row_count,
    sum_by_state_and_group,
)
from tests.conftest import plan_text


def test_group_avg_first_merges_case_variants_and_is_deterministic(spark):
    raw = spark.createDataFrame(
        [
            ("Côte", "10.0", "5.1N", "3.2W"),
            ("CÔTE", "20.0", "4.0N", "9.9W"),
            ("côte", None, None, "1.0W"),
            ("Côte", "bad", "6.0N", "0.0W"),
            (None, "7.0", None, None),
        ],
        "Country string, AverageTemperature string, Latitude string, Longitude string",
    )
    out = group_avg_first(raw, "Country", "AverageTemperature", ["Latitude", "Longitude"], out_value="Temperature")
    assert out.columns == ["Country", "Temperature", "Latitude", "Longitude"]
    rows = {r.Country: tuple(r) for r in out.collect()}
    assert rows["CÔTE"] == ("CÔTE", 15.0, "4.0N", "9.9W")
    assert rows[None] == (None, 7.0, None, None)


def test_group_avg_first_hashes_its_input(spark):
    """Only the grouped tuples are sorted for the representative, never the input rows."""
    raw = spark.createDataFrame([("a", "1.0", "x", "y")], "Country string, t string, lat string, lon string")
    plan = plan_text(group_avg_first(raw, "Country", "t", ["lat", "lon"]))
    below = plan[plan.rindex("Exchange hashpartitioning"):]
    assert "HashAggregate" in below and "SortAggregate" not in below and "Sort [" not in below


def test_row_count(spark):
    assert row_count(spark.range(7)).first().row_count == 7


def test_aggregate_by_state_deduplicates_city_rows(spark):
    demo = spark.createDataFrame(
        [
            ("Austin", "TX", 100, "White", 60),
            ("Austin", "TX", 100, "Asian", 40),
            ("Dallas", "TX", 50, "White", 50),
            ("Reno", "NV", 30, "White", 30),
        ],
        "City string, State_code string, Total_population int, Race string, Count int",
    )
    out = {r.State_code: (r.n_cities, r.Total_population) for r in
           aggregate_by_state(demo, "State_code", ["City"], {"Total_population": "Total_population"}).collect()}
    assert out == {"TX": (2, 150), "NV": (1, 30)}
    race = {(r.State_code, r.Race): r.Count for r in sum_by_state_and_group(demo, "State_code", "Race", "Count").collect()}
    assert race == {("TX", "White"): 110, ("TX", "Asian"): 40, ("NV", "White"): 30}


def test_null_profile(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    got = {r.column_name: (r.null_count, r.row_count) for r in null_profile(df).collect()}
    assert got == {"a": (1, 3), "b": (2, 3)}


def test_null_profile_odd_column_names(spark):
    df = spark.createDataFrame([(None, 1)], "`it's` int, `back\\\\slash` int")
    got = {r.column_name: r.null_count for r in null_profile(df).collect()}
    assert got == {"it's": 1, "back\\\\slash": 0}
