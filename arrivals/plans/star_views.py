"""The star schema as analysts query it: the fact table with its dimensions
linked at state and country grain (J6-J8 on the published contracts)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.operators.aggregate import aggregate_by_state
from arrivals.operators.star import count_per_key, star_link
from arrivals.schemas import STATE_NAME

STATE_MEASURES = {
    "Male_population": "Male_population",
    "Female_population": "Female_population",
    "Total_population": "Total_population",
    "Number_veterans": "Number_veterans",
    "Foreign_born": "Foreign_born",
}


def state_profile(demographics: DataFrame, key: str = "State_code") -> DataFrame:
    """Demographics at state grain: cities counted once (not once per race row), spellings of a state in one case."""
    return aggregate_by_state(demographics.withColumn(key, F.upper(key)), key, ["City"], STATE_MEASURES, n_cities="n_cities").withColumnRenamed(
        key, "link_key"
    )


def enriched_arrivals(
    fact: DataFrame, demographics: DataFrame, airports: DataFrame, temperature: DataFrame, by: str = "code"
) -> DataFrame:
    """Every fact row with its state's population profile and airport count and
    its residence country's mean temperature. Each dimension is reduced to the
    link grain first, so the result has exactly the fact's rows.

    ``by="name"`` links the population by the full state name, for a fact
    built with ``decode_state`` (it holds code and name); airports know codes only.
    """
    fact_key, dim_key = {"code": ("arrival_state", "State_code"), "name": (STATE_NAME, "State")}[by]
    df = star_link(fact, fact_key, state_profile(demographics, dim_key), normalise="upper")
    df = star_link(df, "arrival_state", count_per_key(airports, "state", out="n_airports"))
    temp = temperature.groupBy(F.upper("Country").alias("link_key")).agg(
        F.avg("Temperature").alias("residence_temperature"))
    return star_link(df, "residence_country", temp, normalise="upper")


def arrivals_by_state_month(enriched: DataFrame) -> DataFrame:
    """Arrivals per state and month next to the state's population."""
    return enriched.groupBy("arrival_state", "year", "month").agg(
        F.count(F.lit(1)).alias("n_arrivals"),
        F.max("Total_population").alias("state_population"),
        F.max("n_airports").alias("n_airports"),
    )
