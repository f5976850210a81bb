"""Small per-month states of the published fact, replaced together with their months.

A publishing run makes them from its own stage, so after a refresh of some
months the reports below read states only, of the changed months as well as of
the others:

- ``star``: arrivals per state and residence country (J6-J8 counted per month);
- ``profile``: the column profile of every column (A4, Q3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.operators.key_index import MONTH
from arrivals.operators.profile import column_profile, profile_state
from arrivals.operators.star import count_per_key, star_link
from arrivals.plans.ledger import state_root
from arrivals.plans.star_views import state_profile
from arrivals.schemas import ARRIVALS

STAR_KEYS = ("arrival_state", "residence_country")


def state_path(root: str, fact: str, name: str) -> str:
    return f"{state_root(root)}/{fact}_{name}"


def star_partials(fact: DataFrame) -> DataFrame:
    """(arrival_state, residence_country, n_arrivals, year, month)."""
    return fact.groupBy(*STAR_KEYS, *MONTH).agg(F.count(F.lit(1)).alias("n_arrivals"))


def month_states(fact: DataFrame, columns: list[str]) -> dict[str, DataFrame]:
    """The states of a staged fact's months, by name."""
    has_month = fact.where("year IS NOT NULL AND month IS NOT NULL")
    states = {"profile": profile_state(has_month, MONTH, [c for c in columns if c not in MONTH])}
    if all(c in columns for c in STAR_KEYS):
        states["star"] = star_partials(has_month)
    return states


def published_profile(spark: SparkSession, root: str, fact: str = ARRIVALS.name) -> DataFrame:
    """The column profile over all stored months, merged from their states."""
    return column_profile(spark.read.parquet(state_path(root, fact, "profile")))


def published_state_month(
    spark: SparkSession, root: str, demographics: DataFrame, airports: DataFrame, fact: str = ARRIVALS.name
) -> DataFrame:
    """Arrivals per state and month with the state's population and airports, as ``arrivals_by_state_month`` gives them
    from the fact, but from the months' partial counts."""
    partial = spark.read.parquet(state_path(root, fact, "star")).groupBy("arrival_state", *MONTH).agg(
        F.sum("n_arrivals").alias("n_arrivals"))
    df = star_link(partial, "arrival_state", state_profile(demographics), normalise="upper")
    df = star_link(df, "arrival_state", count_per_key(airports, "state", out="n_airports"))
    return df.select("arrival_state", *MONTH, "n_arrivals", F.col("Total_population").alias("state_population"), "n_airports")
