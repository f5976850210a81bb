"""End-to-end run: raw files -> four checked parquet tables.

    python -m arrivals.plans.run --arrivals A --demographics D --temperature T \\
        --airports P --country-lookup C --output OUT [--format csv] \\
        [--port-lookup P2 --state-lookup S] [--mode-lookup M --visa-lookup V]

The caller's session (``spark-submit``) supplies cluster settings; the output
root should be a shared file system path.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from arrivals.plans.builds import (
    Lookups,
    RawInputs,
    build_airports,
    build_all,
    build_arrivals,
    build_demographics,
    build_temperature,
    publish,
    read_raw_arrivals,
)
from arrivals.schemas import (
    OPTIONAL_AIRPORTS_COLUMNS,
    RAW_AIRPORTS_COLUMNS,
    RAW_DEMOGRAPHICS_COLUMNS,
    RAW_TEMPERATURE_COLUMNS,
)
from arrivals.session import apply_cluster_conf
from arrivals.sources.readers import read_table
from arrivals.sources.sinks import refresh_months, staged, write_parquet


def run_etl(
    spark: SparkSession,
    inputs: RawInputs,
    lookups: Lookups,
    output_root: str,
    decode_port: bool = False,
    decode_state: bool = False,
    replace_fact: bool = False,
    load: str | None = None,
) -> DataFrame:
    """Build the four tables, publish them under ``output_root`` and return the
    (already checked) quality report of this run: rows, keys, rejected rows, and
    codes without a valid label. ``replace_fact`` replaces the fact as a whole
    (a corrected full load) instead of month by month; ``load`` names the input
    in the ledger (by default by its content). The raw arrivals are read once."""
    tables = build_all(spark, inputs, lookups, decode_port=decode_port, decode_state=decode_state, flags=True)
    return publish(spark, tables, output_root, replace_fact=replace_fact, load=load, states=True)


# --- one call per dataset: (spark, input_path, output_path, input_format) -------------
# Fixed names: the public entry points that callers of the original use, ``imput_format`` (their spelling) included.

def process_immigration(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    input_format: str = "csv",
    *,
    country_lookup: str = "lookup/country.csv",
    mode_lookup: str | None = None,
    visa_lookup: str | None = None,
    port_lookup: str | None = None,
    state_lookup: str | None = None,
    replace: bool = False,
    imput_format: str | None = None,
) -> None:
    """Raw arrivals -> fact table at ``output_path`` (months refreshed, not appended; ``replace`` replaces all).

    Code books are passed explicitly (files with a code and a label column);
    mode and visa default to the fixed books, port and state are decoded where
    their book is given.
    """
    raw = read_raw_arrivals(spark, input_path, imput_format or input_format)
    lookups = Lookups.from_files(spark, country=country_lookup, mode=mode_lookup, visa=visa_lookup,
                                 port=port_lookup, state=state_lookup)
    fact = build_arrivals(raw, lookups, decode_port=port_lookup is not None, decode_state=state_lookup is not None)
    refresh_months(staged(fact, "immigration"), output_path, load=input_path, replace=replace)


def process_demographics(
    spark: SparkSession, input_path: str, output_path: str, input_format: str = "csv", *, imput_format: str | None = None
) -> None:
    """Raw city demographics (``;``-separated when CSV) -> demographics table."""
    fmt = imput_format or input_format
    opts = {"sep": ";"} if fmt == "csv" else {}
    raw = read_table(spark, input_path, fmt, columns=RAW_DEMOGRAPHICS_COLUMNS, **opts)
    write_parquet(build_demographics(raw), output_path)


def process_temperature(
    spark: SparkSession, input_path: str, output_path: str, input_format: str = "csv", *, imput_format: str | None = None
) -> None:
    """Raw city temperatures -> one row per country."""
    raw = read_table(spark, input_path, imput_format or input_format, columns=RAW_TEMPERATURE_COLUMNS)
    write_parquet(build_temperature(raw), output_path)


def process_airports(
    spark: SparkSession, input_path: str, output_path: str, input_format: str = "csv", *, imput_format: str | None = None
) -> None:
    """Raw airport codes -> US airports with a state column."""
    raw = read_table(spark, input_path, imput_format or input_format, columns=RAW_AIRPORTS_COLUMNS,
                     allow_missing=OPTIONAL_AIRPORTS_COLUMNS)
    write_parquet(build_airports(raw), output_path)


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("arrivals", "demographics", "temperature", "airports", "country-lookup", "output"):
        p.add_argument(f"--{name}", required=True)
    for name in ("mode-lookup", "visa-lookup", "port-lookup", "state-lookup"):
        p.add_argument(f"--{name}")
    p.add_argument("--format", default="csv")
    p.add_argument("--replace-fact", action="store_true")
    p.add_argument("--load", help="name of this input in the ledger of loads")
    p.add_argument("--input-gb", type=float, help="raw input size; sizes the shuffles")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("arrivals-build").getOrCreate()
    apply_cluster_conf(spark, a.input_gb)
    lookups = Lookups.from_files(spark, country=a.country_lookup, mode=a.mode_lookup, visa=a.visa_lookup,
                                 port=a.port_lookup, state=a.state_lookup)
    inputs = RawInputs(a.arrivals, a.demographics, a.temperature, a.airports, a.format)
    report = run_etl(spark, inputs, lookups, a.output,
                     decode_port=a.port_lookup is not None, decode_state=a.state_lookup is not None, replace_fact=a.replace_fact,
                     load=a.load)
    report.show(200, truncate=False)


if __name__ == "__main__":
    main()
