"""The four table builds (T1-T4) and publishing with checks (T5).

Each build is one lazy DataFrame plan: scan -> rename -> filter -> convert ->
decode -> conform. Building a plan runs small jobs only: the first line of each
raw file, and the size of each code book that is not a fixed one. The data
moves in ``publish``: computed once into a stage, checked there, then released.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.functions.columns import day_number_to_date, substring_from, text_to_int
from arrivals.operators.aggregate import group_avg_first
from arrivals.operators.clean import drop_columns, drop_missing, filter_equals, rename_columns
from arrivals.operators.decode import decode, decode_roles
from arrivals.operators.key_index import (
    MONTH, key_index, keys_across_months, read_key_index, shared_key_count, write_key_index)
from arrivals.operators.quality import invalid_label, key_summary, require, unmatched_codes
from arrivals.plans.codebooks import MODE_CODES, OTHER_STATE, VISA_CODES, mode_lookup, visa_lookup
from arrivals.plans.ledger import REPORT, Load, interrupted, keys_path, record
from arrivals.plans.month_states import month_states, state_path
from arrivals.schemas import (
    AIRPORTS,
    ARRIVALS,
    DEMOGRAPHICS,
    OPTIONAL_AIRPORTS_COLUMNS,
    OPTIONAL_ARRIVALS_COLUMNS,
    RAW_AIRPORTS_COLUMNS,
    RAW_ARRIVALS_COLUMNS,
    RAW_DEMOGRAPHICS_COLUMNS,
    RAW_TEMPERATURE_COLUMNS,
    STATE_NAME,
    TEMPERATURE,
    UNUSED_ARRIVALS_COLUMNS,
    Contract,
    sql_string,
)
from arrivals.sources.readers import read_lookup, read_parquet, read_table
from arrivals.session import scratch_path
from arrivals.sources.sinks import conform, refresh_months, write_parquet

# Raw header name -> contract column name.
ARRIVALS_RENAMES = {
    "cicid": "ID",
    "i94yr": "year",
    "i94mon": "month",
    "i94port": "port_of_admission",
    "i94mode": "mode_code",
    "i94addr": "arrival_state",
    "i94visa": "visa_code",
    "biryear": "birth_year",
    "i94bir": "age",
}

# Raw header name -> contract column name.
DEMOGRAPHICS_RENAMES = {
    "Median Age": "Median_age",
    "Male Population": "Male_population",
    "Female Population": "Female_population",
    "Total Population": "Total_population",
    "Number of Veterans": "Number_veterans",
    "Foreign-born": "Foreign_born",
    "Average Household Size": "Average_household_size",
    "State Code": "State_code",
}
# The contract's integer columns, and those a row must have.
DEMOGRAPHICS_INT_COLUMNS = [
    "Male_population", "Female_population", "Total_population", "Number_veterans", "Foreign_born", "Count",
]
DEMOGRAPHICS_REQUIRED = [
    "Male_population", "Female_population", "Number_veterans", "Foreign_born", "Average_household_size",
]


@dataclass
class Lookups:
    """Code books for the fact build, each a (code, label) DataFrame.

    ``mode`` and ``visa`` default to the fixed books; ``port`` and ``state``
    are optional (the port and state codes are kept as codes without them).
    """

    country: DataFrame
    mode: DataFrame | None = None
    visa: DataFrame | None = None
    port: DataFrame | None = None
    state: DataFrame | None = None

    @classmethod
    def from_files(cls, spark: SparkSession, country: str, mode: str | None = None, visa: str | None = None,
                   port: str | None = None, state: str | None = None) -> "Lookups":
        rd = lambda p: None if p is None else read_lookup(spark, p)
        return cls(country=rd(country), mode=rd(mode), visa=rd(visa), port=rd(port), state=rd(state))


# Beside the fact's columns, a staged fact has a column per decode with one of these states.
FLAG = "__decode_"
FOUND, NULL_CODE, UNMATCHED, INVALID = 0, 1, 2, 3


def _flag(code: Column, label: Column) -> Column:
    """How a decode ended: the states that ``unmatched_codes`` counts."""
    return (
        F.when(code.isNull(), F.lit(NULL_CODE)).when(label.isNull(), F.lit(UNMATCHED))
        .when(invalid_label(label), F.lit(INVALID)).otherwise(F.lit(FOUND)).cast("tinyint")
    )


def build_arrivals(
    raw: DataFrame, lookups: Lookups, decode_port: bool = False, decode_state: bool = False, flags: bool = False
) -> DataFrame:
    """Raw arrivals (text columns by header name) -> fact table contract.

    Rows without a state of arrival are dropped; codes for mode, visa and the
    two country roles are decoded through size-checked broadcast lookups
    (unknown codes give null); day numbers become dates; text numbers become
    ints ("4.0" -> 4, bad text -> null). ``decode_port``/``decode_state``
    use the port and state books: the port code is replaced by its label, the
    state code is kept (the star links by it) and its name (unknown: other) is
    added as ``arrival_state_name``.

    ``flags`` adds a column ``__decode_<label>`` per decode (also of a port or
    state book that is only given, not used) with how it ended, so ``publish``
    reports the decodes without reading the raw rows again.
    """
    spark = raw.sparkSession
    # The fixed books are in memory and their size is known: no counting job.
    mode, mode_rows = (lookups.mode, None) if lookups.mode is not None else (mode_lookup(spark), len(MODE_CODES))
    visa, visa_rows = (lookups.visa, None) if lookups.visa is not None else (visa_lookup(spark), len(VISA_CODES))

    df = rename_columns(raw, ARRIVALS_RENAMES)
    df = drop_columns(df, UNUSED_ARRIVALS_COLUMNS)
    df = drop_missing(df, ["arrival_state"])
    # The fixed books have one row per code by construction.
    df = decode(df, "mode_code", mode, "Mode", key_type="int", keep_code=True,
                known_rows=mode_rows, unique_codes=mode_rows is not None)
    df = decode(df, "visa_code", visa, "visa", key_type="int", keep_code=True,
                known_rows=visa_rows, unique_codes=visa_rows is not None)
    df = decode_roles(df, lookups.country, {"i94cit": "native_country", "i94res": "residence_country"}, key_type="int",
                      keep_code=True)
    pairs = [("mode_code", "Mode"), ("visa_code", "visa"), ("i94cit", "native_country"), ("i94res", "residence_country")]
    for code, book, label, used in (("port_of_admission", lookups.port, "port", decode_port),
                                    ("arrival_state", lookups.state, "state", decode_state)):
        if book is not None and (used or flags):
            df = decode(df, code, book, label, key_type="string", keep_code=True)
            pairs.append((code, label))
    marked = {f"{FLAG}{label}": _flag(F.col(code), F.col(label)) for code, label in pairs} if flags else {}
    df = df.withColumns(marked | {
        "ID": text_to_int("ID"),
        "year": text_to_int("year"),
        "month": text_to_int("month"),
        "birth_year": text_to_int("birth_year"),
        "age": text_to_int("age"),
        "arrival_date": day_number_to_date("arrdate"),
        "departure_date": day_number_to_date("depdate"),
    })
    fields = [*ARRIVALS.schema.fields]
    if decode_state and lookups.state is not None:
        df = df.withColumn(STATE_NAME, F.coalesce("state", F.lit(OTHER_STATE)))
        fields.append(T.StructField(STATE_NAME, T.StringType()))
    if decode_port and lookups.port is not None:
        df = df.withColumn("port_of_admission", F.col("port"))
    return conform(df, T.StructType([*fields, *[T.StructField(c, T.ByteType()) for c in marked]]))


def arrivals_decode_report(raw: DataFrame, lookups: Lookups) -> DataFrame:
    """Q4 for the fact build: per decoded column (column_name, n_rows,
    n_null_code, n_unmatched, n_invalid) over the rows the fact keeps.

    Same rows and decodes as ``build_arrivals``, with the codes kept so that
    codes without a label (and codes the book labels invalid) are counted
    instead of silently becoming null; the port and state books are included
    where they are given. One pass: decodes then a single aggregate.
    """
    spark = raw.sparkSession
    mode, mode_rows = (lookups.mode, None) if lookups.mode is not None else (mode_lookup(spark), len(MODE_CODES))
    visa, visa_rows = (lookups.visa, None) if lookups.visa is not None else (visa_lookup(spark), len(VISA_CODES))
    df = drop_missing(rename_columns(raw, ARRIVALS_RENAMES), ["arrival_state"])
    df = decode(df, "mode_code", mode, "Mode", key_type="int", keep_code=True,
                known_rows=mode_rows, unique_codes=mode_rows is not None)
    df = decode(df, "visa_code", visa, "visa", key_type="int", keep_code=True,
                known_rows=visa_rows, unique_codes=visa_rows is not None)
    df = decode_roles(df, lookups.country, {"i94cit": "native_country", "i94res": "residence_country"},
                      key_type="int", keep_code=True)
    pairs = [("mode_code", "Mode"), ("visa_code", "visa"), ("i94cit", "native_country"), ("i94res", "residence_country")]
    for code, book, label in (("port_of_admission", lookups.port, "port"), ("arrival_state", lookups.state, "state")):
        if book is not None:
            df = decode(df, code, book, label, key_type="string", keep_code=True)
            pairs.append((code, label))
    return unmatched_codes(df, pairs)


def build_demographics(raw: DataFrame) -> DataFrame:
    """Raw city demographics -> demographics contract.

    Six count columns become ints; rows missing any of five required values
    (including counts whose text did not convert) are dropped.
    """
    df = rename_columns(raw, DEMOGRAPHICS_RENAMES)
    df = df.withColumns({c: text_to_int(c) for c in DEMOGRAPHICS_INT_COLUMNS})
    df = drop_missing(df, DEMOGRAPHICS_REQUIRED)
    return conform(df, DEMOGRAPHICS)


def build_temperature(raw: DataFrame) -> DataFrame:
    """Raw city temperatures -> one row per (upper-cased) country.

    Mean temperature (bad or null values skipped) and one coordinate pair
    taken from a single row, deterministically. This is the only shuffle of
    the four builds, with map-side partial aggregation.
    """
    df = group_avg_first(raw, "Country", "AverageTemperature", ["Latitude", "Longitude"],
                         out_group="Country", out_value="Temperature")
    return conform(df, TEMPERATURE)


def build_airports(raw: DataFrame, country: str = "US") -> DataFrame:
    """T4: raw airport codes -> airports of one country with a state column.

    ``iso_region`` ``US-CA`` gives state ``CA``; the country filter reaches
    the scan as a pushed predicate.
    """
    df = filter_equals(raw, "iso_country", country)
    df = df.withColumn("state", substring_from("iso_region", 4, 10)).drop("iso_region")
    return conform(df, AIRPORTS)


@dataclass
class RawInputs:
    arrivals: str
    demographics: str
    temperature: str
    airports: str
    fmt: str = "csv"


def read_raw_arrivals(spark: SparkSession, path: str | list[str], fmt: str = "csv", **options) -> DataFrame:
    """Raw arrivals by column name; only columns the fact does not use may be missing."""
    return read_table(spark, path, fmt, columns=RAW_ARRIVALS_COLUMNS, allow_missing=OPTIONAL_ARRIVALS_COLUMNS, **options)


def build_all(
    spark: SparkSession, inputs: RawInputs, lookups: Lookups, decode_port: bool = False, decode_state: bool = False,
    flags: bool = False,
) -> dict[str, DataFrame]:
    """The four builds from raw files (the format is a parameter, S3); ``flags`` as in ``build_arrivals``."""
    rd = lambda p, cols, **o: read_table(spark, p, inputs.fmt, columns=cols, **o)
    sep = {"sep": ";"} if inputs.fmt == "csv" else {}
    raw = read_raw_arrivals(spark, inputs.arrivals, inputs.fmt)
    return {
        ARRIVALS.name: build_arrivals(raw, lookups, decode_port, decode_state, flags),
        DEMOGRAPHICS.name: build_demographics(rd(inputs.demographics, RAW_DEMOGRAPHICS_COLUMNS, **sep)),
        TEMPERATURE.name: build_temperature(rd(inputs.temperature, RAW_TEMPERATURE_COLUMNS)),
        AIRPORTS.name: build_airports(
            rd(inputs.airports, RAW_AIRPORTS_COLUMNS, allow_missing=OPTIONAL_AIRPORTS_COLUMNS)),
    }


CONTRACTS: dict[str, Contract] = {c.name: c for c in (ARRIVALS, DEMOGRAPHICS, TEMPERATURE, AIRPORTS)}


def _contract_schema(name: str, columns: list[str]) -> T.StructType | None:
    """The contract's schema, with the fact's state name where the table has it."""
    contract = CONTRACTS.get(name)
    if contract is None:
        return None
    named = name == ARRIVALS.name and STATE_NAME in columns
    return T.StructType([*contract.schema.fields, *[T.StructField(STATE_NAME, T.StringType())] * named])


def read_published(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A published table, columns in its contract's order (a partitioned fact
    table otherwise lists ``year``, ``month`` last). A table without a row reads as empty."""
    path = f"{root.rstrip('/')}/{name}"
    contract = CONTRACTS.get(name)
    if contract is None:
        return read_parquet(spark, path)
    try:
        df = read_parquet(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "UNABLE_TO_INFER_SCHEMA":  # files: none yet
            raise
        return spark.createDataFrame([], contract.schema)
    return conform(df, _contract_schema(name, df.columns), strict=True)


def _report_rows(table: str, check: str, counts: DataFrame, *columns: tuple[str, str]) -> DataFrame:
    """(table_name, check_name, column_name, n_rows, passed): one row per (count column, reported column)."""
    parts = ", ".join(f"{sql_string(shown)}, CAST({c} AS BIGINT)" for c, shown in columns)
    rows = counts.selectExpr(f"stack({len(columns)}, {parts}) AS (column_name, n_rows)")
    passed = F.col("n_rows") > 0 if check == "rows" else F.col("n_rows") == 0
    return rows.select(F.lit(table).alias("table_name"), F.lit(check).alias("check_name"), "column_name", "n_rows",
                       passed.alias("passed"))


def _key_rows(name: str, df: DataFrame) -> DataFrame:
    """Q1 and Q2 of one table."""
    key = list(CONTRACTS[name].key) if name in CONTRACTS else []
    if not key:
        return _report_rows(name, "rows", df.agg(F.count(F.lit(1)).alias("n")), ("n", ""))
    summary, shown = key_summary(df, key), ", ".join(key)
    return reduce(DataFrame.unionAll, [_report_rows(name, check, summary, (f"coalesce({c}, 0)", x)) for check, c, x in (
        ("rows", "n_rows", ""), ("null_keys", "n_null_key_rows", shown), ("duplicate_keys", "n_duplicate_keys", shown))])


def _stage_table(name: str, df: DataFrame, stage: str) -> DataFrame:
    """Conform a table and write it to the run's stage, the decode flags of a fact beside its columns."""
    schema = _contract_schema(name, df.columns)
    if schema is not None:
        flags = [f for f in df.schema.fields if f.name.startswith(FLAG)]
        df = conform(df, T.StructType([*schema.fields, *flags]))
    df.write.parquet(f"{stage}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{stage}/{name}")


HAS_MONTH = "year IS NOT NULL AND month IS NOT NULL"


def _fact_facts(fact: DataFrame) -> Row:
    """One pass over a staged fact: rows, rejected rows, months, decode states, and a fingerprint of the content.

    The fingerprint is a sum and a parity of row hashes, so neither order nor partitioning matters.
    """
    month = F.when(F.expr(HAS_MONTH), F.struct("year", "month"))
    columns = [F.col(f"`{c}`") for c in fact.columns]
    nulls = reduce(lambda a, b: a + b, [c.isNull().cast("long") * (1 << i) for i, c in enumerate(columns)])
    row = F.xxhash64(nulls, *columns)  # the hash alone passes over nulls
    aggs = [
        F.count(F.lit(1)).alias("n_all"), F.count(month).alias("n_rows"), F.collect_set(month).alias("months"),
        F.bit_xor(row).alias("parity"), F.sum(row.bitwiseAND(F.lit((1 << 31) - 1))).alias("total"),
    ]
    for c in fact.columns:
        if c.startswith(FLAG):
            aggs += [F.count_if(F.col(c) == state).alias(f"{c}{state}") for state in (UNMATCHED, INVALID)]
    return fact.agg(*aggs).first()


def _fact_rows(name: str, fact: DataFrame, facts: Row, n_shared: int) -> list[tuple]:
    """The report's rows that only a fact has."""
    key = ", ".join(CONTRACTS[name].key)
    rows = [(name, "rejected", "year, month", facts.n_all - facts.n_rows), (name, "keys_in_other_months", key, n_shared)]
    rows += [(name, check, c.removeprefix(FLAG), facts[f"{c}{state}"])
             for c in fact.columns if c.startswith(FLAG) for check, state in (("unmatched", UNMATCHED), ("invalid", INVALID))]
    return [(*r, r[-1] == 0) for r in rows]


def _shared_keys(spark: SparkSession, index: DataFrame, path: str, months: list[tuple[int, int]]) -> int:
    """How many keys of this load the stored months it does not replace hold."""
    try:
        stored = read_key_index(spark, path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return 0
    when = 100 * F.col("year").cast("long") + F.col("month")
    return shared_key_count(index, stored.where(~when.isin([100 * y + m for y, m in months]))).first().n_shared


def _together(spark: SparkSession, jobs: Mapping[str, Callable[[], object]], parallel: bool) -> dict:
    """Run independent jobs side by side: none reads what another writes."""
    if not parallel or len(jobs) < 2:
        return {name: job() for name, job in jobs.items()}
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = {name: pool.submit(job) for name, job in jobs.items()}
        return {name: f.result() for name, f in futures.items()}


def publish(
    spark: SparkSession,
    tables: Mapping[str, DataFrame],
    root: str,
    fact: str = ARRIVALS.name,
    check: bool = True,
    parallel: bool = True,
    replace_fact: bool = False,
    decodes: DataFrame | None = None,
    load: str | None = None,
    states: bool = False,
) -> DataFrame:
    """T5: stage every table, check the stage, then release it under ``root``.

    1. Stage: every table is computed once and written to a folder of this run
       under the shared scratch folder; a fact built with ``flags`` carries the
       state of its decodes.
    2. Check: the report is made from the stage. ``rows`` counts what the run
       will release; ``null_keys`` and ``duplicate_keys`` are over each
       contract's key; ``rejected`` counts the fact rows without a month,
       ``keys_in_other_months`` the keys that stored months this run does not
       replace hold too (from the bitmap index, not from the fact);
       ``unmatched`` and ``invalid`` count the codes that found no or an invalid
       label. Only ``rows`` is required: with ``check`` a table without rows
       raises, naming it, and the warehouse stays as it was.
    3. Release: dimensions are replaced, the fact is refreshed month by month
       (dynamic partition overwrite: a re-run replaces its months), or as a whole
       with ``replace_fact``. Rejects are kept per ``load``, by default named by
       the content: repeating a load replaces its rejects, also when it has none
       any more, and touches no other load's. A release that was interrupted is
       completed by ``complete_releases``.

    Every step is in the ledger (``arrivals.plans.ledger``). The returned report
    is the run's entry there (at most some 40 rows). ``states`` also keeps the
    small per-month states of ``arrivals.plans.month_states``. ``decodes`` adds the rows
    of an ``arrivals_decode_report`` for a fact built without flags. The tables
    share no data, so with ``parallel`` their jobs run side by side. Counts come
    from committed files, so they stay exact when tasks are retried after an
    executor loss.
    """
    names, stage = list(tables), scratch_path(spark, "stage")
    staged = _together(spark, {n: lambda n=n: _stage_table(n, tables[n], stage) for n in names}, parallel)
    keyed = {n: df.where(HAS_MONTH) if n == fact else df for n, df in staged.items()}
    jobs = {n: lambda n=n: [tuple(r) for r in _key_rows(n, df=keyed[n]).collect()] for n in names}
    if fact in staged:
        jobs["__facts"] = lambda: _fact_facts(staged[fact])
        if fact in CONTRACTS:
            jobs["__keys"] = lambda: write_parquet(key_index(staged[fact], *CONTRACTS[fact].key), f"{stage}/{fact}_keys")
        if states:
            kept = month_states(staged[fact], [c for c in staged[fact].columns if not c.startswith(FLAG)])
            for name, df in kept.items():
                jobs[f"__{name}"] = lambda name=name, df=df: write_parquet(df, f"{stage}/{fact}_{name}")
    if decodes is not None:
        jobs["__decodes"] = decodes.collect
    done = _together(spark, jobs, parallel)

    run = Load("", "", stage, replace_fact, names, [], 0, 0)
    if states and fact in staged:
        run.states = sorted(kept)
    for n in names:
        run.report += done[n]
        if n == fact:
            facts = done["__facts"]
            run.months, run.n_rows = sorted(tuple(m) for m in facts.months), facts.n_rows
            run.n_rejected = facts.n_all - facts.n_rows
            run.fingerprint = f"{facts.n_all}-{(facts.parity or 0) % (1 << 64):016x}-{facts.total or 0:x}"
            if fact in CONTRACTS:
                index = read_key_index(spark, f"{stage}/{fact}_keys")
                shared = 0 if replace_fact else _shared_keys(spark, index, keys_path(root, fact), run.months)
                run.report += _fact_rows(n, staged[n], facts, shared)
    for r in done.get("__decodes", ()):
        run.report += [(fact, check_name, r.column_name, r[c], r[c] == 0)
                       for check_name, c in (("unmatched", "n_unmatched"), ("invalid", "n_invalid"))]
    run.load = load or f"content-{run.fingerprint}"
    report = spark.createDataFrame(run.report, REPORT)
    record(spark, root, run, "staged")
    if check:
        try:
            require(report.where("check_name = 'rows'"))
        except ValueError:
            record(spark, root, run, "failed")
            raise
    release(spark, root, run, fact, parallel)
    return report


def release(spark: SparkSession, root: str, run: Load, fact: str = ARRIVALS.name, parallel: bool = True) -> None:
    """Move a staged run into the warehouse. Doing it again gives the same tables."""
    root = root.rstrip("/")

    def move(name: str) -> None:
        df = read_parquet(spark, f"{run.stage}/{name}")
        df = df.drop(*[c for c in df.columns if c.startswith(FLAG)])
        if name == fact:
            refresh_months(df, f"{root}/{name}", MONTH, load=run.load, replace=run.replace)
        else:
            write_parquet(df, f"{root}/{name}")

    jobs: dict[str, Callable[[], object]] = {n: lambda n=n: move(n) for n in run.tables}
    if fact in run.tables and fact in CONTRACTS:
        jobs["__keys"] = lambda: write_key_index(
            read_key_index(spark, f"{run.stage}/{fact}_keys"), keys_path(root, fact), run.replace)
    for state in run.states:
        jobs[f"__{state}"] = lambda state=state: write_parquet(
            read_parquet(spark, f"{run.stage}/{fact}_{state}"), state_path(root, fact, state), partition_by=MONTH,
            partition_mode="static" if run.replace else "dynamic")
    _together(spark, jobs, parallel)
    record(spark, root, run, "released")


def complete_releases(spark: SparkSession, root: str, fact: str = ARRIVALS.name) -> list[str]:
    """Release, oldest first, every run that was staged and checked but not released to the end; their loads."""
    runs = interrupted(spark, root)
    for run in runs:
        release(spark, root, run, fact)
    return [run.load for run in runs]


def published_keys_across_months(spark: SparkSession, root: str, fact: str = ARRIVALS.name) -> DataFrame:
    """Q2 over the whole stored fact: every key that more than one month holds, from the index alone."""
    return keys_across_months(read_key_index(spark, keys_path(root, fact)))
