"""The ledger of loads: what every publishing run staged, reported and released.

It is an append-only table beside the warehouse (``state_root``), one row per
event of a run: ``staged`` (with the quality report and where the staged tables
are), ``failed`` (a required check did not pass; the warehouse was not touched)
and ``released``. A run whose last event is ``staged`` was interrupted between
its checks and the end of its release; releasing its stage again completes it.
"""

from __future__ import annotations

import datetime as dt
import uuid
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

REPORT = "table_name string, check_name string, column_name string, n_rows long, passed boolean"
EVENT = (
    "run string, event string, at timestamp, load string, fingerprint string, stage string, replace boolean, "
    "tables array<string>, states array<string>, months array<struct<year: int, month: int>>, n_rows long, n_rejected long, "
    f"report array<struct<{', '.join(': '.join(c.split()) for c in REPORT.split(', '))}>>"
)


def state_root(root: str) -> str:
    """Where a warehouse keeps its ledger and its key index: beside its tables."""
    return root.rstrip("/") + "_state"


def loads_path(root: str) -> str:
    return f"{state_root(root)}/loads"


def keys_path(root: str, fact: str) -> str:
    return f"{state_root(root)}/{fact}_keys"


@dataclass
class Load:
    """One run of ``publish``."""

    load: str
    fingerprint: str
    stage: str
    replace: bool
    tables: list[str]
    months: list[tuple[int, int]]
    n_rows: int
    n_rejected: int
    report: list[tuple] = field(default_factory=list)
    states: list[str] = field(default_factory=list)
    run: str = field(default_factory=lambda: uuid.uuid4().hex)


def record(spark: SparkSession, root: str, load: Load, event: str) -> None:
    """Append one event of a run (one small file, written by Spark's commit protocol)."""
    row = (load.run, event, dt.datetime.now(dt.timezone.utc), load.load, load.fingerprint, load.stage, load.replace,
           load.tables, load.states, load.months, load.n_rows, load.n_rejected, load.report)
    spark.createDataFrame([row], EVENT).coalesce(1).write.mode("append").parquet(loads_path(root))


def read_loads(spark: SparkSession, root: str) -> DataFrame:
    """All events (``EVENT``); none for a warehouse that has had no run."""
    try:
        return spark.read.schema(EVENT).parquet(loads_path(root))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], EVENT)


def applied_loads(spark: SparkSession, root: str) -> DataFrame:
    """The last release of every load: (load, fingerprint, at, months, n_rows, n_rejected)."""
    latest = Window.partitionBy("load").orderBy(F.col("at").desc(), "run")
    return (
        read_loads(spark, root).where("event = 'released'").withColumn("__at", F.row_number().over(latest))
        .where("__at = 1").select("load", "fingerprint", "at", "months", "n_rows", "n_rejected")
    )


def run_report(spark: SparkSession, root: str, run: str) -> DataFrame:
    """The quality report of one run, as the ledger holds it."""
    return read_loads(spark, root).where((F.col("run") == run) & (F.col("event") == "staged")).select(
        F.inline("report"))


def interrupted(spark: SparkSession, root: str) -> list[Load]:
    """Runs that were staged and checked but neither released nor refused, oldest first."""
    events = read_loads(spark, root)
    ended = events.where("event <> 'staged'").select("run").distinct()
    rows = events.where("event = 'staged'").join(ended, "run", "left_anti").orderBy("at").collect()
    return [_load(r) for r in rows]


def _load(r: Row) -> Load:
    return Load(r.load, r.fingerprint, r.stage, r.replace, list(r.tables), [tuple(m) for m in r.months or ()], r.n_rows,
                r.n_rejected, [tuple(x) for x in r.report or ()], list(r.states or ()), r.run)
