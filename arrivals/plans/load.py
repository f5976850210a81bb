"""The load step: published tables into catalog tables, then a check by table name.

    python -m arrivals.plans.load --root OUT [--database D] [--replace]

Tables that do not exist are created from their contract. Rows are appended by
column name (a repeated load of the same rows therefore doubles them, as a plain
copy would); ``replace`` drops and creates the tables instead.
"""

from __future__ import annotations

import argparse
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from arrivals.operators.quality import non_empty_report, require
from arrivals.plans.builds import CONTRACTS, read_published
from arrivals.sources.sinks import append_by_name, create_table, replace_table


def load_tables(
    spark: SparkSession, root: str, names: Iterable[str] = tuple(CONTRACTS), database: str | None = None,
    replace: bool = False, location: str | None = None, check: bool = True,
) -> DataFrame:
    """Load the published tables under ``root`` and return the non-empty report (table_name, row_count, passed).

    With ``check`` a table without rows raises, naming it. ``location`` makes
    tables that are created external, each in a folder of its own below it.
    """
    tables = {}
    for name in names:
        table = f"{database}.{name}" if database else name
        rows = read_published(spark, root, name)
        path = f"{location.rstrip('/')}/{name}" if location else None
        if replace:
            replace_table(rows, table, path)
        else:
            if not spark.catalog.tableExists(table):
                create_table(spark, table, rows.schema, path)
            append_by_name(rows, table)
        tables[table] = spark.table(table)
    report = non_empty_report(tables)
    return require(report) if check else report


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    p.add_argument("--root", required=True)
    p.add_argument("--database")
    p.add_argument("--location")
    p.add_argument("--replace", action="store_true")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("arrivals-load").getOrCreate()
    load_tables(spark, a.root, database=a.database, replace=a.replace, location=a.location).show(truncate=False)


if __name__ == "__main__":
    main()
