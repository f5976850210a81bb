"""S1-S3 with a reject channel: malformed records are kept apart with their file and raw text.

Spark's CSV reader fills short records with nulls, cuts long ones and keeps an
unclosed quote as text, without a word. Here every line is read as text once
and parsed by the same parser (``from_csv`` / ``from_json``), so a record that
does not fit comes back marked instead of altered:

- ``fields``: the record has more or fewer fields than its file's header;
- ``quote``: a field begins with a quote that does not close it;
- ``json``: the line is no JSON object.

The marked rows travel with the others, so one scan yields both; ``split``
takes them apart. As elsewhere, every file is read by its own header.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.sources.readers import FILE, FILE_OPTIONS, file_headers, literal_path, select_by_name

PROBLEM, LINE = "__problem", "__line"
MARKS = (FILE, PROBLEM, LINE)
_CORRUPT = "__corrupt"


def header_names(header: str, sep: str = ",") -> list[str | None]:
    """The columns of a header as Spark's CSV reader names them; None where the cell is blank."""
    cells = next(csv.reader([header], delimiter=sep), []) if len(sep) == 1 else header.split(sep)
    lower = [c.lower() for c in cells]
    return [None if not c.strip() else f"{c}{i}" if lower.count(c.lower()) > 1 else c for i, c in enumerate(cells)]


def _open_quote(line: Column, sep: str, quote: str, escape: str) -> Column:
    """True if a quote that opens a field does not close it (a quote in the middle of an unquoted field is text).

    The line is cut at every separator; going through the pieces, a piece opens
    a quoted field if it begins with a quote, and a piece closes it if it ends in
    a quote that is not escaped (by ``escape``; the quote itself where quotes are doubled).
    """
    q, e = "\\" + quote, "\\" + escape
    closes = rf"(?:^|[^{e}])(?:{e}{e})*{q}$"
    opens = lambda piece: piece.startswith(quote) & ~F.substring(piece, 2, 1 << 30).rlike(closes)
    left_open = F.aggregate(
        F.split(line, "\\Q" + sep + "\\E"), F.lit(False),
        lambda is_open, piece: F.when(is_open, ~piece.rlike(closes)).otherwise(opens(piece)))
    return line.contains(quote) & left_open


def _checked_group(lines: DataFrame, header: str, sep: str, options: dict[str, str]) -> tuple[DataFrame, list[str]]:
    """The rows of the files with one header: named columns and the marks."""
    names = header_names(header, sep)
    schema = ", ".join(f"`c{i}` string" for i in range(len(names))) + f", `{_CORRUPT}` string"
    parse = options | {"sep": sep, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    row = lines.where((F.trim("value") != "") & (F.regexp_replace("value", "^\ufeff|\r$", "") != header)).select(
        FILE, "value", F.from_csv("value", schema, parse).alias("r"))
    values = [F.col(f"r.c{i}") for i in range(len(names))]
    problem = F.when(F.col(f"r.{_CORRUPT}").isNotNull(), F.lit("fields")).when(
        _open_quote(F.col("value"), sep, options.get("quote", '"'), options.get("escape", "\\")), F.lit("quote"))
    named = [(v, n) for v, n in zip(values, names, strict=True) if n is not None]
    out = row.select(*[v.alias(n) for v, n in named], FILE, problem.alias(PROBLEM), F.col("value").alias(LINE))
    return out.withColumn(LINE, F.when(F.col(PROBLEM).isNotNull(), F.col(LINE))), [n for _, n in named]


def read_checked(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str],
    fmt: str = "csv",
    sep: str = ",",
    allow_missing: bool | Iterable[str] = False,
    **options: str,
) -> DataFrame:
    """The wanted columns as text, plus ``__file``, and for malformed records ``__problem`` and ``__line``.

    ``fmt`` is ``csv`` (header files) or ``json`` (an object per line; an absent
    field is null). Records over several lines are not supported here: a quote
    that is closed on a later line is a ``quote`` or ``fields`` problem.
    """
    columns = list(columns)
    reader = spark.read.options(**{k: v for k, v in options.items() if k in FILE_OPTIONS})
    parse = {k: v for k, v in options.items() if k not in FILE_OPTIONS}
    if fmt.lower() == "json":
        lines = reader.text(path).select(F.col("_metadata.file_path").alias(FILE), "value")
        schema = ", ".join(f"`{c}` string" for c in [*columns, _CORRUPT])
        marks = parse | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
        rows = lines.where(F.trim("value") != "").select(FILE, "value", F.from_json("value", schema, marks).alias("r"))
        bad = F.col(f"r.{_CORRUPT}").isNotNull() | F.col("r").isNull()
        return rows.select(*[F.col(f"r.`{c}`").alias(c) for c in columns], FILE,
                           F.when(bad, F.lit("json")).alias(PROBLEM), F.when(bad, F.col("value")).alias(LINE))
    if fmt.lower() != "csv":
        raise ValueError(f"records of {fmt!r} files are checked by the format itself; use read_table")
    parts = []
    for header, files in file_headers(spark, path, **options).items():
        lines = reader.text([literal_path(f) for f in files]).select(F.col("_metadata.file_path").alias(FILE), "value")
        rows, names = _checked_group(lines, header, sep, parse)
        wanted = select_by_name(rows, columns, allow_missing, files[0], names, keep=MARKS)
        parts.append(wanted)
    if not parts:
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*columns, *MARKS]))
    return reduce(DataFrame.unionByName, parts)


def split(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the marks, rejects as ``file, problem, line``)."""
    good = checked.where(F.col(PROBLEM).isNull()).drop(*MARKS)
    rejects = checked.where(F.col(PROBLEM).isNotNull()).select(
        F.col(FILE).alias("file"), F.col(PROBLEM).alias("problem"), F.col(LINE).alias("line"))
    return good, rejects


def reject_report(checked: DataFrame) -> DataFrame:
    """Per file (name without its folder): rows, and rejected rows by problem."""
    return checked.groupBy(F.substring_index(FILE, "/", -1).alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[F.count_if(F.col(PROBLEM) == p).alias(f"n_{p}") for p in ("fields", "quote", "json")])
