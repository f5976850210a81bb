"""Scans (S1-S6).

Raw delimited files are read as text and columns are found by their header
name. Spark takes the header of one file and applies it to all the others by
position, so a folder is read with one scan per distinct header: the files'
first lines are fetched (each file's first split, one line of it), files are
grouped by header, and the scans are united by column name. Selecting the
wanted columns right after the read lets Catalyst prune the rest at the scan.
"""

from __future__ import annotations

import csv
from collections.abc import Iterable, Iterator
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.functions.columns import normalise_text
from arrivals.operators.profile import infer_types

FILE = "__file"


def _paths(path: str | list[str]) -> list[str]:
    return [path] if isinstance(path, str) else list(path)


def literal_path(path: str) -> str:
    """A path whose characters are all meant literally (Spark would expand ``drop[1].csv`` as a pattern)."""
    return "".join("\\" + c if c in "{}[]*?\\" else c for c in path)


def file_headers(spark: SparkSession, path: str | list[str], **options: str) -> dict[str, list[str]]:
    """First line -> the files that start with it.

    One task per file (neither split nor packed in this job), which stops
    after its first rows; files without a line have no header and no rows.
    """
    def first_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.slice(0, 1)
                return

    reader = spark.read.options(**{k: v for k, v in options.items() if k in FILE_OPTIONS})
    lines = reader.text(_paths(path)).select(F.col("_metadata.file_path").alias("file"), "value")
    before = {k: spark.conf.get(k) for k in _SPLITTING}
    for k in _SPLITTING:
        spark.conf.set(k, str(1 << 50))
    try:
        rows = lines.mapInArrow(first_row, lines.schema).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    out: dict[str, list[str]] = {}
    for r in sorted(rows, key=lambda r: r.file):
        out.setdefault(r.value.lstrip("\ufeff").rstrip("\r"), []).append(unquote(r.file))
    return out


_SPLITTING = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
FILE_OPTIONS = ("encoding", "pathGlobFilter", "recursiveFileLookup", "modifiedBefore", "modifiedAfter")


def _find(names: list[str], wanted: str) -> str | None:
    """A column by its exact name, else ignoring case as Spark does."""
    if wanted in names:
        return wanted
    same = [n for n in names if n.lower() == wanted.lower()]
    if len(same) > 1:
        raise ValueError(f"column {wanted!r} is ambiguous: {same}")
    return same[0] if same else None


def select_by_name(
    df: DataFrame, columns: Iterable[str] | None, allow_missing: bool | Iterable[str], source: str = "the input",
    names: list[str] | None = None, keep: Iterable[str] = (),
) -> DataFrame:
    """The wanted columns in order, then those of ``keep``; missing ones are null if allowed, else an error that
    names the source."""
    names = df.columns if names is None else names
    if columns is None:
        return df.select(*[F.col(f"`{n}`") for n in names])
    optional = None if isinstance(allow_missing, bool) else {c.lower() for c in allow_missing}
    cols = []
    for name in columns:
        have = _find(names, name)
        if have is not None:
            cols.append(F.col(f"`{have}`").alias(name))
        elif allow_missing is True or (optional is not None and name.lower() in optional):
            cols.append(F.lit(None).cast("string").alias(name))
        else:
            raise ValueError(f"column {name!r} not found in {source}; it has {names}")
    return df.select(*cols, *keep)


def _named_cells(df: DataFrame, header: str, sep: str) -> list[str]:
    """Columns that have a name in the header: Spark calls those with a blank cell ``_c<position>``."""
    cells = next(csv.reader([header], delimiter=sep), []) if len(sep) == 1 else header.split(sep)
    return [n for i, n in enumerate(df.columns)
            if not (n == f"_c{i}" and (i >= len(cells) or not cells[i].strip().strip('"')))]


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    columns: Iterable[str] | None = None,
    sep: str = ",",
    allow_missing: bool | Iterable[str] = False,
    with_file: bool = False,
    **options: str,
) -> DataFrame:
    """Header CSV, every column text, columns found by each file's own header (case ignored).

    ``allow_missing`` names the optional columns (True: all); a file without a
    required column is an error that names it. Without ``columns`` the result
    has the columns of all files; a column that a file lacks is null there.
    ``with_file`` adds the file of each row as ``__file``.
    """
    headers = file_headers(spark, path, **options)
    if not headers:
        if columns is None:
            raise ValueError(f"no header line in {path!r}")
        wanted = list(columns)
        return spark.createDataFrame([], ", ".join(f"`{c}` string" for c in [*wanted, *[FILE] * with_file]))
    parts = []
    for header, files in headers.items():
        df = spark.read.options(header="true", sep=sep, **options).csv([literal_path(f) for f in files])
        part = select_by_name(df, columns, allow_missing, files[0], _named_cells(df, header, sep))
        parts.append(part.withColumn(FILE, F.col("_metadata.file_path")) if with_file else part)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_table(
    spark: SparkSession,
    path: str | list[str],
    fmt: str = "csv",
    columns: Iterable[str] | None = None,
    schema=None,
    allow_missing: bool | Iterable[str] = False,
    with_file: bool = False,
    **options: str,
) -> DataFrame:
    """S3: the input format is a parameter (csv, json, parquet, orc, ...).

    CSV defaults to a header file read as text; self-describing formats keep
    their types. A ``schema`` is applied by name for formats that support it
    (json), never to a header CSV.
    """
    fmt = fmt.lower()
    if fmt == "csv":
        return read_delimited(spark, path, columns, allow_missing=allow_missing, with_file=with_file, **options)
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.options(**options).load(path)
    out = select_by_name(df, columns, allow_missing, str(path))
    return out.withColumn(FILE, F.col("_metadata.file_path")) if with_file else out


def read_inferred(spark: SparkSession, path: str | list[str], sep: str = ",", sampling_ratio: float = 1.0) -> DataFrame:
    """Header CSV with type inference: the narrowest type that holds every value of a column.

    Columns are found by name, so files may have different headers; one scan
    counts for all columns of all files how many values each type holds, and the
    picked types do not depend on partitioning or file order. That scan is an
    extra pass over the data: a contract (``read_delimited``) saves it, and a
    sampling ratio below 1 shortens it (a value that does not fit the type
    found on the sample then reads as null).
    """
    text = read_delimited(spark, path, sep=sep)
    schema = infer_types(text if sampling_ratio >= 1 else text.sample(sampling_ratio, seed=41))
    return text.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields])


def read_lookup(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """Two-column code book (code first, label second, any header names).

    Quoted labels may contain the separator. Codes stay text (port codes such
    as ``060`` or ``.GA`` are not numbers); both sides are normalised for
    no-break spaces and outer blanks.
    """
    raw = spark.read.option("header", "true").option("sep", sep).csv(path)
    if len(raw.columns) < 2:
        raise ValueError(f"lookup {path!r} needs two columns, found {raw.columns}")
    code, label = raw.columns[0], raw.columns[1]
    return raw.select(
        normalise_text(F.col(f"`{code}`")).alias("code"),
        normalise_text(F.col(f"`{label}`")).alias("label"),
    )


def read_parquet(spark: SparkSession, path: str | list[str], columns: Iterable[str] | None = None) -> DataFrame:
    """Parquet scan; a column list becomes the scan's ReadSchema."""
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.parquet(*paths)
    return df if columns is None else df.select(*columns)
