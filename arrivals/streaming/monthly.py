"""Incremental load of new monthly arrival drops.

The warehouse is refreshed monthly. Instead of a scheduler deciding which
files are new, a Structured Streaming file source keeps a checkpointed log of
the files it has already handed out; with ``availableNow`` it processes every
file that arrived since the last run and stops. The batch

1. takes the list of new files (the stream is a ``binaryFile`` source reduced
   to its ``path`` column, so file contents are not read there; a streaming
   CSV schema would also be applied by position, not by header name),
2. reads those files by column name, each by its own header,
3. builds the fact rows and refreshes the months they contain (dynamic
   partition overwrite, so a retried batch rewrites the same months instead
   of duplicating them). Rows without a month are kept in the table's rejects,
   in a partition of this batch.

All files that are there when the loader is called form one batch, so rows of
one month may be spread over any number of them. A later call's files replace
the months they contain: a drop carries whole months. A file whose name
declares a month (``2016_05``, ``2016-05``) and that holds rows of another
month is an error, as a stray row would replace that other month.

    python -m arrivals.streaming.monthly --drops D --target T --checkpoint C --country-lookup L

loads what is new and ends, so any scheduler can call it monthly.
"""

from __future__ import annotations

import argparse
import re
from collections.abc import Callable
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from arrivals.functions.columns import text_to_int
from arrivals.plans.builds import Lookups, build_arrivals, read_raw_arrivals
from arrivals.session import apply_cluster_conf, scratch_path
from arrivals.sources.readers import FILE, literal_path
from arrivals.sources.sinks import refresh_months, staged

# Fixed schema of Spark's binaryFile source (a streaming source needs it up front).
BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"

_DECLARED = re.compile(r"(?<!\d)(\d{4})[-_](\d{2})(?!\d)")


def declared_month(path: str) -> tuple[int, int] | None:
    """The month a file name declares, if it names exactly one."""
    found = {(int(y), int(m)) for y, m in _DECLARED.findall(unquote(path).rsplit("/", 1)[-1]) if 1 <= int(m) <= 12}
    return found.pop() if len(found) == 1 else None


def _check_declared(raw: DataFrame) -> None:
    """Raise for rows outside the month their file's name declares."""
    months = raw.where(F.col("i94addr").isNotNull()).select(
        FILE, text_to_int("i94yr").alias("year"), text_to_int("i94mon").alias("month")).distinct()
    stray = [(r[FILE], r.year, r.month) for r in months.where("year IS NOT NULL AND month IS NOT NULL").collect()
             if (d := declared_month(r[FILE])) is not None and d != (r.year, r.month)]
    if stray:
        raise ValueError(f"drops hold rows of months they do not declare: {sorted(stray)[:10]}")


def _batch_writer(
    spark: SparkSession, lookups: Lookups, target: str, fmt: str, options: dict[str, str]
) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # One row per new file: a list of paths (Spark's reader takes them on the driver), never file contents.
        # A set: files that share a task may be listed more than once when the contents are pruned.
        files = sorted({r.path for r in batch.collect()})
        if not files:
            return
        raw = read_raw_arrivals(spark, [literal_path(f) for f in files], fmt, with_file=True, **options)
        _check_declared(raw)
        # Batches are numbered anew by every checkpoint: the stream's own id keeps their rejects apart.
        stream = spark.sparkContext.getLocalProperty("sql.streaming.queryId")
        fact = staged(build_arrivals(raw.drop(FILE), lookups), "drops")
        refresh_months(fact, target, load=f"{stream}-batch-{batch_id}")

    return write


def load_new_drops(
    spark: SparkSession,
    drop_dir: str,
    lookups: Lookups,
    target: str,
    checkpoint: str | None = None,
    sep: str = ",",
    fmt: str = "csv",
) -> None:
    """Load every raw arrivals file that appeared in ``drop_dir`` since the last run.

    Every file of the folder is a drop, whatever its name (as everywhere in
    Spark, names that begin with ``_`` or ``.`` are not data); one that cannot
    be read as ``fmt`` with the required columns is an error. ``checkpoint`` (a
    shared folder) holds the stream's progress; by default a fresh folder under
    ``spark.checkpoint.dir`` is used, which makes the call load everything
    present. Blocks until the available files are done.
    """
    ckpt = checkpoint or scratch_path(spark, "arrivals-drops-checkpoint")
    query = (
        spark.readStream.format("binaryFile").schema(BINARY_FILE_SCHEMA).load(drop_dir)
        .select("path")
        .writeStream.foreachBatch(_batch_writer(spark, lookups, target, fmt, {"sep": sep} if fmt == "csv" else {}))
        .option("checkpointLocation", ckpt)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    exc = query.exception()
    if exc is not None:
        raise RuntimeError(f"monthly load failed: {exc}")


def main(argv: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    for name in ("drops", "target", "checkpoint", "country-lookup"):
        p.add_argument(f"--{name}", required=True)
    for name in ("mode-lookup", "visa-lookup"):
        p.add_argument(f"--{name}")
    p.add_argument("--format", default="csv")
    p.add_argument("--sep", default=",")
    p.add_argument("--input-gb", type=float, help="size of the new drops; sizes the shuffles")
    a = p.parse_args(argv)
    spark = SparkSession.builder.appName("arrivals-drops").getOrCreate()
    apply_cluster_conf(spark, a.input_gb)
    lookups = Lookups.from_files(spark, country=a.country_lookup, mode=a.mode_lookup, visa=a.visa_lookup)
    load_new_drops(spark, a.drops, lookups, a.target, a.checkpoint, sep=a.sep, fmt=a.format)


if __name__ == "__main__":
    main()
