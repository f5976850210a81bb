"""Small code books used as lookups.

FIXED VALUES (from the public arrivals code book; they must stay exactly as
listed for decoded labels to match):
  transport mode: 1 = Air, 2 = Sea, 3 = Land, 9 = Not reported
  visa category:  1 = Business, 2 = Pleasure, 3 = Student
  state code 99:  all other codes
The larger country, port and state books are passed in by the caller as files
(``arrivals.sources.read_lookup``); they are not part of this package.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arrivals.schemas import LOOKUP_SCHEMA

# Fixed values, natural order.
MODE_CODES = [("1", "Air"), ("2", "Sea"), ("3", "Land"), ("9", "Not reported")]
VISA_CODES = [("1", "Business"), ("2", "Pleasure"), ("3", "Student")]

# Recode used by the single-machine exploration (unmapped values are kept);
# labels as written there.
MODE_RECODE = {1.0: "air", 2.0: "see", 3.0: "land", 9.0: "not reported"}
VISA_RECODE = {1.0: "Business", 2.0: "Pleasure", 3.0: "Student"}

# Default label for state codes that are not in the state book.
OTHER_STATE = "other"


def lookup_frame(spark: SparkSession, rows: list[tuple[str, str]]) -> DataFrame:
    """An in-memory code book; its codes must be unique (decodes may then skip
    the per-code reduction)."""
    codes = [c for c, _ in rows]
    if len(set(codes)) != len(codes):
        raise ValueError("in-memory code book has repeated codes")
    return spark.createDataFrame(rows, LOOKUP_SCHEMA)


def mode_lookup(spark: SparkSession) -> DataFrame:
    return lookup_frame(spark, MODE_CODES)


def visa_lookup(spark: SparkSession) -> DataFrame:
    return lookup_frame(spark, VISA_CODES)
