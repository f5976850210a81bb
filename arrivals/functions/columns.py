"""Column -> Column conversions.

All are built-in Catalyst expressions, so they stay inside whole-stage codegen;
none of them needs a UDF.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Day numbers in the arrivals file count from this date (fixed value of the source format).
DAY_NUMBER_EPOCH = _dt.date(1960, 1, 1)


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_double(c: ColumnOrName) -> Column:
    """Text -> double; malformed text becomes null instead of failing the job."""
    return _col(c).try_cast("double")


def text_to_int(c: ColumnOrName) -> Column:
    """Text -> int accepting decimal text: "4.0" -> 4, "-4.7" -> -4 (toward zero).

    Malformed, empty, NaN and out-of-range text become null. A direct
    ``cast`` would fail under ANSI mode and ``try_cast(... as int)`` would turn
    "4.0" into null, so the value goes through double first.
    """
    return text_to_double(c).try_cast("int")


def day_number_to_date(c: ColumnOrName, epoch: _dt.date = DAY_NUMBER_EPOCH) -> Column:
    """Days since ``epoch`` (text or number, may be decimal text) -> date; null stays null."""
    return F.date_add(F.lit(epoch), text_to_int(c))


def parse_date(c: ColumnOrName, pattern: str = "MM/dd/yyyy") -> Column:
    """Parse text by a datetime pattern; unparsable text becomes null."""
    return F.try_to_date(_col(c), pattern)


def substring_from(c: ColumnOrName, pos: int, length: int = 10) -> Column:
    """1-based substring: ``US-CA`` from 4 -> ``CA``; shorter text -> empty string."""
    return F.substring(_col(c), pos, length)


def upper_case(c: ColumnOrName) -> Column:
    return F.upper(_col(c))


def recode(c: ColumnOrName, mapping: Mapping[object, str]) -> Column:
    """Replace mapped values by their label and keep unmapped values as they are.

    Unlike a lookup decode (which yields null for unknown codes), this keeps
    the original value, as text. Numeric keys are compared with the value as a
    number (``"2.0"`` equals 2; text that is no number equals none), text keys
    with the value as text, so a column of any type can be recoded.
    """
    col = _col(c)
    out = None
    for value, label in mapping.items():
        text = col.cast("string")
        cond = text == F.lit(value) if isinstance(value, str) else text_to_double(text) == F.lit(float(value))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    keep = col.cast("string")
    return keep if out is None else out.otherwise(keep)


def normalise_text(c: ColumnOrName) -> Column:
    """No-break spaces become blanks, then outer blanks are trimmed.

    ``trim`` alone keeps U+00A0, which the code-book labels contain.
    """
    return F.trim(F.regexp_replace(_col(c), "\u00a0", " "))
