"""Code -> label decodes.

A decode is a left equi join against a code book. The code book is first
reduced to one row per code (``min`` per label), so a decode can never multiply
fact rows and the label it picks is deterministic. It is broadcast only after
its rows and bytes have been counted (one partially aggregated pass). A code
book beyond the bounds is joined by shuffle instead, through an exchange of its
own, so AQE can still convert the join at run time or split a hot fact code.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from arrivals.functions.columns import normalise_text, text_to_double
from arrivals.schemas import field_type

# Largest code book that is shipped to every executor: rows, and bytes of its values.
MAX_BROADCAST_ROWS = 500_000
MAX_BROADCAST_BYTES = 64 << 20


def size_aggregate(df: DataFrame) -> DataFrame:
    """One row (rows, bytes): counted per task, then summed (a partial row per task crosses the network).

    Text and binary values count their bytes, other values 8, and each row 16.
    """
    wide = [F.octet_length(F.col(f"`{f.name}`")) for f in df.schema.fields
            if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    fixed = 16 + 8 * (len(df.columns) - len(wide))
    row = sum((F.coalesce(w, F.lit(0)) for w in wide), F.lit(fixed)).cast("long")
    return df.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(row), F.lit(0)).alias("bytes"))


def fits_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """True when ``df`` has at most ``max_rows`` rows and ``max_bytes`` bytes."""
    size = size_aggregate(df).first()
    return size.rows <= max_rows and size.bytes <= max_bytes


def checked_broadcast(
    df: DataFrame,
    max_rows: int = MAX_BROADCAST_ROWS,
    size_source: DataFrame | None = None,
    known_rows: int | None = None,
    own_exchange: bool = False,
    max_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """Broadcast hint only when the (source of the) frame fits the row and byte bounds.

    ``size_source`` is a frame with at least as many rows, of rows at least as
    wide. ``known_rows`` is an upper bound the caller already holds (a small
    in-memory code book), which saves the counting job. With ``own_exchange`` a
    frame over the bounds is rebalanced: its join then shuffles it afresh,
    which lets AQE's skew join split a hot key on the other side (a reused
    exchange from the frame's own aggregation would not).
    """
    if known_rows is not None:
        fits = known_rows <= max_rows
    else:
        fits = fits_broadcast(size_source if size_source is not None else df, max_rows, max_bytes)
    if fits:
        return F.broadcast(df)
    return df.hint("rebalance") if own_exchange else df


_INTEGRAL = ("tinyint", "smallint", "int", "bigint")


def _key(c: Column, key_type: str, dtype: str = "string") -> Column:
    if key_type == "int":
        # Both sides become long: integral keys exactly, text (or fractional)
        # keys through the decimal-text route, so "2.0" and 2 meet.
        return c.cast("long") if dtype in _INTEGRAL else text_to_double(c.cast("string")).try_cast("long")
    if key_type == "string":
        return normalise_text(c.cast("string"))
    if key_type == "raw":
        return c
    raise ValueError(f"unknown key_type {key_type!r}")


def prepare_lookup(
    lookup: DataFrame,
    code: str = "code",
    label: str | list[str] = "label",
    key_type: str = "int",
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    known_rows: int | None = None,
    unique_codes: bool = False,
) -> DataFrame:
    """Code book -> (``__code``, ``__label0``, ...), one row per code, size-checked broadcast.

    ``unique_codes`` says the book already has one row per (converted) code,
    as the fixed in-memory books do; the per-code reduction (a small shuffle)
    is then skipped.
    """
    labels = [label] if isinstance(label, str) else list(label)
    keyed = lookup.select(
        _key(F.col(f"`{code}`"), key_type, field_type(lookup.schema, code).simpleString()).alias("__code"),
        *[F.col(f"`{x}`").alias(f"__label{i}") for i, x in enumerate(labels)],
    ).where(F.col("__code").isNotNull())
    names = [f"__label{i}" for i in range(len(labels))]
    reduced = keyed if unique_codes else keyed.groupBy("__code").agg(*[F.min(n).alias(n) for n in names])
    return checked_broadcast(
        reduced, max_broadcast_rows, size_source=keyed, known_rows=known_rows, own_exchange=not unique_codes
    )


def _join_prepared(
    df: DataFrame,
    code_col: str,
    prepared: DataFrame,
    outs: list[str],
    key_type: str,
    default: str | None,
    keep_code: bool,
) -> DataFrame:
    tag = uuid.uuid4().hex[:8]
    k = f"__k_{tag}"
    side = prepared.select(F.col("__code").alias(k), *[F.col(f"__label{i}").alias(f"__v{i}_{tag}") for i in range(len(outs))])
    dtype = field_type(df.schema, code_col).simpleString()
    joined = df.join(side, _key(F.col(f"`{code_col}`"), key_type, dtype) == F.col(k), "left")
    labels = []
    for i, out in enumerate(outs):
        v = F.col(f"__v{i}_{tag}")
        labels.append((v if default is None else F.coalesce(v, F.lit(default))).alias(out))
    # One projection instead of withColumn + drop. Without keep_code the labels
    # take the code column's place; with it they are appended. A column
    # already named like an output is replaced (names resolve case-insensitively).
    taken = {o.lower() for o in outs}
    exprs = []
    for c in df.columns:
        if not keep_code and c.lower() == code_col.lower():
            exprs += labels
        elif c.lower() not in taken:
            exprs.append(F.col(f"`{c}`"))
    if keep_code or code_col.lower() not in {c.lower() for c in df.columns}:
        exprs += labels
    return joined.select(*exprs)


def decode(
    df: DataFrame,
    code_col: str,
    lookup: DataFrame,
    out: str | list[str],
    *,
    lookup_code: str = "code",
    lookup_label: str | list[str] = "label",
    key_type: str = "int",
    default: str | None = None,
    keep_code: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    known_rows: int | None = None,
    unique_codes: bool = False,
) -> DataFrame:
    """Replace ``code_col`` by its label in ``out``.

    ``key_type`` says how both sides are keyed: ``"int"`` converts decimal text
    such as ``"2.0"`` to 2 on both sides (a mode code), ``"string"`` compares
    normalised text (a port code like ``060`` must stay text), ``"raw"`` uses
    the values as they are. Unknown codes give null, or ``default`` when set.
    Several labels of one book (lists of ``lookup_label`` and ``out``) cost one
    scan, one reduction and one join.
    """
    outs = [out] if isinstance(out, str) else list(out)
    prepared = prepare_lookup(lookup, lookup_code, lookup_label, key_type, max_broadcast_rows, known_rows, unique_codes)
    return _join_prepared(df, code_col, prepared, outs, key_type, default, keep_code)


def decode_roles(
    df: DataFrame,
    lookup: DataFrame,
    roles: Mapping[str, str],
    *,
    lookup_code: str = "code",
    lookup_label: str = "label",
    key_type: str = "int",
    default: str | None = None,
    keep_code: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    known_rows: int | None = None,
) -> DataFrame:
    """One code book playing several roles (citizenship and residence).

    The book is reduced and size-checked once; each role joins it under its
    own column names, so the self-join is never ambiguous.
    """
    prepared = prepare_lookup(lookup, lookup_code, lookup_label, key_type, max_broadcast_rows, known_rows)
    for code_col, out in roles.items():
        df = _join_prepared(df, code_col, prepared, [out], key_type, default, keep_code)
    return df


def frequent_codes(df: DataFrame, code: Column, share: float, tracked: int = 10_000) -> list:
    """The codes that may hold at least ``share`` of the rows, by a frequent-items sketch: at most ``1 / share`` of them.

    One pass over the code column; a sketch of ``tracked`` items per task crosses
    the network. A sketch may name a few codes that are somewhat rarer.
    """
    n = int(1 / share)
    top = df.where(code.isNotNull()).select(code.alias("__code")).agg(
        F.count(F.lit(1)).alias("rows"), F.expr(f"approx_top_k(__code, {n}, {max(tracked, n)})").alias("top")).first()
    return [item for item, count in top.top or () if count >= share * top.rows]


def decode_hybrid(
    df: DataFrame,
    code_col: str,
    lookup: DataFrame,
    out: str | list[str],
    *,
    lookup_code: str = "code",
    lookup_label: str | list[str] = "label",
    key_type: str = "int",
    default: str | None = None,
    keep_code: bool = False,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    share: float = 0.01,
) -> DataFrame:
    """``decode`` for a book beyond the broadcast bound and a fact with hot codes.

    Rows whose code holds ``share`` of the fact or more are decoded by a
    broadcast of those codes' book rows alone (at most ``1 / share`` of them) and
    are never shuffled; the other rows are joined with the book by shuffle, where
    no key is hot any more. Same rows and labels as ``decode``. A book within
    the bound is broadcast as a whole.
    """
    outs, labels = ([x] if isinstance(x, str) else list(x) for x in (out, lookup_label))
    keyed = lookup.select(
        _key(F.col(f"`{lookup_code}`"), key_type, field_type(lookup.schema, lookup_code).simpleString()).alias("__code"),
        *[F.col(f"`{x}`").alias(f"__label{i}") for i, x in enumerate(labels)],
    ).where(F.col("__code").isNotNull())
    plain = {"lookup_code": "__code", "lookup_label": [f"__label{i}" for i in range(len(labels))], "key_type": key_type,
             "default": default, "keep_code": keep_code}
    if fits_broadcast(keyed, max_broadcast_rows):
        return decode(df, code_col, keyed, outs, max_broadcast_rows=max_broadcast_rows, **plain)
    code = _key(F.col(f"`{code_col}`"), key_type, field_type(df.schema, code_col).simpleString())
    hot = frequent_codes(df, code, share)
    if not hot:
        return decode(df, code_col, keyed, outs, max_broadcast_rows=0, **plain)
    is_hot = F.coalesce(code.isin(hot), F.lit(False))
    # No more book rows than hot codes: one is left per code before the broadcast.
    hot_book = keyed.where(F.col("__code").isin(hot)).groupBy("__code").agg(
        *[F.min(f"__label{i}").alias(f"__label{i}") for i in range(len(labels))])
    by_broadcast = decode(df.where(is_hot), code_col, hot_book, outs, known_rows=len(hot), unique_codes=True, **plain)
    by_shuffle = decode(df.where(~is_hot), code_col, keyed, outs, max_broadcast_rows=0, **plain)
    return by_broadcast.unionByName(by_shuffle)
