"""Exact removal of repeated windows, shared by the two substring dedups.

A window is ``W`` consecutive units (bytes or words) of one text. Its *key* is a
function of its content alone, chosen so that neighbouring windows mostly share
it; the windows of a run with one key are handled as one *span* record
(lead, key, fingerprint of all the span's units, document, first window,
number of windows). Equal windows have equal keys, so only spans of one key
can repeat each other:

1. Spans are range-partitioned by (lead, key, fingerprint) with sampled
   splitters, sorted in each bucket, and compared with their neighbours.
   A span whose whole content stands earlier is covered. If one key has
   several contents, some windows of the earliest spans may still repeat:
   those spans are *open*. The keys at the edges of a bucket are settled
   across buckets in a small table.
2. The windows of open spans are fingerprinted one by one (96 bits) and
   compared in the same way.
3. Covered windows are gathered per document and removed.

Equal spans share a bucket. A map task therefore sends on only the earliest of
the equal spans it holds at a time (``emit_bytes`` of them): the others are
covered there and then, so a span repeated in a third of all documents costs its
bucket a record per such flush, not per document. Where earlier windows of one
document do not count (``within`` off), spans of one doc_id have one verdict, and
all of them travel. Buckets travel as packed arrays; texts are bucketed by doc_id
and checksum, as many texts may share an id or have none.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty, written
from arrivals.llm.textbytes import U64, doc_ids, text_column, text_tags

# One record: its sort words, then where it stands.
SPAN = np.dtype([("lead", "<u8"), ("key", "<u8"), ("fp", "<u8"), ("doc", "<i8"), ("tag", "<u4"),
                 ("at", "<u4"), ("n", "<u4"), ("own", "u1")])
# A window travels with 96 bits of fingerprint and the number of its text in the blob's list of texts.
WINDOW = np.dtype([("lead", "<u8"), ("key", "<u4"), ("text", "<u4"), ("at", "<u4")])
TEXT = np.dtype([("doc", "<i8"), ("tag", "<u4")])
FOUND = np.dtype([("lead", "<u8"), ("key", "<u4"), ("doc", "<i8"), ("tag", "<u4"), ("at", "<u4")])
PLACE = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("at", "<u4"), ("n", "<u4")])
WORDS = ("lead", "key", "fp")

PACKED = "kind int, bucket long, blob binary"
EDGE = "key long, fp long, doc long, tag long, at long, n long, own boolean"
COVERED, OPEN, EDGES = 0, 1, 2


@dataclass(frozen=True)
class Windows:
    """How texts are seen. Both functions take (data, offsets) of a batch and yield (row, SPAN array without
    doc and tag) / the two fingerprints of given windows of one text."""

    width: int
    spans: Callable[[np.ndarray, np.ndarray], Iterator[tuple[np.ndarray, np.ndarray]]]
    fingerprints: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]
    within: bool               # also windows that start earlier in the same document
    bucket_bytes: int = 4 << 20   # text per bucket: bounds a task's memory (raise it with the executors' memory)
    emit_bytes: int = 4 << 20


def pack(records: np.ndarray) -> bytes:
    """Field by field, which compresses better than record by record."""
    return b"".join(np.ascontiguousarray(records[f]).tobytes() for f in records.dtype.names)


def unpack(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    counts = [len(b) // dtype.itemsize for b in blobs]
    out = np.empty(sum(counts), dtype)
    at = 0
    for blob, n in zip(blobs, counts, strict=True):
        p = 0
        for f in dtype.names:
            size = dtype[f].itemsize
            out[f][at:at + n] = np.frombuffer(blob, dtype[f], n, p)
            p += size * n
        at += n
    return out


def multikey_order(words: list[np.ndarray]) -> np.ndarray:
    """Sort by the first word, then only the ties by the next, and so on."""
    order = np.argsort(words[0], kind="stable")
    tied = words[0][order]
    group = np.cumsum(np.append(True, tied[1:] != tied[:-1])) if len(order) else np.zeros(0, int)
    for w in words[1:]:
        same = np.zeros(len(order), bool)
        same[1:] = group[1:] == group[:-1]
        same[:-1] |= same[1:]
        rows = np.flatnonzero(same)
        if not len(rows):
            break
        order[rows] = order[rows][np.lexsort((w[order[rows]], group[rows]))]
        v = w[order]
        group = np.cumsum(np.append(True, (group[1:] != group[:-1]) | (v[1:] != v[:-1])))
    return order


def _dealt(records: np.ndarray, splitters: np.ndarray) -> np.ndarray:
    """The bucket of each record: the number of splitters (WORDS columns, sorted) that are not above it."""
    low = np.searchsorted(splitters[:, 0], records["lead"], "left")
    high = np.searchsorted(splitters[:, 0], records["lead"], "right")
    for i in np.unique(low[low < high]):
        rows = np.flatnonzero((low == i) & (low < high))
        key, fp = records["key"][rows], records["fp"][rows]
        for s in splitters[i:high[rows[0]]]:
            low[rows] += (key > s[1]) | ((key == s[1]) & (fp >= s[2]))
    return low


def _parts(buckets: np.ndarray, records: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    order = np.argsort(buckets, kind="stable")
    records, buckets = records[order], buckets[order]
    ends = np.append(np.flatnonzero(np.diff(buckets)) + 1, len(buckets))
    at = 0
    for end in ends if len(buckets) else ():
        yield int(buckets[at]), records[at:end]
        at = end


def _blobs(kind: int, buckets: np.ndarray, records: np.ndarray) -> Iterator[tuple[int, int, bytes]]:
    return ((kind, b, pack(r)) for b, r in _parts(buckets, records))


def _pack_windows(found: np.ndarray) -> bytes:
    texts, number = np.unique(found[["doc", "tag"]].astype(TEXT), return_inverse=True)
    r = np.empty(len(found), WINDOW)
    for f in ("lead", "key", "at"):
        r[f] = found[f]
    r["text"] = number
    return len(texts).to_bytes(4, "little") + pack(texts) + pack(r)


def _unpack_windows(blob: bytes) -> np.ndarray:
    cut = 4 + int.from_bytes(blob[:4], "little") * TEXT.itemsize
    texts, r = unpack([blob[4:cut]], TEXT), unpack([blob[cut:]], WINDOW)
    out = np.empty(len(r), FOUND)
    for f in ("lead", "key", "at"):
        out[f] = r[f]
    for f in TEXT.names:
        out[f] = texts[f][r["text"]]
    return out


def _batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    kind, bucket, blob = zip(*rows, strict=True) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(kind, pa.int32()), pa.array(bucket, pa.int64()), pa.array(blob, pa.binary())], ["kind", "bucket", "blob"])


def _table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([_batch(rows)])


def _earliest(records: np.ndarray, new: np.ndarray, within: bool) -> np.ndarray:
    """Of records sorted by class, then place: True where the class does not stand earlier."""
    first = np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))
    same = records["doc"] == records["doc"][first]
    if within:
        same &= (records["tag"] == records["tag"][first]) & (records["at"] == records["at"][first])
    return same


def _home(records: np.ndarray, n: int) -> np.ndarray:
    """The bucket of the texts that records stand in."""
    return (records["doc"] % n + records["tag"].astype(np.int64) % n) % n


def _home_column(n: int) -> Column:
    doc = F.pmod(F.coalesce("doc_id", F.lit(2**63 - 1)), F.lit(n))
    return F.pmod(doc + F.pmod(F.crc32(F.col("text").cast("binary")), F.lit(n)), F.lit(n)).cast("long")


def _combined(records: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """(the records that may be the earliest of their class, the others); records of a repeated row count once."""
    records = records[multikey_order([records[f] for f in (*WORDS, "doc", "tag", "at")])]
    new = np.ones(len(records), bool)
    new[1:] = np.any([records[f][1:] != records[f][:-1] for f in WORDS], axis=0)
    once = new.copy()
    once[1:] |= np.any([records[f][1:] != records[f][:-1] for f in ("doc", "tag", "at")], axis=0)
    stays = _earliest(records, new, within)
    return records[stays & once], records[~stays & once]


def _span_batches(w: Windows, splitters: np.ndarray | None, n_docs: int = 1) -> Callable:
    """Map side: pack the spans of all texts by bucket (without splitters: all in bucket 0), and the places of those
    that equal spans at hand already cover."""

    def flush(held: list[np.ndarray]) -> pa.RecordBatch:
        records = np.concatenate(held)
        if splitters is None:
            return _batch(list(_blobs(OPEN, np.zeros(len(records), int), records)))
        records, gone = _combined(records, w.within)
        places = _blobs(COVERED, _home(gone, n_docs), gone[list(PLACE.names)].astype(PLACE))
        return _batch([*_blobs(OPEN, _dealt(records, splitters), records), *places])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            data, offsets = text_column(batch)
            ids, tags = doc_ids(batch), text_tags(data, offsets)
            for rows, records in w.spans(data, offsets):
                records["doc"], records["tag"] = ids[rows], tags[rows]
                held.append(records)
                size += records.nbytes
                if size > w.emit_bytes:
                    yield flush(held)
                    held, size = [], 0
        if held:
            yield flush(held)

    return run


def _settle(w: Windows, n_docs: int) -> Callable:
    """Reduce side: one bucket of spans, sorted and compared; a bucket of covered places passes."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("kind")[0].as_py() == COVERED:
            return group
        records = unpack(group.column("blob").to_pylist(), SPAN)
        order = multikey_order([records[f] for f in (*WORDS, "doc", "tag", "at")])
        records = records[order]
        key_new = np.append(True, (records["lead"][1:] != records["lead"][:-1]) | (records["key"][1:] != records["key"][:-1]))
        new = key_new | np.append(True, records["fp"][1:] != records["fp"][:-1])
        stays = _earliest(records, new, w.within)
        key_of = np.cumsum(key_new) - 1
        classes = np.add.reduceat(new, np.flatnonzero(key_new))
        edge = (key_of == 0) | (key_of == key_of[-1])
        is_open = stays & ~edge & ((classes[key_of] > 1) | (records["own"] > 0) & w.within)
        rows = []
        for kind, mask in ((COVERED, ~stays), (OPEN, is_open)):
            some = records[mask]
            rows += _blobs(kind, _home(some, n_docs), some[list(PLACE.names)].astype(PLACE))
        rows += [(EDGES, 0, pack(records[edge & stays]))]
        return _table(rows)

    return run


def _edge_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        r = unpack(batch.column("blob").to_pylist(), SPAN)
        yield pa.RecordBatch.from_arrays(
            [pa.array(r["key"].view("<i8")), pa.array(r["fp"].view("<i8")), pa.array(r["doc"]),
             pa.array(r["tag"].astype("<i8")), pa.array(r["at"].astype("<i8")), pa.array(r["n"].astype("<i8")),
             pa.array(r["own"] > 0)],
            ["key", "fp", "doc", "tag", "at", "n", "own"])


def _packed_places(n_docs: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = np.empty(batch.num_rows, PLACE)
            for f in PLACE.names:
                r[f] = np.asarray(batch.column(f))
            kind = np.asarray(batch.column("kind"))
            yield _batch([x for k in (COVERED, OPEN) for x in _blobs(k, _home(r[kind == k], n_docs), r[kind == k])])

    return run


def _across_edges(settled: DataFrame, w: Windows, n_docs: int) -> DataFrame:
    """Settle the keys at bucket edges: partial aggregates per key and per class, joined back."""
    edges = written(settled.filter(F.col("kind") == EDGES).select("blob").mapInArrow(_edge_rows, EDGE), "repeats-edges")
    place = (F.struct("doc", "tag", "at") if w.within else F.struct("doc")).alias("place")
    first = edges.groupBy("key", "fp").agg(F.min(place).alias("first"))
    keys = first.groupBy("key").agg(F.count("*").alias("classes"))
    joined = edges.join(first, ["key", "fp"]).join(keys, "key")
    kind = F.when(F.col("first") != place, COVERED).when(
        (F.col("classes") > 1) | (F.col("own") & F.lit(w.within)), OPEN)
    rows = joined.select(kind.alias("kind"), "doc", "tag", "at", "n").filter(F.col("kind").isNotNull())
    return rows.mapInArrow(_packed_places(n_docs), PACKED)


def _places(group: pa.Table) -> dict[tuple[int, int], np.ndarray]:
    """The places of a group of blobs by (doc, tag)."""
    r = unpack(group.column("blob").to_pylist(), PLACE)
    r = r[np.lexsort((r["at"], r["tag"], r["doc"]))]
    cut = np.flatnonzero((r["doc"][1:] != r["doc"][:-1]) | (r["tag"][1:] != r["tag"][:-1])) + 1
    return {(int(x["doc"][0]), int(x["tag"][0])): x for x in np.split(r, cut) if len(x)}


def _open_windows(w: Windows, n_buckets: int) -> Callable:
    """Fingerprint every window of the open spans."""

    def run(docs: pa.Table, spans: pa.Table) -> pa.Table:
        places = _places(spans) if spans.num_rows else {}
        held = []
        seen = set()
        for batch in docs.to_batches() if places else ():
            data, offsets = text_column(batch)
            for i, (doc, tag) in enumerate(zip(doc_ids(batch), text_tags(data, offsets), strict=True)):
                x = places.get((int(doc), int(tag)))
                if x is None or (doc, tag) in seen:
                    continue
                seen.add((doc, tag))
                at = np.repeat(x["at"].astype(np.int64), x["n"]) + _ramp(x["n"])
                fp1, fp2 = w.fingerprints(data[offsets[i]:offsets[i + 1]], at)
                r = np.empty(len(at), FOUND)
                r["lead"], r["key"], r["doc"], r["tag"], r["at"] = fp1, fp2 >> U64(32), doc, tag, at
                held.append(r)
        if not held:
            return _table([])
        records = np.concatenate(held)
        held.clear()
        # Of equal windows in this group only the earliest has to travel; the others are covered here.
        records = records[multikey_order([records[f] for f in ("lead", "key", "doc", "tag", "at")])]
        new = np.append(True, (records["lead"][1:] != records["lead"][:-1]) | (records["key"][1:] != records["key"][:-1]))
        stays = _earliest(records, new, w.within)
        kept = records[stays]
        rows = [(COVERED, int(docs.column("bucket")[0].as_py()), pack(_single(records[~stays])))]
        rows += [(OPEN, b, _pack_windows(x)) for b, x in _parts((kept["lead"] % U64(n_buckets)).astype(np.int64), kept)]
        return _table(rows)

    return run


def _single(windows: np.ndarray) -> np.ndarray:
    """Windows as places, neighbours of one text joined."""
    r = windows[np.lexsort((windows["at"], windows["tag"], windows["doc"]))]
    apart = (np.diff(r["doc"]) != 0) | (np.diff(r["tag"].astype(np.int64)) != 0) | (np.diff(r["at"].astype(np.int64)) != 1)
    first = np.flatnonzero(np.append(True, apart)[:len(r)])
    out = np.empty(len(first), PLACE)
    for f in ("doc", "tag", "at"):
        out[f] = r[f][first]
    out["n"] = np.diff(np.append(first, len(r)))
    return out


def _settle_windows(w: Windows, n_docs: int) -> Callable:
    """One bucket of windows, compared; a bucket of covered places passes."""

    def run(group: pa.Table) -> pa.Table:
        if group.column("kind")[0].as_py() == COVERED:
            return group
        records = np.concatenate([_unpack_windows(b) for b in group.column("blob").to_pylist()])
        records = records[multikey_order([records[f] for f in ("lead", "key", "doc", "tag", "at")])]
        new = np.append(True, (records["lead"][1:] != records["lead"][:-1]) | (records["key"][1:] != records["key"][:-1]))
        gone = _single(records[~_earliest(records, new, w.within)])
        return _table(list(_blobs(COVERED, _home(gone, n_docs), gone)))

    return run


def _ramp(counts: np.ndarray) -> np.ndarray:
    """0..n-1 for each count, in one array."""
    counts = counts.astype(np.int64)
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def removed_units(places: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of units under the given windows (sorted by start)."""
    start = places["at"].astype(np.int64)
    end = np.maximum.accumulate(start + places["n"] - 1 + width)
    new = np.append(True, start[1:] > end[:-1])
    return start[new], end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)]


def with_removed(docs: DataFrame, w: Windows, digest: Callable, schema: str) -> DataFrame:
    """Run the three steps; ``digest(text bytes, starts, ends)`` gives a result row (without doc_id) per text.

    ``schema`` is that of the result, doc_id first.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = max(12, -(-total // w.bucket_bytes))
    splitters = _splitters(docs, w, n)
    keyed = docs.withColumn("bucket", _home_column(n))

    spans = docs.mapInArrow(_span_batches(w, splitters, n), PACKED)
    settled = written(spans.groupBy("kind", "bucket").applyInArrow(_settle(w, n), PACKED), "repeats-spans")
    places = written(
        settled.filter(F.col("kind") != EDGES).unionByName(_across_edges(settled, w, n)), "repeats-places")

    opened = places.filter(F.col("kind") == OPEN)
    windows = keyed.groupBy("bucket").cogroup(opened.groupBy("bucket")).applyInArrow(_open_windows(w, n), PACKED)
    later = written(windows.groupBy("kind", "bucket").applyInArrow(_settle_windows(w, n), PACKED), "repeats-windows")
    covered = places.filter(F.col("kind") == COVERED).unionByName(later)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out_schema = to_arrow_schema(StructType.fromDDL(schema))

    def finish(docs: pa.Table, spans: pa.Table) -> pa.Table:
        found = _places(spans) if spans.num_rows else {}
        rows = []
        for batch in docs.to_batches():
            data, offsets = text_column(batch)
            ids = batch.column("doc_id").to_pylist()
            keys = zip(doc_ids(batch), text_tags(data, offsets), strict=True) if found else ()
            own = [found.get((int(d), int(t))) for d, t in keys] or [None] * len(ids)
            empty = np.zeros(0, np.int64)
            for i, (doc, x) in enumerate(zip(ids, own, strict=True)):
                starts, ends = (empty, empty) if x is None else removed_units(x, w.width)
                rows.append((doc, *digest(data[offsets[i]:offsets[i + 1]], starts, ends)))
        columns = list(zip(*rows, strict=True)) if rows else [[] for _ in out_schema]
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out_schema, strict=True)], schema=out_schema)

    return keyed.groupBy("bucket").cogroup(covered.groupBy("bucket")).applyInArrow(finish, schema)


def _splitters(docs: DataFrame, w: Windows, n: int, per_bucket: int = 200) -> np.ndarray:
    """``n - 1`` splitters from a bounded sample of records; they steer the partitioning, never the result."""
    count = docs.count()
    some = docs.sample(min(1.0, 400 / max(count, 1)), seed=3).limit(800)
    sampled = some.mapInArrow(_span_batches(w, None), PACKED)
    width, dtype, most = len(WORDS), SPAN, n * per_bucket

    def thin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            r = unpack(batch.column("blob").to_pylist(), dtype)
            yield _batch([(0, 0, pack(r[:: max(1, len(r) // 2000)]))])

    blobs = [bytes(x.blob) for x in sampled.mapInArrow(thin, PACKED).collect()]
    r = unpack(blobs, dtype)
    if not len(r):
        return np.zeros((0, width), U64)
    r = _combined(r, w.within)[0]
    r = r[:: max(1, len(r) // most)]
    picks = r[(np.arange(1, n) * len(r)) // n]
    return np.stack([picks[f] for f in WORDS], axis=1)
