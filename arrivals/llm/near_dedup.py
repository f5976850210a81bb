"""Near-duplicate classes by BagMinHash over five-word shingles.

A text is the multiset of its five-word shingles (a shorter text is one
shingle); two texts are near duplicates if the weighted Jaccard similarity of
their multisets is at least ``similarity``, and classes are the connected
components of these links.

Signature: each shingle drives Poisson processes over its weight axis, split
into dyadic blocks ([0, 1), [1, 2), [2, 4), ...): block after block the rate
doubles, and a point carries its arrival time, a register, and its level inside
the block. A text of weight w takes the points below level w, so two texts share
exactly the points below the smaller weight, and registers (the earliest
arrival) agree with probability equal to the weighted Jaccard similarity.
Points later than all registers are never drawn, and a heavy shingle costs the
logarithm of its weight.

Search: texts with equal words collapse first, by a 128-bit hash. Bands of
registers bucket the rest; each member of a bucket is verified against one
leader, the member that shares most buckets (in a group of near copies that is
mostly the text they were copied from), and verified links give components.
Where members of a bucket are still in different components, those outside its
largest component are compared with all its members, block by block, so no
link between components is lost; only links leave the tasks, never pairs.

Edge cases: a null text is empty; texts without words form one class; rows with
one doc_id are separate texts; a null doc_id is ordered last (the class id is
the least doc_id, null if there is no other); very long texts are processed
whole; an empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty, written
from arrivals.llm.components import components
from arrivals.llm.textbytes import NULL_ID, U64, RangeHash, mixed, slices, text_column, word_bounds


@dataclass(frozen=True)
class NearParams:
    similarity: float = 0.8
    shingle: int = 5
    bands: int = 24
    rows: int = 5       # at similarity 0.8 a pair shares no band with probability (1 - 0.8^5)^24 < 1e-4
    block: int = 512    # texts of either side in one task of the last comparison
    slice_bytes: int = 2 << 20


def word_values(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text + total)."""
    a, b, first = word_bounds(data, starts, ends)
    return mixed(RangeHash.of_bytes(data, seed)(a, b) + (b - a).astype(U64)), first


def shingle_bags(words: np.ndarray, first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, shingle hash, count) of the distinct shingles of each text, by text."""
    ranges, sizes = RangeHash(words, 5), np.diff(first)
    a = np.arange(max(0, len(words) - k + 1))
    doc = np.searchsorted(first[:-1], a, "right") - 1
    inside = a + k <= first[doc + 1]
    a, doc = a[inside], doc[inside]
    short = np.flatnonzero((sizes > 0) & (sizes < k))
    doc = np.concatenate([doc, short])
    value = np.concatenate([ranges(a, a + k), ranges(first[short], first[short + 1])])
    value = mixed(value + np.concatenate([np.full(len(a), k, U64), sizes[short].astype(U64)]))
    apart = value ^ mixed(doc.astype(U64) + U64(1))
    order = np.argsort(apart, kind="stable")
    new = np.append(True, np.diff(apart[order]) != 0)[:len(order)]
    at = np.flatnonzero(new)
    one = order[at]
    counts = np.diff(np.append(at, len(order)))
    by_doc = np.argsort(doc[one], kind="stable")
    return doc[one][by_doc], value[one][by_doc], counts[by_doc]


def bag_signatures(doc: np.ndarray, value: np.ndarray, weight: np.ndarray, n_docs: int, m: int) -> np.ndarray:
    """BagMinHash registers (n_docs x m arrival times, infinite for an empty bag)."""
    blocks = np.frexp(weight - 0.5)[1].clip(0) + 1           # dyadic blocks that start below the weight
    element = np.repeat(np.arange(len(doc)), blocks)
    block = np.arange(len(element)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    doc, weight = doc[element], weight[element]
    seed = mixed(value[element] + block.astype(U64) * U64(0x9E3779B97F4A7C15))
    low = np.where(block > 0, 1 << np.maximum(block - 1, 0), 0)
    size = np.maximum(low, 1)                                # block length = rate
    registers = np.full(n_docs * m, np.inf)
    time = np.zeros(len(doc))
    step = 0
    while len(doc):
        step += 1
        draw = mixed(seed + U64(step))
        time = time - np.log(((draw >> U64(11)).astype(np.float64) + 0.5) * 2.0**-53) / size
        pick = mixed(draw ^ U64(0x5851F42D4C957F2D))
        register = ((pick >> U64(40)).astype(np.int64) * m) >> 24
        level = low + ((pick & U64(0xFFFFFFFF)).astype(np.float64) * 2.0**-32 * size).astype(np.int64)
        taken = np.flatnonzero(level < weight)
        np.minimum.at(registers, doc[taken] * m + register[taken], time[taken])
        alive = np.flatnonzero(time <= registers.reshape(n_docs, m).max(axis=1)[doc])
        doc, weight, seed, low, size, time = (x[alive] for x in (doc, weight, seed, low, size, time))
    return registers.reshape(n_docs, m)


def _sketches(p: NearParams):
    m = p.bands * p.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch)
            for s in slices(data, offsets, p.slice_bytes):
                words, first = word_values(s.data, s.starts, s.ends)
                doc, value, weight = shingle_bags(words, first, p.shingle)
                n = len(s.rows)
                total = np.bincount(doc, weight, n).astype(np.int64)
                registers = bag_signatures(doc, value, weight, n, m)
                bits = registers.view(U64).reshape(n, p.bands, p.rows)
                band = np.zeros((n, p.bands), U64)
                for r in range(p.rows):
                    band = mixed(band * U64(31) + bits[:, :, r] + U64(r))
                keys = []
                for seed in (6, 7):
                    other = words if seed == 6 else word_values(s.data, s.starts, s.ends, 1)[0]
                    keys.append(mixed(RangeHash(other, seed)(first[:-1], first[1:]) + np.diff(first).astype(U64)))
                ids = np.stack(keys, axis=1).tobytes()
                flat = pa.array(band.ravel().view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[16 * i:16 * i + 16] for i in range(n)], pa.binary()),
                     pa.array(total),
                     pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * p.bands), flat)],
                    ["id", "n", "bands"])

    return run


def sketches(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """(doc, hash, id, n, bands) of each row: its doc_id (a null is the greatest) and text hash, the hash of all its
    words, the number of shingles, and a hash per band."""
    run = _sketches(p)

    def with_row(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for out in run(iter([batch])):
                own = [batch.column(c).slice(at, out.num_rows) for c in ("doc", "hash")]
                at += out.num_rows
                yield pa.RecordBatch.from_arrays([*own, *out.columns], ["doc", "hash", *out.schema.names])

    return keyed(docs).mapInArrow(with_row, "doc long, hash long, id binary, n long, bands array<long>")


def keyed(docs: DataFrame) -> DataFrame:
    """(doc, hash, text) of each row, none of them null."""
    text = text_or_empty(F.col("text"))
    return docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc"),
                       F.xxhash64(text).alias("hash"), text.alias("text"))


def _similar(p: NearParams):
    def bag(text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        words, first = word_values(text, np.array([0]), np.array([len(text)]))
        _, value, weight = shingle_bags(words, first, p.shingle)
        order = np.argsort(value)
        return value[order], weight[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = [text_column(batch, c) for c in ("text_a", "text_b")]
            held: list = [None, None]
            close = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                bags = []
                for k, (data, offsets) in enumerate(sides):
                    text = data[offsets[i]:offsets[i + 1]]
                    if held[k] is None or not np.array_equal(held[k][0], text):  # neighbours often share a side
                        held[k] = text, bag(text)
                    bags.append(held[k][1])
                (v1, w1), (v2, w2) = bags
                _, at1, at2 = np.intersect1d(v1, v2, assume_unique=True, return_indices=True)
                both = np.minimum(w1[at1], w2[at2]).sum()
                close[i] = both >= p.similarity * (w1.sum() + w2.sum() - both) and both > 0
            keep = pa.array(np.flatnonzero(close))
            yield pa.RecordBatch.from_arrays([batch.column(c).take(keep) for c in ("a", "b")], ["a", "b"])

    return run


def _verified(pairs: DataFrame, texts: DataFrame, p: NearParams) -> DataFrame:
    """The pairs (a, b) whose multisets are similar enough."""
    a, b = (texts.select(F.col("id").alias(c), F.col("text").alias(f"text_{c}")) for c in ("a", "b"))
    return pairs.join(a, "a").join(b, "b").select("a", "b", "text_a", "text_b").mapInArrow(
        _similar(p), "a binary, b binary")


def _texts(docs: DataFrame, sketched: DataFrame, ids: DataFrame) -> DataFrame:
    """(id, text) of one document of each wanted id."""
    wanted = sketched.join(ids, "id", "left_semi")
    chosen = wanted.groupBy("id").agg(F.min(F.struct("doc", "hash")).alias("m")).select("id", "m.*")
    found = keyed(docs).join(chosen, ["doc", "hash"])
    return found.groupBy("doc", "hash", "id").agg(F.first("text").alias("text")).select("id", "text")


def near_links(docs: DataFrame, sketched: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """Verified links (a, b) between word hashes whose components are the near-duplicate classes."""
    one = written(sketched.groupBy("id").agg(F.first("n").alias("n"), F.first("bands").alias("bands")), "near-distinct")
    member = one.filter("n > 0").select("id", "n", F.posexplode("bands").alias("band", "hash"))
    sizes = member.groupBy("band", "hash").agg(F.count("*").alias("size")).filter("size > 1")
    bucket = written(member.join(sizes, ["band", "hash"]), "near-members")
    central = bucket.groupBy("id").agg(F.sum("size").alias("central"))
    bucket = written(bucket.join(central, "id"), "near-buckets")
    texts = written(_texts(docs, sketched, bucket.select("id").distinct()), "near-texts")
    links = written(_verified(written(_star_pairs(bucket, p), "near-stars"), texts, p), "near-links")

    label = components(links)
    told = bucket.join(label, F.col("id") == F.col("node"), "left").select(
        "band", "hash", "id", "size", F.coalesce("label", "id").alias("label"))
    per = told.groupBy("band", "hash", "label").agg(F.count("*").alias("c"))
    split = per.groupBy("band", "hash").agg(
        F.count("*").alias("parts"), F.max_by("label", F.struct("c", "label")).alias("largest"), F.max("c").alias("c"))
    open_ = written(told.join(split.filter("parts > 1").select("band", "hash", "largest", "c"), ["band", "hash"]), "near-open")
    return links.union(written(_cross_links(open_, texts, p), "near-cross"))


def _star_pairs(bucket: DataFrame, p: NearParams) -> DataFrame:
    """Every member of a bucket with its most central member, where their sizes allow the similarity."""
    leader = bucket.groupBy("band", "hash").agg(F.max(F.struct("central", "id", "n")).alias("l")).select(
        "band", "hash", F.col("l.id").alias("id_b"), F.col("l.n").alias("n_b"))
    alike = F.least("n", "n_b") >= F.lit(p.similarity) * F.greatest("n", "n_b")
    pairs = bucket.join(leader, ["band", "hash"]).filter((F.col("id") != F.col("id_b")) & alike)
    return pairs.select(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b")).distinct()


def _cross_links(open_: DataFrame, texts: DataFrame, p: NearParams) -> DataFrame:
    """Links between components that share a bucket: its members outside the largest component with all members.

    Both sides are dealt into blocks of about ``block`` texts; a task gets one
    block of either and intersects all their multisets at once.
    """
    outside = F.col("label") != F.col("largest")
    open_ = open_.withColumns({
        "n_left": F.ceil((F.col("size") - F.col("c")) / p.block), "n_right": F.ceil(F.col("size") / p.block)})
    spot = F.xxhash64("id")
    left = open_.filter(outside).withColumns({
        "side": F.lit(True), "i": F.pmod(spot, "n_left"), "j": F.explode(F.sequence(F.lit(0), F.col("n_right") - 1))})
    right = open_.withColumns({
        "side": F.lit(False), "j": F.pmod(spot, "n_right"), "i": F.explode(F.sequence(F.lit(0), F.col("n_left") - 1))})
    columns = ["band", "hash", "i", "j", "side", "id", "label"]
    rows = left.select(*columns).union(right.select(*columns)).join(texts, "id")
    return rows.groupBy("band", "hash", "i", "j").applyInArrow(_block_links(p), "a binary, b binary").distinct()


def _block_links(p: NearParams):
    def run(group: pa.Table) -> pa.Table:
        batch = group.select(["side", "id", "label", "text"]).combine_chunks().to_batches()[0]
        data, offsets = text_column(batch)
        data, offsets = data[offsets[0]:offsets[-1]], offsets - offsets[0]
        words, first = word_values(data, offsets[:-1], offsets[1:])
        doc, value, weight = shingle_bags(words, first, p.shingle)
        side = np.asarray(batch.column("side"))
        ids, labels = batch.column("id").to_pylist(), batch.column("label").to_pylist()
        number = {x: i for i, x in enumerate(dict.fromkeys(labels))}
        label = np.array([number[x] for x in labels])
        total = np.bincount(doc, weight, len(ids))
        start = np.searchsorted(doc, np.arange(len(ids) + 1))
        theirs = np.flatnonzero(~side[doc])
        theirs = theirs[np.argsort(value[theirs], kind="stable")]
        shelf, owner, copies = value[theirs], doc[theirs], weight[theirs]
        a, b = [], []
        for x in np.flatnonzero(side):
            own = slice(start[x], start[x + 1])
            lo, hi = np.searchsorted(shelf, value[own], "left"), np.searchsorted(shelf, value[own], "right")
            n = hi - lo
            at = np.arange(n.sum()) + np.repeat(lo - (np.cumsum(n) - n), n)
            both = np.bincount(owner[at], np.minimum(copies[at], np.repeat(weight[own], n)), len(ids))
            near = (both >= p.similarity * (total + total[x] - both)) & (both > 0) & (label != label[x])
            for y in np.flatnonzero(near):
                a.append(min(ids[x], ids[y]))
                b.append(max(ids[x], ids[y]))
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return run


def near_classes(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """(doc, hash, n, class_id, keeper) of each row of ``keyed(docs)``: the least doc_id of its near-duplicate class,
    and whether this row (or one equal to it) is the one of the class that stays."""
    sketched = written(sketches(docs, p), "near-sketches")
    label = components(near_links(docs, sketched, p))
    ids = sketched.groupBy("id").agg(F.min(F.struct("doc", "hash")).alias("low"))
    named = ids.join(label, F.col("id") == F.col("node"), "left").select("id", "low", F.coalesce("label", "id").alias("label"))
    least = named.groupBy("label").agg(F.min("low").alias("m"))
    classes = named.join(least, "label").select("id", "m")
    return sketched.join(classes, "id").select(
        "doc", "hash", "n", F.nullif(F.col("m.doc"), F.lit(NULL_ID)).alias("class_id"),
        ((F.col("doc") == F.col("m.doc")) & (F.col("hash") == F.col("m.hash"))).alias("keeper"))


def near_duplicates(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """(doc_id, n_shingles, class_id) of every row."""
    return near_classes(docs, p).select(
        F.nullif("doc", F.lit(NULL_ID)).alias("doc_id"), F.col("n").alias("n_shingles"), "class_id")


def near_stage(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """One document of each near-duplicate class: the one of the least doc_id."""
    stay = near_classes(docs, p).filter("keeper").select(F.col("doc").alias("__llm_doc"), F.col("hash").alias("__llm_hash")).distinct()
    rows = docs.withColumns({
        "__llm_doc": F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)), "__llm_hash": F.xxhash64(text_or_empty(F.col("text")))})
    equal = Window.partitionBy("__llm_doc", "__llm_hash").orderBy(F.lit(0))
    kept = rows.join(stay, ["__llm_doc", "__llm_hash"]).withColumn("__llm_n", F.row_number().over(equal)).filter("__llm_n = 1")
    return kept.select(*docs.columns)
