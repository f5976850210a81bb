"""Benchmark decontamination by latent semantic retrieval.

Texts are cut into passages (two neighbouring blocks of ``block`` words) and
weighted by TF-IDF over hashed words, with passage frequencies counted over all
documents. A distributed randomised SVD of the benchmark's passages gives the
latent space: subspace iteration whose products are summed over partitions.
Every passage of every document is folded into that space and compared with the
benchmark passages by cosine; candidates are then verified on the words
themselves. A document is contaminated by an item if the longest common
subsequence of their words covers ``verbatim`` of the item, or ``paraphrase`` of
it and also ``answer`` of the item's answer (its column ``answer`` if there is
one, else its last sentence). Of an item longer than a passage, each passage
(the last is the item's last words) is verified on its own as well, at the same
thresholds of the passage's words: a document that quotes one holds the item. The
shares reported are the greatest that met the thresholds.

Words are runs of letters and digits (any non-ASCII byte counts as one), lower
case in ASCII. The benchmark is a stated query set: it is searched in blocks of
``block_items`` passages, each against all documents. The latent basis is bounded
by ``2^feature_bits x rank`` floats, whatever the size of either side.

Edge cases: a null or empty text or item matches nothing; a null doc_id or
item_id is reported as null; repeated rows are reported once each; ties do not
matter (all pairs above the thresholds are kept); very long texts are searched
whole; an empty table on either side gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty, written
from arrivals.llm.textbytes import U64, RangeHash, Slice, mixed, slices, text_column

# Bytes that belong to words, and their lower case.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[48:58] = _IN_WORD[65:91] = _IN_WORD[97:123] = _IN_WORD[128:] = True


@dataclass(frozen=True)
class LeakParams:
    block: int = 32          # words; a passage is two neighbouring blocks
    feature_bits: int = 17
    rank: int = 96
    cosine: float = 0.4
    verbatim: float = 0.7
    paraphrase: float = 0.5
    answer: float = 0.8
    block_items: int = 4096


def _tokens(s: Slice) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, first word of each text + total) of a slice."""
    inside = np.zeros(len(s.data) + 2, bool)
    inside[1:-1] = _IN_WORD[s.data]
    a, b = inside[1:] & ~inside[:-1], inside[:-1] & ~inside[1:]
    cuts = s.starts[(s.starts > 0) & (s.starts < len(s.data))]
    cuts = cuts[inside[cuts] & inside[cuts + 1]]
    a[cuts] = b[cuts] = True
    a, b = np.flatnonzero(a), np.flatnonzero(b)
    hashes = mixed(RangeHash.of_bytes(_LOWER[s.data], 9)(a, b) + (b - a).astype(U64))
    return hashes, np.append(np.searchsorted(a, s.starts), len(a))


def _blocks(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word of each block + total, text of each block); texts without words have none."""
    n = -(-np.diff(first) // size)
    text = np.repeat(np.arange(len(n)), n)
    within = np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)
    return np.append(first[:-1][text] + within * size, first[-1]), text


def _features(hashes: np.ndarray, p: LeakParams) -> np.ndarray:
    return (hashes >> U64(64 - p.feature_bits)).astype(np.int64)


def passage_frequencies(docs: DataFrame, p: LeakParams) -> np.ndarray:
    """For each hashed word, the blocks of the corpus that hold it; the last entry counts all blocks."""
    size = 1 << p.feature_bits
    parts = 16

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size + 1, np.int64)
        for batch in batches:
            for s in slices(*text_column(batch)):
                hashes, first = _tokens(s)
                starts, _ = _blocks(first, p.block)
                block = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                seen = np.sort(block * size + _features(hashes, p))
                seen = seen[np.append(True, np.diff(seen) != 0)[:len(seen)]]
                total[:size] += np.bincount(seen % size, minlength=size)
                total[size] += len(starts) - 1
        pieces = np.array_split(total, parts)
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(parts), pa.int32()), pa.array([x.tobytes() for x in pieces], pa.binary())], ["part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(x, np.int64) for x in group.column("counts").to_pylist())
        return group.slice(0, 1).set_column(1, "counts", pa.array([out.tobytes()], pa.binary()))

    schema = "part int, counts binary"
    summed = docs.select("text").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    if not summed:
        return np.zeros(size + 1, np.int64)
    return np.concatenate([np.frombuffer(bytes(r.counts), np.int64) for r in sorted(summed, key=lambda r: r.part)])


def _passage_rows(idf: np.ndarray, p: LeakParams):
    """TF-IDF rows of unit length of the benchmark's passages (pairs of blocks; one block if there is no second)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, at, columns, weights = [], [], [], []
            for s in slices(*text_column(batch)):
                hashes, first = _tokens(s)
                feature = _features(hashes, p)
                starts, text = _blocks(first, p.block)
                for i, t in enumerate(text):
                    second = i + 1 < len(text) and text[i + 1] == t
                    if not second and i > 0 and text[i - 1] == t:
                        continue
                    f, n = np.unique(feature[starts[i]:starts[i + 1 + second]], return_counts=True)
                    w = n * idf[f]
                    if (norm := np.sqrt((w * w).sum())) > 0:
                        items.append(int(s.rows[t]))
                        at.append(int(starts[i] - first[t]))
                        columns.append(f.astype("<i4").tobytes())
                        weights.append((w / norm).astype("<f4").tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("item_no").take(pa.array(items, pa.int64())), pa.array(at, pa.int64()),
                 pa.array(columns, pa.binary()), pa.array(weights, pa.binary())], ["item_no", "at", "features", "weights"])

    return run


def _row(features: bytes, weights: bytes) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(features, "<i4"), np.frombuffer(weights, "<f4")


def randomised_svd(passages: DataFrame, p: LeakParams) -> tuple[np.ndarray, np.ndarray]:
    """(features, basis): the leading right singular vectors of the passages, one row per occurring feature.

    Each product sums ``a_i x (a_i . Q)`` over the passages of a partition and
    then over partitions, by feature group; only the bounded basis
    (features x rank) is held by the driver and sent to the executors.
    """
    spark = passages.sparkSession
    groups, size = 64, 1 << p.feature_bits

    def multiplied(q: tuple[np.ndarray, np.ndarray] | None) -> tuple[np.ndarray, np.ndarray]:
        shared = spark.sparkContext.broadcast(q)

        def product(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[int, np.ndarray] = {}
            q = shared.value
            at = None
            if q is not None:
                at = np.full(size, -1)
                at[q[0]] = np.arange(len(q[0]))
            for batch in batches:
                for f, w in zip(batch.column("features").to_pylist(), batch.column("weights").to_pylist(), strict=True):
                    f, w = _row(f, w)
                    if q is None:  # random signs, the same for a feature everywhere
                        draw = mixed(f.astype(U64)[:, None] * U64(p.rank) + np.arange(p.rank, dtype=U64) + U64(1))
                        rows = np.where(draw >> U64(63), 1.0, -1.0)
                    else:
                        rows = q[1][at[f]]
                    y = w @ rows
                    for j, x in zip(f.tolist(), w.tolist(), strict=True):
                        held[j] = held.get(j, 0) + x * y
            by: dict[int, list[int]] = {}
            for j in held:
                by.setdefault(j % groups, []).append(j)
            blobs = [np.array(js, "<i4").tobytes() + np.stack([held[j] for j in js]).astype("<f4").tobytes() for js in by.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(by), pa.int32()), pa.array(blobs, pa.binary())], ["part", "blob"])

        def add(group: pa.Table) -> pa.Table:
            held: dict[int, np.ndarray] = {}
            for blob in group.column("blob").to_pylist():
                n = len(blob) // (4 + 4 * p.rank)
                values = np.frombuffer(blob, "<f4", offset=4 * n).reshape(n, p.rank)
                for j, v in zip(np.frombuffer(blob, "<i4", n).tolist(), values, strict=True):
                    held[j] = held.get(j, 0) + v
            blob = np.array(list(held), "<i4").tobytes() + np.stack(list(held.values())).astype("<f4").tobytes()
            return group.slice(0, 1).set_column(1, "blob", pa.array([blob], pa.binary()))

        schema = "part int, blob binary"
        out = [bytes(r.blob) for r in
               passages.select("features", "weights").mapInArrow(product, schema).groupBy("part").applyInArrow(add, schema).collect()]
        shared.destroy()
        counts = [len(b) // (4 + 4 * p.rank) for b in out]
        if not out:
            return np.zeros(0, np.int64), np.zeros((0, p.rank), np.float32)
        features = np.concatenate([np.frombuffer(b, "<i4", n) for b, n in zip(out, counts, strict=True)])
        values = np.concatenate([np.frombuffer(b, "<f4", offset=4 * n).reshape(n, p.rank) for b, n in zip(out, counts, strict=True)])
        order = np.argsort(features)
        return features[order].astype(np.int64), values[order]

    features, z = multiplied(None)
    for _ in range(2):
        if not len(features):
            break
        q = np.linalg.qr(z.astype(np.float64))[0]
        q = np.pad(q, ((0, 0), (0, p.rank - q.shape[1]))).astype(np.float32)
        features, z = multiplied((features, q))
    left, values, _ = np.linalg.svd(z.astype(np.float64), full_matrices=False) if len(features) else (z, np.zeros(0), None)
    return features, left[:, values > 1e-6 * values.max(initial=1e-30)].astype(np.float32)


def common_subsequence(a: list, b: list) -> int:
    """Length of the longest common subsequence, all positions of ``a`` at once as bits."""
    masks: dict = {}
    for i, x in enumerate(a):
        masks[x] = masks.get(x, 0) | (1 << i)
    row = full = (1 << len(a)) - 1
    for y in b:
        if m := masks.get(y):
            hit = row & m
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def _answer(text: str, given: str | None) -> str:
    if given:
        return given
    return ([x for x in re.split(r"[.!?\n]+", text) if x.strip()] or [""])[-1]


class _Screen:
    """For pairs of a block and an item (or a passage of one): its words that occur anywhere near the block.

    This bounds their common subsequence from above, so it only spares
    verifications. It sees hashed words, in chunks of ``chunk`` blocks.
    """

    def __init__(self, items: list[tuple], at: np.ndarray, n_features: int, p: LeakParams, chunk: int = 512):
        self.reach = -(-max((len(words) for _, words, _ in items), default=0) // p.block)
        self.n_features, self.chunk = n_features, chunk
        columns, counts = [], []
        for _, words, _ in items:
            column = at[_features(np.array(words, U64), p)]
            f, n = np.unique(np.where(column >= 0, column, n_features), return_counts=True)
            columns.append(f)
            counts.append(n)
        self.first = np.cumsum([0, *map(len, columns)])
        self.columns = np.concatenate(columns) if columns else np.zeros(0, int)
        self.counts = np.concatenate(counts) if counts else np.zeros(0, int)
        self.fewest = np.array([p.paraphrase * len(words) for _, words, _ in items])

    def __call__(self, block: np.ndarray, item: np.ndarray, seen_block: np.ndarray, seen: np.ndarray, n_blocks: int) -> np.ndarray:
        """Which (block, item) pairs, by block, may reach the least share; seen: the words' blocks and columns."""
        keep = np.zeros(len(block), bool)
        wide = 2 * self.reach + 2
        for lo in range(0, n_blocks, self.chunk):
            a, b = np.searchsorted(block, [lo, lo + self.chunk])
            if a == b:
                continue
            x, y = np.searchsorted(seen_block, [lo - self.reach, lo + self.chunk + self.reach + 1])
            near = np.zeros((self.chunk + wide - 1, self.n_features + 1), bool)
            near[:, -1] = True  # words without a feature count as there
            near[seen_block[x:y] - (lo - self.reach), seen[x:y]] = True
            done = 1
            while done < wide:  # row r: anything in rows r .. r + wide - 1
                step = min(done, wide - done)
                near = near[:len(near) - step] | near[step:]
                done += step
            rows, n = block[a:b] - lo, self.first[item[a:b] + 1] - self.first[item[a:b]]
            start = np.cumsum(n) - n
            flat = np.arange(n.sum()) + np.repeat(self.first[item[a:b]] - start, n)
            there = near[np.repeat(rows, n), self.columns[flat]] * self.counts[flat]
            keep[a:b] = np.add.reduceat(there, start) >= self.fewest[item[a:b]]
        return keep


def _search(items: list[tuple], vectors: np.ndarray, item_of: np.ndarray, at_word: list[int], features: np.ndarray,
            basis: np.ndarray, idf: np.ndarray, p: LeakParams):
    """Search all documents for a block of benchmark passages; items are (id, words, answer words), ``at_word`` the
    first word of each passage. What is verified are the items and, of the longer ones, the passages."""
    size = 2 * p.block
    units, own = list(items), np.full(len(item_of), -1)
    item_at = list(range(len(items)))
    for j, (k, a) in enumerate(zip(item_of.tolist(), at_word, strict=True)):
        item_id, words, answer = items[k]
        if len(words) > size:
            a = min(a, len(words) - size)
            own[j] = len(units)
            units.append((item_id, words[a:a + size], answer))
            item_at.append(k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = np.full(1 << p.feature_bits, -1)
        at[features] = np.arange(len(features))
        weighted = basis * idf[features][:, None].astype(np.float32)
        screen = _Screen(units, at, len(features), p)
        for batch in batches:
            found: list[tuple] = []
            for s in slices(*text_column(batch)):
                hashes, first = _tokens(s)
                starts, text = _blocks(first, p.block)
                if not len(text):
                    continue
                column = at[_features(hashes, p)]
                known = np.flatnonzero(column >= 0)
                sums = np.zeros((len(text) + 1, basis.shape[1]), np.float32)
                block = np.searchsorted(starts, known, "right") - 1
                cut = np.flatnonzero(np.append(True, np.diff(block) != 0)[:len(block)])
                if len(cut):
                    sums[block[cut]] = np.add.reduceat(weighted[column[known]], cut, axis=0)
                follows = np.append(text[1:] == text[:-1], False)
                passage = sums[:-1] + np.where(follows[:, None], sums[1:], 0)
                norm = np.sqrt((passage * passage).sum(axis=1))
                cosine = (passage / np.maximum(norm, 1e-12)[:, None]) @ vectors.T
                i, j = np.nonzero(cosine >= p.cosine)
                alone = own[j] >= 0
                pair = np.unique(np.append(i * len(units) + item_of[j], (i * len(units) + own[j])[alone]))
                at_block, unit = pair // len(units), pair % len(units)
                may = screen(at_block, unit, block, column[known], len(text))
                best: dict[tuple[int, int], tuple[float, float]] = {}
                for i, u in zip(at_block[may].tolist(), unit[may].tolist(), strict=True):
                    _, words, answer = units[u]
                    t, k = int(text[i]), item_at[u]

                    def region(reach: int) -> list[int]:
                        return hashes[max(first[t], starts[i] - reach):min(first[t + 1], starts[i] + size + reach)].tolist()

                    share = common_subsequence(words, region(len(words))) / len(words)
                    if share < p.paraphrase:
                        continue
                    told = common_subsequence(answer, region(len(items[k][1]))) / len(answer) if answer else 0.0
                    if share >= p.verbatim or told >= p.answer:
                        best[t, k] = max(best.get((t, k), (0.0, 0.0)), (share, told))
                found += [(int(s.rows[t]), k, *v) for (t, k), v in best.items()]
            rows = pa.array([x[0] for x in found], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id").take(rows), batch.column("hash").take(rows),
                 pa.array([items[x[1]][0] for x in found], pa.int64()),
                 pa.array([x[2] for x in found], pa.float64()), pa.array([x[3] for x in found], pa.float64())],
                ["doc_id", "hash", "item_id", "share", "answer_share"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """(doc_id, hash of the text, item_id, share, answer_share): every contaminated document and item."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"),
                       F.xxhash64(text_or_empty(F.col("text"))).alias("hash"))
    answer = F.col("answer") if "answer" in benchmark.columns else F.lit(None)
    # The same item may stand in several rows; a number for each distinct one.
    items = written(
        benchmark.select(F.col("item_id").cast("long").alias("item_id"), text_or_empty(F.col("text")).alias("text"),
                         answer.cast("string").alias("answer")).distinct()
        .withColumn("item_no", F.xxhash64(F.coalesce("item_id", F.lit(-1)), "text", F.coalesce("answer", F.lit("")))),
        "leaks-items")
    counts = passage_frequencies(rows, p)
    idf = np.log((counts[-1] + 1) / (counts[:-1] + 1)).astype(np.float32)
    passages = written(
        items.mapInArrow(_passage_rows(idf, p), "item_no long, at long, features binary, weights binary"), "leaks-passages")
    features, basis = randomised_svd(passages, p)
    n_blocks = -(-passages.count() // p.block_items)
    block = F.pmod(F.xxhash64("item_no"), F.lit(max(n_blocks, 1)))
    schema = "doc_id long, hash long, item_id long, share double, answer_share double"
    found = rows.limit(0).selectExpr("doc_id", "hash", "doc_id AS item_id", "0D AS share", "0D AS answer_share")
    place = np.full(1 << p.feature_bits, -1)
    place[features] = np.arange(len(features))
    for b in range(n_blocks):
        own = items.filter(block == b).collect()
        number = {r.item_no: i for i, r in enumerate(own)}
        known = [(r.item_id, _word_hashes(r.text), _word_hashes(_answer(r.text, r.answer))) for r in own]
        vectors, item_of, at_word = [], [], []
        for r in passages.filter(block == b).collect():
            f, w = _row(bytes(r.features), bytes(r.weights))
            vectors.append(w @ basis[place[f]])
            item_of.append(number[r.item_no])
            at_word.append(r.at)
        if not vectors:
            continue
        vectors = np.stack(vectors)
        vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
        search = _search(known, vectors.astype(np.float32), np.array(item_of), at_word, features, basis, idf, p)
        found = found.union(rows.mapInArrow(search, schema))
    return found


def _word_hashes(text: str) -> list[int]:
    data = np.frombuffer(text.encode(), np.uint8)
    if not len(data):
        return []
    return _tokens(Slice(data, np.array([0]), np.array([len(data)]), np.array([0])))[0].tolist()


def leak_pairs(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    return leaks(docs, benchmark, p).drop("hash")


def decontamination_stage(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """The documents that no benchmark item contaminates."""
    gone = written(leaks(docs, benchmark, p).select("doc_id", "hash").distinct(), "leaks-found")
    gone = gone.select(F.col("doc_id").alias("__llm_doc"), F.col("hash").alias("__llm_leak"))
    rows = docs.withColumn("__llm_hash", F.xxhash64(text_or_empty(F.col("text"))))
    clean = rows.join(
        gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__llm_doc")) & (F.col("__llm_hash") == F.col("__llm_leak")), "left_anti")
    return clean.select(*docs.columns)
