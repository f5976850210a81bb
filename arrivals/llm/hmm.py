"""A hidden Markov language model over all training texts, and exact text scores.

Tokens are words (ASCII lower case) and one end per text. The model has
``states`` latent states with transitions, a start distribution, and emissions
over word classes: each of the commonest training words (``frequent`` at most) is its
own class, the end is one, and all other words fall into classes by their last
three bytes. Inside such a class a word has probability (c + 1) / (N_b + V_b + 1)
with its training count c, the class' tokens N_b and types V_b; the 1 is the
class' unknown word. So a text's probability is a proper product, exact for the
whole text.

Training is Baum-Welch: each iteration runs forward-backward over all training
texts (in segments of ``segment`` tokens, a later segment starting from the
states' long-run distribution) and sums the expected counts over partitions.
Start values come from a bounded sample of texts that are far apart.

Scoring is the scaled forward recursion over the whole text. Long texts are
scored in segments at once: a segment's recursion is a linear map of the states,
and a text applies its segments' maps in order, which is the same recursion.

Counts of rare words are never broadcast: texts send their rare words to the
buckets that hold the counts, and sums come back. Only the frequent words and
class totals (bounded by parameters) reach every task.

Edge cases: a null text is empty and holds one end; a null doc_id counts as the
empty text for the split; repeated rows are scored (and counted) one by one;
very long texts are scored whole; with no training text every count is 0 and the
model is uniform; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import hash_sample, text_or_empty, written
from arrivals.llm.textbytes import U64, RangeHash, mixed, slices, text_column, word_bounds

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

COUNT = np.dtype([("word", "<u8"), ("suffix", "<u2"), ("n", "<i8")])
RARE = np.dtype([("word", "<u8"), ("row", "<i8"), ("n", "<u4")])
SUM = np.dtype([("row", "<i8"), ("logs", "<f8"), ("known", "<i8")])


@dataclass(frozen=True)
class HmmParams:
    states: int = 8
    frequent: int = 32768
    suffixes: int = 1024
    iterations: int = 5
    segment: int = 64
    seeds: int = 200          # about so many texts the start values are picked from
    prior: float = 200.0      # weight of the overall class frequencies in each state's emissions
    bucket_bytes: int = 16 << 20
    at_once: int = 4096       # segments per forward-backward

    @property
    def classes(self) -> int:
        return self.frequent + self.suffixes + 1  # the last class is the end


def _tokens(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: HmmParams) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word hash, suffix class, first word of each text + total) of a slice."""
    low = _LOWER[data]
    a, b, first = word_bounds(low, starts, ends)
    words = mixed(RangeHash.of_bytes(low, 21)(a, b) + (b - a).astype(U64))
    tail = np.zeros(len(a), U64)
    for i in (1, 2, 3):
        byte = low[np.maximum(b - i, 0)].astype(U64) if len(low) else np.zeros(0, U64)
        tail = (tail << U64(8)) | np.where(b - i >= a, byte, U64(0))
    return words, (mixed(tail + U64(1)) % U64(p.suffixes)).astype(np.int64), first


def _pack(r: np.ndarray) -> bytes:
    return b"".join(np.ascontiguousarray(r[f]).tobytes() for f in r.dtype.names)


def _unpack(blobs: list[bytes], dtype: np.dtype) -> np.ndarray:
    out = []
    for blob in blobs:
        n, at = len(blob) // dtype.itemsize, 0
        r = np.empty(n, dtype)
        for f in dtype.names:
            r[f] = np.frombuffer(blob, dtype[f], n, at)
            at += n * dtype[f].itemsize
        out.append(r)
    return np.concatenate(out) if out else np.empty(0, dtype)


def _by_bucket(r: np.ndarray, bucket: np.ndarray) -> tuple[list[int], list[bytes]]:
    order = np.argsort(bucket, kind="stable")
    r, bucket = r[order], bucket[order]
    at = np.flatnonzero(np.append(True, np.diff(bucket) != 0)[:len(r)])
    return bucket[at].tolist(), [_pack(x) for x in np.split(r, at[1:])] if len(r) else []


def _merged_counts(r: np.ndarray) -> np.ndarray:
    r = r[np.argsort(r["word"], kind="stable")]
    at = np.flatnonzero(np.append(True, np.diff(r["word"]) != 0)[:len(r)])
    out = r[at].copy()
    if len(at):
        out["n"] = np.add.reduceat(r["n"], at)
    return out


def word_counts(train: DataFrame, p: HmmParams, buckets: int) -> DataFrame:
    """(bucket, counts): every training word's count, packed and sorted by word hash."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush() -> pa.RecordBatch:
            r = _merged_counts(np.concatenate(held))
            ids, blobs = _by_bucket(r, (r["word"] % U64(buckets)).astype(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "counts"])

        for batch in batches:
            for s in slices(*text_column(batch), limit=2 << 20):
                words, suffix, _ = _tokens(s.data, s.starts, s.ends, p)
                r = np.empty(len(words), COUNT)
                r["word"], r["suffix"], r["n"] = words, suffix, 1
                held.append(_merged_counts(r))
                size += len(held[-1])
                if size > 800_000:
                    held = [_merged_counts(np.concatenate(held))]
                    size = len(held[0])
                    if size > 400_000:
                        yield flush()
                        held, size = [], 0
        if held:
            yield flush()

    def add(group: pa.Table) -> pa.Table:
        r = _merged_counts(_unpack(group.column("counts").to_pylist(), COUNT))
        return pa.table({"bucket": group.column("bucket").slice(0, 1), "counts": pa.array([_pack(r)], pa.binary())})

    schema = "bucket long, counts binary"
    return written(train.select("text").mapInArrow(count, schema).groupBy("bucket").applyInArrow(add, schema), "hmm-counts")


def _size_class(n: np.ndarray) -> np.ndarray:
    """A number that grows with a count, at most 64 to each power of two: 4096 at most."""
    mantissa, exponent = np.frexp(n.astype(np.float64))
    return exponent.astype(np.int64) * 64 + ((mantissa - 0.5) * 128).astype(np.int64)


def frequent_words(counts: DataFrame, p: HmmParams) -> tuple[np.ndarray, np.ndarray]:
    """(word hashes in order, their counts) of the commonest words, at most ``frequent``.

    A histogram of the counts' size classes gives the least class that still
    fits; only words of that class and above reach the driver.
    """

    def histogram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0, np.int64)
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                add = np.bincount(_size_class(_unpack([blob], COUNT)["n"]))
                total = np.pad(total, (0, max(0, len(add) - len(total))))
                total[:len(add)] += add
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["size", "words"])

    sizes = counts.mapInArrow(histogram, "size long, words long").groupBy("size").agg(F.sum("words").alias("words")).collect()
    least, room = None, p.frequent
    for r in sorted(sizes, key=lambda r: -r.size):
        room -= r.words
        if room < 0:
            break
        least = r.size
    if least is None:
        return np.zeros(0, U64), np.zeros(0, np.int64)

    def top(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                r = _unpack([blob], COUNT)
                r = r[_size_class(r["n"]) >= least]
                yield pa.RecordBatch.from_arrays([pa.array(r["word"].view("<i8")), pa.array(r["n"])], ["word", "n"])

    rows = counts.mapInArrow(top, "word long, n long").toPandas()
    words, n = rows["word"].to_numpy(np.int64).view(U64), rows["n"].to_numpy(np.int64)
    order = np.argsort(words)
    return words[order], n[order]


def _class_totals(counts: DataFrame, frequent: np.ndarray, p: HmmParams) -> np.ndarray:
    """Rows (tokens, types) of each suffix class without the frequent words, then of all words."""

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = np.zeros((p.suffixes + 1, 2))
        for batch in batches:
            for blob in batch.column("counts").to_pylist():
                r = _unpack([blob], COUNT)
                out[-1] += r["n"].sum(), len(r)
                r = r[~np.isin(r["word"], frequent)]
                out[:-1, 0] += np.bincount(r["suffix"], r["n"], p.suffixes)
                out[:-1, 1] += np.bincount(r["suffix"], minlength=p.suffixes)
        i, kind = np.nonzero(out)
        yield pa.RecordBatch.from_arrays([pa.array(i), pa.array(kind), pa.array(out[i, kind])], ["i", "kind", "n"])

    out = np.zeros((p.suffixes + 1, 2))
    for r in counts.mapInArrow(total, "i long, kind long, n double").groupBy("i", "kind").agg(F.sum("n").alias("n")).collect():
        out[r.i, r.kind] = r.n
    return out


def encoded(docs: DataFrame, frequent: np.ndarray, p: HmmParams, buckets: int) -> DataFrame:
    """One written table of two kinds of rows: each text's classes, and its rare words packed by bucket.

    ``row`` numbers the rows; it is fixed by the write, which holds both kinds.
    """
    known = frequent if len(frequent) else np.array([0], U64)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 33
        for batch in batches:
            for s in slices(*text_column(batch), limit=2 << 20):
                words, suffix, first = _tokens(s.data, s.starts, s.ends, p)
                at = np.minimum(np.searchsorted(known, words), len(known) - 1)
                common = (known[at] == words) & bool(len(frequent))
                kind = np.where(common, at, p.frequent + suffix).astype("<u2")
                n = len(s.rows)
                own = np.arange(row, row + n)
                row += n
                text = np.repeat(np.arange(n), np.diff(first))
                sequences = [x.tobytes() for x in np.split(kind, first[1:-1])]
                meta = batch.slice(int(s.rows[0]), n)
                nulls = pa.nulls(n, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), meta.column("doc_id"), meta.column("held_out"), pa.array(sequences, pa.binary()), nulls,
                     pa.nulls(n, pa.binary())], ["row", "doc_id", "held_out", "classes", "bucket", "rare"])
                rare = np.flatnonzero(~common)
                order = rare[np.lexsort((words[rare], text[rare]))]
                new = np.append(True, (np.diff(text[order]) != 0) | (np.diff(words[order]) != 0))[:len(order)]
                cut = np.flatnonzero(new)
                r = np.empty(len(cut), RARE)
                r["word"], r["row"] = words[order[cut]], own[text[order[cut]]]
                r["n"] = np.diff(np.append(cut, len(order)))
                ids, blobs = _by_bucket(r, (r["word"] % U64(buckets)).astype(np.int64))
                m = len(ids)
                yield pa.RecordBatch.from_arrays(
                    [pa.nulls(m, pa.int64()), pa.nulls(m, pa.int64()), pa.nulls(m, pa.bool_()), pa.nulls(m, pa.binary()),
                     pa.array(ids, pa.int64()), pa.array(blobs, pa.binary())],
                    ["row", "doc_id", "held_out", "classes", "bucket", "rare"])

    return written(docs.mapInArrow(
        encode, "row long, doc_id long, held_out boolean, classes binary, bucket long, rare binary"), "hmm-encoded")


def _segments(sequences: list[bytes], p: HmmParams) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(classes padded with -1 [segment, position], length of each, text of each, first segment of each text)."""
    lengths = np.array([len(x) // 2 + 1 for x in sequences], np.int64)
    n = -(-lengths // p.segment)
    first = np.cumsum(n) - n
    text = np.repeat(np.arange(len(n)), n)
    flat = np.full(int(n.sum()) * p.segment, -1, np.int32)
    for i, x in enumerate(sequences):
        at = int(first[i]) * p.segment
        c = np.frombuffer(x, "<u2")
        flat[at:at + len(c)] = c
        flat[at + len(c)] = p.classes - 1
    size = np.full(len(text), p.segment)
    size[first + n - 1] = lengths - (n - 1) * p.segment
    return flat.reshape(-1, p.segment), size, text, first


@dataclass
class Model:
    start: np.ndarray       # [state]
    later: np.ndarray       # [state], of a training segment that is not the first of its text
    step: np.ndarray        # [state, state]
    emit: np.ndarray        # [class, state]


def _emissions(model: Model, kind: np.dtype) -> np.ndarray:
    """[class + padding, state]: padding (class -1) emits nothing with certainty."""
    return np.vstack([model.emit, np.ones((1, model.emit.shape[1]))]).astype(kind)


def expected_counts(segments: np.ndarray, size: np.ndarray, opening: np.ndarray, model: Model) -> tuple[np.ndarray, ...]:
    """Forward-backward over a block of segments: expected (emissions, steps, starts, later starts), log likelihood."""
    order = np.argsort(-size, kind="stable")             # longest first: the live segments are a prefix
    segments, size, opening = segments[order], size[order], opening[order]
    emit = _emissions(model, np.float32)
    step = model.step.astype(np.float32)
    n, k, last = len(size), step.shape[0], int(size[0])
    live = np.searchsorted(-size, -np.arange(last + 1), "left")
    alpha = np.empty((last, n, k), np.float32)
    scale = np.ones((last, n), np.float32)
    now = np.where(opening[:, None], model.start, model.later).astype(np.float32)
    for t in range(last):
        m = live[t]
        now = (now if t == 0 else now[:m] @ step) * emit[segments[:m, t]]
        scale[t, :m] = now.sum(axis=1)
        now /= scale[t, :m, None]
        alpha[t, :m] = now
    steps = np.zeros((k, k))
    beta = np.ones((n, k), np.float32)
    seen, share = [], []
    for t in range(last - 1, -1, -1):
        m = live[t]
        gamma = alpha[t, :m] * beta[:m]
        kinds = segments[:m, t]
        seen.append(kinds)
        share.append(gamma)
        if t:
            ahead = emit[kinds] * beta[:m] / scale[t, :m, None]
            steps += alpha[t - 1, :m].T @ ahead
            beta[:m] = ahead @ step.T
    steps *= model.step
    seen, share = np.concatenate(seen), np.concatenate(share)
    emitted = np.stack([np.bincount(seen, share[:, j], len(model.emit)) for j in range(k)], axis=1)
    return emitted, steps, gamma[opening].sum(axis=0), gamma[~opening].sum(axis=0), float(np.log(scale).sum())


def baum_welch(train: DataFrame, model: Model, overall: np.ndarray, p: HmmParams) -> Model:
    """One iteration over all training texts; expected counts are summed over partitions by class group."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast((model.start, model.later, model.step, model.emit))
    parts, k = 16, p.states

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*shared.value)
        emitted, rest = np.zeros((p.classes, k)), np.zeros((k + 2, k))
        for batch in batches:
            segments, size, text, first = _segments(batch.column("classes").to_pylist(), p)
            opening = np.zeros(len(size), bool)
            opening[first] = True
            for at in range(0, len(size), p.at_once):
                cut = slice(at, at + p.at_once)
                e, s, o, later, _ = expected_counts(segments[cut], size[cut], opening[cut], model)
                emitted += e
                rest += np.vstack([s, o, later])
        pieces = [x.tobytes() for x in np.array_split(np.vstack([emitted, rest]), parts)]
        yield pa.RecordBatch.from_arrays([pa.array(range(parts), pa.int32()), pa.array(pieces, pa.binary())], ["part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        out = sum(np.frombuffer(x) for x in group.column("sums").to_pylist())
        return pa.table({"part": group.column("part").slice(0, 1), "sums": pa.array([out.tobytes()], pa.binary())})

    schema = "part int, sums binary"
    rows = train.select("classes").mapInArrow(count, schema).groupBy("part").applyInArrow(add, schema).collect()
    shared.destroy()
    if not rows:
        return model
    total = np.concatenate([np.frombuffer(bytes(r.sums)) for r in sorted(rows, key=lambda r: r.part)]).reshape(-1, k)
    emitted, steps, start, later = total[:p.classes], total[p.classes:p.classes + k], total[-2], total[-1]
    return Model(_share(start + 0.1), _share(later + 0.1), _share(steps + 0.1),
                 ((emitted + p.prior * overall[:, None]) / (emitted.sum(axis=0) + p.prior)))


def _share(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=-1, keepdims=True)


def start_model(train: DataFrame, n_texts: int, overall: np.ndarray, p: HmmParams) -> Model:
    """States that lean to texts far apart, picked from a bounded sample."""
    sample = hash_sample(train, ["doc_id", "classes"], p.seeds, n_texts).limit(2 * p.seeds).collect()
    bags = [np.bincount(np.frombuffer(x, "<u2"), minlength=p.classes) for x in sorted(bytes(r.classes) for r in sample)]
    bags = [b for b in bags if b.sum() >= 20] or [np.ones(p.classes)]
    unit = [b / np.sqrt((b * b).sum()) for b in bags]
    chosen = [0]
    while len(chosen) < min(p.states, len(bags)):
        near = np.max([[u @ unit[c] for c in chosen] for u in unit], axis=1)
        chosen.append(int(near.argmin()))
    emit = np.empty((p.classes, p.states))
    for k in range(p.states):
        bag = bags[chosen[k % len(chosen)]]
        emit[:, k] = 0.7 * overall + 0.3 * bag / bag.sum()
    even = np.full(p.states, 1 / p.states)
    return Model(even, even, 0.9 * np.eye(p.states) + 0.1 / p.states, emit)


def text_scores(sequences: list[bytes], model: Model, p: HmmParams) -> np.ndarray:
    """Natural log probability of each text's classes: exact scaled forward recursion."""
    if not sequences:
        return np.zeros(0)
    emit = _emissions(model, np.float64)
    segments, size, text, first = _segments(sequences, p)
    k = p.states
    opening = np.zeros(len(size), bool)
    opening[first] = True
    maps, logs = np.empty((len(size), k, k)), np.zeros(len(size))
    order = np.argsort(-size, kind="stable")            # longest first: the live segments are a prefix
    for at in range(0, len(size), p.at_once // 4):
        own = order[at:at + p.at_once // 4]
        seg, n, fresh = segments[own], size[own], opening[own]
        now = np.broadcast_to(np.eye(k), (len(own), k, k)).copy()
        log = np.zeros(len(own))
        for t in range(int(n[0])):
            m = int(np.searchsorted(-n, -t, "left"))    # segments with more than t tokens
            live = now[:m]
            moved = (live.reshape(-1, k) @ model.step).reshape(m, k, k)
            if t == 0:
                moved = np.where(fresh[:, None, None], live, moved)
            moved *= emit[seg[:m, t]][:, None, :]
            if t % 4 == 3:                              # four steps stay far above the least double
                top = moved.reshape(m, -1).max(axis=1)
                moved /= top[:, None, None]
                log[:m] += np.log(top)
            now[:m] = moved
        maps[own], logs[own] = now, log
    state = np.broadcast_to(model.start, (len(sequences), k)).copy()
    out = np.zeros(len(sequences))
    count = np.diff(np.append(first, len(size)))
    for j in range(int(count.max())):
        live = np.flatnonzero(count > j)
        seg = first[live] + j
        after = np.einsum("ni,nij->nj", state[live], maps[seg])
        total = after.sum(axis=1)
        state[live] = after / total[:, None]
        out[live] += np.log(total) + logs[seg]
    return out


def _scored(model: Model, frequent_counts: np.ndarray, totals: np.ndarray, p: HmmParams):
    """Map side of scoring: everything but the rare words' own counts."""
    spread = np.zeros(p.classes)
    spread[p.frequent:-1] = np.log10(totals[:-1].sum(axis=1) + 1)      # normaliser of a suffix class
    logs = np.zeros(p.classes)
    logs[:len(frequent_counts)] = np.log10(frequent_counts + 1)
    known = np.zeros(p.classes, np.int64)
    known[:len(frequent_counts)] = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sequences = batch.column("classes").to_pylist()
            kinds = [np.frombuffer(x, "<u2") for x in sequences]
            scores = text_scores(sequences, model, p) / np.log(10)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("doc_id"), batch.column("held_out"),
                 pa.array([len(x) + 1 for x in kinds], pa.int64()),
                 pa.array([int(known[x].sum()) for x in kinds], pa.int64()),
                 pa.array([float(logs[x].sum()) for x in kinds], pa.float64()),
                 pa.array(scores - np.array([spread[x].sum() for x in kinds]))],
                ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "score"])

    return run


def rare_sums(rows: DataFrame, counts: DataFrame, buckets: int) -> DataFrame:
    """(row, logs, known): for each text, the sum of log10(c + 1) over its rare words, and how many have c > 0."""

    def look_up(rare: pa.Table, held: pa.Table) -> pa.Table:
        r = _unpack(rare.column("rare").to_pylist(), RARE)
        c = _unpack(held.column("counts").to_pylist(), COUNT)
        n = np.zeros(len(r), np.int64)
        if len(c):
            at = np.minimum(np.searchsorted(c["word"], r["word"]), len(c) - 1)
            n = np.where(c["word"][at] == r["word"], c["n"][at], 0)
        out = np.empty(len(r), SUM)
        out["row"], out["logs"], out["known"] = r["row"], r["n"] * np.log10(n + 1.0), r["n"] * (n > 0)
        out = _summed(out)
        ids, blobs = _by_bucket(out, out["row"] % buckets)
        return pa.table({"bucket": pa.array(ids, pa.int64()), "sums": pa.array(blobs, pa.binary())})

    def add(group: pa.Table) -> pa.Table:
        r = _summed(_unpack(group.column("sums").to_pylist(), SUM))
        return pa.table({"row": pa.array(r["row"]), "rare_logs": pa.array(r["logs"]), "rare_known": pa.array(r["known"])})

    rare = rows.filter(F.col("rare").isNotNull()).select("bucket", "rare")
    found = rare.groupBy("bucket").cogroup(counts.groupBy("bucket")).applyInArrow(look_up, "bucket long, sums binary")
    return found.groupBy("bucket").applyInArrow(add, "row long, rare_logs double, rare_known long")


def _summed(r: np.ndarray) -> np.ndarray:
    r = r[np.argsort(r["row"], kind="stable")]
    at = np.flatnonzero(np.append(True, np.diff(r["row"]) != 0)[:len(r)])
    out = r[at].copy()
    for f in ("logs", "known"):
        if len(at):
            out[f] = np.add.reduceat(r[f], at)
    return out


def language_model_scores(docs: DataFrame, p: HmmParams = HmmParams(), fold: int = 7, held: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row.

    Texts whose crc32(doc_id as text) mod ``fold`` is ``held`` are held out of training.
    """
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold == held
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"),
                       held_out.alias("held_out"))
    size = rows.agg(F.sum(F.octet_length("text").cast("long")).alias("b"),
                    F.count(F.when(~F.col("held_out"), 1)).alias("n")).first()
    buckets = max(12, -(-(size.b or 0) // p.bucket_bytes))
    counts = word_counts(rows.filter(~F.col("held_out")), p, buckets)
    frequent, frequent_counts = frequent_words(counts, p)
    totals = _class_totals(counts, frequent, p)
    n_tokens, n_types = int(totals[-1, 0]) + size.n, int(totals[-1, 1]) + (size.n > 0)

    table = encoded(rows, frequent, p, buckets)
    texts = table.filter(F.col("classes").isNotNull())
    train = texts.filter(~F.col("held_out"))
    overall = np.ones(p.classes)
    overall[:len(frequent_counts)] += frequent_counts
    overall[p.frequent:-1] += totals[:-1].sum(axis=1)
    overall[-1] += size.n
    overall[len(frequent_counts):p.frequent] = 0        # classes without a word
    overall /= overall.sum()
    model = start_model(train, size.n, overall, p)
    for _ in range(p.iterations if size.n else 0):
        model = baum_welch(train, model, overall, p)

    scored = texts.select("row", "doc_id", "held_out", "classes").mapInArrow(
        _scored(model, frequent_counts, totals, p),
        "row long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double")
    joined = scored.join(rare_sums(table, counts, buckets), "row", "left")
    rare = F.coalesce("rare_logs", F.lit(0.0))
    end_known, end_logs = int(size.n > 0), float(np.log10(size.n + 1))
    total = float(np.log10(n_tokens + n_types + 1))
    return joined.select(
        "doc_id", "held_out", "n_tokens",
        (F.col("n_known") + F.coalesce("rare_known", F.lit(0)) + F.lit(end_known)).cast("long").alias("n_known"),
        F.lit(n_tokens).cast("long").alias("train_tokens"),
        (F.col("logs") + rare + F.lit(end_logs) - F.col("n_tokens") * F.lit(total)).alias("base_score"),
        (F.col("score") + rare).alias("score"))
