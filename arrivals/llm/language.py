"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text in windows of ``window`` bytes, forwards and
backwards, labels every byte position with language probabilities, and the
document's probabilities are the mean over all its positions. It is trained in
numpy by backpropagation through time, on windows of a bounded sample of
labelled documents (about ``sample`` documents, ``per_document`` windows of each;
both parameters bound what reaches the driver). The sample is divided over the
languages: rare ones give all their rows, the others an equal share, and each at
least one, so every language with a trainable row is learned. Prediction runs in the scan tasks
over every byte of every text; only the weights are sent along.

Edge cases: a null text, or one without a letter, is ``und`` with score 0; very
long texts are read whole, window by window; ties go to the first language in
order; repeated rows are predicted one by one; with no labelled training text
every prediction is ``und``; an empty table gives an empty result; a null doc_id
counts as the empty text for the split; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty
from arrivals.llm.textbytes import slices, text_column


@dataclass(frozen=True)
class NetParams:
    hidden: int = 8
    window: int = 256
    sample: int = 3000
    per_document: int = 2
    train_window: int = 128
    steps: int = 400
    batch: int = 96
    rate: float = 0.02
    at_once: int = 1024      # windows read side by side


@dataclass
class Net:
    languages: list[str]
    inputs: np.ndarray    # [direction, byte, 3 hidden]: update, reset, candidate (with bias)
    step: np.ndarray      # [direction, hidden, 3 hidden]
    out: np.ndarray       # [direction, hidden, language]
    bias: np.ndarray      # [language]


def _logistic(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def _gradients(net: Net, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss per position and its gradients for windows x [time, batch] (all full) of languages y [batch]."""
    t_all, n = x.shape
    h = net.step.shape[1]
    saved, states = [], []
    for d in range(2):
        now, keep, outs = np.zeros((n, h)), [], np.empty((t_all, n, h))
        for t in range(t_all) if d == 0 else range(t_all - 1, -1, -1):
            a, g = net.inputs[d][x[t]], now @ net.step[d]
            z, r = _logistic(a[:, :h] + g[:, :h]), _logistic(a[:, h:2 * h] + g[:, h:2 * h])
            c = np.tanh(a[:, 2 * h:] + r * g[:, 2 * h:])
            keep.append((t, now, z, r, c, g[:, 2 * h:]))
            now = c + z * (now - c)
            outs[t] = now
        saved.append(keep)
        states.append(outs)
    prob = _softmax(states[0] @ net.out[0] + states[1] @ net.out[1] + net.bias)
    at = (slice(None), np.arange(n), y)
    loss = float(-np.log(prob[at] + 1e-12).mean())
    prob[at] -= 1
    prob /= t_all * n
    d_inputs, d_step = np.zeros_like(net.inputs), np.zeros_like(net.step)
    d_out = np.stack([s.reshape(-1, h).T @ prob.reshape(-1, prob.shape[2]) for s in states])
    for d in range(2):
        above = prob @ net.out[d].T
        back = np.zeros((n, h))
        deltas = np.empty((t_all, n, 3 * h))
        for t, before, z, r, c, g in reversed(saved[d]):
            grad = above[t] + back
            dz = grad * (before - c) * z * (1 - z)
            dc = grad * (1 - z) * (1 - c * c)
            dr = dc * g * r * (1 - r)
            deltas[t] = np.concatenate([dz, dr, dc], axis=1)
            through = np.concatenate([dz, dr, dc * r], axis=1)
            d_step[d] += before.T @ through
            back = grad * z + through @ net.step[d].T
        flat = deltas.reshape(-1, 3 * h)
        for j in range(3 * h):
            d_inputs[d][:, j] = np.bincount(x.ravel(), flat[:, j], 256)
    return loss, [d_inputs, d_step, d_out, prob.sum(axis=(0, 1))]


def train(windows: list[tuple[bytes, str]], p: NetParams) -> Net:
    """Adam on minibatches with languages drawn evenly; windows are cut to ``train_window`` bytes."""
    rng = np.random.default_rng(5)
    languages = sorted({lang for _, lang in windows})
    h, n = p.hidden, len(languages)
    net = Net(languages, rng.normal(0, 0.3, (2, 256, 3 * h)), rng.normal(0, 0.3, (2, h, 3 * h)),
              rng.normal(0, 0.3, (2, h, n)), np.zeros(n))
    groups = [[np.frombuffer(w.ljust(p.train_window, b" ")[:p.train_window], np.uint8) for w, x in windows if x == lang]
              for lang in languages]
    if n < 2:
        return net
    weights = [net.inputs, net.step, net.out, net.bias]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for i in range(1, p.steps + 1):
        y = rng.integers(n, size=p.batch)
        x = np.stack([groups[k][rng.integers(len(groups[k]))] for k in y], axis=1)
        _, grads = _gradients(net, x, y)
        rate = p.rate * min(1.0, 2 * (1 - i / (p.steps + 1)))
        for w, g, m, v in zip(weights, grads, first, second, strict=True):
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            w -= rate * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
    return net


def _window_sums(net: Net, x: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sums over the positions of each window of the language probabilities; x [time, window], later windows shorter."""
    h, n = net.step.shape[1], x.shape[1]
    forward = np.empty((len(x), n, h), np.float32)
    sums = np.zeros((n, len(net.languages)), np.float32)
    # Halved weights turn the logistic gates into tanh; windows come longest first, so the live ones are a prefix.
    live = np.searchsorted(-size, -np.arange(len(x)), "left")
    half = np.ones(3 * h, np.float32)
    half[:2 * h] = 0.5
    for d in range(2):
        inputs, step = (net.inputs[d] * half).astype(np.float32), (net.step[d] * half).astype(np.float32)
        out = net.out[d].astype(np.float32)
        front, bias = net.out[0].astype(np.float32), net.bias.astype(np.float32)
        state = np.zeros((n, h), np.float32)
        for t in range(len(x)) if d == 0 else range(len(x) - 1, -1, -1):
            m = live[t]
            now = state[:m]
            a, g = inputs[x[t, :m]], now @ step
            gates = np.tanh(a[:, :2 * h] + g[:, :2 * h])
            gates += 1
            gates *= 0.5
            c = g[:, 2 * h:] * gates[:, h:]
            c += a[:, 2 * h:]
            np.tanh(c, out=c)
            now -= c
            now *= gates[:, :h]
            now += c
            if d == 0:
                forward[t, :m] = now
            else:
                e = np.exp(forward[t, :m] @ front + now @ out + bias)
                e /= e.sum(axis=1, keepdims=True)
                sums[:m] += e
    return sums


def _has_letter(text: np.ndarray) -> bool:
    ascii_letter = ((text | 32) - 97).astype(np.uint8) < 26
    if ascii_letter.any():
        return True
    return any(c.isalpha() for c in text.tobytes().decode("utf-8", "ignore"))


def text_probabilities(net: Net, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, p: NetParams) -> np.ndarray:
    """[text, language]: the mean over all byte positions (0 for an empty text)."""
    sizes = ends - starts
    n = -(-sizes // p.window)
    text = np.repeat(np.arange(len(n)), n)
    at = starts[text] + (np.arange(len(text)) - np.repeat(np.cumsum(n) - n, n)) * p.window
    size = np.minimum(p.window, ends[text] - at)
    order = np.argsort(-size, kind="stable")
    total = np.zeros((len(n), len(net.languages)))
    padded = np.append(data, np.zeros(p.window, np.uint8))
    for i in range(0, len(order), p.at_once):
        own = order[i:i + p.at_once]
        most = int(size[own[0]])
        x = padded[at[own][None, :] + np.arange(most)[:, None]]
        np.add.at(total, text[own], _window_sums(net, x, size[own]))
    return total / np.maximum(sizes, 1)[:, None]


def _sample_windows(p: NetParams):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch)
            rows, windows = [], []
            for i in range(batch.num_rows):
                text = data[offsets[i]:offsets[i + 1]].tobytes()
                draw = int.from_bytes(hashlib.blake2b(text, digest_size=8).digest(), "big")
                for _ in range(p.per_document):
                    at = draw % max(1, len(text) - p.train_window + 1)
                    draw = draw // 7 + 12345
                    rows.append(i)
                    windows.append(text[at:at + p.train_window])
            yield pa.RecordBatch.from_arrays(
                [pa.array(windows, pa.binary()), batch.column("lang").take(pa.array(rows, pa.int64()))], ["window", "lang"])

    return run


def _shares(counts: dict[str, int], sample: int) -> dict[str, float]:
    """The share of each language's rows to take: all of the rarer ones, an equal number of the others."""
    shares, left = {}, sample
    for done, lang in enumerate(sorted(counts, key=lambda x: (counts[x], x))):
        take = min(counts[lang], max(1.0, left / (len(counts) - done)))
        shares[lang] = take / counts[lang]
        left -= take
    return shares


def sampled(docs: DataFrame, sample: int) -> DataFrame:
    """(text, lang) of about ``sample`` of the rows that have a label and a letter, by hash within each language;
    the row of a language's least hash is always among them."""
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    rows = rows.filter(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.withColumn("draw", F.pmod(F.xxhash64(F.lit(41), "doc_id", "text"), F.lit(1 << 40)))
    found = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("draw").alias("least")).collect()
    shares = _shares({r.lang: r.n for r in found}, sample)
    below = [(r.lang, max(r.least + 1, int(shares[r.lang] * (1 << 40)))) for r in found]
    limits = docs.sparkSession.createDataFrame(below, "lang string, below long")
    return rows.join(F.broadcast(limits), "lang").filter("draw < below").select("text", "lang")


def fit(docs: DataFrame, p: NetParams = NetParams()) -> Net | None:
    """Train on the rows of ``sampled``; rows that repeat a whole text and label count once."""
    windows = sampled(docs, p.sample).mapInArrow(_sample_windows(p), "window binary, lang string").distinct()
    found = [(bytes(r.window), r.lang) for r in windows.collect()]
    return train(sorted(found), p) if found else None


def predict(docs: DataFrame, net: Net | None, p: NetParams = NetParams()) -> DataFrame:
    """``doc_id, held_out`` of docs plus ``lang_pred`` and ``score``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_column(batch)
            names: list[str] = []
            scores: list[float] = []
            for s in slices(data, offsets):
                letters = [_has_letter(s.data[a:b]) for a, b in zip(s.starts, s.ends, strict=True)]
                if net is None:
                    names += ["und"] * len(letters)
                    scores += [0.0] * len(letters)
                    continue
                found = text_probabilities(net, s.data, s.starts, s.ends, p)
                best = found.argmax(axis=1)
                names += [net.languages[k] if ok else "und" for k, ok in zip(best, letters, strict=True)]
                scores += np.where(letters, found.max(axis=1), 0.0).clip(0, 1).tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"), "held_out")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify_languages(docs: DataFrame, p: NetParams = NetParams(), fold: int = 5) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every row; rows whose crc32(doc_id as text) mod ``fold`` is 0 are held out."""
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % fold == 0
    rows = docs.select("doc_id", "text", "lang", held_out.alias("held_out"))
    net = fit(rows.filter(~F.col("held_out")), p)
    return predict(rows, net, p)
