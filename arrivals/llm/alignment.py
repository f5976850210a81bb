"""Alignment of two tokenizers' tokens, with inverted bitmaps of the token pairs that they link.

A byte-level vocabulary (A) and a piece vocabulary (B) cut the same bytes
differently. Byte offsets at which tokens of both end cut a text into groups; the
A and the B token that end at such an offset are *linked*. The pairs of linked
ids are counted over the corpus, and every document gets scores from the counts
of its links:

1. Per block of documents (bounded by documents and postings) each pair gets an
   inverted list of the block's documents, bit-sliced by multiplicity: plane k is
   the bitmap of the documents in which bit k of the pair's number of links is
   set. Bitmaps are compressed containers of 16-bit document numbers: sorted
   numbers, or 65,536 bits where those are shorter.
2. A block's document count of a pair is the popcount of the OR of its planes,
   its link count the sum of 2^k popcounts. Blocks have no document in common, so
   OR-merging a pair over the corpus adds its blocks' counts.
3. The counts return to the blocks (only keys and counts are shuffled for that),
   and the postings hand every document the sum over its links.

Texts never leave the task that reads them. A pair that a third of the links
hold is a few planes per block; its keys are one row per block.

Edge cases: texts that are null, empty, or whose tokens' bytes are not the text's
own (B spells U+2581 like a space) have no tokens; repeated rows and null ids are
separate documents; an empty table gives an empty result; other columns are not
read.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from arrivals.llm.common import text_or_empty, written
from arrivals.llm.vocabularies import (
    LONG_PIECE, PLAIN, SPACED_RUNS, Remembered, byte_letters, kept_in_worker, read_vocabulary, speller)

POSTINGS = 1 << 21     # (document, pair) entries of a block, about
DOCUMENTS = 1 << 16    # documents of a block: their numbers fit 16 bits
SPARSE = 4096          # a container of more documents is shorter as bits
_BITS = DOCUMENTS // 8
_CUT = re.compile(r"(?<=\S) (?=\S)")
_B_IDS = 1 << 16       # a pair's code is a * 65536 + b
_SPACE = "▁"

BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, "
          "groups_sha256 array<string>, pair array<long>, pair_docs array<long>, pair_links array<long>, planes binary")
SCORED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, "
          "groups_sha256 string")


class Aligner:
    """Groups and linked pairs of texts under two vocabularies.

    Both tokenizers end a token before a single space between visible
    characters, whatever stands around it (A's pattern starts a match there, and
    no piece of B has a space after another character), so texts are aligned
    word by word and words are remembered. Other rules align whole texts.
    """

    def __init__(self, vocabulary_a: bytes, vocabulary_b: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_buffer(vocabulary_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=vocabulary_b)
        self.model, self.spelled = self.a.model, speller()
        byte_of = {c: b for b, c in byte_letters().items()}
        self.a_bytes = {i: bytes(byte_of[c] for c in t) for t, i in self.a.get_vocab(with_added_tokens=False).items()
                        if all(c in byte_of for c in t)}
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_SPACE, " ").encode()
                        for i, p in enumerate(pieces)]
        n_a, n_b = max(self.a_bytes) + 1, len(pieces)
        self.a_len = np.array([len(self.a_bytes.get(i, b"")) for i in range(n_a)])
        self.b_len = np.array([len(x) for x in self.b_bytes])
        # Every way an id is written in a spelling of groups: A then "," or "|", B then ",", ";" or the end of the word.
        self.written = [f"{i}{end}" for n, ends in ((n_a, ",|"), (n_b, ",;\n")) for end in ends for i in range(n)]
        rules = json.loads(vocabulary_a)
        first = rules.get("pre_tokenizer") or {}
        self.by_word = (
            rules.get("normalizer") is None and first.get("type") == "ByteLevel" and first.get("use_regex") is True
            and first.get("add_prefix_space") is False and not any(_SPACE in p.lstrip(_SPACE) for p in pieces)
        )
        if len(pieces) > _B_IDS or b"" in self.b_bytes or b"" in self.a_bytes.values():
            raise ValueError("the second vocabulary must have at most 65536 ids, and no token may be empty")
        self.words = Remembered(self._word)

    def tokens(self, text: str) -> tuple[list[int], list[int]]:
        """The ids of space + text under both vocabularies."""
        return self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)

    def _word(self, word: str) -> tuple[bytes, bytes, str] | None:
        a, b = self.tokens(word)
        bytes_a, bytes_b = [self.a_bytes.get(i, b"") for i in a], [self.b_bytes[i] for i in b]
        raw = f" {word}".encode()
        if b"".join(bytes_a) != raw or b"".join(bytes_b) != raw:
            return None
        groups, codes = [], []
        end_a = end_b = j = 0
        group_a = group_b = ""
        for i, x in enumerate(a):
            end_a += len(bytes_a[i])
            group_a = f"{group_a},{x}" if group_a else str(x)
            while end_b < end_a:
                y = b[j]
                end_b += len(bytes_b[j])
                group_b = f"{group_b},{y}" if group_b else str(y)
                j += 1
            if end_a == end_b:
                groups.append(f"{group_a}|{group_b}")
                codes.append(x * _B_IDS + y)
                group_a = group_b = ""
        return array("q", (len(a), len(b))).tobytes(), array("q", codes).tobytes(), ";".join(groups)

    def _learn(self, words: list[str]) -> None:
        """Remember plain words, all in one go: their tokens stand one after the other, as if in one text."""
        text = " " + " ".join(words)
        # A's pattern cuts them by character class: straight to the merges.
        runs, tokenize = "\0".join(SPACED_RUNS.findall(text)).translate(self.spelled).split(self.spelled[0]), self.model.tokenize
        a = np.array([t.id for run in runs for t in tokenize(run)])
        b, raw = np.array([*chain.from_iterable(self.b.encode(words, num_threads=1))]), text.encode()
        if b"".join(map(self.a_bytes.get, a.tolist())) != raw or b"".join(map(self.b_bytes.__getitem__, b.tolist())) != raw:
            return  # word by word, then
        ends_a, ends_b = np.cumsum(self.a_len[a]), np.cumsum(self.b_len[b])
        at = np.searchsorted(ends_b, ends_a)
        link_a = np.flatnonzero(ends_b[at] == ends_a)
        link_b = at[link_a]
        word_ends = np.cumsum([len(w.encode()) + 1 for w in words])
        of_a, of_b, of_link = (np.searchsorted(e, word_ends, "right") for e in (ends_a, ends_b, ends_a[link_a]))

        # The spelling: the groups one after the other, each its A tokens, then its B tokens.
        group_a = np.searchsorted(link_a, np.arange(len(a)))
        group_b = np.searchsorted(link_b, np.arange(len(b)))
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[link_a], last_b[link_b], last_b[of_b - 1] = 1, 1, 2
        pieces = np.empty(len(a) + len(b), np.int64)
        n_a, n_b = len(self.a_len), len(self.b_len)
        pieces[np.arange(len(a)) + np.append(0, link_b + 1)[group_a]] = a + n_a * last_a
        pieces[np.arange(len(b)) + link_a[group_b] + 1] = 2 * n_a + b + n_b * last_b
        spelled = "".join(map(self.written.__getitem__, pieces.tolist())).split("\n")
        counts = np.stack([np.diff(of_a, prepend=0), np.diff(of_b, prepend=0)], 1).astype(np.int64).tobytes()
        codes, ends = (a[link_a] * _B_IDS + b[link_b]).tobytes(), (8 * of_link).tolist()
        start = 0
        for i, (word, end) in enumerate(zip(words, ends, strict=True)):
            self.words[word] = counts[16 * i:16 * i + 16], codes[start:end], spelled[i]
            start = end

    def align_all(self, texts: list[str | None]) -> Iterator[tuple[int, int, np.ndarray, str]]:
        """Per text: (A tokens, B tokens, code of each link in order, groups); nothing for a text without tokens."""
        known = self.words
        known.trim()
        split = [(_CUT.split(t) if self.by_word else [t]) if t else [] for t in texts]
        if self.by_word:
            new = known.new_of(set(chain.from_iterable(split)))
            plain = [w for w in new if len(w) <= LONG_PIECE and PLAIN.fullmatch(w)]
            if plain:
                self._learn(plain)
        for words in split:
            found = list(map(known.__getitem__, words))
            if not found or None in found:
                yield 0, 0, np.empty(0, np.int64), ""
                continue
            counts, codes, groups = zip(*found, strict=True)
            n_a, n_b = np.frombuffer(b"".join(counts), np.int64).reshape(-1, 2).sum(0).tolist()
            yield n_a, n_b, np.frombuffer(b"".join(codes), np.int64), ";".join(groups)

    def align(self, text: str | None) -> tuple[int, int, np.ndarray, str]:
        return next(self.align_all([text]))


def _some(texts: pa.Array, most: int = 1 << 20) -> Iterator[list[str]]:
    """The texts of a batch, about ``most`` characters at a time."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py())
        size += len(held[-1])
        if size >= most:
            yield held
            held, size = [], 0
    if held:
        yield held


def pack_planes(pair: np.ndarray, doc: np.ndarray, links: np.ndarray, n_pairs: int) -> bytes:
    """The multiplicity planes of a block: entries (pair, doc, links), sorted by pair, then doc.

    Per plane: the documents of every pair (32 bits each), the 16-bit numbers of
    the sparse containers, then the bits of the dense ones.
    """
    import zstandard

    out, k = [], 0
    while (links >> k).any():
        rows = (links >> k) & 1 == 1
        sizes = np.bincount(pair[rows], minlength=n_pairs).astype("<u4")
        dense = (sizes > SPARSE)[pair[rows]]
        docs = doc[rows].astype("<u2")
        out += [sizes.tobytes(), docs[~dense].tobytes()]
        ends = np.cumsum(sizes)
        for p in np.flatnonzero(sizes > SPARSE):
            bits = np.zeros(DOCUMENTS, np.uint8)
            bits[docs[ends[p] - sizes[p]:ends[p]]] = 1
            out.append(np.packbits(bits).tobytes())
        k += 1
    return zstandard.compress(b"".join(out), 3)


def unpack_planes(blob: bytes, n_pairs: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(k, pair of each entry, doc of each entry) of every plane."""
    import zstandard

    data, at, k = zstandard.decompress(blob), 0, 0
    while at < len(data):
        sizes = np.frombuffer(data, "<u4", n_pairs, at)
        at += 4 * n_pairs
        sparse, pairs = sizes <= SPARSE, np.arange(n_pairs)
        n = int(sizes[sparse].sum())
        pair, doc = [np.repeat(pairs[sparse], sizes[sparse])], [np.frombuffer(data, "<u2", n, at)]
        at += 2 * n
        for p in pairs[~sparse]:
            doc.append(np.flatnonzero(np.unpackbits(np.frombuffer(data, np.uint8, _BITS, at))).astype("<u2"))
            pair.append(np.full(len(doc[-1]), p))
            at += _BITS
        yield k, np.concatenate(pair), np.concatenate(doc)
        k += 1


def _block_batch(block: int, docs: list[tuple], postings: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    codes = np.concatenate([c for c, _ in postings])
    links = np.concatenate([n for _, n in postings])
    doc = np.repeat(np.arange(len(postings)), [len(c) for c, _ in postings])
    order = np.argsort(codes, kind="stable")
    pairs, first, n_docs = np.unique(codes[order], return_index=True, return_counts=True)
    links, doc = links[order], doc[order]
    n_links = np.add.reduceat(links, first) if len(pairs) else np.empty(0, np.int64)
    planes = pack_planes(np.repeat(np.arange(len(pairs)), n_docs), doc, links, len(pairs))
    lists = [*zip(*docs, strict=True), pairs, n_docs, n_links]
    kinds = [pa.int64()] * 4 + [pa.string()] + [pa.int64()] * 3
    columns = [pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), pa.array(v, t))
               for v, t in zip(lists, kinds, strict=True)]
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), *columns, pa.array([planes], pa.binary())], names=names)


def _index(vocabulary_a: bytes, vocabulary_b: bytes, most_postings: int, most_docs: int):
    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept_in_worker(Aligner, vocabulary_a, vocabulary_b)
        docs, postings, held, number, part = [], [], 0, 0, 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else part
            ids = iter(batch.column("doc_id").to_pylist())
            aligned = (x for texts in _some(batch.column("text")) for x in aligner.align_all(texts))
            for doc_id, (n_a, n_b, codes, groups) in zip(ids, aligned, strict=True):
                sha = hashlib.sha256(groups.encode()).hexdigest() if n_a else ""
                docs.append((doc_id, n_a, n_b, len(codes), sha))
                postings.append(np.unique(codes, return_counts=True))
                held += len(postings[-1][0])
                if held >= most_postings or len(docs) == most_docs:
                    yield _block_batch((part << 32) + number, docs, postings)
                    docs, postings, held, number = [], [], 0, number + 1
        if docs:
            yield _block_batch((part << 32) + number, docs, postings)

    return index


def pair_index(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, most_postings: int = POSTINGS,
               most_docs: int = DOCUMENTS) -> DataFrame:
    """The index (``BLOCKS``): a row per block of documents with their sizes, the block's pairs and their planes."""
    a, b = read_vocabulary("byte_bpe_50k.json", path_a), read_vocabulary("piece_bpe_32k.model", path_b)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"),
                        F.spark_partition_id().alias("part"))
    return written(texts.mapInArrow(_index(a, b, most_postings, most_docs), BLOCKS), "pair-index")


def pair_counts(index: DataFrame) -> DataFrame:
    """(pair, a, b, n_docs, n_links, best): the pairs of the corpus; best if no pair of the B id has more links."""
    merged = (
        index.select(F.inline(F.arrays_zip("pair", "pair_docs", "pair_links"))).groupBy("pair")
        .agg(F.sum("pair_docs").alias("n_docs"), F.sum("pair_links").alias("n_links"))
    )
    a, b = F.shiftright("pair", 16), F.col("pair").bitwiseAND(_B_IDS - 1)
    # A window holds the pairs of one B id, at most one per A id.
    return merged.select("pair", a.alias("a"), b.alias("b"), "n_docs", "n_links").withColumn(
        "best", F.col("n_links") == F.max("n_links").over(Window.partitionBy("b")))


def _summed(doc: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Exact 64-bit sums of weights by document: doubles hold the sums of the 24-bit thirds."""
    total = np.zeros(n, np.int64)
    for shift in (0, 24, 48):
        part = np.bincount(doc, ((weight >> shift) & 0xFFFFFF).astype(np.float64), n)
        total += part.astype(np.int64) << shift
    return total


def _return_scores(key: tuple, blocks: pa.Table, keys: pa.Table) -> pa.Table:
    row = {c: blocks.column(c).combine_chunks() for c in blocks.column_names}
    doc_ids = row["doc_id"].flatten()
    n, n_pairs = len(doc_ids), keys.num_rows
    order = np.argsort(keys.column("at").to_numpy())
    counts = keys.column("n_links").to_numpy()[order]
    best = keys.column("best").to_numpy()[order].astype(np.int64)
    count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for k, pair, doc in unpack_planes(row["planes"][0].as_py(), n_pairs):
        count_sum += _summed(doc, counts[pair], n) << k
        n_best += _summed(doc, best[pair], n) << k
    groups = row["n_groups"].flatten()
    return pa.Table.from_arrays(
        [doc_ids, row["n_a"].flatten(), row["n_b"].flatten(), groups, groups, pa.array(n_best), pa.array(count_sum),
         row["groups_sha256"].flatten()], names=[c.split()[0] for c in SCORED.split(", ")])


def score_documents(index: DataFrame, counts: DataFrame) -> DataFrame:
    """Per document of the index: its sizes, n_best and count_sum by the given counts (``pair, n_links, best``)."""
    keys = (
        index.select(F.col("block").alias("of"), F.posexplode("pair").alias("at", "pair"))
        .join(counts.select("pair", "n_links", "best"), "pair").select("of", "at", "n_links", "best")
    )
    blocks = index.drop("pair", "pair_docs", "pair_links")
    return blocks.groupBy("block").cogroup(keys.groupBy("of")).applyInArrow(_return_scores, SCORED)


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, **sizes: int) -> DataFrame:
    """Per document: tokens, groups, links, best links, the sum of its links' counts, and the hash of its groups."""
    index = pair_index(docs, path_a, path_b, **sizes)
    return score_documents(index, written(pair_counts(index), "pair-counts"))


def token_groups(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """(doc_id, groups): the alignment itself, ``a1,a2|b1;a3|b2,b3`` (empty without tokens)."""
    a, b = read_vocabulary("byte_bpe_50k.json", path_a), read_vocabulary("piece_bpe_32k.model", path_b)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = kept_in_worker(Aligner, a, b)
        for batch in batches:
            groups = [x[3] for texts in _some(batch.column("text")) for x in aligner.align_all(texts)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(groups, pa.string())], names=["doc_id", "groups"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    return texts.mapInArrow(align, "doc_id long, groups string")


def pair_documents(index: DataFrame, a: int, b: int) -> DataFrame:
    """(doc_id, n_links) of the documents that link A id ``a`` with B id ``b``, read from the postings."""
    code = a * _B_IDS + b

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids = batch.column("doc_id")[i].values
                at, links = batch.column("at")[i].as_py(), np.zeros(len(ids), np.int64)
                for k, pair, doc in unpack_planes(batch.column("planes")[i].as_py(), batch.column("n_pairs")[i].as_py()):
                    links[doc[pair == at]] += 1 << k
                rows = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(links[rows])], names=["doc_id", "n_links"])

    held = index.filter(F.array_contains("pair", code)).select(
        "doc_id", (F.array_position("pair", F.lit(code)) - 1).alias("at"), F.size("pair").alias("n_pairs"), "planes")
    return held.mapInArrow(look_up, "doc_id long, n_links long")
