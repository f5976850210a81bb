"""Token ids in binary shard files, each document compressed on its own with one shared dictionary.

A zstandard dictionary is trained on the serialized ids of a bounded sample of
documents; with it even a document of a few words compresses well by itself, so
any document can be read without its neighbours.

Layout of a folder of token files:

- ``files/kind=data/shard=<partition>-<number>/``: one file per shard. It is a
  valid stream of zstandard frames: a frame of little-endian unsigned 32-bit ids
  per document in ascending order of doc_id (null first; equal ids by a hash of
  the text), and skippable frames for the head (format, hash of the dictionary)
  and the index at the end (per document: doc_id, ids, offset and length of its
  frame).
- ``files/kind=totals/``: a line per shard (documents, ids, first and last doc_id).
- ``shards``: Parquet, the totals with the number of ids before each shard.
- ``dictionary``: Parquet, one row: the dictionary, its SHA-256, the tokenizer's
  SHA-256 and the end id.

Everything is written by Spark's writers and their commit protocol, so it works
on any file system Spark can write and survives lost executors. A shard is
closed at ``shard_bytes``, whatever its partition holds, so no reader's memory
grows with the data. Documents are range-partitioned by (doc_id, hash of the
text, input partition): no id, and no text that a third of the rows share, is
one task's load.

Edge cases: a null text counts as empty and holds only the end id; an empty
table gives no shard; repeated rows are separate documents; other columns are
not read.
"""

from __future__ import annotations

import hashlib
import json
import math
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from arrivals.llm.common import hash_sample, text_or_empty
from arrivals.llm.vocabularies import WordEncoder, kept_in_worker, read_vocabulary

# Fixed values of the zstandard frame format: the magic number of skippable frames.
_SKIP = b"\x50\x2a\x4d\x18"
_BETWEEN = (_SKIP + bytes(4)).decode()  # an empty skippable frame ends every row that the text writer writes
_MAGIC = b"token-ids-1\0"
_ROWS = "kind string, shard string, seq int, value binary"
_TAIL = "<Q12s"  # last bytes of the index frame: its length, and the magic again
_INDEX = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("offset", pa.int64()), ("length", pa.int64())])


def _skippable(payload: bytes) -> bytes:
    return _SKIP + struct.pack("<I", len(payload)) + payload


def _dictionary(content: bytes):
    import zstandard

    return zstandard.ZstdCompressionDict(content) if content else None


class _Shard:
    """The rows of one shard file, built document by document."""

    def __init__(self, name: str, dict_hash: bytes, row_bytes: int):
        self.name, self.row_bytes, self.seq, self.at = name, row_bytes, 0, 0
        self.held: list[bytes] = []
        self.held_bytes = 0
        self.index: list[tuple] = []
        self.add(_skippable(_MAGIC + dict_hash))

    def add(self, frame: bytes) -> None:
        self.held.append(frame)
        self.held_bytes += len(frame)

    def add_document(self, doc_id: int | None, n_tokens: int, frame: bytes) -> Iterator[tuple]:
        self.index.append((doc_id, n_tokens, self.at + self.held_bytes, len(frame)))
        self.add(frame)
        if self.held_bytes >= self.row_bytes:
            yield self.row()

    @property
    def size(self) -> int:
        return self.at + self.held_bytes

    def row(self) -> tuple:
        value = b"".join(self.held)
        self.at += len(value) + len(_BETWEEN)
        self.held, self.held_bytes, self.seq = [], 0, self.seq + 1
        return "data", self.name, self.seq, value

    def close(self) -> Iterator[tuple]:
        columns = [pa.array(c, f.type) for c, f in zip(zip(*self.index, strict=True), _INDEX, strict=True)]
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, _INDEX) as writer:
            writer.write_table(pa.Table.from_arrays(columns, schema=_INDEX))
        body = sink.getvalue().to_pybytes()
        self.add(_skippable(body + struct.pack(_TAIL, len(body), _MAGIC)))
        yield self.row()
        totals = {"shard": self.name, "n_docs": len(self.index), "n_tokens": sum(r[1] for r in self.index),
                  "first_id": self.index[0][0], "last_id": self.index[-1][0]}
        yield "totals", self.name, 0, json.dumps(totals).encode()


def _row_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.string(), pa.int32(), pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=["kind", "shard", "seq", "value"])


def _encode_shards(vocabulary: bytes, end_id: int, content: bytes, shard_bytes: int, row_bytes: int):
    dict_hash = hashlib.sha256(content).digest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        encoder, end = kept_in_worker(WordEncoder, vocabulary), struct.pack("<I", end_id)
        compressor = zstandard.ZstdCompressor(level=3, dict_data=_dictionary(content))
        shard, number = None, 0
        for batch in batches:
            part = batch.column("part")[0].as_py() if batch.num_rows else 0
            texts = encoder.encode_each(t.as_py() for t in batch.column("text"))
            for doc_id, ids in zip(batch.column("doc_id").to_pylist(), texts, strict=True):
                if shard is None:
                    shard = _Shard(f"{part:08d}-{number:06d}", dict_hash, row_bytes)
                    number += 1
                ids += end
                for row in shard.add_document(doc_id, len(ids) // 4, compressor.compress(ids)):
                    yield _row_batch([row])
                if shard.size >= shard_bytes:
                    yield _row_batch(list(shard.close()))
                    shard = None
        if shard is not None:
            yield _row_batch(list(shard.close()))

    return encode


def _sample_ids(vocabulary: bytes, most: int):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = kept_in_worker(WordEncoder, vocabulary)
        for batch in batches:
            ids = [x[:most] for x in encoder.encode_each(t.as_py() for t in batch.column("text"))]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.binary())], names=["ids"])

    return encode


def train_dictionary(docs: DataFrame, vocabulary: bytes, n_docs: int, sample: int = 2000, sample_bytes: int = 16384,
                     dict_bytes: int = 112640) -> bytes:
    """A zstandard dictionary of serialized ids, trained on about ``sample`` distinct texts.

    Bounded whatever the input: texts are picked by hash, copies count once, and
    ``sample_bytes`` of each text's ids are used. Too few texts for a training
    serve as the dictionary themselves.
    """
    import zstandard

    texts = hash_sample(docs.select(text_or_empty(F.col("text")).alias("text")), ["text"], sample, n_docs).distinct()
    rows = texts.mapInArrow(_sample_ids(vocabulary, sample_bytes), "ids binary").collect()
    samples = sorted(bytes(r.ids) for r in rows if r.ids)
    try:
        return zstandard.train_dictionary(dict_bytes, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:dict_bytes]


def write_token_files(
    docs: DataFrame, path: str, tokenizer_path: str | None = None, tokenizer: str = "word_bpe_49k.json",
    end_id: int = 1, shard_bytes: int = 16 << 20, text_bytes: int = 32 << 20, row_bytes: int = 1 << 20,
) -> None:
    """Encode every whole text of ``docs`` (doc_id, text) and write the token files under ``path``.

    ``end_id`` is appended to each document. A partition gets about
    ``text_bytes`` of text, a shard file ends at ``shard_bytes``.
    """
    spark = docs.sparkSession
    vocabulary = read_vocabulary(tokenizer, tokenizer_path)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty(F.col("text")).alias("text"))
    n_docs, n_bytes = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    content = train_dictionary(texts, vocabulary, n_docs)
    spark.createDataFrame(
        [(hashlib.sha256(content).hexdigest(), hashlib.sha256(vocabulary).hexdigest(), end_id, content)],
        "dict_sha256 string, tokenizer_sha256 string, end_id long, dictionary binary").write.parquet(f"{path}/dictionary")

    ordered = (
        texts.withColumns({"hash": F.xxhash64("text"), "salt": F.spark_partition_id()})
        .repartitionByRange(max(1, math.ceil(n_bytes / text_bytes)), "doc_id", "hash", "salt")
        .sortWithinPartitions("doc_id", "hash")
        .select("doc_id", "text", F.spark_partition_id().alias("part"))
    )
    rows = ordered.mapInArrow(_encode_shards(vocabulary, end_id, content, shard_bytes, row_bytes), _ROWS)
    # The text writer writes a row's bytes as they are and an empty skippable frame after it.
    (
        rows.sortWithinPartitions("kind", "shard", "seq").select("kind", "shard", F.col("value").cast("string"))
        .write.partitionBy("kind", "shard").option("lineSep", _BETWEEN).text(f"{path}/files")
    )
    _shard_starts(spark, path, n_docs).write.parquet(f"{path}/shards")


_TOTALS = "shard string, n_docs long, n_tokens long, first_id long, last_id long"


def _shard_starts(spark: SparkSession, path: str, n_docs: int, block: int = 1000) -> DataFrame:
    """The totals of the shards with ``start``, the ids before each: summed by blocks of partitions, then within them."""
    if not n_docs:
        return spark.createDataFrame([], _TOTALS + ", start long")
    lines = spark.read.option("lineSep", _BETWEEN).schema("value string").text(f"{path}/files/kind=totals")
    totals = lines.select(F.from_json("value", _TOTALS).alias("t")).select("t.*").withColumn(
        "block", F.floor(F.substring("shard", 1, 8).cast("long") / block))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = totals.groupBy("block").agg(F.sum("n_tokens").alias("n")).select(
        "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return (
        totals.withColumn("inner", F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).join(blocks, "block")
        .select(*[c.split()[0] for c in _TOTALS.split(", ")], (F.col("base") + F.col("inner")).alias("start"))
    )


def shard_index(content: bytes, dict_hash: bytes) -> pa.Table:
    """The index at the end of a shard file; its head must name the dictionary."""
    head = _skippable(_MAGIC + dict_hash)
    if content[:len(head)] != head:
        raise ValueError("not a shard of token ids, or written with another dictionary")
    end = len(content) - len(_BETWEEN)
    at = end - struct.calcsize(_TAIL)
    size, magic = struct.unpack(_TAIL, content[at:end])
    if magic != _MAGIC:
        raise ValueError("the shard file is cut off")
    return pa.ipc.open_stream(content[at - size:at]).read_all()


def _decode(dictionary: bytes, with_ids: bool):
    dict_hash = hashlib.sha256(dictionary).digest()

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(dictionary))
        for batch in batches:
            for shard, content in zip(batch.column("shard").to_pylist(), batch.column("content"), strict=True):
                data = content.as_py()
                index = shard_index(data, dict_hash)
                counts = index.column("n_tokens").to_numpy()
                crcs, ids, lengths = [], [], []
                for at, size in zip(index.column("offset").to_pylist(), index.column("length").to_pylist(), strict=True):
                    raw = decompressor.decompress(data[at:at + size])
                    crcs.append(zlib.crc32(raw))
                    lengths.append(len(raw) // 4)
                    if with_ids:
                        ids.append(np.frombuffer(raw, "<u4").astype(np.int64))
                if not np.array_equal(counts, lengths):
                    raise ValueError(f"shard {shard}: its index does not fit its frames")
                columns = [index.column("doc_id").combine_chunks(), pa.array([shard] * len(counts), pa.string()),
                           pa.array(np.cumsum(counts) - counts), pa.array(counts), pa.array(crcs, pa.int64())]
                names = ["doc_id", "shard", "shard_start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns.append(pa.array(ids, pa.list_(pa.int64())))
                    names.append("ids")
                yield from pa.Table.from_arrays(columns, names=names).to_batches(max_chunksize=1000)

    return decode


def _dictionary_of(spark: SparkSession, path: str) -> bytes:
    row = spark.read.parquet(f"{path}/dictionary").first()
    content = bytes(row.dictionary)
    if hashlib.sha256(content).hexdigest() != row.dict_sha256:
        raise ValueError("the dictionary does not have the hash it was stored with")
    return content


def read_token_files(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """Per document: doc_id, start (ids of all documents before it), n_tokens, ids_crc32, and ``ids`` if wanted."""
    shards = spark.read.parquet(f"{path}/shards")
    columns = ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * with_ids]
    if shards.isEmpty():
        schema = "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
        return spark.createDataFrame([], schema)
    data = spark.read.format("binaryFile").load(f"{path}/files/kind=data").select("shard", "content")
    schema = "doc_id long, shard string, shard_start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids
    rows = data.mapInArrow(_decode(_dictionary_of(spark, path), with_ids), schema)
    starts = shards.select("shard", F.col("start").alias("before"))
    return rows.join(starts, "shard").withColumn("start", F.col("before") + F.col("shard_start")).select(*columns)


def read_document(spark: SparkSession, path: str, doc_id: int) -> list[list[int]]:
    """The ids of the documents with ``doc_id``: only shards whose range holds it are read, only its frames decoded."""
    content = _dictionary_of(spark, path)
    shards = spark.read.parquet(f"{path}/shards").filter(
        (F.col("last_id") >= doc_id) & (F.col("first_id").isNull() | (F.col("first_id") <= doc_id)))
    names = [f"{path}/files/kind=data/shard={r.shard}" for r in shards.select("shard").collect()]
    if not names:
        return []
    dict_hash = hashlib.sha256(content).digest()

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        decompressor = zstandard.ZstdDecompressor(dict_data=_dictionary(content))
        for batch in batches:
            for data in batch.column("content"):
                data = data.as_py()
                index = shard_index(data, dict_hash)
                found = index.filter(pc.equal(index.column("doc_id"), doc_id)).to_pylist()
                frames = [decompressor.decompress(data[r["offset"]:r["offset"] + r["length"]]) for r in found]
                ids = [np.frombuffer(f, "<u4").astype(np.int64) for f in frames]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.list_(pa.int64()))], names=["ids"])

    files = spark.read.format("binaryFile").load(names).select("content")
    return [list(r.ids) for r in files.mapInArrow(pick, "ids array<long>").collect()]
