"""op12 against the tokenizer on whole texts, an exact round trip, and the files themselves."""

import glob
import random
import struct
import zlib

import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arrivals.llm.token_files import read_document, read_token_files, train_dictionary, write_token_files
from arrivals.llm.vocabularies import WordEncoder, read_vocabulary
from tests.llm.cases import edge_docs, edge_rows, empty_docs

VOCABULARY = read_vocabulary("word_bpe_49k.json")
TOKENIZER = Tokenizer.from_buffer(VOCABULARY)
ENCODER = WordEncoder(VOCABULARY)
ODD = ["", " ", "\x1c", "a\x1cb", "don't DON'T", "a'll 's", "İstanbul ǅ ΑΣ ς", "é ́x", "ﬁ ①²", "12345 3.14",
       "<|endoftext|> x<|startoftext|>y <|END", "日本語 ✓ 👍🏽", "tab\tand\r\nline\x0b\x0c\x85 end", "a b c​d",
       "ÀÉÎ×÷ßÿ ÆØ", "x" * 3000, "ab " * 2000, "Å ẞ", "﻿bom", "\x00nul"]


def ids(text):
    return TOKENIZER.encode(text or "", add_special_tokens=False).ids + [1]


def packed(values):
    return struct.pack(f"<{len(values)}I", *values)


@pytest.mark.parametrize("text", ODD)
def test_ids_of_words_are_the_ids_of_the_text(text):
    assert ENCODER.by_word
    assert ENCODER.encode(text) == packed(ids(text)[:-1])


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from(" \n\t'eéÉsSll<|>"))))
def test_ids_of_any_text(text):
    assert ENCODER.encode(text) == packed(ids(text)[:-1])


def test_other_rules_encode_whole_texts():
    other = WordEncoder(read_vocabulary("byte_bpe_50k.json"))
    assert not other.by_word
    whole = Tokenizer.from_buffer(read_vocabulary("byte_bpe_50k.json")).encode("Two  words\n", add_special_tokens=False).ids
    assert other.encode("Two  words\n") == packed(whole)


def expected(rows):
    """(doc_id, n_tokens, crc) of every row, and that the starts add up in the order of the ids."""
    return sorted(((r[0], len(ids(r[1])), zlib.crc32(packed(ids(r[1])))) for r in rows), key=str)


def check(spark, docs, rows, path, **sizes):
    write_token_files(docs, path, **sizes)
    got = read_token_files(spark, path).collect()
    assert sorted(((r.doc_id, r.n_tokens, r.ids_crc32) for r in got), key=str) == expected(rows)
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and len(r.ids) == r.n_tokens and zlib.crc32(packed(r.ids)) == r.ids_crc32
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    return got


def test_round_trip_of_odd_rows(spark, tmp_path):
    rows = edge_rows() + [(100 + i, t, None, None, 0) for i, t in enumerate(ODD)]
    extra = spark.createDataFrame([(r[0], r[1]) for r in rows], "doc_id long, text string")
    check(spark, extra, rows, str(tmp_path / "one"))
    # Tiny shards: many per partition, rows cut within a shard, and the same documents.
    check(spark, extra.repartition(5), rows, str(tmp_path / "many"), shard_bytes=700, text_bytes=9000, row_bytes=100)
    assert len(glob.glob(f"{tmp_path}/many/files/kind=data/*/part-*")) > 10


def test_clashing_columns_and_empty_table(spark, tmp_path):
    check(spark, edge_docs(spark, ("hash", "salt", "part", "shard", "ids", "start")), edge_rows(), str(tmp_path / "wide"))
    write_token_files(empty_docs(spark), str(tmp_path / "empty"))
    assert read_token_files(spark, str(tmp_path / "empty")).count() == 0
    assert read_document(spark, str(tmp_path / "empty"), 1) == []


def test_one_document_is_read_alone(spark, tmp_path):
    path = str(tmp_path / "files")
    write_token_files(edge_docs(spark), path, shard_bytes=700, text_bytes=9000)
    texts = [(r[0], r[1]) for r in edge_rows()]
    for doc_id in (0, 30, 41, 60):
        assert sorted(read_document(spark, path, doc_id)) == sorted(ids(t) for d, t in texts if d == doc_id)
    assert read_document(spark, path, 12345) == []


def test_shards_are_plain_zstandard_streams(spark, tmp_path):
    """Any zstandard reader with the dictionary gets the ids of a shard; another dictionary is refused."""
    path = str(tmp_path / "files")
    write_token_files(edge_docs(spark), path)
    dictionary = bytes(spark.read.parquet(f"{path}/dictionary").first().dictionary)
    reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary))
    size = 0
    for file in glob.glob(f"{path}/files/kind=data/*/part-*"):
        with open(file, "rb") as f:
            size += len(reader.stream_reader(f, read_across_frames=True).read())
    assert size == 4 * sum(len(ids(r[1])) for r in edge_rows())
    other = str(tmp_path / "other")
    spark.createDataFrame([("0" * 64, "", 1, bytearray(b"x"))],
                          "dict_sha256 string, tokenizer_sha256 string, end_id long, dictionary binary").write.parquet(other)
    with pytest.raises(ValueError, match="hash"):
        read_document(spark.newSession(), _with_dictionary(path, other, tmp_path), 0)


def _with_dictionary(path, other, tmp_path):
    import shutil

    mixed = tmp_path / "mixed"
    shutil.copytree(f"{path}/files", mixed / "files")
    shutil.copytree(f"{path}/shards", mixed / "shards")
    shutil.copytree(other, mixed / "dictionary")
    return str(mixed)


def test_hot_ids_and_copies_cross_shards(spark, tmp_path):
    """A third of the rows is one text without an id: no shard and no partition takes them all."""
    rng = random.Random(4)
    rows = [(None, "the same text without an id") for _ in range(600)] + [
        (rng.randrange(300), " ".join(rng.choice(("alpha", "beta", "gamma", "delta")) for _ in range(40))) for _ in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    check(spark, docs, rows, str(tmp_path / "hot"), text_bytes=8000)
    shards = spark.read.parquet(f"{tmp_path}/hot/shards").collect()
    assert max(s.n_docs for s in shards) < 400


def test_dictionary_repeats_and_pays(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    one, two = (train_dictionary(docs.repartition(n), VOCABULARY, 1000) for n in (2, 7))
    assert one == two
    short = [packed(ids(r.text)) for r in docs.filter("n_chars between 100 and 600").limit(50).collect()]
    shared = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(one))
    plain = zstandard.ZstdCompressor(level=3)
    assert sum(len(shared.compress(x)) for x in short) < 0.9 * sum(len(plain.compress(x)) for x in short)


def test_remembered_pieces_survive_generations(monkeypatch):
    """With room for a few pieces only, and a worker's encoder used again, ids stay the same."""
    from arrivals.llm import vocabularies

    monkeypatch.setattr(vocabularies, "PIECES", 6)
    encoder = vocabularies.kept_in_worker(WordEncoder, VOCABULARY)
    rng = random.Random(6)
    for _ in range(60):
        text = " ".join(rng.choice(["the", "of", "don't", "l'été", "x" * 70, "été.", f"w{rng.randrange(40)}"]) for _ in range(9))
        assert encoder.encode(text) == packed(ids(text)[:-1])
        assert vocabularies.kept_in_worker(WordEncoder, VOCABULARY) is encoder
    assert len(encoder.parts) + len(encoder.parts.old) < 60
    assert vocabularies.kept_in_worker(WordEncoder, read_vocabulary("byte_bpe_50k.json")) is not encoder


@pytest.mark.parametrize("stretch", [1, 7, 100, 1 << 20])
def test_texts_in_bulk_have_the_ids_of_each(monkeypatch, stretch):
    """Plain, odd and blank texts in one batch, cut anywhere between words: the ids of each text by itself, in order."""
    from arrivals.llm import vocabularies

    monkeypatch.setattr(vocabularies, "STRETCH", stretch)
    rng = random.Random(8)
    words = ["the", "Été", "ÀÖÞß", "a1b22c", "--", "x.y!?", "3.14", "don't", "日本", "été.", "word" * 9, "\n\n", "\t", " "]
    texts = [" ".join(rng.choices(words[:7] + words[9:] if k % 3 else words, k=rng.randrange(12))) for k in range(60)]
    texts = ["", " ", *texts, "\n", *ODD, ""]
    assert list(ENCODER.encode_each(texts)) == [packed(ids(t)[:-1]) for t in texts]
    assert list(ENCODER.encode_each([])) == []


def test_a_part_is_merged_once_for_all_its_places(monkeypatch):
    encoder, seen = WordEncoder(VOCABULARY), []
    compute = encoder.parts.compute
    encoder.parts.compute = lambda part: seen.append(part) or compute(part)
    texts = ["The theatre été", "THE theatre ÉTÉ the", "the  été\nThe"] * 20
    assert list(encoder.encode_each(texts)) == [packed(ids(t)[:-1]) for t in texts]
    assert len([p for p in seen if p.strip()]) == 3
