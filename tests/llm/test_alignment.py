"""op11 against whole-text encodings and plain counting."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from arrivals.llm.alignment import (
    Aligner, align_documents, pack_planes, pair_counts, pair_documents, pair_index, token_groups, unpack_planes)
from arrivals.llm.vocabularies import read_vocabulary
from tests.llm.cases import edge_docs, edge_rows, empty_docs
from tests.llm.test_token_files import ODD

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
ALIGNER = Aligner(read_vocabulary("byte_bpe_50k.json"), read_vocabulary("piece_bpe_32k.model"))
MORE = ["a ▁b", "▁", " lead", "trail ", "two  spaces here", "line\n\nbreak \n x", "don't we'll 'S", "it 's", "a b"]


def byte_table():
    visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in visible]
    return {chr(b): b for b in visible} | {chr(256 + i): b for i, b in enumerate(hidden)}


BYTE = byte_table()


def piece_bytes(i):
    piece = B.id_to_piece(i)
    return bytes([int(piece[3:5], 16)]) if B.is_byte(i) else piece.replace("▁", " ").encode()


def brute_groups(text):
    """[(A ids, B ids)] of the groups, from the encodings of the whole text; None without tokens."""
    if not text:
        return None
    a, b = A.encode(" " + text, add_special_tokens=False).ids, B.encode(text)
    bytes_a, bytes_b = [bytes(BYTE[c] for c in A.id_to_token(i)) for i in a], [piece_bytes(i) for i in b]
    if not b"".join(bytes_a) == b"".join(bytes_b) == (" " + text).encode():
        return None
    ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
    out, i, j = [], 0, 0
    for end in sorted(set(ends_a) & set(ends_b)):
        p, q = ends_a.index(end) + 1, ends_b.index(end) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def spelled(groups):
    return ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)


def brute(rows):
    docs = [(r[0], brute_groups(r[1])) for r in rows]
    count = Counter((x[-1], y[-1]) for _, groups in docs for x, y in groups or ())
    top = defaultdict(int)
    for (_, b), n in count.items():
        top[b] = max(top[b], n)
    out = []
    for doc_id, groups in docs:
        links = [(x[-1], y[-1]) for x, y in groups or ()]
        out.append((
            doc_id, sum(len(x) for x, _ in groups or ()), sum(len(y) for _, y in groups or ()), len(links), len(links),
            sum(count[p] == top[p[1]] for p in links), sum(count[p] for p in links),
            hashlib.sha256(spelled(groups).encode()).hexdigest() if groups else ""))
    return sorted(out, key=str), count


def rows_with_odd_texts():
    return [(r[0], r[1]) for r in edge_rows()] + [(100 + i, t) for i, t in enumerate(ODD + MORE)]


def result(df):
    return sorted((tuple(r) for r in df.select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=str)


@pytest.mark.parametrize("text", ODD + MORE)
def test_words_align_like_the_text(text):
    assert ALIGNER.by_word
    groups = brute_groups(text)
    n_a, n_b, codes, got = ALIGNER.align(text)
    assert got == (spelled(groups) if groups else "")
    assert codes.tolist() == [x[-1] * 65536 + y[-1] for x, y in groups or ()]
    assert n_a == sum(len(x) for x, _ in groups or ()) and n_b == sum(len(y) for _, y in groups or ())


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet=st.one_of(st.characters(exclude_categories=("Cs",)), st.sampled_from("   \n\t'eéÉsSll<|>▁"))))
def test_any_text_aligns_like_the_whole(text):
    groups = brute_groups(text)
    assert ALIGNER.align(text)[3] == (spelled(groups) if groups else "")


def test_scores_equal_plain_counting(spark):
    rows = rows_with_odd_texts()
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want, _ = brute(rows)
    assert result(align_documents(docs)) == want
    assert result(align_documents(docs.repartition(7), most_postings=300, most_docs=5)) == want  # many small blocks
    groups = {(r.doc_id, r.groups) for r in token_groups(docs).collect()}
    assert groups == {(d, spelled(brute_groups(t) or ())) for d, t in rows}


def test_index_counts_and_lookups(spark):
    rows = rows_with_odd_texts()
    _, count = brute(rows)
    index = pair_index(spark.createDataFrame(rows, "doc_id long, text string"), most_postings=500)
    got = {(r.a, r.b): (r.n_links, r.n_docs) for r in pair_counts(index).collect()}
    in_docs = Counter(p for _, t in rows for p in {(x[-1], y[-1]) for x, y in brute_groups(t) or ()})
    assert got == {p: (n, in_docs[p]) for p, n in count.items()}
    (a, b), _ = count.most_common(1)[0]
    held = Counter()
    for d, t in rows:
        n = sum((x[-1], y[-1]) == (a, b) for x, y in brute_groups(t) or ())
        if n:
            held[d, n] += 1
    assert Counter((r.doc_id, r.n_links) for r in pair_documents(index, a, b).collect()) == held
    assert pair_documents(index, 50000, 31999).count() == 0


def test_planes_hold_sparse_and_dense_pairs():
    rng = np.random.default_rng(5)
    entries = []
    for pair, n in enumerate((1, 4096, 4097, 60000, 0, 7)):
        for doc in np.sort(rng.choice(65536, n, replace=False)).tolist():
            entries.append((pair, doc, int(rng.integers(1, 9)) if doc % 3 else 70000))
    pair, doc, links = (np.array(c) for c in zip(*entries, strict=True))
    blob = pack_planes(pair, doc, links, 6)
    back = Counter()
    for k, p, d in unpack_planes(blob, 6):
        for key in zip(p.tolist(), d.tolist(), strict=True):
            back[key] += 1 << k
    assert back == {(p, d): n for p, d, n in entries}
    assert list(unpack_planes(pack_planes(*[np.empty(0, np.int64)] * 3, 0), 0)) == []


def test_clashing_columns_and_empty_table(spark):
    assert result(align_documents(edge_docs(spark, ("part", "block", "pair", "n_links")))) == brute(edge_rows())[0]
    assert align_documents(empty_docs(spark)).count() == 0


def test_remembered_words_survive_generations(monkeypatch):
    from arrivals.llm import vocabularies

    monkeypatch.setattr(vocabularies, "PIECES", 4)
    aligner = Aligner(read_vocabulary("byte_bpe_50k.json"), read_vocabulary("piece_bpe_32k.model"))
    texts = [f"the word{i % 5} of don't l'été ▁x {'y' * 70} word{i % 3}" if i % 4 else f"the word{i % 5},\nnext of" for i in range(30)]
    for _ in range(2):
        for text, (_, _, _, groups) in zip(texts, aligner.align_all(texts), strict=True):
            want = brute_groups(text)
            assert groups == (spelled(want) if want else "")
