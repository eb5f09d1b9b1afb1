"""Splitting, encoding, counting and id files against the tokenizer libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from haulmark.llm import counts as C, encoders as E, idfile as I, merges as M
from haulmark.llm.codec import encode_decode
from haulmark.llm.pretoken import Splitter

FILE = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(FILE)
ODD = ["", "a", "  a  b \n\n c ", "it's 'sup don't'll !!'s 's\t's", "<|endoftext|>x<|endoftext|>", "  x　y 日本語 \U0001F600՘z",
       "a" * 5000, "ab" * 3000 + "!" * 300, "\x1c\x1fa b\x85c", "é |éé1|", "<<b", "퟿", "x" * 49, "0" * 200]


def random_texts(n, seed=1):
    r = random.Random(seed)
    return ["".join(r.choice("ab 's\n\t!1éß日́\U0001F468‍<|ԯ") for _ in range(r.randint(1, 80))) for _ in range(n)]


def library_ids(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


def test_splitting_agrees_on_all_code_points():
    split = Splitter(FILE)
    for base in range(0, 0x110000, 4096):
        chars = [chr(c) for c in range(base, base + 4096) if not 0xD800 <= c < 0xE000]
        text = "".join(f"a{c}1{c}!{c} {c}{c}" for c in chars)
        if text:
            assert split.pieces(text) == [text[a:b] for _, (a, b) in LIBRARY.pre_tokenizer.pre_tokenize_str(text)]


@pytest.mark.parametrize("make", [E.library_encoder, M.merge_encoder])
def test_encoders_equal_the_library(make, monkeypatch):
    monkeypatch.setattr(E, "REMEMBER", 50)  # forgets while it runs
    encoder = make(FILE)
    texts = ODD + random_texts(600)
    for a in range(0, len(texts), 40):
        some = texts[a:a + 40]
        ids, offsets = encoder.encode(some)
        assert [ids[x:y].tolist() for x, y in zip(offsets, offsets[1:])] == [library_ids(t) for t in some]


@settings(max_examples=60, deadline=None)
@given(st.text(max_size=60))
def test_merges_round_trip(text):
    encoder = M.merge_encoder(FILE)
    ids, _ = encoder.encode([text])
    assert ids.tolist() == library_ids(text) and encoder.decode(ids) == LIBRARY.decode(ids.tolist(), skip_special_tokens=False) == text


def test_short_and_long_words_merge_alike(monkeypatch):
    encoder = M.MergeEncoder(FILE)
    words = ["".join(random.Random(k).choice("etaonris") for _ in range(k)) for k in range(1, 48)]
    short = list(encoder.new_ids(words))
    monkeypatch.setattr(M, "SHORT", 0)
    assert list(encoder.new_ids(words)) == short


def test_broken_bytes_decode_as_in_the_library():
    encoder = M.merge_encoder(FILE)
    for ids in ([447], [447, 246, 64], [160], [50256, 160, 1]):
        assert encoder.decode(np.array(ids)) == LIBRARY.decode(ids, skip_special_tokens=False)


def test_encode_decode_rows(documents):
    rows = [(1, None), (2, ""), (3, "x y"), (3, "x y"), (None, "z")] + list(enumerate(ODD, 10))
    got = encode_decode(documents(rows), FILE).collect()
    assert sorted((r.doc_id or -1, tuple(r.ids), r.decoded) for r in got) == sorted((i or -1, tuple(library_ids(t or "")), t or "") for i, t in rows)
    assert encode_decode(documents([]), FILE).count() == 0


def test_cuts_are_safe():
    text = " ".join(random_texts(400, 5))
    for size in (1, 7, 50):
        parts = C.cut(text, size)
        assert "".join(parts) == text and len(parts) > 20
        assert sum(len(library_ids(p)) for p in parts) == len(library_ids(text))
    assert list(C.cut("x" * 1000, 10)) == ["x" * 1000]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"])
def test_counts_of_all_files(documents, monkeypatch, name):
    path = public_tokenizers.path(name)
    monkeypatch.setattr(C, "PART", 40)
    texts = [None, "", "plain words only here", "word " * 300 + "end"] + random_texts(30, 9)
    if name.endswith(".model"):
        from sentencepiece import SentencePieceProcessor
        want = [len(SentencePieceProcessor(model_file=path).encode(t or "")) for t in texts]
    else:
        want = [len(Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids) for t in texts]
    got = {r.doc_id: r for r in C.token_counts(documents(list(enumerate(texts))), path, limit=20).collect()}
    assert [got[k].n_tokens for k in range(len(texts))] == want
    assert [got[k].n_bytes for k in range(len(texts))] == [len((t or "").encode()) for t in texts]
    assert [got[k].over_limit for k in range(len(texts))] == [n > 20 for n in want]
    assert C.token_counts(documents([]), path).count() == 0


@pytest.mark.parametrize("bits", [False, True])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000])
def test_planes_round_trip(bits, n):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, 1 << 32, n, dtype=np.uint32)
    assert (I.ids_of(I.planes_of(ids, bits), n, bits) == ids).all()
    counts = np.array([n // 2, 0, n - n // 2])
    back, docs, sizes = I.unpack(I.pack(ids, np.array([5, -1, 9]), counts, block=64, bits=bits))
    assert (back == ids).all() and docs.tolist() == [5, -1, 9] and sizes.tolist() == counts.tolist()


@pytest.mark.parametrize("bits", [False, True])
def test_id_files(spark, documents, tmp_path, bits):
    texts = [None, "", "one two", "#" * 30, "x y z " * 500] + random_texts(40, 3)
    rows = [((k * 37) % 101, t) for k, t in enumerate(texts)] + [(37, None), (200, "twice"), (200, "twice")]
    folder = str(tmp_path / "ids")
    I.write_ids(documents(rows), folder, FILE, end_id=2, shards=3, chunk=200, block=64, bits=bits)
    got = sorted((r.start, r.doc_id, r.n_tokens, tuple(r.ids)) for r in I.read_ids(spark, folder).collect())
    assert sorted((d, ids) for _, d, _, ids in got) == sorted((i, tuple(library_ids(t or "") + [2])) for i, t in rows)
    assert [d for _, d, _, _ in got] == sorted(i for i, _ in rows)
    at = 0
    for start, _, n, ids in got:
        assert start == at and n == len(ids)
        at += n
    digest = {(r.doc_id, r.start): r.ids_crc32 for r in I.read_ids(spark, folder, digest=True).collect()}
    assert digest == {(d, s): zlib.crc32(np.array(ids, "<u4").tobytes()) for s, d, _, ids in got}
    index = spark.read.parquet(folder + "/index")
    assert index.agg({"n_ids": "sum"}).first()[0] == at and index.count() > 5


def test_empty_id_files(spark, documents, tmp_path):
    I.write_ids(documents([]), str(tmp_path / "none"), FILE, end_id=2)
    assert I.read_ids(spark, str(tmp_path / "none")).count() == 0


def test_id_files_need_ids(documents, tmp_path):
    with pytest.raises(Exception, match="without an id"):
        I.write_ids(documents([(None, "x")]), str(tmp_path / "bad"), FILE, end_id=2)


def test_queries_equal_the_library(spark):
    from haulmark.llm.queries import QUERIES
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(folder + "/documents.parquet").collect()}
    ids = {i: library_ids(t) for i, t in texts.items()}
    for r in QUERIES["op3_bpe_round_trip"](spark, folder).collect():
        assert r.n_tokens == len(ids[r.doc_id])
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids[r.doc_id])).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
    start = 0
    got = {r.doc_id: r for r in QUERIES["op1_id_files"](spark, folder).collect()}
    for i in sorted(ids):
        assert (got[i].start, got[i].n_tokens) == (start, len(ids[i]) + 1)
        assert got[i].ids_crc32 == zlib.crc32(np.array(ids[i] + [2], "<u4").tobytes())
        start += len(ids[i]) + 1
    for r in QUERIES["op4_token_counts"](spark, folder).collect():
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(texts[r.doc_id].encode()), len(ids[r.doc_id]), len(ids[r.doc_id]) > 512)
