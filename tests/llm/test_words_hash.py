"""Word hashing, signatures and compact windows against plain versions."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest

from haulmark.llm import repeats as R, superminhash as S, words as W

TEXTS = [None, "", " \t\n", "one", "One oNE two", "a" * 5000, "naïve Ünïté 日本 x y", "x\x0b\x0cy\rz", " lead and trail "]


def plain_words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall("[^\x20\x09-\x0d]+", low)


@pytest.mark.parametrize("block", [3, 17, W.BLOCK])
def test_equal_words_have_equal_hashes_only(monkeypatch, block):
    monkeypatch.setattr(W, "BLOCK", block)
    column = pa.array(TEXTS + ["pad"], pa.string()).slice(0, len(TEXTS))
    hashes, first = W.rows_hashes(column)
    words = [plain_words(t) for t in TEXTS]
    assert np.diff(first).tolist() == [len(w) for w in words]
    flat = [w for row in words for w in row]
    assert len(set(zip(flat, hashes.tolist()))) == len(set(flat)) == len(set(hashes.tolist()))


def test_slices_cover_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(range(9)), pa.array(["x" * 10] * 4 + [None, ""] + ["y" * 100] * 3)], names=["doc_id", "text"])
    parts = list(W.slices(batch, "text", 25))
    assert [i for p in parts for i in p.column(0).to_pylist()] == list(range(9))
    assert max(p.num_rows for p in parts) < 9


def test_shingles_of_short_texts():
    w = np.arange(1, 6, dtype=np.uint64)
    assert len(W.shingles(w, 3)) == 3 and len(W.shingles(w[:2], 3)) == 1 and len(W.shingles(w[:0], 3)) == 0
    assert W.shingles(w[:2], 3)[0] not in set(W.shingles(w, 3).tolist())


def element_by_element(elements, m):
    """SuperMinHash for one set, an element at a time, with the operator's random numbers."""
    out = [2 ** 64 - 1] * m
    for e in elements:
        perm, state = list(range(m)), np.array([e], np.uint64)
        for j in range(m):
            state = W.mix(state)
            x = int(state[0])
            k = j + (x >> 32) % (m - j)
            perm[j], perm[k] = perm[k], perm[j]
            out[perm[j]] = min(out[perm[j]], (j << 48) | ((x & 0xFFFFFFFF) << 16))
    return out


def test_signatures_equal_the_plain_algorithm(monkeypatch):
    rng = np.random.default_rng(3)
    sizes = [0, 1, 2, 5, 30, 200, 0]
    values = rng.integers(0, 1 << 63, sum(sizes)).astype(np.uint64)
    offsets = np.concatenate([[0], np.cumsum(sizes)])
    want = [element_by_element(values[a:b].tolist(), 16) for a, b in zip(offsets, offsets[1:])]
    assert S.signatures(values, offsets, 16).tolist() == want
    monkeypatch.setattr(S, "ELEMENTS", 64)  # parts of a large set
    assert S.signatures(values, offsets, 16).tolist() == want


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(5)
    errors = []
    for _ in range(60):
        shared, own = rng.integers(0, 1 << 63, 80).astype(np.uint64), rng.integers(0, 1 << 63, 40).astype(np.uint64)
        sets = np.concatenate([shared, own[:20], shared, own[20:]])
        a, b = S.signatures(sets, np.array([0, 100, 200]), 80)
        errors.append((a == b).mean() - 80 / 120)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_sliding_least():
    values = np.array(random.Random(1).sample(range(1000), 100), np.uint64)
    for size in (1, 2, 7, 50, 100):
        assert R.sliding_least(values, size).tolist() == [min(values[k:k + size]) for k in range(101 - size)]


def test_compact_windows_equal_the_definition():
    rng = np.random.default_rng(0)
    for _ in range(40):
        sizes = rng.integers(0, 40, 3)
        tokens = rng.integers(0, 1 << 60, sizes.sum()).astype(np.uint64)
        first = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        last, least = first + sizes, int(rng.integers(2, 9))
        value = W.mix(tokens ^ W.mix(np.array([1], np.uint64)))
        want = set()
        for row in range(3):
            for c in range(first[row], last[row]):
                left = right = c
                while left > first[row] and value[left - 1] > value[c]:
                    left -= 1
                while right + 1 < last[row] and value[right + 1] > value[c]:
                    right += 1
                if right - left + 1 >= least:
                    want.add((row, c, left, right))
        got = R.compact_windows(tokens, first, last, least, 1)
        assert set(zip(*(x.tolist() for x in got))) == want
