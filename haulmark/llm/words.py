"""Words of whole texts as 64-bit hashes, computed on Arrow buffers with numpy.

A word is a run of bytes other than space, tab, line feed, vertical tab, form feed and
carriage return; A-Z count as a-z. Texts are UTF-8, in which these bytes never occur
inside another character. Nothing is cut: long texts are hashed in byte blocks, so the
working memory is a few times ``BLOCK`` plus eight bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes hashed at once.
BLOCK = 1 << 20
#: Bytes of text handed on together by ``slices`` (one longer text goes alone).
SLICE = 2 << 20

_U = np.uint64


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (the splitmix64 finaliser)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_BYTE = mix(np.arange(256, dtype=_U) + _U(1))
_BYTE[ord("A"):ord("Z") + 1] = _BYTE[ord("a"):ord("z") + 1]
_BYTE[_SPACE] = 0
_PLACE = mix(np.arange(4096, dtype=_U) + _U(1 << 20)) | _U(1)


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets (from 0) of a text column; null rows are empty."""
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or not len(at) or at[-1] == at[0]:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[at[0]:at[-1]], at - at[0]


def spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First byte and end byte of each word, and per row the index of its first word (one more at the end)."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    full = ~_SPACE[data]
    first, last = full.copy(), full.copy()
    first[1:] &= ~full[:-1]
    last[:-1] &= ~full[1:]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = full[inner]
    last[inner - 1] = full[inner - 1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    return start, end, np.searchsorted(start, offsets)


def hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word, independent of where the word stands."""
    out = np.zeros(len(start), _U)
    for a in range(0, len(data) if len(start) else 0, BLOCK):
        part = data[a:a + BLOCK]
        i, j = np.searchsorted(start, [a, a + len(part)])
        # the word that began in an earlier block goes on here
        i0 = i - 1 if i and (i == len(start) or start[i] > a) else i
        if i0 == j:
            continue
        seg = np.maximum(start[i0:j], a) - a
        base = start[i0:j] - a
        lens = np.diff(np.append(seg, len(part)))
        place = np.arange(seg[0], len(part), dtype=np.int64) - np.repeat(base, lens)
        value = _BYTE[part[seg[0]:]] * _PLACE[place & 4095]
        out[i0:j] += np.add.reduceat(value, seg - seg[0])
    return mix(out)


def rows_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a column, and per row the index of its first word."""
    data, offsets = buffers(column)
    start, _, first = spans(data, offsets)
    return hashes(data, start), first


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` words; the whole as one run if there are fewer; none without words."""
    n = len(words)
    if n == 0:
        return words
    size = min(size, n)
    out = np.zeros(n - size + 1, _U)
    for k in range(size):
        out += words[k:n - size + 1 + k] * _PLACE[k + 1]
    return mix(out + _U(size))


def slices(batch: pa.RecordBatch, text: str, size: int = SLICE) -> Iterator[pa.RecordBatch]:
    """Runs of rows of a batch with about ``size`` bytes of text each; every row is in one of them."""
    if not batch.num_rows:
        return
    _, offsets = buffers(batch.column(batch.schema.get_field_index(text)))
    a = 0
    while a < batch.num_rows:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + size, "right")) - 1)
        yield batch.slice(a, b - a)
        a = b
