"""Byte-pair encoding by contiguous rank arrays, and decoding.

A short word is held as the ids of its parts, one after the other, beside the ranks of
adjacent pairs. Each step scans the ranks for the least (the leftmost of equal ones),
joins that pair, deletes the boundary by moving what follows one place down, and looks up
the two ranks beside it. Words of like length go through the steps side by side as
rows of one array. Words of more than ``SHORT`` bytes, for which scanning would
cost the square of the length, go through a heap of pairs with the same order of merges.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterable

import numpy as np

from haulmark.llm.encoders import Encoder
from haulmark.llm.pretoken import byte_letters

SHORT = 48
_NONE = np.iinfo(np.int32).max


class MergeEncoder(Encoder):
    """By the merges of a byte-level BPE file."""

    def __init__(self, path: str):
        super().__init__(path)
        if not self.split.fits:
            raise ValueError(f"{path} is not a plain byte-level BPE file")
        vocab, letters = self.split.model["vocab"], byte_letters()
        self.byte_id = np.zeros(256, np.int64)
        for letter, byte in letters.items():
            self.byte_id[byte] = vocab[letter]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in self.split.model["merges"]]
        key = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(key, kind="stable")
        self.pair, self.pair_rank = key[order], order.astype(np.int32)
        self.joined = np.array([vocab[a + b] for a, b in pairs], np.int64)
        size = max([*vocab.values(), *self.split.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for token, number in vocab.items():
            self.bytes_of[number] = bytes(letters[c] for c in token)
        for token, number in self.split.special.items():
            self.bytes_of[number] = token.encode()

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = (left << 32) | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        return np.where(self.pair[at] == key, self.pair_rank[at], _NONE)

    def new_ids(self, pieces: list[str]) -> Iterable[bytes]:
        out: list[bytes] = [b""] * len(pieces)
        groups: dict[int, list[int]] = {}
        raw = [p.encode("utf-8") for p in pieces]
        for k, p in enumerate(pieces):
            if p in self.split.special:
                out[k] = np.array([self.split.special[p]], "<u4").tobytes()
            elif len(raw[k]) > SHORT:
                out[k] = self._long(raw[k])
            else:
                groups.setdefault(len(raw[k]), []).append(k)
        for length, rows in groups.items():
            for a in range(0, len(rows), 8192):
                part = rows[a:a + 8192]
                data = np.frombuffer(b"".join([raw[k] for k in part]), np.uint8).reshape(-1, length)
                ids, counts = self._short(self.byte_id[data])
                flat = ids.astype("<u4").tobytes()
                for k, at, n in zip(part, range(0, len(flat), 4 * length), (4 * counts).tolist()):
                    out[k] = flat[at:at + n]
        return out

    def _short(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the rows of ``ids`` (all of one length); ids and their number for each row."""
        n, width = ids.shape
        counts = np.full(n, width)
        if width < 2:
            return ids, counts
        out, live = ids.copy(), np.arange(n)
        rank = self.ranks(ids[:, :-1], ids[:, 1:])
        place = np.arange(width)
        while len(live):
            at = rank.argmin(axis=1)
            row = np.arange(len(live))
            best = rank[row, at]
            more = best < _NONE
            if not more.all():
                done = ~more
                out[live[done], :ids.shape[1]] = ids[done]
                live, ids, rank, at, best = live[more], ids[more], rank[more], at[more], best[more]
                row = np.arange(len(live))
                if not len(live):
                    break
            ids[row, at] = self.joined[best]
            counts[live] -= 1
            width = ids.shape[1] - 1
            # the boundary after `at` goes: what follows moves one place down
            ids = np.take_along_axis(ids, place[:width] + (place[:width] > at[:, None]), axis=1)
            if width > 1:
                rank = np.take_along_axis(rank, place[:width - 1] + (place[:width - 1] >= at[:, None]), axis=1)
                has = at > 0
                rank[row[has], at[has] - 1] = self.ranks(ids[row[has], at[has] - 1], ids[row[has], at[has]])
                has = at < counts[live] - 1
                rank[row[has], at[has]] = self.ranks(ids[row[has], at[has]], ids[row[has], at[has] + 1])
                has = (at >= counts[live] - 1) & (at < width - 1)
                rank[row[has], at[has]] = _NONE
            else:
                out[live, :1] = ids
                break
        return out, counts

    def _long(self, data: bytes) -> bytes:
        ids = self.byte_id[np.frombuffer(data, np.uint8)]
        first = self.ranks(ids[:-1], ids[1:])
        part = ids.tolist()
        n = len(part)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(int(first[k]), int(k), part[k], part[k + 1]) for k in np.flatnonzero(first < _NONE)]
        heapq.heapify(heap)
        table = self._table
        while heap:
            rank, k, left, right = heapq.heappop(heap)
            r = after[k]
            if part[k] != left or r >= n or part[r] != right:
                continue
            part[k], part[r] = int(self.joined[rank]), -1
            after[k] = after[r]
            if after[k] < n:
                before[after[k]] = k
            for a, b in ((before[k], k), (k, after[k])):
                if a >= 0 and b < n and (found := table.get((part[a] << 32) | part[b])) is not None:
                    heapq.heappush(heap, (found, a, part[a], part[b]))
        return np.array([p for p in part if p >= 0], "<u4").tobytes()

    @functools.cached_property
    def _table(self) -> dict[int, int]:
        return dict(zip(self.pair.tolist(), self.pair_rank.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids, special tokens included; bytes that are not UTF-8 become U+FFFD."""
        table = self.bytes_of
        return b"".join([table[i] for i in ids.tolist()]).decode("utf-8", "replace")


@functools.cache
def merge_encoder(path: str) -> MergeEncoder:
    return MergeEncoder(path)
