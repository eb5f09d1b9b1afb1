"""Token ids of texts: with the tokenizers library, or by merges of its own (see ``merges``).

Both encode a distinct piece of a text once and remember it. What is remembered has two ages of
``REMEMBER`` pieces each: when the younger one is full it becomes the older one, and what is
used again gets younger, so frequent pieces stay. This changes no result.
"""

from __future__ import annotations

import functools
import os
import sys
from array import array
from collections.abc import Iterable
from itertools import chain

import numpy as np

from haulmark.llm.pretoken import Splitter, byte_letters

REMEMBER = 1 << 18
#: Pieces longer than this are not remembered.
LONG = 64
#: Texts that the library is given at once.
GROUP = 4096

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")


def _little(ids: list[int]) -> bytes:
    data = array("I", ids)
    if sys.byteorder == "big":
        data.byteswap()
    return data.tobytes()


class Memory(dict):
    """What is known of pieces."""

    def __init__(self) -> None:
        super().__init__()
        self.older: dict = {}

    def lacking(self, rows: list[list[str]]) -> list[str]:
        """Distinct pieces of the rows that nothing is known of; the known ones can be looked up."""
        if len(self) > REMEMBER:
            self.older = dict(self)
            self.clear()
        lacking = set(chain.from_iterable(rows)).difference(self)
        if self.older:
            again = lacking.intersection(self.older)
            self.update({p: self.older[p] for p in again})
            lacking -= again
        return list(lacking)

    def forget_long(self, pieces: list[str]) -> None:
        for p in pieces:
            if len(p) > LONG:
                del self[p]


class Encoder:
    """Ids of whole texts, as little-endian 32-bit values one after the other."""

    def __init__(self, path: str):
        self.split = Splitter(path)
        self.known = Memory()

    def new_ids(self, pieces: list[str]) -> Iterable[bytes]:
        raise NotImplementedError

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where each text begins (one more at the end)."""
        pieces = [self.split.pieces(t) for t in texts]
        known = self.known
        missing = known.lacking(pieces)
        known.update(zip(missing, self.new_ids(missing)))
        coded = [b"".join(map(known.__getitem__, row)) for row in pieces]
        known.forget_long(missing)
        counts = np.fromiter(map(len, coded), np.int64, len(coded)) // 4
        return np.frombuffer(b"".join(coded), "<u4"), np.concatenate([[0], np.cumsum(counts)])


class LibraryEncoder(Encoder):
    """By the tokenizers library, without truncation, padding or added special tokens."""

    def __init__(self, path: str):
        super().__init__(path)
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.letters = {byte: letter for letter, byte in byte_letters().items()}
        self.special = {p: _little([n]) for p, n in self.split.special.items()}

    def new_ids(self, pieces: list[str]) -> Iterable[bytes]:
        # the pieces are split already, so their bytes go straight to the library's model; 255 is no byte of UTF-8
        tokenize = self.library.model.tokenize
        words = b"\xff".join([p.encode("utf-8") for p in pieces]).decode("latin-1").translate(self.letters).split(self.letters[255])
        for piece, word in zip(pieces, words):
            yield self.special.get(piece) or _little([t.id for t in tokenize(word)])

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if self.split.fits:
            return super().encode(texts)
        coded = [_little(e.ids) for a in range(0, len(texts), GROUP)
                 for e in self.library.encode_batch_fast(texts[a:a + GROUP], add_special_tokens=False)]
        return (np.frombuffer(b"".join(coded), "<u4"),
                np.concatenate([[0], np.cumsum([len(c) // 4 for c in coded], dtype=np.int64)]))


@functools.cache
def library_encoder(path: str) -> LibraryEncoder:
    return LibraryEncoder(path)
