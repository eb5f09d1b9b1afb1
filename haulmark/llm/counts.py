"""Token counts of whole texts by a tokenizer library.

Inside an Arrow function, texts are cut at safe boundaries into parts of about ``PART``
bytes, the parts are packed into batches of about ``BATCH`` bytes, whatever the texts'
lengths are, each batch is encoded at once and only lengths are kept, which add up to the
counts of the texts. A cut is safe before a single space between two characters that are
no white space: no token of the supported files reaches over one. A text without such a
place stays whole.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulmark.llm import encoders, words as W
from haulmark.llm.common import each, id_text

PART, BATCH = 1 << 16, 1 << 18

_CUT = re.compile(r"(?<=\S)(?= \S)")


class PieceCounter:
    """Byte-level BPE files: distinct pieces go to the library once, whole texts are sums over pieces."""

    def __init__(self, path: str):
        self.library = encoders.library_encoder(path)
        self.known = encoders.Memory()

    def lengths(self, parts: list[str]) -> list[int]:
        rows = [self.library.split.pieces(p) for p in parts]
        missing = self.known.lacking(rows)
        for a in range(0, len(missing), 4096):
            some = missing[a:a + 4096]
            self.known.update(zip(some, map(len, self.library.library.encode_batch_fast(some, add_special_tokens=False))))
        out = [sum(map(self.known.__getitem__, row)) for row in rows]
        self.known.forget_long(missing)
        return out


class BatchCounter:
    """Any other file of the tokenizers library."""

    def __init__(self, path: str):
        self.library = encoders.library_encoder(path).library

    def lengths(self, parts: list[str]) -> list[int]:
        return list(map(len, self.library.encode_batch_fast(parts, add_special_tokens=False)))


class ModelCounter:
    """sentencepiece models. A part begins with the space it was cut before; the model would add one more, so that is taken off."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)

    def lengths(self, parts: list[str]) -> list[int]:
        return list(map(len, self.model.encode(parts, num_threads=1)))


@functools.cache
def counter(path: str):
    if path.endswith(".model"):
        return ModelCounter(path)
    return PieceCounter(path) if encoders.library_encoder(path).split.fits else BatchCounter(path)


def cut(text: str, size: int = PART) -> Iterable[str]:
    """The text in parts of at least ``size`` characters (the last one may be shorter), cut at safe places."""
    if len(text) <= size:
        return [text]
    out, a = [], 0
    while len(text) - a > size:
        place = _CUT.search(text, a + size)
        if place is None:
            break
        out.append(text[a:place.start()])
        a = place.start()
    return [*out, text[a:]]


def _counts(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(path)
        model = isinstance(count, ModelCounter)
        for batch in each(batches):
            for part in W.slices(batch, "text"):
                owner, parts = [], []
                for k, text in enumerate(part.column(1).to_pylist()):
                    cuts = cut(text or "")
                    parts += [c[1:] if i and model else c for i, c in enumerate(cuts)]
                    owner += [k] * len(cuts)
                # batches of equal bytes rather than of equal rows
                ends = np.cumsum([len(p) for p in parts])
                total = np.zeros(part.num_rows, np.int64)
                a = 0
                while a < len(parts):
                    b = max(a + 1, int(np.searchsorted(ends, (ends[a - 1] if a else 0) + BATCH, "right")))
                    np.add.at(total, owner[a:b], count.lengths(parts[a:b]))
                    a = b
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(total)], names=["doc_id", "n_bytes", "n_tokens"])
    return run


def token_counts(docs: DataFrame, path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row; only numbers leave the tasks.

    ``path`` names a tokenizers .json or a sentencepiece .model that every executor has. A
    null text counts as empty (0 bytes, 0 tokens); null and repeated ids are passed on; an empty
    table gives none.
    """
    texts = id_text(docs, id_col, text_col).withColumn("n_bytes", F.octet_length(F.coalesce("text", F.lit(""))).cast("long"))
    return (texts.mapInArrow(_counts(path), "doc_id long, n_bytes long, n_tokens long")
            .withColumn("over_limit", F.col("n_tokens") > limit))
