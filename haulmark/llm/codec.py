"""Byte-pair encoding and decoding of whole texts (see ``merges``)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from haulmark.llm import words as W
from haulmark.llm.common import each, id_text
from haulmark.llm.merges import merge_encoder

_CODED = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32())), ("decoded", pa.string())])


def _round_trip(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = merge_encoder(path)
        for batch in each(batches):
            for part in W.slices(batch, "text"):
                ids, offsets = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                decoded = [encoder.decode(ids[offsets[k]:offsets[k + 1]]) for k in range(part.num_rows)]
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view(np.int32)))
                yield pa.RecordBatch.from_arrays([part.column(0), lists, pa.array(decoded, pa.string())], schema=_CODED)
    return run


def encode_decode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids, decoded) for every row: token ids of the whole text, and the text that they decode to.

    ``path`` names a byte-level BPE file that every executor has. Strings of special
    tokens inside a text become these tokens. A null text counts as empty (no ids, decoded
    empty); null and repeated ids are passed on; an empty table gives none.
    """
    return id_text(docs, id_col, text_col).mapInArrow(_round_trip(path), "doc_id long, ids array<int>, decoded string")
