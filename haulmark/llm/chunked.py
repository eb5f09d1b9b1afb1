"""Byte-level BPE by rank files, for texts of any length: overlapping chunks, stitched where their pieces agree.

A text of more than ``CHUNK`` characters is cut into chunks that overlap by ``OVERLAP``. Chunks are rows of their own,
dealt out to all tasks, and each is split into pieces from its own beginning, which may lie inside a piece. The
pattern looks at nothing before the place where it stands, so from a place at which two neighbours
both begin a piece they go on alike: the first such place in the overlap is the seam. Pieces between
the seams are then encoded chunk by chunk, and ids are put together per text. Where neighbours share no place (a
piece as long as the overlap), the text is split from its start in one go.
"""

from __future__ import annotations

import base64
import functools
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, functions as F

from haulmark.llm import words as W
from haulmark.llm.common import each, id_text, scratch, stash
from haulmark.llm.encoders import Memory

#: Characters of a chunk without its overlap, and of the overlap.
CHUNK, OVERLAP = 1 << 16, 1 << 11
#: Characters past a piece's end that its end may depend on: an apostrophe with two letters, a character after white space.
MARGIN = 8

_CODED = "doc_id long, n_tokens long, ids binary, decoded binary"


class RankEncoder:
    """Pieces to ids by the ranks of a file, remembered as in ``encoders``; ids to bytes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in file if line.strip())}
        self.split = regex.compile(pattern)
        self.library = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
        self.known = Memory()
        self.bytes_of = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_of[rank] = token

    def encode(self, rows: list[list[str]]) -> list[bytes]:
        """Ids of rows of pieces, as little-endian unsigned 32-bit integers. A piece alone splits into itself, so the library may encode it alone."""
        missing = self.known.lacking(rows)
        self.known.update((p, np.array(self.library.encode_ordinary(p), "<u4").tobytes()) for p in missing)
        out = [b"".join(map(self.known.__getitem__, row)) for row in rows]
        self.known.forget_long(missing)
        return out

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@functools.cache
def rank_encoder(path: str, pattern: str) -> RankEncoder:
    return RankEncoder(path, pattern)


def ends_of(split: regex.Pattern, text: str) -> np.ndarray:
    """Where the pieces of a text end."""
    return np.cumsum([len(p) for p in split.findall(text)], dtype=np.int64)


def _whole(path: str, pattern: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path, pattern)
        for batch in each(batches):
            for part in W.slices(batch, "text"):
                coded = encoder.encode([encoder.split.findall(t or "") for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array([len(c) // 4 for c in coded], pa.int64()), pa.array(coded, pa.binary()),
                    pa.array([encoder.decode(c) for c in coded], pa.binary())], names=["doc_id", "n_tokens", "ids", "decoded"])
    return run


def _cut(chunk: int, overlap: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for k in range(batch.num_rows):
                row, doc, text = (batch.column(c)[k].as_py() for c in ("row", "doc_id", "text"))
                for number, at in enumerate(range(0, len(text), chunk)):
                    last = at + chunk >= len(text)
                    yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in (
                        (row, pa.int64()), (doc, pa.int64()), (number, pa.int32()), (last, pa.bool_()), (text[at:at + chunk + overlap], pa.string()))],
                        names=["row", "doc_id", "k", "last", "text"])
    return run


def _split(pattern: str, chunk: int, overlap: int):
    """Chunks with the ends of their pieces, and the places in the two overlaps where one begins for certain, counted from the overlap's start."""
    compiled = regex.compile(pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for part in W.slices(batch, "text"):
                found: tuple[list, list, list] = ([], [], [])
                for text, last in zip(part.column("text").to_pylist(), part.column("last").to_pylist()):
                    ends = ends_of(compiled, text)
                    starts = np.append(0, ends)
                    sure = starts if last else starts[starts <= len(text) - MARGIN]
                    tail = sure[:0] if last else sure[sure >= chunk] - chunk
                    for out, places in zip(found, (ends, sure[sure <= overlap], tail)):
                        out.append(places.astype(np.int32))
                yield pa.RecordBatch.from_arrays([*part.columns, *(pa.array(x, pa.list_(pa.int32())) for x in found)],
                                                 names=[*part.schema.names, "ends", "head", "tail"])
    return run


def _encode_between(path: str, pattern: str):
    """Ids of the pieces between two places of a chunk."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = rank_encoder(path, pattern)
        for batch in each(batches):
            for part in W.slices(batch, "text"):
                rows = []
                for k, text in enumerate(part.column("text").to_pylist()):
                    ends, low, high = part.column("ends")[k].values.to_numpy(), part.column("low")[k].as_py(), part.column("high")[k].as_py()
                    high = len(text) if high is None else high
                    cuts = [low, *ends[(ends > low) & (ends <= high)].tolist()]
                    rows.append([text[a:b] for a, b in itertools.pairwise(cuts)])
                coded = encoder.encode(rows)
                yield pa.RecordBatch.from_arrays([
                    *(part.column(c) for c in ("row", "doc_id", "k")), pa.array(coded, pa.binary()),
                    pa.array([encoder.decode(c) for c in coded], pa.binary())], names=["row", "doc_id", "k", "ids", "decoded"])
    return run


def rank_encode(docs: DataFrame, path: str, pattern: str = public_tokenizers.PATTERN, chunk: int = CHUNK, overlap: int = OVERLAP,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_tokens, ids, decoded) for every row: ids of the whole text by the ranks of a file, and the bytes that they decode to.

    ids are little-endian unsigned 32-bit integers one after the other. ``path`` names a file that every executor has; ``pattern`` must
    not look back, nor further ahead than ``MARGIN`` characters past a piece. Strings of special tokens are plain text. A null text counts as empty (no
    ids, nothing decoded); null and repeated ids and equal rows are passed on as they are; an empty table gives no rows; other columns, whatever their names, are not read.
    """
    if not MARGIN < overlap < chunk:
        raise ValueError("the overlap must lie between the margin and the chunk")
    texts = id_text(docs, id_col, text_col)
    size = F.coalesce(F.char_length("text"), F.lit(0))
    short = texts.where(size <= chunk).mapInArrow(_whole(path, pattern), _CODED)
    with scratch(docs.sparkSession):
        cut = (texts.where(size > chunk).withColumn("row", F.monotonically_increasing_id())
               .mapInArrow(_cut(chunk, overlap), "row long, doc_id long, k int, last boolean, text string"))
        # the written rows fix the row numbers, which a second run of the scan might not repeat
        cut = stash(cut, "chunks")
        parts = stash(cut.repartition("row", "k").mapInArrow(
            _split(pattern, chunk, overlap),
            "row long, doc_id long, k int, last boolean, text string, ends array<int>, head array<int>, tail array<int>"), "pieces")
        after = parts.select("row", (F.col("k") - 1).alias("k"), "head")
        seams = stash(parts.where("not last").select("row", "k", "tail").join(after, ["row", "k"])
                      .select("row", "k", F.array_min(F.array_intersect("tail", "head")).alias("seam")), "seams")
        torn = seams.where("seam is null").select("row").distinct()
        low = seams.select("row", (F.col("k") + 1).alias("k"), F.col("seam").alias("low"))
        high = seams.select("row", "k", (F.col("seam") + chunk).alias("high"))
        sound = (parts.join(torn, "row", "left_anti").join(low, ["row", "k"], "left").join(high, ["row", "k"], "left")
                 .select("row", "doc_id", "k", "text", "ends", F.coalesce("low", F.lit(0)).alias("low"), "high"))
        coded = (sound.mapInArrow(_encode_between(path, pattern), "row long, doc_id long, k int, ids binary, decoded binary")
                 .groupBy("row", "doc_id").agg(*[F.expr(f"listagg({c}, X'') within group (order by k)").alias(c) for c in ("ids", "decoded")])
                 .select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), "ids", "decoded"))
        again = (cut.join(torn, "row", "left_semi").select("row", "doc_id", "k", F.left("text", F.lit(chunk)).alias("text"))
                 .groupBy("row", "doc_id").agg(F.expr("listagg(text, '') within group (order by k)").alias("text"))
                 .select("doc_id", "text").mapInArrow(_whole(path, pattern), _CODED))
        long = stash(coded.unionByName(again), "long", keep=True)
    return short.unionByName(long)
