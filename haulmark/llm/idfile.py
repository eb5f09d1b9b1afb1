"""Token ids on disk: blocks of ids, shuffled into byte or bit planes and compressed.

A data set is a folder with two Parquet tables, so that Spark's commit protocol makes
writes atomic and repeatable on any store:

``chunks``  one row per chunk: shard, chunk, before (ids before it in the shard), n_docs, n_ids, crc32
            and ``payload``, the binary chunk
``index``   one row per chunk: shard, chunk, n_docs, n_ids, n_bytes, start (ids of all chunks before)

Shards hold ascending ranges of documents, and chunks go up within a shard. A chunk holds
whole documents. Its payload, all numbers little-endian:

    4 bytes   "BPL1"
    1 byte    planes: 0 bytes, 1 bits
    1 byte    bytes of an id (4)
    2 bytes   zero
    4 x 4     ids in a block, blocks, documents, planes of a block
    8 x docs  ids of each document (unsigned)
    8 x docs  doc_id (signed)
    4 x b x p block index: compressed bytes of each plane of each block, plane by plane within a block
    ...       the planes, each a zstandard frame

Plane k of a block holds byte (or bit) k of all its ids, so the upper planes, which hardly
vary, take almost nothing. All blocks have the same number of ids but the last.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from haulmark.llm import words as W
from haulmark.llm.common import each, id_text
from haulmark.llm.encoders import library_encoder

BLOCK = 1 << 14
#: A chunk ends with the document that brings it to so many ids.
CHUNK = 1 << 18

_HEAD = struct.Struct("<4sBBHIIII")
_CHUNKS = pa.schema([("shard", pa.int32()), ("chunk", pa.int32()), ("before", pa.int64()), ("n_docs", pa.int64()), ("n_ids", pa.int64()),
                     ("crc32", pa.int64()), ("payload", pa.binary())])


def planes_of(ids: np.ndarray, bits: bool) -> list[bytes]:
    """The byte planes (4) or bit planes (32) of a block of ids."""
    data = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4)
    if not bits:
        return [data[:, k].tobytes() for k in range(4)]
    unpacked = np.unpackbits(data, axis=1, bitorder="little")
    return [np.packbits(unpacked[:, k], bitorder="little").tobytes() for k in range(32)]


def ids_of(planes: list[bytes], n: int, bits: bool) -> np.ndarray:
    """The ids of the planes of one block."""
    if not bits:
        return np.stack([np.frombuffer(p, np.uint8) for p in planes], axis=1).copy().view("<u4").ravel()
    unpacked = np.stack([np.unpackbits(np.frombuffer(p, np.uint8), bitorder="little")[:n] for p in planes], axis=1)
    return np.packbits(unpacked, axis=1, bitorder="little").copy().view("<u4").ravel()


def pack(ids: np.ndarray, doc_ids: np.ndarray, counts: np.ndarray, block: int = BLOCK, bits: bool = False, level: int = 3) -> bytes:
    """A chunk of whole documents."""
    press = zstandard.ZstdCompressor(level=level)
    frames = [[press.compress(p) for p in planes_of(ids[a:a + block], bits)] for a in range(0, len(ids), block)]
    planes = 32 if bits else 4
    head = _HEAD.pack(b"BPL1", int(bits), 4, 0, block, len(frames), len(doc_ids), planes)
    index = np.array([len(p) for f in frames for p in f], "<u4")
    return b"".join([head, counts.astype("<u8").tobytes(), doc_ids.astype("<i8").tobytes(), index.tobytes(),
                     *(p for f in frames for p in f)])


def unpack(payload: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """ids, doc_ids and ids per document of a chunk."""
    magic, bits, width, _, block, blocks, docs, planes = _HEAD.unpack_from(payload)
    if magic != b"BPL1" or width != 4:
        raise ValueError("not a chunk of this format")
    at = _HEAD.size
    counts = np.frombuffer(payload, "<u8", docs, at).astype(np.int64)
    doc_ids = np.frombuffer(payload, "<i8", docs, at + 8 * docs)
    at += 16 * docs
    index = np.frombuffer(payload, "<u4", blocks * planes, at)
    ends = at + 4 * len(index) + np.cumsum(index, dtype=np.int64)
    left, press, out = int(counts.sum()), zstandard.ZstdDecompressor(), []
    for b in range(blocks):
        n = min(block, left)
        cuts = [(int(ends[k] - index[k]), int(ends[k])) for k in range(b * planes, (b + 1) * planes)]
        out.append(ids_of([press.decompress(payload[x:y]) for x, y in cuts], n, bool(bits)))
        left -= n
    return (np.concatenate(out) if out else np.zeros(0, "<u4")), doc_ids, counts


def _write(path: str, end_id: int, chunk: int, block: int, bits: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        shard, number, before = TaskContext.get().partitionId(), 0, 0
        encoder = library_encoder(path)
        held: list[tuple[np.ndarray, int]] = []
        size = 0

        def row() -> pa.RecordBatch:
            ids = np.concatenate([i for i, _ in held])
            payload = pack(ids, np.array([d for _, d in held]), np.array([len(i) for i, _ in held]), block, bits)
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(
                (shard, number, before, len(held), len(ids), zlib.crc32(payload), payload), _CHUNKS)], schema=_CHUNKS)

        for batch in each(batches):
            for part in W.slices(batch, "text"):
                ids, offsets = encoder.encode([t or "" for t in part.column(1).to_pylist()])
                ids = np.insert(ids, offsets[1:], np.uint32(end_id))
                offsets = offsets + np.arange(len(offsets))
                for k, doc in enumerate(part.column(0).to_pylist()):
                    held.append((ids[offsets[k]:offsets[k + 1]], doc))
                    size += len(held[-1][0])
                    if size >= chunk:
                        yield row()
                        held, size, number, before = [], 0, number + 1, before + size
        if held:
            yield row()
    return run


def write_ids(docs: DataFrame, folder: str, tokenizer: str, end_id: int, shards: int | None = None, chunk: int = CHUNK,
              block: int = BLOCK, bits: bool = False, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encode whole texts, append ``end_id`` to each, and write them in ascending id order.

    A null text has the end id only. Rows with a null id are not documents a reader could
    ask for, and fail the job. Rows with equal ids stand side by side, in the order of a
    hash of their texts. An empty table gives a data set without chunks. Each task holds one chunk, or one
    document if that is longer.
    """
    texts = id_text(docs, id_col, text_col).select(
        F.coalesce("doc_id", F.raise_error(F.lit("a document without an id"))).cast("long").alias("doc_id"), "text",
        F.xxhash64("text").alias("tie"))
    spark = docs.sparkSession
    shards = shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    (texts.repartitionByRange(shards, "doc_id", "tie").sortWithinPartitions("doc_id", "tie")
     .select("doc_id", "text")
     .mapInArrow(_write(tokenizer, end_id, chunk, block, bits),
                 "shard int, chunk int, before long, n_docs long, n_ids long, crc32 long, payload binary")
     .write.option("compression", "none").option("parquet.block.size", 16 << 20).parquet(f"{folder}/chunks"))
    chunks = spark.read.parquet(f"{folder}/chunks")
    # one row per shard, so this window without partitions is as small as the list of shards
    totals = chunks.groupBy("shard").agg(F.sum("n_ids").alias("ids"))
    base = totals.select("shard", (F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")).alias("base"))
    (chunks.select("shard", "chunk", "before", "n_docs", "n_ids", F.octet_length("payload").cast("long").alias("n_bytes"))
     .join(base, "shard").select("shard", "chunk", "n_docs", "n_ids", "n_bytes", (F.col("base") + F.col("before")).alias("start"))
     .write.parquet(f"{folder}/index"))


def _read(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for k in range(batch.num_rows):
                payload = batch.column("payload")[k].as_py()
                if zlib.crc32(payload) != batch.column("crc32")[k].as_py():
                    raise ValueError("a chunk does not match its checksum")
                ids, doc_ids, counts = unpack(payload)
                ends = np.cumsum(counts)
                starts = ends - counts + batch.column("start")[k].as_py()
                if digest:
                    last = pa.array([zlib.crc32(ids[e - n:e].tobytes()) for e, n in zip(ends, counts)], pa.int64())
                else:
                    last = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(ids.astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(doc_ids.astype(np.int64)), pa.array(starts), pa.array(counts), last],
                                                 names=["doc_id", "start", "n_tokens", "ids_crc32" if digest else "ids"])
    return run


def read_ids(spark: SparkSession, folder: str, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document of a data set; with ``digest`` ids_crc32 in place of ids.

    start counts the ids of all documents before. Chunks are read by themselves, in any order.
    """
    chunks = spark.read.parquet(f"{folder}/chunks").select("shard", "before", "crc32", "payload")
    # a row per shard, whose number the writer was given
    shards = spark.read.parquet(f"{folder}/index").where("chunk = 0").select("shard", F.col("start").alias("base"))
    last = "ids_crc32 long" if digest else "ids array<long>"
    return (chunks.join(F.broadcast(shards), "shard").select("crc32", "payload", (F.col("base") + F.col("before")).alias("start"))
            .mapInArrow(_read(digest), f"doc_id long, start long, n_tokens long, {last}"))
