"""Contiguous shards whose largest is as small as it can be.

Equal texts form an atomic group. Groups are put in the order of a digest of their text,
which spreads sources over shards, and cut into contiguous runs. The smallest capacity
for which a greedy pass (fill a shard until the next group would not fit) needs no more than
the given number of shards is found by binary search, and the cuts are those of that pass.

The pass only asks, for a byte position x, for the last group start at or before x. The
driver holds a summary of the group starts, at most ``SLOTS`` intervals with their first and
last start, and gets a lower and an upper answer from it. Two binary searches with these give a
range that holds the smallest capacity; only intervals that a pass with a capacity in that
range may ask for are split further, until both agree. No single group, task or driver list grows with the
largest group: rows are ordered by (digest, doc_id), so a group may lie in many partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulmark.llm.common import each, id_text, stash

SLOTS = 1 << 14
#: Parts that an interval is split into when the first summary is too coarse.
FINER = 1 << 8

_PLACED = pa.schema([("doc_id", pa.int64()), ("size", pa.int64()), ("text_crc32", pa.int64()), ("digest", pa.string()),
                     ("part", pa.int32()), ("row", pa.int64()), ("before", pa.int64()), ("first", pa.bool_())])


def _place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext
    part, row, before, last = TaskContext.get().partitionId(), 0, 0, None
    for batch in each(batches):
        n = batch.num_rows
        size = batch.column("size").to_numpy()
        digest = batch.column("digest").to_numpy(zero_copy_only=False)
        first = np.ones(n, bool)
        first[1:] = digest[1:] != digest[:-1]
        first[0] = digest[0] != last
        ends = before + np.cumsum(size)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "size", "text_crc32", "digest")),
                                          pa.array(np.full(n, part, np.int32)), pa.array(np.arange(row, row + n)),
                                          pa.array(ends - size), pa.array(first)], schema=_PLACED)
        row, before, last = row + n, int(ends[-1]), digest[-1]


class Starts:
    """What the driver knows of the group starts: sorted intervals, each with its first and last start."""

    def __init__(self, low: np.ndarray, high: np.ndarray, total: int):
        self.low, self.high, self.total = low, high, total

    def at_least(self, x: int) -> int:
        """A start that is no later than the last start at or before x."""
        if x >= self.total:
            return self.total
        k = int(np.searchsorted(self.low, x, "right")) - 1
        return int(self.high[k]) if self.high[k] <= x else int(self.low[k])

    def at_most(self, x: int) -> int:
        """A position that is no earlier than the last start at or before x."""
        if x >= self.total:
            return self.total
        k = int(np.searchsorted(self.low, x, "right")) - 1
        return int(min(self.high[k], x))


def greedy(capacity: int, shards: int, total: int, last_start: Callable[[int], int]) -> list[int]:
    """Ends of the shards of a greedy pass; the last one is ``total`` if they suffice."""
    ends, at = [], 0
    for _ in range(shards):
        end = last_start(at + capacity)
        if end <= at:
            break
        ends.append(end)
        at = end
        if at >= total:
            break
    return ends


def smallest(shards: int, total: int, last_start: Callable[[int], int]) -> int:
    """The smallest capacity for which the greedy pass needs no more than ``shards``."""
    low, high = -(-total // shards), total
    while low < high:
        mid = (low + high) // 2
        ends = greedy(mid, shards, total, last_start)
        if ends and ends[-1] >= total:
            high = mid
        else:
            low = mid + 1
    return low


def minimax_shards(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot) for every row.

    size is the UTF-8 bytes of the text plus one; a null text is sized and grouped as an empty one.
    Shards are numbered from 0 in cut order, slots from 0 within a shard. With fewer groups than
    shards the last shards stay empty. Rows with a null id come first in their group, equal ids
    in any order. An empty table gives none.
    """
    text = F.coalesce("text", F.lit(""))
    rows = id_text(docs, id_col, text_col).select(
        "doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.md5(text.cast("binary")).alias("digest"))
    spark = docs.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    placed = stash(rows.repartitionByRange(parts, "digest", "doc_id").sortWithinPartitions("digest", "doc_id").mapInArrow(
        _place, "doc_id long, size long, text_crc32 long, digest string, part int, row long, before long, first boolean"), "placed")
    # a row per partition, whose number was chosen above
    summary = (placed.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"),
                                          F.min("digest").alias("head"), F.max("digest").alias("tail")).orderBy("part").collect())
    base, row, byte, tail = [], 0, 0, None
    for s in summary:
        base.append((s["part"], row, byte, s["head"] == tail))
        row, byte, tail = row + s["n"], byte + s["bytes"], s["tail"]
    if not base:
        return placed.select("doc_id", "size", "text_crc32", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot"))
    bases = F.broadcast(spark.createDataFrame(base, "part int, row_base long, byte_base long, goes_on boolean"))
    whole = placed.join(bases, "part").withColumn("at", F.col("byte_base") + F.col("before"))
    starts = whole.where("first and not (row = 0 and goes_on)").select("at")
    ends = _cuts(starts, shards, byte)
    shard = sum((F.col("at") >= F.lit(e)).cast("int") for e in ends[:-1]) if len(ends) > 1 else F.lit(0)
    numbered = whole.select("doc_id", "size", "text_crc32", shard.cast("int").alias("shard"), (F.col("row_base") + F.col("row")).alias("g"))
    heads = F.broadcast(numbered.groupBy("shard").agg(F.min("g").alias("head")))  # a row per shard
    return numbered.join(heads, "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("g") - F.col("head")).alias("slot"))


def _cuts(starts: DataFrame, shards: int, total: int) -> list[int]:
    """Ends of the best shards, from group starts that stay in the cluster."""
    width = -(-total // SLOTS)
    found = _summary(starts, width)
    known = Starts(found[0], found[1], total)
    while True:
        low, high = smallest(shards, total, known.at_most), smallest(shards, total, known.at_least)
        first, last = greedy(low, shards, total, known.at_least), greedy(high, shards, total, known.at_most)
        if low == high and greedy(low, shards, total, known.at_most) == greedy(low, shards, total, known.at_least):
            return greedy(low, shards, total, known.at_least)
        # positions that a pass with a capacity from low to high may ask for, cut by cut
        asked = [(a + low, b + high) for a, b in zip([0, *first], [0, *last])]
        open_ = np.zeros(len(known.low), bool)
        for a, b in asked:
            open_ |= (known.low <= b) & (known.high >= a) & (known.low < known.high)
        width = max(1, width // FINER)
        ranges = _merged(known.low[open_], known.high[open_])
        inside = None
        for a, b in ranges:
            here = F.col("at").between(a, b)
            inside = here if inside is None else inside | here
        finer = _summary(starts.where(inside), width)
        low_, high_ = np.concatenate([known.low[~open_], finer[0]]), np.concatenate([known.high[~open_], finer[1]])
        order = np.argsort(low_)
        known = Starts(low_[order], high_[order], total)


def _merged(low: np.ndarray, high: np.ndarray) -> list[tuple[int, int]]:
    """Runs of neighbouring open intervals, at most a few per cut."""
    out: list[tuple[int, int]] = []
    for a, b in zip(low.tolist(), high.tolist()):
        if out and a - out[-1][1] <= max(out[-1][1] - out[-1][0], b - a):
            out[-1] = (out[-1][0], b)
        else:
            out.append((a, b))
    return out


def _summary(starts: DataFrame, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last start of each interval of ``width`` bytes that has any."""
    got = (starts.groupBy(F.floor(F.col("at") / F.lit(width)).alias("slot"))
           .agg(F.min("at").alias("low"), F.max("at").alias("high")).orderBy("low").toPandas())
    return got["low"].to_numpy(np.int64), got["high"].to_numpy(np.int64)
