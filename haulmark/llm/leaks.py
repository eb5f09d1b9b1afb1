"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment of words.

All word n-grams of an item are its seeds, found in the documents by joining on their hashes. A seed of an
item that hits a document, with those on diagonals near it, marks a passage. Passages that hold too few of the
item's words to reach the score are left out, the others are aligned with the whole item.

The benchmark is a query set against all rows: it is read in blocks of ``ITEM_WORDS`` words at most (or one
longer item), each broadcast in turn, so what a task holds is bounded however large the benchmark is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulmark.llm import words as W
from haulmark.llm.common import each, id_text, ship

GRAM = 3
#: Hits of seeds that are looked at together, but for those of one document.
HITS = 1 << 21
ITEM_WORDS = 1 << 20
MATCH, MISMATCH, GAP = 2, -1, -1
#: A pair is a leak if the alignment has this share of the score of a full copy of the item.
SCORE = 0.5

_U = np.uint64
_LEAKS = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64()),
                    ("first_word", pa.int64()), ("last_word", pa.int64()), ("seeds", pa.int32())])


@dataclass
class Items:
    """A block of the benchmark: ids, word hashes, and each distinct n-gram with its places."""

    ids: list[int]
    words: list[np.ndarray]
    grams: np.ndarray          # sorted distinct hashes
    first: np.ndarray          # places of gram k are first[k]:first[k + 1]
    item: np.ndarray
    at: np.ndarray
    quick: np.ndarray          # 2^20 flags on the low bits of the hashes


def _gram_of(words: np.ndarray) -> np.ndarray:
    return W.shingles(words, GRAM)


def items_of(ids: list[int], words: list[np.ndarray]) -> Items:
    gram, item, at = [], [], []
    for k, w in enumerate(words):
        g = _gram_of(w)
        gram.append(g)
        item.append(np.full(len(g), k, np.int64))
        at.append(np.arange(len(g)))
    flat = np.concatenate(gram) if gram else np.zeros(0, _U)
    order = np.argsort(flat, kind="stable")
    grams, first = np.unique(flat[order], return_index=True)
    quick = np.zeros(1 << 20, bool)
    quick[(grams & _U((1 << 20) - 1)).astype(np.int64)] = True
    join = lambda x: np.concatenate(x)[order].astype(np.int64) if x else np.zeros(0, np.int64)
    return Items(ids, words, grams, np.append(first, len(flat)), join(item), join(at), quick)


def _hits(texts: pa.Array, items: Items) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of a slice, first word of each row, and of each hit the place (in the slice) and the gram."""
    words, first = W.rows_hashes(texts)
    n = len(words) - GRAM + 1
    # short texts and items are one gram of all their words
    short = np.flatnonzero((np.diff(first) > 0) & (np.diff(first) < GRAM))
    gram = _gram_of(words) if n > 0 else np.zeros(0, _U)
    place = np.arange(len(gram))
    if n > 0:
        ends = np.repeat(first[1:], np.diff(first))[:n]
        place = place[place + GRAM <= ends]
        gram = gram[place]
    if len(short):
        place = np.concatenate([place, first[short]])
        gram = np.concatenate([gram, [_gram_of(words[first[k]:first[k + 1]])[0] for k in short]]).astype(_U)
    if not len(items.grams):
        none = np.zeros(0, np.int64)
        return words, first, none, none
    maybe = items.quick[(gram & _U((1 << 20) - 1)).astype(np.int64)]
    place, gram = place[maybe], gram[maybe]
    at = np.minimum(np.searchsorted(items.grams, gram), len(items.grams) - 1)
    same = items.grams[at] == gram
    return words, first, place[same], at[same]


def align(item: np.ndarray, passage: np.ndarray) -> tuple[int, int, int]:
    """Best local alignment of two word sequences: its score, and first and last word of the passage in it.

    Smith-Waterman with linear gaps, a row of the item at a time. A gap inside a row is a running
    maximum; starts are carried beside the scores.
    """
    n = len(passage)
    place = np.arange(n + 1)
    score, start = np.zeros(n + 1, np.int64), place.copy()
    best, span = 0, (0, -1)
    for w in item:
        step = np.where(passage == w, MATCH, MISMATCH)
        diagonal, above = score[:-1] + step, score[1:] + GAP
        now, begin = np.zeros(n + 1, np.int64), place.copy()
        now[1:] = np.maximum(diagonal, above)
        begin[1:] = np.where(diagonal >= above, start[:-1], start[1:])
        fresh = now <= 0
        now[fresh], begin[fresh] = 0, place[fresh]
        raised = now - GAP * place
        top = np.maximum.accumulate(raised)
        source = np.maximum.accumulate(np.where(raised == top, place, 0))
        score, start = top + GAP * place, begin[source]
        k = int(score.argmax())
        if score[k] > best:
            best, span = int(score[k]), (int(start[k]), k - 1)
    return best, span[0], span[1]


def passages(words: np.ndarray, first: np.ndarray, place: np.ndarray, gram: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item, first word, end word, seeds) around seeds of one item that lie on near diagonals."""
    order = np.argsort(place, kind="stable")
    place, gram = place[order], gram[order]
    total = np.cumsum(items.first[gram + 1] - items.first[gram])
    ends = np.searchsorted(place, first[1:])  # hits before the end of each row
    a = 0
    while a < len(place):
        b = int(np.searchsorted(total, (total[a - 1] if a else 0) + HITS, "right"))
        b = int(ends[max(np.searchsorted(ends, b, "right") - 1, np.searchsorted(ends, a, "right"))])
        yield from _near(first, place[a:b], gram[a:b], items)
        a = b


def _near(first: np.ndarray, place: np.ndarray, gram: np.ndarray, items: Items) -> Iterator[tuple[int, int, int, int, int]]:
    size = items.first[gram + 1] - items.first[gram]
    source = np.repeat(np.arange(len(place)), size)
    posting = np.repeat(items.first[gram] - np.concatenate([[0], np.cumsum(size)[:-1]]), size) + np.arange(len(source))
    row = np.searchsorted(first, place, "right")[source] - 1
    item, spot = items.item[posting], place[source]
    diagonal = spot - items.at[posting]
    order = np.lexsort((diagonal, item, row))
    row, item, diagonal, spot = row[order], item[order], diagonal[order], spot[order]
    length = np.array([len(w) for w in items.words])
    slack = np.maximum(8, length // 2)
    cut = np.flatnonzero((row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > slack[item[1:]])) + 1
    for a, b in zip(np.append(0, cut).tolist(), np.append(cut, len(row)).tolist()):
        k, r = int(item[a]), int(row[a])
        low = max(int(diagonal[a]) - int(slack[k]), int(first[r]))
        yield r, k, low, min(int(diagonal[b - 1]) + int(length[k] + slack[k]), int(first[r + 1])), len(np.unique(spot[a:b])) if b > a + 1 else 1


def _leaks(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in each(batches):
            for part in W.slices(batch, "text"):
                words, first, place, gram = _hits(part.column(1), items)
                ids = part.column(0)
                found: dict[tuple[int, int], tuple] = {}
                for r, k, low, high, seeds in passages(words, first, place, gram, items):
                    # no alignment matches more words of the item than occur in the passage
                    if np.isin(items.words[k], words[low:high]).sum() < least * len(items.words[k]):
                        continue
                    score, begin, end = align(items.words[k], words[low:high])
                    share = score / (MATCH * len(items.words[k]))
                    if share >= least and share > found.get((r, k), (0.0,))[0]:
                        found[(r, k)] = (share, low + begin - int(first[r]), low + end - int(first[r]), seeds)
                if found:
                    rows = [(ids[r].as_py(), items.ids[k], *v) for (r, k), v in sorted(found.items())]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _LEAKS)], schema=_LEAKS)
    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """The items in blocks of a bounded number of words, in the order of their ids; items without words or id are left out."""
    rows = benchmark.select(F.col(item_col).cast("long").alias("i"), F.col(text_col).cast("string").alias("t")).where("i is not null and t is not null")
    ids, words, size = [], [], 0
    for r in rows.distinct().orderBy("i", "t").toLocalIterator():
        w, _ = W.rows_hashes(pa.array([r["t"]]))
        if not len(w):
            continue
        if ids and size + len(w) > ITEM_WORDS:
            yield ids, words
            ids, words, size = [], [], 0
        ids.append(r["i"])
        words.append(w)
        size += len(w)
    if ids:
        yield ids, words


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = SCORE, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word, seeds): benchmark items that documents hold copies of.

    score is the share (0 to 1) of a full copy's alignment score, of the best passage; words of the document
    are counted from 0. One row per pair of a document and an item with a score of ``least`` or more.
    Null and empty texts hold nothing; items without id or words are left out; rows with equal ids
    each give their pairs; an empty table on either side gives none.
    """
    spark = ship(docs.sparkSession)
    texts = id_text(docs, id_col, text_col)
    out = spark.createDataFrame([], "doc_id long, item_id long, score double, first_word long, last_word long, seeds int")
    for ids, words in _blocks(benchmark, item_col, item_text_col):
        seeds = items_of(ids, words)
        out = out.unionByName(texts.mapInArrow(_leaks(spark.sparkContext.broadcast(seeds), least),
                                               "doc_id long, item_id long, score double, first_word long, last_word long, seeds int"))
    return out


def without_leaks(docs: DataFrame, leaks: DataFrame) -> DataFrame:
    """The documents that hold no copy of a benchmark item."""
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti")
