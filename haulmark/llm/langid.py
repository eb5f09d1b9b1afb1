"""Language identification: multinomial naive Bayes over hashed character n-grams."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.llm import words as W
from haulmark.llm.common import each, ship

ORDERS = (1, 2, 3)
FEATURES = 1 << 16
#: The classifier learns from at most so many whole documents of a language, those of least id hash.
SAMPLE = 3000
#: Ids of the sample are broadcast if there are no more than this.
BROADCAST = 1 << 19
UNKNOWN = "und"
#: Bytes of text whose n-grams are held at once; they take some fifty times as much.
SLICE = 1 << 19

_U = np.uint64


@dataclass(frozen=True)
class Model:
    languages: list[str]
    #: FEATURES by languages, float32: log-probabilities; 256 KB a language
    weights: np.ndarray
    priors: np.ndarray


def ngrams(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each order, the features of the n-grams of all texts and the row of each; none reaches over a text's end."""
    data, offsets = W.buffers(texts)
    points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), "<u4")
    begins = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    row = np.repeat(np.arange(len(texts), dtype=np.int32), np.diff(begins))
    coded = W.mix(points.astype(_U))
    for order in ORDERS:
        n = len(points) - order + 1
        if n <= 0:
            continue
        value = coded[:n].copy()
        for k in range(1, order):
            value *= _U(0x9E3779B97F4A7C15)
            value += coded[k:n + k]
        within = row[:n] == row[order - 1:]
        value = W.mix(value + _U(order))[within]
        yield (value & _U(FEATURES - 1)).astype(np.int32), row[:n][within]


def _count(languages: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(languages) * FEATURES, np.int64)
        place = {name: k for k, name in enumerate(languages)}
        for batch in each(batches):
            for part in W.slices(batch, "text", SLICE):
                of = np.array([place[x] for x in part.column(0).to_pylist()], np.int64)
                for feature, row in ngrams(part.column(1)):
                    total += np.bincount(of[row] * FEATURES + feature, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], names=["slot", "n"])
    return run


def train(docs: DataFrame, learn: Column, lang_col: str = "lang", sample: int = SAMPLE, smoothing: float = 0.5) -> Model:
    """Learn from the rows where ``learn`` holds and language and text are not null.

    Priors come from all of them, n-gram counts from ``sample`` documents of each language. The
    driver gets one row per language, and FEATURES counts per language at most.
    """
    spark = ship(docs.sparkSession)
    rows = docs.where(learn).select(F.col("doc_id").cast("long").alias("doc_id"), F.col(lang_col).alias("lang"), "text").where("lang is not null and text is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((FEATURES, 0), np.float32), np.zeros(0))
    # hashes below a limit that leaves about half more than the sample of each language, then the least of them:
    # one task ranks a bounded number of ids, however many a language has
    places = 1 << 62
    limits = F.create_map(*[F.lit(v) for x in languages for v in (x, min(places, int(places * (1.5 * sample + 100) / sizes[x])))])
    ranked = (rows.select("doc_id", "lang", F.pmod(F.xxhash64("doc_id"), F.lit(places)).alias("place"))
              .where(F.col("place") < F.element_at(limits, F.col("lang"))))
    first = Window.partitionBy("lang").orderBy("place", "doc_id")
    chosen = ranked.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= sample).select("doc_id", "lang")
    if sample * len(languages) <= BROADCAST:
        chosen = F.broadcast(chosen)  # so many rows at most
    counted = (rows.join(chosen, ["doc_id", "lang"], "left_semi").select("lang", "text")
               .mapInArrow(_count(languages), "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toPandas())
    counts = np.zeros(len(languages) * FEATURES)
    counts[counted["slot"].to_numpy(np.int64)] = counted["n"].to_numpy(float)
    counts = counts.reshape(len(languages), FEATURES) + smoothing
    weights = np.log(counts / counts.sum(axis=1, keepdims=True)).T.astype(np.float32)
    n = np.array([sizes[x] for x in languages], float)
    return Model(languages, np.ascontiguousarray(weights), np.log(n / n.sum()))


_SCORED = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])


def score_texts(texts: pa.Array, model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Index of the likeliest language of each text (the first of equal ones), and its probability."""
    total = np.tile(model.priors, (len(texts), 1))
    for feature, row in ngrams(texts):
        if len(row):
            first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
            for k in range(len(model.languages)):  # one language at a time keeps the gathered block small
                total[row[first], k] += np.add.reduceat(model.weights[:, k][feature], first, dtype=np.float64)
    best = total.argmax(axis=1)
    share = np.exp(total - total.max(axis=1, keepdims=True))
    return best, 1.0 / share.sum(axis=1)


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in each(batches):
            for part in W.slices(batch, "text", SLICE):
                known = part.column(2).to_numpy(zero_copy_only=False)
                best, share = score_texts(part.column(1), model)
                names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(best, known)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(names, pa.string()), pa.array(np.where(known, share, 0.0))], schema=_SCORED)
    return run


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score) for every row, from its whole text alone.

    A text that is null or has no letter is ``und`` with score 0, and so is every text if nothing was learned.
    """
    spark = ship(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("known"))
    if not model.languages:
        return rows.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    return rows.mapInArrow(_score(spark.sparkContext.broadcast(model)), "doc_id long, lang_pred string, score double")


def held_out(doc_id: str = "doc_id") -> Column:
    """Documents that are never learned from: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def _accept(shared, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in each(batches):
            # the text is in the row, and isn't sent beside it again
            whole = pa.RecordBatch.from_arrays([batch.column("row"), batch.column("row").field("text"), batch.column("letter")], names=["row", "text", "letter"])
            for part in W.slices(whole, "text", SLICE):
                _, share = score_texts(part.column("text"), model)
                kept = part.filter(pa.array(part.column("letter").to_numpy(zero_copy_only=False) & (share >= least)))
                if kept.num_rows:
                    yield kept.select(["row"])
    return run


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` with a text in a language that the model finds with probability ``least`` or more.

    All columns are kept as they are, whatever their names. Texts that are null or without a letter go; so do all if nothing was learned.
    """
    spark = ship(docs.sparkSession)
    if not model.languages:
        return docs.limit(0)
    packed = docs.select(F.struct("*").alias("row"))
    rows = packed.select("row", F.coalesce(F.col("row.text").rlike(r"\p{L}"), F.lit(False)).alias("letter"))
    return rows.mapInArrow(_accept(spark.sparkContext.broadcast(model), least), packed.schema).select("row.*")
