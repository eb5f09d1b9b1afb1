"""Vectors as short codes: each part of a vector is the number of its nearest entry in that part's codebook.

All arithmetic is on integers. Distances from every part to a few fixed pivots are computed once and
stored with the rows. In each round the distances from the pivots to the entries give, by the triangle
inequality, a lower bound of the distance from a part to each entry. Entries are looked at in the order of these bounds,
with exact integer distances, until the next bound lies above the best distance found.

Rows stay on the executors; the driver holds the codebooks and gets, per round, one sum for each component of each
entry, whatever the number of vectors.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulmark.llm.common import each, scratch, ship, stash

PARTS, ENTRIES, ROUNDS, PIVOTS = 16, 64, 2, 4
#: Components are counted in parts of one.
SCALE = 256
#: Larger components would not fit the sums of squares and make the job fail.
LARGEST = 1 << 20
#: Vectors looked at together.
ROWS = 4096
#: Groups of labels up to which their sums are sent to every executor.
FEW = 1 << 17
#: Pivot distances are stored with 24 bits; bounds give way by so much of the two distances.
_SLACK = 2.0 ** -21

_CODES = pa.schema([("code", pa.string()), ("error", pa.int64())])


class Books:
    """Codebooks of all parts, the pivots, and how far entries are from pivots."""

    def __init__(self, entries: np.ndarray, parts: int, pivots: list[np.ndarray] | None = None, n_pivots: int = PIVOTS):
        self.entries = entries  # a row per entry, with the components of all parts
        self.cuts = np.linspace(0, entries.shape[1], parts + 1).astype(int)
        self.parts = parts
        self.pivots = pivots or [_apart(self.of(k), n_pivots) for k in range(parts)]
        self.far = [_distances(self.of(k), self.pivots[k]) for k in range(parts)]

    def of(self, part: int) -> np.ndarray:
        return self.entries[:, self.cuts[part]:self.cuts[part + 1]]

    def pivot_distances(self, rows: np.ndarray) -> np.ndarray:
        """Distances of all parts of the rows to the pivots, parts one after the other."""
        return np.hstack([_distances(rows[:, self.cuts[k]:self.cuts[k + 1]], self.pivots[k]) for k in range(self.parts)]).astype(np.float32)

    def assign(self, rows: np.ndarray, near: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each part of each row, and the squared distances."""
        codes, errors, at = [], [], 0
        for k in range(self.parts):
            many = len(self.pivots[k])
            c, e = nearest(rows[:, self.cuts[k]:self.cuts[k + 1]], self.of(k), near[:, at:at + many], self.far[k])
            codes.append(c)
            errors.append(e)
            at += many
        return np.stack(codes, axis=1), np.stack(errors, axis=1)

    def sha256(self) -> str:
        """Of all entries' components in decimal, by part, entry and position, joined by commas."""
        text = ",".join(str(v) for k in range(self.parts) for v in self.of(k).ravel().tolist())
        return hashlib.sha256(text.encode()).hexdigest()


def _distances(rows: np.ndarray, points: np.ndarray) -> np.ndarray:
    out = np.empty((len(rows), len(points)))
    for k, p in enumerate(points):
        out[:, k] = np.sqrt(((rows - p) ** 2).sum(axis=1))
    return out


def _apart(entries: np.ndarray, many: int) -> np.ndarray:
    """Pivots: the first entry, then always the one farthest from the pivots so far."""
    chosen = [0]
    gap = ((entries - entries[0]) ** 2).sum(axis=1)
    while len(chosen) < min(many, len(entries)):
        chosen.append(int(gap.argmax()))
        gap = np.minimum(gap, ((entries - entries[chosen[-1]]) ** 2).sum(axis=1))
    return entries[chosen]


def nearest(rows: np.ndarray, entries: np.ndarray, near: np.ndarray, far: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each row, the lowest of equal ones, and the squared distance.

    near: distances of rows to pivots; far: of entries to pivots.
    """
    bound = np.zeros((len(rows), len(entries)))
    for p in range(near.shape[1]):
        x, y = near[:, p, None].astype(np.float64), far[None, :, p]
        np.maximum(bound, np.abs(x - y) - _SLACK * (x + y), out=bound)
    order = np.argsort(bound, axis=1, kind="stable")
    reach = np.take_along_axis(bound, order, axis=1) ** 2
    code = order[:, 0].copy()
    best = ((rows - entries[code]) ** 2).sum(axis=1)
    live = np.arange(len(rows))
    for k in range(1, len(entries)):
        live = live[reach[live, k] <= best[live]]
        if not len(live):
            break
        other = order[live, k]
        gap = ((rows[live] - entries[other]) ** 2).sum(axis=1)
        better = (gap < best[live]) | ((gap == best[live]) & (other < code[live]))
        code[live[better]] = other[better]
        best[live[better]] = gap[better]
    return code, best


def _matrix(column: pa.Array, kind) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def _measured(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            near = shared.value.pivot_distances(_matrix(batch.column("q"), np.int64))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(near) + 1) * near.shape[1], pa.int32()), pa.array(near.ravel()))
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "near"])
    return run


def _assigned(books: Books, batches: Iterator[pa.RecordBatch]):
    for batch in each(batches):
        for a in range(0, batch.num_rows, ROWS):
            part = batch.slice(a, ROWS)
            rows = _matrix(part.column("q"), np.int64)
            yield part, rows, *books.assign(rows, _matrix(part.column("near"), np.float32))


def _summed(shared):
    """(part, entry, at, total): sums of the components of the parts that an entry got; at -1 their number. A few rows per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        books: Books = shared.value
        sums, counts = np.zeros_like(books.entries), np.zeros((books.parts, len(books.entries)), np.int64)
        for _, rows, codes, _ in _assigned(books, batches):
            for k in range(books.parts):
                counts[k] += np.bincount(codes[:, k], minlength=len(books.entries))
                np.add.at(sums[:, books.cuts[k]:books.cuts[k + 1]], codes[:, k], rows[:, books.cuts[k]:books.cuts[k + 1]])
        part, entry = np.nonzero(counts)
        if not len(part):
            return
        yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (part, entry, np.full(len(part), -1))] + [pa.array(counts[part, entry])],
                                         names=["part", "entry", "at", "total"])
        for k in range(books.parts):
            used = np.flatnonzero(counts[k])
            width = books.cuts[k + 1] - books.cuts[k]
            yield pa.RecordBatch.from_arrays([pa.array(x.astype(np.int32)) for x in (
                np.full(len(used) * width, k), np.repeat(used, width), np.tile(np.arange(width), len(used)))]
                + [pa.array(sums[used, books.cuts[k]:books.cuts[k + 1]].ravel())], names=["part", "entry", "at", "total"])
    return run


def _coded(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, codes, errors in _assigned(shared.value, batches):
            text = np.ascontiguousarray(codes.astype(np.uint8)).tobytes().hex()
            width = 2 * codes.shape[1]
            yield pa.RecordBatch.from_arrays([
                part.column("vec_id"), part.column("label"), pa.array([text[a:a + width] for a in range(0, len(text), width)], pa.string()),
                pa.array(errors.sum(axis=1))], names=["vec_id", "label", *_CODES.names])
    return run


def _first(rows: DataFrame, many: int) -> np.ndarray:
    """The vectors of the ``many`` least ids, ascending; of rows with one id the least vector. A pass gets as many rows, with new ids among them."""
    found: dict[int, list[int]] = {}
    least = rows.where("vec_id is not null")
    while len(found) < many:
        after = least.where(F.col("vec_id") > max(found)) if found else least
        got = after.select("vec_id", "q").orderBy("vec_id", "q").limit(many).collect()
        for r in got:
            if len(found) < many:
                found.setdefault(r.vec_id, r.q)
        if len(got) < many:
            break
    return np.array([found[k] for k in sorted(found)], np.int64)


def vector_codes(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, pivots: int = PIVOTS, id_col: str = "vec_id",
                 vector_col: str = "embedding", label_col: str = "label") -> tuple[DataFrame, Books | None]:
    """(vec_id, label, code, error, label_error) for every vector, and the codebooks.

    Vectors that are null, or that hold null, NaN or infinite components, are left out. Components become floor(SCALE * x). Vectors are
    cut into ``parts`` consecutive parts as equal as can be; a codebook starts as the parts of the vectors of the
    least ``entries`` ids (fewer if there are fewer), is learned in ``rounds`` rounds over all vectors, and codes every vector. code has
    two hex digits per part, error is the sum of squared distances, label_error its sum over equal labels, nulls together. Ties go to the lower entry; an entry that no
    part chose stays. Repeated rows count as often as they occur; of several vectors with one id the least starts a codebook, and a null id starts
    none. The length of vectors is that of the least id's; vectors of another length, empty ones included, have a null code and error. Components
    of ``LARGEST`` or more make the job fail. Without a vector that has an id there are no codebooks (None) and all codes
    are null; an empty table gives no rows. Other columns, whatever their names, are not read.
    """
    spark = ship(vectors.sparkSession)
    if entries > 256:
        raise ValueError("a code has two hex digits per part, so 256 entries at most")
    x = F.col("vector")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    cell = lambda v: F.when(F.abs(v) < LARGEST, F.floor(v * SCALE)).otherwise(F.raise_error(F.lit("a component is too large")).cast("long"))
    rows = (vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
                           F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
            .where(x.isNotNull() & finite).select("vec_id", "label", F.transform(x, cell).cast("array<int>").alias("q")))
    with scratch(spark):
        head = rows.where("vec_id is not null and size(q) > 0").select("vec_id", F.size("q").alias("n")).orderBy("vec_id", "n").limit(1).collect()
        width = head[0].n if head else 0
        fits = rows.where(F.size("q") == width) if head else rows.limit(0)
        odd = rows.where(F.size("q") != width) if head else rows
        coded = odd.select("vec_id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
        books = None
        if head:
            books = Books(_first(fits, entries), parts, n_pivots=pivots)
            label = fits.schema["label"].dataType.simpleString()
            work = stash(fits.mapInArrow(_measured(spark.sparkContext.broadcast(books)), f"vec_id long, label {label}, q array<int>, near array<float>"), "vectors")
            for _ in range(rounds):
                books = _learned(work, books)
            coded = work.mapInArrow(_coded(spark.sparkContext.broadcast(books)), f"vec_id long, label {label}, code string, error long").unionByName(coded)
        coded = stash(coded, "codes", keep=True)
        sums = stash(coded.groupBy("label").agg(F.sum("error").alias("label_error")), "labels", keep=True)
    if sums.count() <= FEW:
        sums = F.broadcast(sums)
    sums = sums.withColumnRenamed("label", "of_label")
    out = coded.join(sums, coded["label"].eqNullSafe(F.col("of_label")), "left").select("vec_id", "label", "code", "error", "label_error")
    return out, books


def _learned(work: DataFrame, books: Books) -> Books:
    """Codebooks whose entries are the floored means of the parts that chose them."""
    shared = work.sparkSession.sparkContext.broadcast(books)
    sums = (work.mapInArrow(_summed(shared), "part int, entry int, at int, total long")
            .groupBy("part", "entry", "at").agg(F.sum("total").alias("total")).toPandas())
    new = books.entries.copy()
    count = {(r.part, r.entry): r.total for r in sums[sums["at"] < 0].itertuples()}
    for r in sums[sums["at"] >= 0].itertuples():
        new[r.entry, books.cuts[r.part] + r.at] = r.total // count[r.part, r.entry]
    return Books(new, books.parts, books.pivots)
