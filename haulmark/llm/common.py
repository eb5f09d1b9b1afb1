"""Pieces the operators share: staging in the shared folder, Arrow batches, shipping the code."""

from __future__ import annotations

import ctypes
import gc
import os
import pathlib
import tempfile
import zipfile
from collections.abc import Iterable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulmark.session import scratch_path

_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Send this package to the Python workers, once per application."""
    app = spark.sparkContext.applicationId
    if app not in _shipped:
        package = pathlib.Path(__file__).resolve().parents[1]
        target = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="haulmark-code-")), "haulmark_code.zip")
        with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as out:
            for file in sorted(package.rglob("*.py")):
                out.write(file, file.relative_to(package.parent))
        spark.sparkContext.addPyFile(target)
        _shipped.add(app)
    return spark


_scopes: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is stashed inside goes at the end, but for what is kept."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)


@contextmanager
def batches_of(spark: SparkSession, rows: int) -> Iterator[None]:
    """What runs inside hands its Python workers so many rows at once at most; afterwards the session is as it was."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    old = spark.conf.get(name, None)
    spark.conf.set(name, rows)
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, old)


def stash(df: DataFrame, label: str, keep: bool = False) -> DataFrame:
    """The rows written to the shared folder and read back: a cut of the lineage that survives lost executors.

    Inside ``scratch`` the rows go with it, or, with ``keep``, with the scratch around it if there is
    one. Nothing reads the shuffles behind the rows any more, so the driver drops what refers to
    them; Spark's cleaner then deletes their files instead of keeping them to the end of the job.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    owners = _scopes[:-1] if keep else _scopes
    if owners:
        owners[-1].append(path)
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.stashed = path
    return out


def discard(df: DataFrame) -> None:
    """Delete stashed rows that nothing will read any more."""
    _delete(df.sparkSession, df.stashed)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (long) and the text of the rows; other columns, whatever their names, are left out.

    Every operator starts here, so the code its Python workers need is sent along.
    """
    ship(docs.sparkSession)
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


#: Slots of the filter of ``likely``: at most 266,306 words of flags, whatever the number of ids. A prime, so runs and steps of ids spread.
SLOTS = 16_777_213


def likely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """Of rows (doc_id, text) all whose id is in ``ids``, and few others, so that a join after it moves few texts.

    The flags of the filter have a fixed size, so they are broadcast, and no text leaves the JVM. With very many ids most flags are set;
    then it lets more rows through, and the join does the rest.
    """
    return _flagged(rows, ids, "inner").where("(shiftright(flags, cast(slot % 63 as int)) & 1) = 1").select(*rows.columns)


def unlikely(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows that ``likely`` leaves out, but for those without an id."""
    return _flagged(rows, ids, "left").where("flags is null or (shiftright(flags, cast(slot % 63 as int)) & 1) = 0").select(*rows.columns)


def _flagged(rows: DataFrame, ids: DataFrame, how: str) -> DataFrame:
    slot = F.pmod(F.col("doc_id"), F.lit(SLOTS))
    words = (ids.select(slot.alias("slot")).groupBy((F.col("slot") / 63).cast("long").alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(slot % 63 as int))")).alias("flags")))
    return (rows.where("doc_id is not null").withColumn("slot", slot).withColumn("word", (F.col("slot") / 63).cast("long"))
            .join(F.broadcast(words), "word", how))


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def give_back() -> None:
    """Memory that this worker holds for nothing any more goes back to the system; Spark keeps workers for later tasks, beside others."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def each(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    give_back()
    yield from (b for b in batches if b.num_rows)
    give_back()
