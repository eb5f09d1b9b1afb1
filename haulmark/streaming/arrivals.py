"""Incremental ingest of a folder of exports: router, headers file by file and write modes, batch by batch.

The stream's checkpoint remembers which files were seen. A batch is a list of files, and each list
goes through the same run as a whole folder would. A batch that is replayed after a failure changes nothing that it wrote
before: merges and duplicate checks repeat themselves, and tables without a duplicate rule keep a partition
per batch, which the replay writes anew.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from haulmark.plans.jobs import ingest_directory

__all__ = ["ingest_arrivals"]


def ingest_arrivals(spark: SparkSession, source: str, database: str, checkpoint: str, now: dt.datetime, name: str = "exports",
                    files_per_batch: int = 500, multi_line: bool = True, options: dict[str, dict] | None = None) -> int:
    """Ingest the files of ``source`` that no earlier run has seen; the number of files.

    Batches go by the time files were written, and inside a batch files apply in path order. ``checkpoint`` and ``name`` must be the same
    for every run. ``files_per_batch`` bounds the list that the driver gets; contents are read by the run, not by the stream.
    """
    seen = 0

    def store(batch: DataFrame, batch_id: int) -> None:
        nonlocal seen
        files = sorted(r.path for r in batch.collect())
        if files:
            ingest_directory(spark, files, database, now, multi_line, options, run=f"{name} batch {batch_id}")
        seen += len(files)

    query = (
        spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary").option("recursiveFileLookup", True).option("maxFilesPerTrigger", files_per_batch)
        .load(source).select("path").writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    return seen
