"""Writers: typed append, window overwrite, staged replacement, inventory and run report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from haulmark.operators.columns import col
from haulmark.session import scratch_path

__all__ = ["conform", "append_rows", "write_ordered", "order_breaks", "stage_rows",
           "table_inventory", "file_inventory", "ingest_report"]


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns, in order and typed; absent ones are null."""
    unknown = [c for c in df.columns if c not in schema.names]
    if unknown:
        raise ValueError(f"columns not in the table: {', '.join(unknown)}")
    return df.select(*[
        (col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in schema.fields])


def append_rows(df: DataFrame, schema: T.StructType, path: str,
                partition_by: str | None = None) -> None:
    writer = conform(df, schema).write.mode("append")
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.parquet(path)


def write_ordered(df: DataFrame, path: str, keys: Sequence[str | Column]) -> None:
    """Rows in the order of ``keys``: file names ascend with it, and so do the rows of a file. Nulls come first."""
    order = [col(k).asc_nulls_first() if isinstance(k, str) else k for k in keys]
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def order_breaks(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """Files (file_name) whose rows are out of order, or that begin before the file ahead of them ends; none if all is in order.

    Rows are compared inside their file only; of a file just the ends meet those of others.
    """
    rows = spark.read.parquet(path).select(
        F.col("_metadata.file_name").alias("file_name"), F.col("_metadata.row_index").alias("row"), F.struct(*[col(k) for k in keys]).alias("key"))
    inside = Window.partitionBy("file_name").orderBy("row")
    files = rows.withColumn("wrong", F.lag("key").over(inside) > F.col("key")).groupBy("file_name").agg(
        F.coalesce(F.bool_or("wrong"), F.lit(False)).alias("wrong"), F.min_by("key", "row").alias("first"), F.max_by("key", "row").alias("last"))
    ahead = F.lag("last").over(Window.orderBy("file_name"))  # a row per file
    return files.withColumn("early", F.coalesce(ahead > F.col("first"), F.lit(False))).where("wrong or early").select("file_name", "wrong", "early")


def stage_rows(df: DataFrame, label: str) -> DataFrame:
    """The rows written once to the shared folder, for several readers."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table_inventory(tables: Mapping[str, DataFrame], schema_name: str) -> DataFrame:
    """Row count per table. Counts need no columns, so Parquet answers from footers."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema_name).alias("schema_name"), F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def file_inventory(tables: Mapping[str, DataFrame], schema_name: str) -> DataFrame:
    """``table_inventory`` with files, bytes and the times (UTC) at which the oldest and the newest file were written.

    A table's files are found from the rows' metadata, so an empty table has none and null times.
    """
    found = []
    for name, df in tables.items():
        meta = F.col("_metadata")
        files = df.groupBy(meta["file_path"].alias("file"), meta["file_size"].alias("size"), meta["file_modification_time"].alias("at")).agg(
            F.count(F.lit(1)).alias("n"))
        found.append(files.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"), F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes"),
            F.min("at").alias("created_utc"), F.max("at").alias("modified_utc")).select(F.lit(schema_name).alias("schema_name"), F.lit(name).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, found)


def ingest_report(rows: DataFrame, file: str = "file_name", table: str = "table") -> DataFrame:
    """Rows taken from each file into each table."""
    return rows.groupBy(file, table).agg(F.count(F.lit(1)).alias("rows"))
