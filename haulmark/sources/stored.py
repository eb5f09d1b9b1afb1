"""Stored tables: versions that readers can finish, partitions that changes are confined to.

A stored table is a Parquet table of the session's catalog. Files are never changed or deleted by a
write: new ones go to a fresh folder, and the catalog is then pointed at them, table by table or, for a table with
partitions, partition by partition. A frame that was built before keeps reading the old files.
Those are listed in the table's properties with the time they were retired, and go once they have been
retired for ``RETENTION``; folders that a failed run left behind go by their age.

A partitioned table has a text column ``part`` (see ``TableSpec.part``), a function of the columns that identify a row. So a row
and whatever replaces it are in one partition, and a change reads and writes only the partitions its
rows are in, however long the history is.
"""

from __future__ import annotations

import datetime as dt
import re
import uuid
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulmark.operators.columns import col

__all__ = ["PART", "RETENTION", "replace_table", "write_partitions", "append_partitions", "change_partitions",
           "touched_parts", "stored_parts", "parts_of", "days_between", "table_or_empty", "purge_versions", "clustered"]

#: The column that partitions a stored table.
PART = "part"
#: How long files that nothing points at are kept for readers that began before.
RETENTION = dt.timedelta(days=2)

_RETIRED = "haulmark.retired."


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _path(spark: SparkSession, path: str):
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _same(path: str) -> str:
    """A path as it is compared: without the spellings of a local scheme."""
    return path.removeprefix("file://").removeprefix("file:").rstrip("/")


def _home(spark: SparkSession, name: str) -> tuple[str, str]:
    """The folder of a table's database, and the table's bare name."""
    database, _, table = name.rpartition(".")
    home = spark.catalog.getDatabase(database or spark.catalog.currentDatabase()).locationUri
    return home.rstrip("/"), table


def _fresh(spark: SparkSession, name: str) -> str:
    home, table = _home(spark, name)
    return f"{home}/{table}_v{uuid.uuid4().hex}"


def _detail(spark: SparkSession, name: str, partition: str = "") -> str:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}{partition}").collect()
    return next(r.data_type for r in rows if r.col_name == "Location")


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}


def _retire(spark: SparkSession, name: str, paths: Iterable[str]) -> None:
    now = dt.datetime.now(dt.timezone.utc).isoformat()
    listed = ", ".join(f"{_quoted(_RETIRED + p)} = {_quoted(now)}" for p in paths)
    if listed:
        spark.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ({listed})")


def purge_versions(spark: SparkSession, name: str, retention: dt.timedelta = RETENTION) -> int:
    """Delete what was retired longer ago than ``retention``, and folders as old that no run has put to use; their number."""
    now = dt.datetime.now(dt.timezone.utc)
    retired = {k.removeprefix(_RETIRED): dt.datetime.fromisoformat(v) for k, v in _properties(spark, name).items() if k.startswith(_RETIRED)}
    gone = [p for p, since in retired.items() if now - since >= retention]
    for p in gone:
        place, files = _path(spark, p)
        files.delete(place, True)
    if gone:
        spark.sql(f"ALTER TABLE {name} UNSET TBLPROPERTIES IF EXISTS ({', '.join(_quoted(_RETIRED + p) for p in gone)})")
    kept = {_same(p) for p in [*(set(retired) - set(gone)), _detail(spark, name), *_locations(spark, name).values()]}
    home, table = _home(spark, name)
    place, files = _path(spark, home)
    lost = 0
    for found in files.listStatus(place) if files.exists(place) else []:
        at = found.getPath().toString()
        inside = any(k == _same(at) or k.startswith(_same(at) + "/") for k in kept)
        old = now - dt.datetime.fromtimestamp(found.getModificationTime() / 1000, dt.timezone.utc) >= retention
        own = re.fullmatch(re.escape(table) + "_v(0|[0-9a-f]{32})", found.getPath().getName())
        if own and not inside and old:
            files.delete(found.getPath(), True)
            lost += 1
    return len(gone) + lost


def table_or_empty(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """The columns of ``schema`` of a stored table; no rows if it doesn't exist yet."""
    if spark.catalog.tableExists(name):
        return spark.table(name).select(*[col(c) for c in schema.names])
    return spark.createDataFrame([], schema)


def replace_table(spark: SparkSession, df: DataFrame, name: str, retention: dt.timedelta = RETENTION,
                  cluster: Sequence[str] = ()) -> None:
    """Write ``df`` as a new version of the whole table ``name`` and point the name at it.

    ``df`` may read the table it replaces. The name always has a complete version, and the old one
    stays for ``retention``. ``cluster`` names the columns that lookups use.
    """
    path = _fresh(spark, name)
    (clustered(df, cluster) if cluster else df).write.parquet(path)
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=path, source="parquet")
        return
    old = _detail(spark, name)
    _retire(spark, name, [old])
    spark.sql(f"ALTER TABLE {name} SET LOCATION {_quoted(path)}")
    spark.catalog.refreshTable(name)
    purge_versions(spark, name, retention)


# --- partitions ------------------------------------------------------------------

def stored_parts(spark: SparkSession, name: str) -> set[str]:
    """Partitions that the table has; the catalog lists them."""
    return set(_locations(spark, name))


def _locations(spark: SparkSession, name: str) -> dict[str, str]:
    """Folder of each partition, from the catalog alone."""
    if not spark.catalog.tableExists(name):
        return {}
    catalog = spark._jsparkSession.sessionState().catalog()
    ident = spark._jsparkSession.sessionState().sqlParser().parseTableIdentifier(name)
    if not catalog.getTableMetadata(ident).partitionColumnNames().mkString(","):
        return {}
    none = getattr(getattr(spark.sparkContext._jvm.scala, "None$"), "MODULE$")
    found = catalog.listPartitions(ident, none)
    return {p.spec().apply(PART): p.location().toString() for p in (found.apply(k) for k in range(found.size()))}


def touched_parts(rows: DataFrame) -> list[str]:
    """Partitions that rows with a column ``part`` fall in: folder names, of which the driver holds a list in any case."""
    return sorted(r[0] for r in rows.select(PART).distinct().collect())


def parts_of(spark: SparkSession, name: str, schema: T.StructType, parts: Iterable[str]) -> DataFrame:
    """The rows of some partitions, with ``part``; no other folder is listed or read."""
    if not spark.catalog.tableExists(name):
        return spark.createDataFrame([], T.StructType([*schema.fields, T.StructField(PART, T.StringType())]))
    return spark.table(name).select(*[col(c) for c in schema.names], PART).where(F.col(PART).isin(list(parts)))


def days_between(first: dt.date, last: dt.date) -> list[str]:
    """The day partitions of an inclusive window."""
    return [(first + dt.timedelta(days=k)).isoformat() for k in range((last - first).days + 1)]


def clustered(df: DataFrame, cluster: Sequence[str]) -> DataFrame:
    """Rows in ranges of the key columns, sorted by them, so that a lookup by key reads the one row group that can hold it."""
    return df.repartitionByRange(*[col(c) for c in cluster]).sortWithinPartitions(*[col(c) for c in cluster])


def _create(spark: SparkSession, name: str, df: DataFrame) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != PART)
    home, table = _home(spark, name)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, {PART} string) USING parquet PARTITIONED BY ({PART}) "
              f"LOCATION {_quoted(f'{home}/{table}_v0')}")


def append_partitions(spark: SparkSession, df: DataFrame, name: str) -> None:
    """Add rows with a column ``part`` to their partitions; stored files stay as they are."""
    _create(spark, name, df)
    columns = [c for c in spark.table(name).columns]
    df.select(*[col(c) for c in columns]).hint("rebalance", F.col(PART)).write.insertInto(name)


def write_partitions(spark: SparkSession, df: DataFrame, name: str, parts: Iterable[str], retention: dt.timedelta = RETENTION,
                     cluster: Sequence[str] = ()) -> list[str]:
    """Replace exactly the partitions ``parts`` of a table by the rows of ``df``; those without a row are dropped.

    Every row must be in one of them. ``df`` may read the table. All files are
    written first; then the catalog is pointed at them. Returns the partitions written.
    """
    wanted = set(parts)
    root = _fresh(spark, name)
    inside = F.when(F.col(PART).isin(sorted(wanted)), F.col(PART)).otherwise(
        F.raise_error(F.concat(F.lit("a row outside of the partitions that are written: "), F.coalesce(PART, F.lit("null")))).cast("string"))
    # a partition is a few files, and a large one still goes to many tasks
    dealt = df.withColumn(PART, inside).hint("rebalance", F.col(PART)).sortWithinPartitions(PART, *[col(c) for c in cluster])
    dealt.write.partitionBy(PART).parquet(root)
    _create(spark, name, df)
    before = _locations(spark, name)
    place, files = _path(spark, root)
    written = {spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(
        s.getPath().getName().removeprefix(f"{PART}=")): s.getPath().toString()
        for s in files.listStatus(place) if s.isDirectory() and s.getPath().getName().startswith(f"{PART}=")}
    _retire(spark, name, [before[p] for p in wanted if p in before])
    for p in sorted(set(written) & set(before)):
        spark.sql(f"ALTER TABLE {name} PARTITION ({PART} = {_quoted(p)}) SET LOCATION {_quoted(written[p])}")
    fresh = " ".join(f"PARTITION ({PART} = {_quoted(p)}) LOCATION {_quoted(written[p])}" for p in sorted(set(written) - set(before)))
    if fresh:
        spark.sql(f"ALTER TABLE {name} ADD {fresh}")
    gone = ", ".join(f"PARTITION ({PART} = {_quoted(p)})" for p in sorted((wanted & set(before)) - set(written)))
    if gone:
        spark.sql(f"ALTER TABLE {name} DROP {gone}")
    spark.catalog.refreshTable(name)
    purge_versions(spark, name, retention)
    return sorted(written)


def change_partitions(spark: SparkSession, name: str, schema: T.StructType, source: DataFrame,
                      change: Callable[[DataFrame, DataFrame], DataFrame], retention: dt.timedelta = RETENTION,
                      cluster: Sequence[str] = ()) -> list[str]:
    """Apply ``change(stored rows, source rows)`` to the partitions that the source touches, and to no others.

    ``source`` has a column ``part`` and is read twice, so it should be staged. The change sees both sides with ``part`` and
    must keep it. Returns the partitions written.
    """
    parts = touched_parts(source)
    if not parts and spark.catalog.tableExists(name):
        return []
    return write_partitions(spark, change(parts_of(spark, name, schema, parts), source), name, parts, retention, cluster)
