"""End-to-end runs over files and catalog tables.

Tables live in one database as Parquet tables named after their spec, most of them partitioned (see
``haulmark.sources.stored``); a run reads and writes only the partitions its rows fall in. The driver gets table
names, headers with the files that have them, and names of partitions. Each file is parsed once: its cells are staged in the shared
folder, and so are the typed rows of a table, which the table, its rejects and the report read.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from haulmark import functions as H
from haulmark.operators.changes import (
    dedup_keep_last, insert_ignore_dups, upsert_coalesce, upsert_overwrite, with_signature,
)
from haulmark.operators.checks import split_valid
from haulmark.operators.columns import col
from haulmark.plans import ingest as I, revenue as R, specs as S, tenure as TN
from haulmark.sources import exports as X, stored as ST
from haulmark.operators.headers import require_columns
from haulmark.sources.routing import is_workbook
from haulmark.sources.sinks import conform, ingest_report, stage_rows
from haulmark.sources.stored import PART, replace_table, table_or_empty

__all__ = ["ingest_directory", "ingest_backlog_file", "store_rows", "revenue_week", "revenue_recent",
           "update_tenure", "merge_tenure_report", "purge_duplicates", "purge_all", "table_schema", "append_new"]

_BUNDLE = (S.DELIVERED_PACKAGES, S.SERVICE_DETAILS, S.TRAINING, S.UNPLANNED_DELAY, S.WEEKLY_WORK)
_MATRIX = ("daily_overview", "weekly_overview")
#: Buckets of files that rejects are kept in.
_BUCKETS = 64


def table_schema(spec: S.TableSpec) -> T.StructType:
    """Columns of a table: those of the spec and, where it has one, the signature."""
    schema = spec.schema()
    return schema.add("row_sig", "string") if spec.signature else schema


def append_new(spark: SparkSession, name: str, schema: T.StructType, signed: DataFrame, order: Sequence[str]) -> None:
    """Append the rows whose signature is not stored. A signature holds what makes its partition, so only the
    signatures of the partitions that the rows fall in are read, and no other column."""
    known = ST.parts_of(spark, name, T.StructType([schema["row_sig"]]), ST.touched_parts(signed))
    fresh = insert_ignore_dups(known, signed, "row_sig", list(order))
    ST.append_partitions(spark, conform(fresh.select(*schema.names, PART), T.StructType([*schema, T.StructField(PART, T.StringType())])), name)


def _store_noted(spark: SparkSession, name: str, rows: DataFrame, file: str) -> None:
    """Keep rows that no table took, once per file and content with their number (``rows``); a second run adds nothing."""
    content = F.to_json(F.struct(*[F.when(F.lit(True), col(c)).alias(c) for c in rows.columns]))
    counted = rows.groupBy(*[col(c) for c in rows.columns]).agg(F.count(F.lit(1)).alias("rows"))
    signed = counted.withColumn("row_sig", F.sha2(content, 256)).withColumn(
        PART, F.lpad(F.pmod(F.xxhash64(col(file)), F.lit(_BUCKETS)).cast("string"), 2, "0"))
    signed = stage_rows(signed, "noted")
    append_new(spark, name, signed.drop(PART).schema, signed, ["row_sig"])


def store_rows(spark: SparkSession, spec: S.TableSpec, rows: DataFrame, order: list[str],
               database: str, run: str | None = None, file: str = "file_path") -> None:
    """Apply typed rows to a table in the mode of its spec.

    Rows that lack a NOT NULL column, or hold a text longer than declared, go to ``<table>_rejected`` with
    the reasons, their file and how often the file has them. ``rows`` should be staged. Tables without a duplicate
    rule keep a partition per ``run``, so that a run that is repeated under its name replaces what it wrote.
    """
    name = f"{database}.{spec.table}"
    schema = table_schema(spec)
    rows, rejected = split_valid(rows, spec.checks())
    _store_noted(spark, f"{name}_rejected", rejected.select(*[col(c) for c in spec.schema().names], "failed", col(file).alias("file_path")), "file_path")
    part, key = spec.part(), list(spec.key)
    if spec.mode == "append":
        label = run or uuid.uuid4().hex
        ST.write_partitions(spark, conform(rows.select(*schema.names), schema).withColumn(PART, F.lit(label)), name, [label])
    elif spec.mode == "ignore_dups":
        append_new(spark, name, schema, with_signature(rows, spec.signature_parts()).withColumn(PART, part), order)
    elif spec.mode == "coalesce":
        needed = [f.name for f in spec.fields if f.required]
        merged = upsert_coalesce(table_or_empty(spark, name, schema), rows, key, order, needed[-1])
        replace_table(spark, conform(merged, schema), name, cluster=key)
    else:
        compare = {k: H.canonical_key(col(k)) for k in ("route_code", "transporter_id")} if spec.table == "routes" else None

        def change(stored: DataFrame, source: DataFrame) -> DataFrame:
            merged = upsert_overwrite(stored, source, key, order, spec.null_safe, compare)
            return with_signature(merged.drop("row_sig"), spec.signature_parts()) if spec.signature else merged

        if part is None:
            replace_table(spark, conform(change(table_or_empty(spark, name, schema), rows), schema), name, cluster=key)
        else:
            full = T.StructType([*schema, T.StructField(PART, T.StringType())])
            ST.change_partitions(spark, name, schema, rows.withColumn(PART, part), lambda t, s: conform(change(t, s), full), cluster=key)


def _typed(spark: SparkSession, raw: DataFrame, table: str, now: Column, this_year: int,
           database: str, options: dict) -> DataFrame:
    """Typed rows of one table with their origin columns; ``options`` are those of its ingest function."""
    if table == "daily_overview":
        return I.ingest_daily_overview(raw, X.ORIGIN)
    if table == "weekly_overview":
        cells = raw.withColumn("file_year", H.filename_week_year(F.col("file_name")))
        known = table_or_empty(spark, f"{database}.weekly_overview", S.WEEKLY_OVERVIEW.schema())
        return I.ingest_weekly_overview(cells, known, this_year, ["file_path"], "file_year", X.ORIGIN)
    stamp = F.coalesce(H.filename_timestamp(F.col("file_name")), now)
    if table == "associate":
        return I.ingest_people(raw, X.ORIGIN)
    if table == "routes":
        return I.ingest_routes(raw, stamp, ["file_path"], X.ARRIVAL, carry=X.ORIGIN, **options)
    if table == "itineraries":
        # a list past its limit is left whole and found among the rejects, unless the options say otherwise
        return I.ingest_itineraries(raw, stamp, carry=X.ORIGIN, **{"strategy": "keep", **options})
    return I.ingest_table(S.ALL_SPECS[table], raw, X.ORIGIN)


def ingest_directory(spark: SparkSession, source: str | Sequence[str], database: str, now: dt.datetime,
                     multi_line: bool = True, options: dict[str, dict] | None = None, run: str | None = None) -> DataFrame:
    """Ingest every known file under ``source``, a folder or a list of files; returns rows per file and table (lazy).

    Files apply in path order, later rows win, and a second run changes nothing, but for tables
    without a duplicate rule, unless both runs have the same name ``run``. ``now`` stands in for file times that a name does not carry. ``options``
    holds, by table, keyword arguments of ``ingest_routes`` and ``ingest_itineraries``.
    Workbooks are listed with no rows: saved as CSV under their name they are read. Rows with
    text in cells without a header go to ``surplus_rows`` with their cells and number.
    """
    clock = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    run = run or f"{now.isoformat()} {uuid.uuid4().hex}"
    files = X.list_files(spark, source)
    unread = is_workbook(F.col("file_name"))
    present = {r.table for r in files.filter(~unread).select("table").distinct().collect()}
    reports = []
    order = list(X.ORIGIN)
    for table in [t for t in S.ALL_SPECS if t in present]:
        spec, own = S.ALL_SPECS[table], (options or {}).get(table, {})
        if table == "itineraries" and "max_len" in own:
            spec = S.itineraries(own["max_len"])
        read = X.read_matrix_rows if table in _MATRIX else X.read_table_rows
        raw = stage_rows(read(spark, source, spec, table, multi_line), f"cells-{table}")
        kept = raw.filter("surplus is null")
        rows = stage_rows(_typed(spark, X.matrix_cells(kept) if table in _MATRIX else kept.drop("cells", "surplus"), table, clock, now.year, database, own),
                          f"typed-{table}")
        store_rows(spark, spec, rows, order, database, run)
        _store_noted(spark, f"{database}.surplus_rows", raw.filter("surplus is not null").select(
            F.lit(table).alias("table"), "file_path", "cells", "surplus"), "file_path")
        reports.append(rows.select("file_name", F.lit(table).alias("table")))
    if "(bundle)" in present:
        bundle = stage_rows(X.read_bundle_rows(spark, source), "bundle")
        for spec in _BUNDLE:
            raw = X.bundle_table_rows(bundle, spec)
            rows = stage_rows(S.apply_spec(spec, raw, carry=("file_path", "file_name", "member", "row_no")), f"typed-{spec.table}")
            store_rows(spark, spec, rows, ["file_path", "member", "row_no"], database, run)
        beyond = bundle.filter("surplus is not null")
        _store_noted(spark, f"{database}.surplus_rows", beyond.select(
            "table", F.concat_ws("/", "file_path", "member").alias("file_path"), F.map_values("cells").alias("cells"), "surplus"), "file_path")
        reports.append(bundle.select("file_name", "table"))
    other = files.filter(unread | (F.col("table") == "(unmatched)")).select(
        "file_name", "table", F.lit(0).cast("bigint").alias("rows"))
    if not reports:
        return other
    return ingest_report(reduce(DataFrame.unionByName, reports)).unionByName(other)


def ingest_backlog_file(spark: SparkSession, path: str, database: str, max_len: int = 32,
                        strategy: str = "keep") -> None:
    """Backlog itineraries from CSV into the itineraries table, stored rows first.

    A code of more than ``max_len`` characters goes to the rejects; with the strategies ``truncate`` and ``error`` it is cut, or the job fails.
    """
    raw = X.read_table_rows(spark, path, S.BACKLOG).filter("surplus is null").drop("cells", "surplus")
    rows = stage_rows(I.ingest_backlog(raw, max_len, X.ORIGIN, strategy), "typed-backlog")
    spec = S.TableSpec(S.BACKLOG.table, {}, S.BACKLOG.fields, S.BACKLOG.key, mode="ignore_dups",
                       signature=S.BACKLOG.signature, lengths={"route_code": max_len})
    store_rows(spark, spec, rows, [*X.ORIGIN, "route_code"], database)


def revenue_week(spark: SparkSession, rates: DataFrame, week: str, database: str,
                 monday: dt.date, rebuild: bool = True) -> None:
    """Store the rates of one ISO week and, if asked, rebuild that week's revenue log.

    ``rates`` is the raw rate sheet in row order column ``line``.
    """
    name = f"{database}.revenue_rate"
    require_columns(rates, ["Station", "Service_type", "Billable hours", "revenue_rate"])
    typed = S.apply_spec(S.RATES, rates, {"iso_year_week": F.lit(week)}, ("line",)).dropna()
    stored = table_or_empty(spark, name, S.RATES.schema())
    replace_table(spark, R.upsert_rates(stored, typed, ["line"]), name)
    if rebuild:
        _rebuild_log(spark, database, monday, monday + dt.timedelta(days=6))


def revenue_recent(spark: SparkSession, database: str, today: dt.date, days: int = 14) -> None:
    """Rebuild the revenue log from ``days`` before ``today`` to that day, both included, at the stored rates."""
    _rebuild_log(spark, database, *R.default_window(today, days))


def _rebuild_log(spark: SparkSession, database: str, first: dt.date, last: dt.date) -> None:
    """Write the days of the window anew: each is a partition, days without a row are dropped, and all others stay untouched.

    Sources are read from the same days only, where they are partitioned by day.
    """
    days = ST.days_between(first, last)

    def source(spec: S.TableSpec) -> DataFrame:
        name, schema = f"{database}.{spec.table}", table_schema(spec)
        return ST.parts_of(spark, name, schema, days).drop(PART) if spec.part() is not None else table_or_empty(spark, name, schema)

    sources = [source(s) for s in (S.SERVICE_DETAILS, S.WEEKLY_WORK, S.DELIVERED_PACKAGES, S.TRAINING)]
    rates = table_or_empty(spark, f"{database}.revenue_rate", S.RATES.schema())
    fresh = R.build_revenue_log(*sources, rates, first, last)
    ST.write_partitions(spark, fresh.withColumn(PART, H.day_part(F.col("row_date"))), f"{database}.revenue_log", days)


_STAFF = ("transporter_id string, full_name string, tenured_date date, tenured_source string, "
          "tenured_year int, tenured_week int, routes_at_tenure int, is_active boolean, "
          "updated_utc timestamp_ntz")


def update_tenure(spark: SparkSession, database: str) -> None:
    """Add newly tenured people from the stored service rows."""
    name = f"{database}.tenured_workforce"
    target = table_or_empty(spark, name, T.StructType.fromDDL(_STAFF))
    service = table_or_empty(spark, f"{database}.wst_service_details", table_schema(S.SERVICE_DETAILS))
    people = table_or_empty(spark, f"{database}.associate", table_schema(S.PEOPLE))
    replace_table(spark, TN.tenure_from_service(service, people, target), name)


def merge_tenure_report(spark: SparkSession, database: str, updated: dt.datetime) -> None:
    """Merge the stored external tenure report into the tenure table."""
    name = f"{database}.tenured_workforce"
    target = table_or_empty(spark, name, T.StructType.fromDDL(_STAFF))
    report = table_or_empty(spark, f"{database}.{S.TENURE_REPORT.table}", table_schema(S.TENURE_REPORT))
    stamp = F.lit(updated.isoformat(sep=" ")).cast("timestamp_ntz")
    replace_table(spark, TN.tenure_merge(target, report, stamp), name)


def purge_duplicates(spark: SparkSession, spec: S.TableSpec, database: str, order: list[str] | None = None) -> list[str]:
    """Keep, of the stored rows with one key, the last by ``order``, or the one written last; null key parts are equal.

    Only partitions that hold a key twice are written anew; their names are returned.
    """
    name = f"{database}.{spec.table}"
    keys = [H.canonical_key(col(k)) if spec.schema()[k].dataType == T.StringType() else col(k) for k in spec.key]
    columns = spark.table(name).columns
    written = {"__at": "file_modification_time", "__file": "file_path", "__row": "row_index"}
    rows = spark.table(name).select("*", *[F.col(f"_metadata.{m}").alias(c) for c, m in written.items()])
    order = order or list(written)
    if PART not in columns:
        replace_table(spark, dedup_keep_last(rows, keys, order).select(*columns), name)
        return []
    twice = (rows.groupBy(PART, *[k.alias(f"__k{i}") for i, k in enumerate(keys)]).agg(F.count(F.lit(1)).alias("n"))
             .where("n > 1").select(PART).distinct())
    parts = sorted(r[0] for r in twice.collect())
    if parts:
        ST.write_partitions(spark, dedup_keep_last(rows.where(F.col(PART).isin(parts)), keys, order).select(*columns), name, parts, cluster=spec.key)
    return parts


def purge_all(spark: SparkSession, database: str) -> dict[str, list[str]]:
    """``purge_duplicates`` of every stored table that has a key: the partitions written anew, by table."""
    return {spec.table: purge_duplicates(spark, spec, database) for spec in {s.table: s for s in S.ALL_SPECS.values()}.values()
            if spec.key and spark.catalog.tableExists(f"{database}.{spec.table}")}
