"""Scans, routing, headers, sinks and inventory."""

from __future__ import annotations

from pyspark.sql import functions as F, types as T

from haulmark.catalog import duck as D
from haulmark.catalog.base import (
    Registry, as_text, blotted, dirty, money, plain, raw_frame, raw_sql, table,
)
from haulmark.catalog.q_functions import FILES
from haulmark.functions import null_like, to_decimal, to_int
from haulmark.operators.headers import canonical_headers, fill_missing_columns, require_columns
from haulmark.session import scratch_path
from haulmark.sources.exports import scan_csv_strings
from haulmark.sources.routing import route_file
from haulmark.sources.sinks import append_rows, ingest_report, table_inventory

QUERIES = Registry()

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

_CSV = {
    "Order Key": as_text("o_orderkey"),
    "Status": blotted("o_orderkey", "o_orderstatus"),
    "Total, paid": "CASE WHEN o_orderkey % 9 = 0 THEN '1,' || " + money("o_totalprice % 1000 + 1000")
                   + " ELSE " + dirty("o_custkey", money("o_totalprice")) + " END",
    "Priority": "'\"' || o_orderpriority || '\"'",
}


@QUERIES.add("scan_csv_strings", f"""
WITH raw AS ({raw_sql("orders", _CSV)})
SELECT "Order Key" AS order_key, {D.null_like('"Status"')} AS status,
       {D.to_decimal('"Total, paid"')} AS total, "Priority" AS priority FROM raw""")
def scan_csv(spark, sf):
    """Orders written as quoted CSV text in the shared folder and scanned back."""
    path = scratch_path(spark, "orders-csv")
    raw_frame(table(spark, sf, "orders"), _CSV).write.option("header", True).option(
        "quoteAll", True).option("escape", '"').csv(path)
    read = scan_csv_strings(spark, path)
    return plain(read.select(
        F.col("Order Key").alias("order_key"), null_like(F.col("Status")).alias("status"),
        to_decimal(F.col("`Total, paid`")).alias("total"), F.col("Priority").alias("priority")))


_ROUTES_SQL = """CASE
  WHEN lower(file_name) = 'associatedata.csv' THEN 'associate'
  WHEN regexp_matches(lower(file_name), '^routes_.*\\.(csv|xlsx|xlsm|xls)$') THEN 'routes'
  WHEN regexp_matches(lower(file_name), '^dsp_overview_dashboard_.*\\.csv$') THEN 'weekly_scorecard'
  WHEN regexp_matches(lower(file_name), '^itineraries_.*\\.(csv|xlsx|xlsm|xls)$') THEN 'itineraries'
  WHEN regexp_matches(lower(file_name), '^safety_dashboard.*\\.csv$') THEN 'safety_events'
  WHEN lower(file_name) IN ('vehiclesdata.xlsx', 'fleet.xlsx', 'fleet.csv')
    OR regexp_matches(lower(file_name), 'vehiclesdata.*\\.(csv|xlsx|xlsm|xls)$') THEN 'fleet_vehicles'
  WHEN regexp_matches(lower(file_name), '^dsp_delivery_overview_all_.*\\.csv$') THEN
    CASE WHEN contains(lower(file_name), '-w') THEN 'weekly_overview' ELSE 'daily_overview' END
  WHEN regexp_matches(lower(file_name), '^dsp_associates_concessions_dsw3.*\\.csv$')
    AND NOT contains(lower(file_name), '-w') THEN 'daily_scorecard'
  WHEN regexp_matches(lower(file_name), '^station_level_metrics.*\\.csv$') THEN
    CASE WHEN contains(lower(file_name), '-w') THEN 'station_metrics_weekly' ELSE 'station_metrics_daily' END
  WHEN regexp_matches(lower(file_name), 'tenure_workforce_das_report.*\\.csv$') THEN 'tenure_backlog_raw'
  ELSE '(unmatched)' END"""


def _files(spark, sf):
    return raw_frame(table(spark, sf, "orders"), FILES).withColumn("table", route_file(F.col("file_name")))


@QUERIES.add("route_files", f"""
WITH raw AS ({raw_sql("orders", FILES)})
SELECT o_orderkey, file_name, {_ROUTES_SQL} AS "table" FROM raw""")
def route_files(spark, sf):
    return _files(spark, sf)


@QUERIES.add("ingest_report", f"""
WITH raw AS ({raw_sql("orders", FILES)})
SELECT file_name, {_ROUTES_SQL} AS "table", count(*) AS "rows" FROM raw GROUP BY ALL""")
def report(spark, sf):
    return ingest_report(_files(spark, sf))


_HEADERS = {
    " Driver ID ": as_text("s_suppkey"),
    "Name and ID": "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE s_name END",
    "Display Name": "'shown ' || s_name",
    "Delivered on date": "'2025-01-' || lpad(" + as_text("s_nationkey + 1") + ", 2, '0')",
    "Balance": dirty("s_suppkey", money("s_acctbal")),
}


@QUERIES.add("canonical_headers", f"""
WITH raw AS ({raw_sql("supplier", _HEADERS)})
SELECT " Driver ID " AS transporter_id, coalesce("Name and ID", "Display Name") AS full_name,
       "Delivered on date" AS metric_date, "Balance" AS balance FROM raw""")
def headers(spark, sf):
    """Aliases, a doubled target, the date fallback and the required-column check."""
    frame = canonical_headers(raw_frame(table(spark, sf, "supplier"), _HEADERS), {
        "name and id": "full_name", "display name": "full_name", "driver id": "transporter_id",
    }, date_column="metric_date")
    return require_columns(frame, ["transporter_id", "full_name", "metric_date"])


@QUERIES.add("fill_missing_columns", """
SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS email, CAST(NULL AS DATE) AS id_expiration_date
FROM customer""")
def missing(spark, sf):
    frame = table(spark, sf, "customer").select("c_custkey", "c_name")
    return fill_missing_columns(frame, {"c_name": "string", "email": "string", "id_expiration_date": "date"})


_APPEND = "p_partkey bigint, size int, price decimal(9,2), note string"


@QUERIES.add("typed_append", f"""
SELECT p_partkey, {D.to_int(dirty("p_partkey", as_text("p_size")))} AS size,
       {D.to_decimal(dirty("p_partkey", money("p_retailprice")), 9, 2)} AS price,
       CAST(NULL AS VARCHAR) AS note FROM part
UNION ALL SELECT p_partkey, p_size, NULL, p_name FROM part""")
def append(spark, sf):
    """Two batches of different width appended to one typed table."""
    path = scratch_path(spark, "typed-append")
    schema = T.StructType.fromDDL(_APPEND)
    parts = table(spark, sf, "part")
    raw = raw_frame(parts, {
        "p_partkey": "p_partkey", "size": dirty("p_partkey", as_text("p_size")),
        "price": dirty("p_partkey", money("p_retailprice"))})
    append_rows(raw.select("p_partkey", to_int(F.col("size")).alias("size"),
                           to_decimal(F.col("price"), 9, 2).alias("price")), schema, path)
    append_rows(parts.select("p_partkey", F.col("p_size").alias("size"), F.col("p_name").alias("note")),
                schema, path)
    return plain(spark.read.schema(schema).parquet(path))


@QUERIES.add("table_inventory", " UNION ALL ".join(
    f"SELECT 'dsp' AS schema_name, '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES))
def inventory(spark, sf):
    return table_inventory({t: table(spark, sf, t) for t in TABLES}, "dsp")
