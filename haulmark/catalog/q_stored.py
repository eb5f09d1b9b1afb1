"""Stored tables, whole folders and archives: what jobs do to them, read back."""

from __future__ import annotations

import datetime as dt
import io
import uuid
import zipfile

import pyarrow as pa
from pyarrow import compute as pc, csv as pa_csv
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark import functions as H
from haulmark.catalog import duck as D
from haulmark.catalog.base import Registry, as_text, blotted, dirty, raw_frame, raw_sql, table
from haulmark.catalog.q_calendar import _DAYS, _SUNDAY, _span, _week_columns
from haulmark.catalog.q_ingest import SAFETY, SAFETY_ORACLE, _select
from haulmark.operators import changes as C
from haulmark.plans import calendar as CAL, jobs, specs as S
from haulmark.session import scratch_path
from haulmark.sources import exports as X, stored as ST
from haulmark.streaming.arrivals import ingest_arrivals

QUERIES = Registry()


def database(spark: SparkSession) -> str:
    """A fresh database in the shared folder."""
    name = f"haulmark_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'database')}'")
    return name


def _month(c: Column) -> Column:
    return F.date_format(c, "yyyy-MM")


def _store(spark: SparkSession, df: DataFrame, name: str) -> None:
    ST.write_partitions(spark, df, name, ST.touched_parts(df))


# --- changes confined to partitions ------------------------------------------------

_OLD = {"o_orderkey": "o_orderkey", "day": "CAST(o_orderdate AS date)", "status": "o_orderstatus", "total": "o_totalprice"}
_NEW = {"o_orderkey": "CASE WHEN o_orderkey % 5 = 0 THEN o_orderkey + 100000000 ELSE o_orderkey END", "day": "CAST(o_orderdate AS date)",
        "status": "CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE 'new' END", "total": "o_totalprice + 1", "line": "o_custkey"}
_WINDOW = "CAST(o_orderdate AS DATE) BETWEEN DATE '1995-03-10' AND DATE '1995-06-20'"


@QUERIES.add("upsert_stored", f"""
WITH t AS ({raw_sql("orders", _OLD)}), s AS ({raw_sql("orders", _NEW)} WHERE {_WINDOW})
SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.day, s.day) AS day,
  CASE WHEN s.day IS NULL THEN t.status ELSE s.status END AS status, CASE WHEN s.day IS NULL THEN t.total ELSE s.total END AS total
FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey AND t.day = s.day""")
def q_upsert(spark, sf):
    """A table by months, and a merge that touches four of them."""
    orders, name = table(spark, sf, "orders"), f"{database(spark)}.orders"
    _store(spark, raw_frame(orders, _OLD).withColumn(ST.PART, _month(F.col("day"))), name)
    source = raw_frame(orders.filter(_WINDOW), _NEW).withColumn(ST.PART, _month(F.col("day")))
    ST.change_partitions(spark, name, spark.table(name).drop(ST.PART).schema, source,
                         lambda t, s: C.upsert_overwrite(t, s, ["o_orderkey", "day"], ["line", "status"]), cluster=["o_orderkey"])
    return spark.table(name).drop(ST.PART)


@QUERIES.add("rebuild_stored", f"""
SELECT o_orderkey, day, total FROM ({raw_sql("orders", _OLD)}) WHERE day NOT BETWEEN DATE '1995-03-01' AND DATE '1996-02-29'
UNION ALL SELECT o_orderkey, day, 0.0 AS total FROM ({raw_sql("orders", _OLD)}) WHERE day BETWEEN DATE '1995-05-01' AND DATE '1995-07-31'""")
def q_rebuild(spark, sf):
    """The partitions of twelve months are replaced; nine of them become empty and go."""
    rows = raw_frame(table(spark, sf, "orders"), _OLD).drop("status").withColumn(ST.PART, _month(F.col("day")))
    name = f"{database(spark)}.log"
    _store(spark, rows, name)
    months = [f"{y}-{m:02d}" for y in (1995, 1996) for m in range(1, 13)][2:14]
    fresh = rows.filter("day BETWEEN DATE '1995-05-01' AND DATE '1995-07-31'").withColumn("total", F.lit(0.0))
    ST.write_partitions(spark, fresh, name, months)
    return spark.table(name).drop(ST.PART)


_SIGNED = {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber", "code": blotted("l_partkey", "'cx' || " + as_text("l_suppkey")),
           "day": "CAST(l_shipdate AS date)"}
_SIGNED_SQL = D.signature([D.time_text("day"), D.key_text("code")])


@QUERIES.add("insert_stored", f"""
WITH signed AS (SELECT *, {_SIGNED_SQL} AS row_sig FROM ({raw_sql("lineitem", _SIGNED)})),
a AS (SELECT *, min(l_orderkey % 3) OVER (PARTITION BY row_sig) AS arrival FROM signed)
SELECT row_sig, day, l_orderkey, l_linenumber FROM a WHERE l_orderkey % 3 = arrival
QUALIFY row_number() OVER (PARTITION BY row_sig ORDER BY l_orderkey, l_linenumber) = 1""")
def q_insert(spark, sf):
    """Three arrivals; each looks for its signatures in the months it has rows of."""
    name = f"{database(spark)}.lines"
    signed = C.with_signature(raw_frame(table(spark, sf, "lineitem"), _SIGNED), [H.time_text(F.col("day")), H.key_text(F.col("code"))])
    signed = signed.drop("code").withColumn(ST.PART, _month(F.col("day")))
    schema = signed.drop(ST.PART).schema
    for arrival in range(3):
        jobs.append_new(spark, name, schema, signed.filter(F.col("l_orderkey") % 3 == arrival), ["l_orderkey", "l_linenumber"])
    return spark.table(name).drop(ST.PART)


@QUERIES.add("rebuilt_calendar", f"""WITH {_DAYS}, more AS (SELECT CAST(unnest(range({_SUNDAY.format(d="make_date(a, 1, 1)")},
  {_SUNDAY.format(d="make_date(b + 1, 1, 1)")}, INTERVAL 7 DAY)) AS DATE) AS s FROM span)
SELECT 'stored' AS version, {_week_columns("s")} FROM more
UNION ALL SELECT 'rebuilt', {_week_columns("s")} FROM more WHERE year(s) % 2 = 0""")
def q_rebuilt(spark, sf):
    """A table is rebuilt; the frame of the version before still gives that version."""
    name = f"{database(spark)}.weeks"
    weeks = CAL.calendar_weeks(_span(spark, sf))
    ST.replace_table(spark, weeks, name)
    stored = spark.table(name)
    ST.replace_table(spark, stored.filter(F.year("week_start") % 2 == 0), name)
    return stored.withColumn("version", F.lit("stored")).unionByName(spark.table(name).withColumn("version", F.lit("rebuilt")))


# --- folders and archives ----------------------------------------------------------

def _named_csv(spark: SparkSession, df: DataFrame, folder: str, prefix: str) -> None:
    """CSV files of a frame, under names as exports have them."""
    path = scratch_path(spark, "named")
    df.write.option("header", True).option("escape", '"').csv(path)
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    files = at(folder).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(at(folder))
    for k, found in enumerate(f for f in files.listStatus(at(path)) if f.getPath().getName().endswith(".csv")):
        files.rename(found.getPath(), at(f"{folder}/{prefix}_{k:05d}.csv"))


_SHEET = {"Driver ID ": as_text("o_custkey"), "Full Name": "'name, ' || o_orderpriority", "Work Phone Number": as_text("o_orderkey"),
          "status": blotted("o_orderkey", "o_orderstatus")}

@QUERIES.add("scan_exports", f"""
WITH raw AS ({raw_sql("orders", _SHEET)})
SELECT trim("Driver ID ") AS transporter_id, "Full Name" AS full_name, "Work Phone Number" AS work_phone,
  CASE WHEN CAST("Work Phone Number" AS BIGINT) % 2 = 0 THEN {D.null_like('"status"')} END AS working_status FROM raw""")
def q_scan(spark, sf):
    """A folder of files with two headers, in another order and with a column less."""
    folder = scratch_path(spark, "sheets")
    raw = raw_frame(table(spark, sf, "orders"), _SHEET)
    even = F.col("Work Phone Number").cast("bigint") % 2 == 0
    _named_csv(spark, raw.filter(even), f"{folder}/week 1", "AssociateData")
    _named_csv(spark, raw.filter(~even).select("Work Phone Number", "Full Name", F.col("Driver ID ").alias("driver id")), f"{folder}/week 2", "AssociateData")
    rows = X.read_table_rows(spark, folder, S.PEOPLE)
    return S.apply_spec(S.PEOPLE, rows).select("transporter_id", "full_name", "work_phone", "working_status")


_PARCELS = {"Station": "'Dallas (DSW' || " + as_text("o_custkey % 9") + " || ')'", "Date": "CAST(CAST(o_orderdate AS DATE) AS string)",
            "Package Count": dirty("o_orderkey", as_text("o_orderkey % 1000")), "Package Type": "o_orderpriority", "Package Details": as_text("o_orderkey")}


def _zipped(rows: pa.Table) -> pa.Table:
    """One archive with the rows of a block of orders, a member per order status."""
    packed = io.BytesIO()
    with zipfile.ZipFile(packed, "w", zipfile.ZIP_DEFLATED) as z:
        for status in sorted(set(rows.column("status").to_pylist())):
            own = rows.filter(pc.equal(rows.column("status"), status)).drop(["status", "block"])
            out = io.BytesIO()
            pa_csv.write_csv(own, out)
            z.writestr(f"{status} Delivered Packages Report.csv", out.getvalue())
        z.writestr("readme.txt", "no rows")
    block = rows.column("block")[0].as_py()
    return pa.table({"file_path": [f"/{block}/x Weekly Report.zip"], "file_name": ["x Weekly Report.zip"], "content": pa.array([packed.getvalue()], pa.binary())})


@QUERIES.add("scan_archives", f"""
WITH raw AS ({raw_sql("orders", _PARCELS)})
SELECT {D.null_like('"Station"')} AS station, CAST("Date" AS DATE) AS metric_date, {D.to_int('"Package Count"')} AS package_count,
  "Package Type" AS package_type, "Package Details" AS package_details, count(*) AS "rows" FROM raw GROUP BY ALL""")
def q_archives(spark, sf):
    """Orders packed into archives of 20,000 keys each, and read back member by member."""
    orders = table(spark, sf, "orders")
    raw = raw_frame(orders, {**_PARCELS, "status": "o_orderstatus", "block": "CAST(o_orderkey / 20000 AS int)"})
    archives = raw.groupBy("block").applyInArrow(_zipped, "file_path string, file_name string, content binary")
    rows = X.bundle_table_rows(X.bundle_rows(archives), S.DELIVERED_PACKAGES)
    typed = S.apply_spec(S.DELIVERED_PACKAGES, rows)
    return typed.groupBy("station", "metric_date", "package_count", "package_type", "package_details").agg(F.count(F.lit(1)).alias("rows"))


_SAFE_SIG = D.signature(["coalesce(CAST(event_id AS VARCHAR), '#NOID#')", D.time_text("event_datetime"),
                         *(D.key_text(c) for c in ("transporter_id", "metric_type", "metric_subtype", "vin"))])


@QUERIES.add("ingest_arrivals", f"""
WITH raw AS ({raw_sql("events", SAFETY)}), typed AS (SELECT {_select(SAFETY_ORACLE)} FROM raw),
signed AS (SELECT *, {_SAFE_SIG} AS row_sig FROM typed WHERE event_date IS NOT NULL)
SELECT row_sig, any_value(vin) AS vin, any_value(event_datetime) AS event_datetime FROM signed GROUP BY row_sig""")
def q_arrivals(spark, sf):
    """Exports of events arrive in three parts; a run after each takes what is new, the last run nothing."""
    name = database(spark)
    folder, checkpoint = scratch_path(spark, "arriving"), scratch_path(spark, "checkpoint")
    raw = raw_frame(table(spark, sf, "events"), {**SAFETY, "part": "event_id % 3"})
    for k in range(3):
        own = raw.filter(F.col("part") == k).drop("part")
        _named_csv(spark, own.select(*(own.columns if k else reversed(own.columns))), f"{folder}/{k}", f"Safety_Dashboard_{k}")
        ingest_arrivals(spark, folder, name, checkpoint, dt.datetime(2025, 9, 10))
    ingest_arrivals(spark, folder, name, checkpoint, dt.datetime(2025, 9, 10))
    return spark.table(f"{name}.safety_events").select("row_sig", "vin", "event_datetime")
