"""Upserts, deduplication, window rebuild and the incremental ingest."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark import functions as H
from haulmark.catalog import duck as D
from haulmark.catalog.base import Registry, as_text, blotted, plain, raw_frame, raw_sql, table
from haulmark.catalog.q_ingest import (
    RATE, RATE_ORACLE, TENURE_SQL, _select, tenure_rows,
)
from haulmark.operators import changes as C
from haulmark.plans import ingest as I, revenue as R, tenure as TN
from haulmark.session import scratch_path
from haulmark.streaming.directory import ingest_new_files

QUERIES = Registry()

_LINE_COLUMNS = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                 "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
# Newest by ship date, then by every other column, so that the order is total.
_ARRIVAL = ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
            "l_returnflag", "l_linestatus")
_DESC = ", ".join(f"{c} DESC" for c in _ARRIVAL)
_ASC = ", ".join(_ARRIVAL)


@QUERIES.add("dedup_keep_last", f"""SELECT {", ".join(_LINE_COLUMNS)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_DESC}) = 1""")
def q_last(spark, sf):
    return C.dedup_keep_last(table(spark, sf, "lineitem").select(*_LINE_COLUMNS),
                             ["l_orderkey", "l_linenumber"], _ARRIVAL)


@QUERIES.add("dedup_keep_first", f"""SELECT {", ".join(_LINE_COLUMNS)} FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {_ASC}) = 1""")
def q_first(spark, sf):
    return C.dedup_keep_first(table(spark, sf, "lineitem").select(*_LINE_COLUMNS),
                              ["l_orderkey", "l_linenumber"], _ARRIVAL)


_SIGNED = {"l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
           "code": blotted("l_partkey", "'cx' || " + as_text("l_suppkey")),
           "day": "CAST(l_shipdate AS date)", "price": "l_extendedprice"}
_SIGNED_SQL = D.signature([D.time_text("day"), D.key_text("code")])


@QUERIES.add("insert_ignore_dups", f"""
WITH raw AS ({raw_sql("lineitem", _SIGNED)}), signed AS (SELECT *, {_SIGNED_SQL} AS row_sig FROM raw),
stored AS (SELECT row_sig FROM signed WHERE l_orderkey % 3 = 0),
batch AS (SELECT * FROM signed QUALIFY row_number() OVER
  (PARTITION BY row_sig ORDER BY l_orderkey, l_linenumber, price, code) = 1)
SELECT row_sig, day, upper(trim(code)) AS code, l_orderkey FROM batch b WHERE NOT EXISTS
  (SELECT 1 FROM stored s WHERE s.row_sig = b.row_sig)""")
def q_ignore(spark, sf):
    signed = C.with_signature(
        raw_frame(table(spark, sf, "lineitem"), _SIGNED),
        [H.time_text(F.col("day")), H.key_text(F.col("code"))])
    stored = signed.filter("l_orderkey % 3 = 0")
    fresh = C.insert_ignore_dups(stored, signed, "row_sig", ["l_orderkey", "l_linenumber", "price", "code"])
    return fresh.select("row_sig", "day", H.canonical_key(F.col("code")).alias("code"), "l_orderkey")


# Upserts: the stored table is one part of the source, older and different.
_FLEET_TARGET = {"vin": "p_partkey", "make": "p_brand", "kind": "p_type", "price": "p_retailprice"}
_FLEET_SOURCE = {"vin": "l_partkey", "make": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag END",
                 "kind": "l_linestatus", "price": "l_extendedprice", "l_shipdate": "l_shipdate",
                 "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber"}
_FLEET_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "price", "kind", "make")
_FLEET_DESC = ", ".join(f"{c} DESC NULLS LAST" for c in _FLEET_ORDER)


@QUERIES.add("upsert_overwrite", f"""
WITH t AS ({raw_sql("part", _FLEET_TARGET)} WHERE p_partkey % 3 <> 0),
s AS (SELECT * FROM ({raw_sql("lineitem", _FLEET_SOURCE)}) QUALIFY row_number() OVER
  (PARTITION BY vin ORDER BY {_FLEET_DESC}) = 1 )
SELECT coalesce(t.vin, s.vin) AS vin, CASE WHEN s.vin IS NULL THEN t.make ELSE s.make END AS make,
  CASE WHEN s.vin IS NULL THEN t.kind ELSE s.kind END AS kind,
  CASE WHEN s.vin IS NULL THEN t.price ELSE s.price END AS price
FROM t FULL JOIN s ON t.vin = s.vin""")
def q_overwrite(spark, sf):
    target = raw_frame(table(spark, sf, "part").filter("p_partkey % 3 <> 0"), _FLEET_TARGET)
    source = raw_frame(table(spark, sf, "lineitem"), _FLEET_SOURCE)
    return C.upsert_overwrite(target, source, ["vin"], _FLEET_ORDER)


_PERSON_TARGET = {"id": "c_custkey", "name": "c_name", "phone": "CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END",
                  "email": "CASE WHEN c_custkey % 5 = 0 THEN c_name END"}
_PERSON_SOURCE = {
    "id": "o_custkey + 10", "name": "'name ' || o_orderstatus",
    "phone": "CASE WHEN o_orderkey % 3 = 0 THEN " + as_text("o_orderkey") + " END",
    "email": "CASE WHEN o_orderkey % 4 = 0 THEN o_orderpriority END", "line": "o_orderkey"}


@QUERIES.add("upsert_coalesce", f"""
WITH t AS ({raw_sql("customer", _PERSON_TARGET)}), r AS ({raw_sql("orders", _PERSON_SOURCE)}),
s AS (SELECT id, arg_max(name, line) FILTER (name IS NOT NULL) AS name,
  arg_max(phone, line) FILTER (phone IS NOT NULL) AS phone,
  arg_max(email, line) FILTER (email IS NOT NULL) AS email FROM r GROUP BY id)
SELECT coalesce(t.id, s.id) AS id, coalesce(s.name, t.name) AS name, coalesce(s.phone, t.phone) AS phone,
  coalesce(s.email, t.email) AS email FROM t FULL JOIN s ON t.id = s.id
WHERE t.id IS NOT NULL OR s.name IS NOT NULL""")
def q_coalesce(spark, sf):
    target = raw_frame(table(spark, sf, "customer"), _PERSON_TARGET)
    source = raw_frame(table(spark, sf, "orders"), _PERSON_SOURCE)
    return C.upsert_coalesce(target, source, ["id"], ["line"], "name")


_STOPS = {"day": "CAST(ts AS date)", "person": "user_id",
          "route": "CASE WHEN event_id % 11 = 0 THEN NULL WHEN event_id % 2 = 0 THEN ' cx' || " + as_text("event_id % 7")
                   + " ELSE 'CX' || " + as_text("event_id % 7") + " END",
          "stops": "event_id", "status": "event_type"}
_STOP_ROWS = (f"WITH r AS ({raw_sql('events', _STOPS)}), "
              "last AS (SELECT * FROM r QUALIFY row_number() OVER "
              "(PARTITION BY day, person, upper(trim(route)) ORDER BY stops DESC) = 1), "
              "t AS (SELECT day, person, route, stops, 'stored' AS status FROM last WHERE person % 2 = 0) ")


@QUERIES.add("upsert_null_safe", _STOP_ROWS + """
SELECT coalesce(t.day, s.day) AS day, coalesce(t.person, s.person) AS person,
  CASE WHEN t.day IS NULL THEN s.route ELSE t.route END AS route,
  CASE WHEN s.day IS NULL THEN t.stops ELSE s.stops END AS stops,
  CASE WHEN s.day IS NULL THEN t.status ELSE s.status END AS status
FROM t FULL JOIN last s ON t.day = s.day AND t.person = s.person
  AND upper(trim(t.route)) IS NOT DISTINCT FROM upper(trim(s.route))""")
def q_null_safe(spark, sf):
    rows = raw_frame(table(spark, sf, "events"), _STOPS)
    route = H.canonical_key(F.col("route"))
    target = C.dedup_keep_last(rows.filter("person % 2 = 0"), ["day", "person", route], ["stops"]).withColumn(
        "status", F.lit("stored"))
    return C.upsert_overwrite(target, rows, ["day", "person", "route"], ["stops"], ["route"], {"route": route})


_RATE_ROWS = RATE | {"line": "o_orderkey", "iso_year_week": "CASE WHEN o_orderkey % 3 = 0 THEN '2025-W36' ELSE '2025-W37' END"}
_RATE_SQL = (f"raw AS ({raw_sql('orders', _RATE_ROWS)}), rates AS (SELECT line, iso_year_week, {_select(RATE_ORACLE)} FROM raw), "
             "good AS (SELECT * FROM rates WHERE station_code IS NOT NULL AND service_type IS NOT NULL AND revenue_rate IS NOT NULL)")


@QUERIES.add("upsert_rates", f"""WITH {_RATE_SQL},
s AS (SELECT * FROM good QUALIFY row_number() OVER (PARTITION BY station_code, service_type, iso_year_week ORDER BY line DESC) = 1),
t AS (SELECT DISTINCT 'N' || (n_nationkey + 20) AS station_code, 'Package' AS service_type, '2025-W36' AS iso_year_week, 0.1 AS rate FROM nation)
SELECT coalesce(s.station_code, t.station_code) AS station_code, coalesce(s.service_type, t.service_type) AS service_type,
  coalesce(s.iso_year_week, t.iso_year_week) AS iso_year_week, CAST(coalesce(s.revenue_rate, t.rate) AS DOUBLE) AS revenue_rate
FROM s FULL JOIN t ON s.station_code = t.station_code AND s.service_type = t.service_type AND s.iso_year_week = t.iso_year_week""")
def q_rates(spark, sf):
    raw = raw_frame(table(spark, sf, "orders"), _RATE_ROWS)
    typed = raw.select(
        "line", "iso_year_week", H.station_code(F.col("Station")).alias("station_code"),
        H.service_type(F.col("Service_type")).alias("service_type"),
        H.to_float(F.col("revenue_rate")).try_cast("decimal(18,4)").alias("revenue_rate")).dropna()
    target = table(spark, sf, "nation").select(
        F.concat(F.lit("N"), (F.col("n_nationkey") + 20).cast("string")).alias("station_code"),
        F.lit("Package").alias("service_type"), F.lit("2025-W36").alias("iso_year_week"),
        F.lit("0.1").cast("decimal(18,4)").alias("revenue_rate"))
    return plain(R.upsert_rates(target, typed, ["line"]))


_STAFF = {"transporter_id": "'T' || " + as_text("c_custkey"), "full_name": "c_name",
          "tenured_date": "CAST(NULL AS date)", "tenured_source": "'OLD'", "tenured_year": "2020", "tenured_week": "1",
          "routes_at_tenure": "CASE WHEN c_custkey % 2 = 0 THEN 31 END", "is_active": "c_custkey % 4 = 0"}


@QUERIES.add("tenure_merge", f"""WITH {TENURE_SQL},
t AS ({raw_sql("customer", _STAFF)} WHERE c_custkey % 3 = 0),
s AS (SELECT trim(transporter_id) AS transporter_id, name, year, week, lifetime_routes, tenure_status, driver_status
  FROM report WHERE transporter_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY trim(transporter_id)
  ORDER BY year DESC, week DESC, lifetime_routes DESC, name DESC, tenure_status DESC, driver_status DESC) = 1)
SELECT coalesce(t.transporter_id, s.transporter_id) AS transporter_id,
  CASE WHEN s.transporter_id IS NOT NULL THEN s.name ELSE t.full_name END AS full_name,
  t.tenured_date, CASE WHEN t.transporter_id IS NULL THEN 'AMZ_TENURE_REPORT' ELSE t.tenured_source END AS tenured_source,
  CASE WHEN t.transporter_id IS NULL THEN s.year ELSE t.tenured_year END AS tenured_year,
  CASE WHEN t.transporter_id IS NULL THEN s.week ELSE t.tenured_week END AS tenured_week,
  coalesce(t.routes_at_tenure, s.lifetime_routes) AS routes_at_tenure,
  CASE WHEN upper(s.driver_status) = 'ACTIVE' THEN true WHEN t.transporter_id IS NULL THEN false ELSE t.is_active END AS is_active,
  CASE WHEN t.transporter_id IS NOT NULL AND s.transporter_id IS NOT NULL THEN TIMESTAMP '2025-09-01 00:00:00' END AS updated_utc
FROM t FULL JOIN s ON t.transporter_id = s.transporter_id
WHERE t.transporter_id IS NOT NULL OR upper(s.tenure_status) = 'TENURED'""")
def q_tenure(spark, sf):
    staff = raw_frame(table(spark, sf, "customer").filter("c_custkey % 3 = 0"), _STAFF).withColumn(
        "updated_utc", F.lit(None).cast("timestamp_ntz"))
    now = F.lit("2025-09-01 00:00:00").cast("timestamp_ntz")
    return TN.tenure_merge(staff, tenure_rows(spark, sf), now)


_REFILL = {"o_orderkey": "o_orderkey", "row_date": "CAST(o_orderdate AS date)", "total": "0.0", "source": "'new'"}
_LOG = {"o_orderkey": "o_orderkey", "row_date": "CASE WHEN o_custkey % 50 = 0 THEN NULL ELSE CAST(o_orderdate AS date) END",
        "total": "o_totalprice", "source": "'old'"}


@QUERIES.add("rebuild_window", f"""
SELECT o_orderkey, row_date, CAST(total AS DOUBLE) AS total, source FROM ({raw_sql("orders", _LOG)})
  WHERE row_date IS NULL OR row_date NOT BETWEEN DATE '1996-03-01' AND DATE '1998-03-01'
UNION ALL SELECT o_orderkey, row_date, CAST(total AS DOUBLE), source FROM ({raw_sql("orders", _REFILL)})
  WHERE row_date BETWEEN DATE '1996-03-01' AND DATE '1998-03-01'""")
def q_rebuild(spark, sf):
    orders = table(spark, sf, "orders")
    fresh = raw_frame(orders, _REFILL).withColumn("total", F.col("total").cast("double"))
    return R.rebuild_revenue_log(raw_frame(orders, _LOG), fresh, "1996-03-01", "1998-03-01")


@QUERIES.add("stream_ingest", f"""
SELECT min(event_id) AS event_id, user_id, event_type, CAST(ts AS DATE) AS day FROM events GROUP BY ALL""")
def q_stream(spark, sf):
    """Events arrive in three parts; each arrival is ingested by its own run."""
    events = table(spark, sf, "events").select(
        "event_id", "user_id", "event_type", F.col("ts").cast("date").alias("day"))
    parts = [H.id_text(F.col("user_id")), H.key_text(F.col("event_type")), H.time_text(F.col("day"))]
    source, target, checkpoint = (
        scratch_path(spark, f"events-{x}") for x in ("arriving", "stored", "checkpoint"))
    for arrival in range(3):
        events.filter(F.dayofmonth("day") % 3 == arrival).write.mode("append").parquet(source)
        stored = ingest_new_files(
            spark, source, events.schema, target, parts, ["event_id"], checkpoint)
    return stored.drop("row_sig")
