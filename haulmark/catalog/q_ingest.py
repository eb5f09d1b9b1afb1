"""The twenty ingest pipelines over text frames made from whole tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, functions as F

from haulmark.catalog import duck as D
from haulmark.catalog.base import (
    Registry, as_text, blotted, date_text, dirty, iso_date, money, plain, raw_frame, raw_sql,
    table, whole,
)
from haulmark.operators.reshape import melt_matrix
from haulmark.plans import ingest as I, specs as S

QUERIES = Registry()

Oracle = Mapping[str, tuple[str, Callable[[str], str]]]


def _select(oracle: Oracle) -> str:
    return ", ".join(f'{parse(chr(34) + header + chr(34))} AS {out}' for out, (header, parse) in oracle.items())


def _pipeline(name: str, source: str, raw: Mapping[str, str], oracle: Oracle,
              run: Callable[[DataFrame], DataFrame], having: str = "true",
              keep: tuple[str, ...] = ()) -> None:
    """Register a one-select pipeline; ``keep`` names key columns both sides carry."""
    columns = dict(raw) | {k: k for k in keep}
    carried = "".join(f"{k}, " for k in keep)
    sql = (f"WITH raw AS ({raw_sql(source, columns)}), typed AS "
           f"(SELECT {carried}{_select(oracle)} FROM raw) SELECT * FROM typed WHERE {having}")
    QUERIES.add(name, sql)(
        lambda spark, sf: plain(run(raw_frame(table(spark, sf, source), columns))))


def t(header: str):
    return header, D.null_like


def i(header: str):
    return header, D.to_int


def d(header: str):
    return header, D.to_date


def dec(precision: int, places: int):
    return lambda header: (header, lambda x: D.to_decimal(x, precision, places))


# I1 people --------------------------------------------------------------------

PEOPLE = {
    "Name and ID": "CASE WHEN c_custkey % 7 = 0 THEN 'Missing' ELSE ' ' || c_name || ' ' END",
    "First Name": "CASE WHEN c_custkey % 21 = 0 THEN '' ELSE 'First' || " + as_text("c_nationkey") + " END",
    "Last Name": "CASE WHEN c_custkey % 42 = 0 THEN '' ELSE c_mktsegment END",
    "Transporter ID": "CASE WHEN c_custkey % 11 = 0 THEN 'None' ELSE 'T' || " + as_text("c_custkey") + " || '|x' END",
    "Position": dirty("c_custkey", "c_mktsegment"),
    "Qualifications": dirty("c_custkey + 1", "'van'"),
    "ID Expiration": date_text("c_custkey", "DATE '2025-09-06'"),
    "Personal Phone Number": blotted("c_custkey", as_text("c_nationkey * 1001")),
    "Email": "c_name || '@example.com'",
    "Status": "CASE WHEN c_acctbal > 0 THEN 'Active' ELSE 'INACTIVE' END",
}

_composed = (f"nullif(trim(concat_ws(' ', {D.name_text('\"First Name\"')}, "
             f"{D.name_text('\"Last Name\"')})), '')")
_pipeline("ingest_people", "customer", PEOPLE, {
    "transporter_id": ("Transporter ID", D.normalize_id),
    "full_name": ("Name and ID", lambda x: f"coalesce({D.name_text(x)}, {_composed})"),
    "position_title": t("Position"), "qualifications": t("Qualifications"),
    "id_expiration_date": d("ID Expiration"), "personal_phone": t("Personal Phone Number"),
    "work_phone": ("Email", lambda x: "CAST(NULL AS VARCHAR)"), "email": t("Email"),
    "working_status": t("Status"),
}, I.ingest_people, "transporter_id IS NOT NULL AND full_name IS NOT NULL")

# I2 routes --------------------------------------------------------------------

_HELPERS = "CASE WHEN o_orderkey % {m} = 0 THEN '|{p}' || " + as_text("o_custkey % {k}") + " ELSE '' END"
ROUTES = {
    "file": "o_orderpriority", "line": "o_orderkey",
    "Route Code": "CASE WHEN o_orderkey % 50 = 7 THEN 'N/A' ELSE 'CX' || " + as_text("o_orderkey % 50") + " END",
    "DSP": "o_orderstatus",
    "Transporter ID": "CASE WHEN o_orderkey % 29 = 0 THEN ' ' ELSE ' D' || " + as_text("o_custkey")
                      + " || " + _HELPERS.format(m=3, p="H", k=17) + " || " + _HELPERS.format(m=4, p=" J", k=400) + " END",
    "Driver Name": "CASE WHEN o_orderkey % 31 = 0 THEN 'missing' ELSE 'name ' || " + as_text("o_custkey")
                   + " || " + _HELPERS.format(m=3, p="aide ", k=17) + " || " + _HELPERS.format(m=5, p="extra ", k=9) + " END",
    "Delivery Service Type": "o_orderpriority",
    "Route Duration": dirty("o_orderkey", whole("o_totalprice")),
    "All Stops": as_text("o_custkey % 190"),
    "Stops Complete": as_text("o_custkey % 90"),
    "Not Started Stops": blotted("o_orderkey", as_text("o_custkey % 100")),
}

_ROUTE_ROWS = f"""
raw AS ({raw_sql("orders", ROUTES)}),
base AS (SELECT file, line, coalesce({D.null_like('"Route Code"')}, '') AS route_code, "DSP" AS dsp_name,
    coalesce({D.split_list(D.null_like('"Transporter ID"'))}, []) AS ids,
    coalesce({D.split_list(D.null_like('"Driver Name"'))}, []) AS names,
    "Delivery Service Type" AS delivery_service_type,
    {D.to_int('"Route Duration"')} AS route_duration_min, {D.to_int('"All Stops"')} AS all_stops,
    {D.to_int('"Stops Complete"')} AS stops_complete,
    {D.to_int('"Not Started Stops"')} AS not_started_stops FROM raw),
spots AS (SELECT *, unnest(range(greatest(len(ids), len(names), 1))) AS participant_index FROM base),
people AS (SELECT * EXCLUDE (ids, names),
    {D.normalize_id("ids[participant_index + 1]")} AS transporter_id,
    {D.null_like("names[participant_index + 1]")} AS driver_name FROM spots),
seen AS (SELECT file, driver_name, count(*) AS n, count(*) FILTER (participant_index > 0) AS late
    FROM people WHERE driver_name IS NOT NULL GROUP BY file, driver_name),
tagged AS (SELECT people.*, CASE WHEN participant_index = 0 OR n IS NULL THEN NULL
    WHEN n = 2 AND late = 1 THEN 'Rescue' WHEN n = late THEN 'Sweeper' END AS helper_tag
    FROM people LEFT JOIN seen USING (file, driver_name)),
counted AS (SELECT *, CASE WHEN participant_index = 0 THEN 0 ELSE 1 END AS is_helper,
    sum(CASE WHEN participant_index > 0 THEN 1 ELSE 0 END) OVER
      (PARTITION BY file, route_code ORDER BY line, participant_index) AS helper_no FROM tagged)
"""


@QUERIES.add("ingest_routes", f"""WITH {_ROUTE_ROWS}
SELECT TIMESTAMP '2025-09-04 14:11:00' AS snapshot_dt,
  CASE WHEN is_helper = 1 THEN route_code || '(' || CAST(helper_no AS BIGINT) || ')' ELSE route_code END AS route_code,
  dsp_name, transporter_id, driver_name, CAST(NULL AS VARCHAR) AS route_progress, delivery_service_type,
  CASE WHEN is_helper = 0 THEN route_duration_min END AS route_duration_min,
  CASE WHEN is_helper = 0 THEN all_stops END AS all_stops,
  CASE WHEN is_helper = 0 THEN stops_complete END AS stops_complete,
  CASE WHEN is_helper = 0 THEN not_started_stops END AS not_started_stops FROM counted""")
def ingest_routes(spark, sf):
    raw = raw_frame(table(spark, sf, "orders"), ROUTES)
    snapshot = F.lit("2025-09-04 14:11:00").cast("timestamp_ntz")
    return I.ingest_routes(raw, snapshot, ["file"], ["line"])


@QUERIES.add("ingest_routes_tagged", f"""WITH {_ROUTE_ROWS}
SELECT line, CASE WHEN is_helper = 1 THEN route_code || '(' || CAST(helper_no AS BIGINT) || ')' ELSE route_code END AS route_code,
  transporter_id, driver_name, coalesce(helper_tag, delivery_service_type) AS delivery_service_type
FROM counted""")
def ingest_routes_tagged(spark, sf):
    """Routes with Rescue and Sweeper tags in place of the helpers' service type."""
    raw = raw_frame(table(spark, sf, "orders"), ROUTES)
    snapshot = F.lit("2025-09-04 14:11:00").cast("timestamp_ntz")
    rows = I.ingest_routes(raw, snapshot, ["file"], ["line"], helper_tags=True, carry=("line",))
    return rows.select("line", "route_code", "transporter_id", "driver_name", "delivery_service_type")


# I3, I4 itineraries -----------------------------------------------------------

_ROUTE_LIST = ("CASE WHEN event_id % 11 = 0 THEN ' ' WHEN value > 30 THEN 'IS' || " + whole("value")
               + " || ', CX' || " + as_text("user_id") + " || '|CX9' WHEN value > 10 THEN ' is' || "
               + whole("value") + " ELSE 'CX' || " + as_text("user_id") + " || ' | CX1' END")
ITINERARY = {
    "Transporter ID": "CASE WHEN event_id % 13 = 0 THEN 'null' ELSE 'U' || " + as_text("user_id") + " || ',x' END",
    "Driver Name": blotted("event_id", "'driver ' || " + as_text("user_id")),
    "DSP": "event_type",
    "DA Activity": dirty("event_id", "event_type"),
    "Route Code": _ROUTE_LIST,
    "Progress Status": "'on time'",
    "Projected Return To Station": dirty("event_id", whole("value")),
    "Projected Overtime Duration (Minutes)": dirty("event_id + 1", whole("value * 2")),
    "Delivery Service Type": "'AMZL'",
    "CORTEX_VIN_NUMBER": "'VIN' || " + as_text("user_id % 40"),
    "All Stops": "'1,' || lpad(" + as_text("event_id % 1000") + ", 3, '0')",
    "Stops Complete": as_text("event_id % 1000"),
    "Not Started Stops": as_text("user_id"),
    "Total Packages": dirty("event_id + 2", as_text("event_id")),
    "CORTEX_AVG_PACE_STOPS_PER_HOUR": dirty("event_id + 3", money("value")),
    "CORTEX_REMAINING_STATE_OF_CHARGE": money("value") + " || '%'",
    "CORTEX_LAST_STOP_EXECUTION_TIME": iso_date("ts") + " || ' 10:05:09.5'",
    "CORTEX_TOTAL_BREAK_TIME_USED": as_text("user_id % 45"),
}
_ITINERARY_ORACLE: dict = {
    "driver_name": t("Driver Name"), "dsp_name": t("DSP"), "da_activity": t("DA Activity"),
    "progress_status": t("Progress Status"), "projected_rts": i("Projected Return To Station"),
    "projected_ot_min": i("Projected Overtime Duration (Minutes)"),
    "delivery_service_type": t("Delivery Service Type"), "cortex_vin_number": t("CORTEX_VIN_NUMBER"),
    "all_stops": i("All Stops"), "stops_complete": i("Stops Complete"),
    "not_started_stops": i("Not Started Stops"), "total_packages": i("Total Packages"),
    "cortex_avg_pace_sph": dec(9, 2)("CORTEX_AVG_PACE_STOPS_PER_HOUR"),
    "cortex_remaining_soc": dec(9, 2)("CORTEX_REMAINING_STATE_OF_CHARGE"),
    "cortex_last_stop_exec_time": ("CORTEX_LAST_STOP_EXECUTION_TIME",
                                   lambda x: D.round_second(D.to_datetime(x))),
    "cortex_total_break_min": i("CORTEX_TOTAL_BREAK_TIME_USED"),
    "station_code": ("Route Code", lambda x: D.route_station(D.null_like(x))),
}
_LIVE = ITINERARY | {"App Sign In:": iso_date("ts") + " || ' 07:30'"}

_pipeline("ingest_itineraries", "events", _LIVE, {
    "file_datetime": ("DSP", lambda x: "TIMESTAMP '2025-09-04 23:51:00'"),
    "transporter_id": ("Transporter ID", D.normalize_id),
    "route_code": t("Route Code"), **_ITINERARY_ORACLE,
    "app_sign_in_time": ("App Sign In:", D.to_datetime),
    "app_sign_out_time": ("DSP", lambda x: "CAST(NULL AS TIMESTAMP)"),
}, lambda raw: I.ingest_itineraries(raw, F.lit("2025-09-04 23:51:00").cast("timestamp_ntz")))

_BACKLOG = ITINERARY | {"Day": date_text("event_id", "ts"), "App Sign In": iso_date("ts") + " || ' 07:30'"}
_BACKLOG_SQL = _select({
    "file_datetime": ("Day", lambda x: f"CAST({D.to_date(x)} AS TIMESTAMP) + INTERVAL 23 HOUR"),
    "transporter_id": ("Transporter ID", lambda x: D.normalize_id(x, "|,")),
    "items": ("Route Code", lambda x: D.split_list(D.null_like(x), "|,")),
    **_ITINERARY_ORACLE, "app_sign_in_time": ("App Sign In", D.to_datetime),
    "app_sign_out_time": ("DSP", lambda x: "CAST(NULL AS TIMESTAMP)"),
})


@QUERIES.add("ingest_backlog", f"""
WITH raw AS ({raw_sql("events", _BACKLOG)}), typed AS (SELECT {_BACKLOG_SQL} FROM raw)
SELECT * EXCLUDE (items), left(unnest(CASE WHEN items IS NULL OR len(items) = 0 THEN [NULL] ELSE items END), 32)
  AS route_code FROM typed WHERE transporter_id IS NOT NULL""")
def ingest_backlog(spark, sf):
    return plain(I.ingest_backlog(raw_frame(table(spark, sf, "events"), _BACKLOG)))


# I5 safety events ---------------------------------------------------------------

SAFETY = {
    "Date": iso_date("ts"), "Delivery Associate": "'driver ' || " + as_text("user_id"),
    "Transporter ID": blotted("event_id", "'U' || " + as_text("user_id")),
    "Event ID": dirty("event_id", as_text("event_id + 5000000000")),
    "Date Time (PDT/PST)": as_text("ts"), "VIN": "'VIN' || " + as_text("user_id % 40"),
    "OSS Impact": "CASE WHEN value > 10 THEN 'Y' ELSE 'N' END", "Metric Type": "event_type",
    "Metric Subtype": blotted("event_id + 2", "event_type"), "Source": "'camera'",
    "Review Details": "props",
}
SAFETY_ORACLE: Oracle = {
    "event_date": d("Date"), "delivery_associate": t("Delivery Associate"),
    "transporter_id": t("Transporter ID"), "event_id": ("Event ID", lambda x: D.to_int(x, "BIGINT")),
    "event_datetime": ("Date Time (PDT/PST)", lambda x: D.round_second(D.to_datetime(x))),
    "vin": t("VIN"), "oss_impact": t("OSS Impact"), "metric_type": t("Metric Type"),
    "metric_subtype": t("Metric Subtype"), "source": t("Source"),
    "video_link": ("Source", lambda x: "CAST(NULL AS VARCHAR)"), "review_details": t("Review Details"),
}
_pipeline("ingest_safety_events", "events", SAFETY, SAFETY_ORACLE, lambda raw: I.ingest_table(S.SAFETY_EVENTS, raw))

# I6 fleet -----------------------------------------------------------------------

FLEET = {
    "VIN": "'VIN' || " + as_text("p_partkey"), "serviceType": "p_type", "vehicleName": "p_name",
    "make": dirty("p_partkey", "p_brand"), "model": "p_name", "status":
    "CASE p_partkey % 3 WHEN 0 THEN 'ACTIVE' WHEN 1 THEN 'INACTIVE' ELSE 'N/A' END",
    "statusPriority": dirty("p_partkey", as_text("p_size")),
    "operationalStatus": "CASE WHEN p_partkey % 4 = 0 THEN 'GROUNDED' ELSE 'OPERATIONAL' END",
    "year": as_text("2015 + p_size % 10"), "ownershipStartDate": date_text("p_partkey", "DATE '2024-02-29'"),
    "registrationExpiryDate": date_text("p_partkey + 1", "DATE '2026-11-03'"),
    "stationCode": "'DSW' || " + as_text("p_size % 9"),
}
_FLEET_ORACLE: Oracle = {
    "vin": t("VIN"), "service_type": t("serviceType"), "vehicle_name": t("vehicleName"),
    "make": t("make"), "model": t("model"), "vehicle_status": t("status"),
    "status_priority": i("statusPriority"), "operational_status": t("operationalStatus"),
    "vehicle_year": i("year"), "ownership_start": d("ownershipStartDate"),
    "registration_expiry": d("registrationExpiryDate"), "station_code": t("stationCode"),
    "ownership_end": ("make", lambda x: "CAST(NULL AS DATE)"),
    **{c: ("make", lambda x: "CAST(NULL AS VARCHAR)") for c in (
        "license_plate", "sub_model", "status_reason_code", "status_reason_msg",
        "status_search_value", "subcontractor_name", "vehicle_provider", "vehicle_reg_type",
        "vehicle_type", "ownership_type", "pm_stats", "registered_state", "service_tier",
        "payload", "cubic_capacity")},
}
_pipeline("ingest_fleet", "part", FLEET, _FLEET_ORACLE, lambda raw: I.ingest_table(S.FLEET, raw))

# I7, I8 overview matrices -------------------------------------------------------
# One matrix row per (event type, user): activity per day or week as messy text.

# The label of an event's column, for Spark and for DuckDB.
DAY = ("CAST(CAST(ts AS date) AS string)", "CAST(CAST(ts AS DATE) AS VARCHAR)")
WEEK = ("concat(extract(YEAROFWEEK FROM ts), '-W', lpad(CAST(weekofyear(ts) AS string), 2, '0'))", "strftime(ts, '%G-W%V')")


def matrix(spark, sf, label: tuple[str, str]) -> DataFrame:
    """All events as a matrix: the first column is the metric, the others one label of the data each."""
    events = table(spark, sf, "events").filter("ts IS NOT NULL").withColumn("label", F.expr(label[0]))
    # the days or weeks of the calendar that the table spans
    labels = [r.label for r in events.select("label").distinct().orderBy("label").collect()]
    metric = F.concat_ws(" ", F.lit(""), "event_type", F.col("user_id").cast("string"))
    counts = events.groupBy(metric.alias("Metric")).agg(*[
        F.count(F.when(F.col("label") == x, 1)).alias(x) for x in labels])
    return counts.select("Metric", *[
        F.when(F.col(f"`{x}`") % 3 == 2, F.concat(F.col(f"`{x}`").cast("string"), F.lit("%%")))
        .when(F.col(f"`{x}`") == 0, " ")
        .otherwise(F.concat(F.lit("1,00"), F.col(f"`{x}`").cast("string"))).alias(x) for x in labels])


_CELL = ("CASE WHEN n % 3 = 2 THEN CAST(n AS DOUBLE) WHEN n = 0 THEN NULL "
         "ELSE CAST('100' || CAST(n AS VARCHAR) AS DOUBLE) END")


def matrix_sql(label: tuple[str, str]) -> str:
    """The matrix in long form: one row per metric and label."""
    return (f"hits AS (SELECT event_type || ' ' || user_id AS metric_name, {label[1]} AS label, count(*) AS n "
            f"FROM events WHERE ts IS NOT NULL GROUP BY ALL), "
            f"metrics AS (SELECT DISTINCT metric_name FROM hits), labels AS (SELECT DISTINCT label FROM hits), "
            f"cells AS (SELECT metric_name, label, {_CELL} AS metric_value FROM "
            f"(SELECT m.metric_name, l.label, coalesce(h.n, 0) AS n FROM metrics m CROSS JOIN labels l "
            f"LEFT JOIN hits h ON h.metric_name = m.metric_name AND h.label = l.label))")


@QUERIES.add("ingest_daily_overview", f"""WITH {matrix_sql(DAY)}
SELECT CAST(label AS DATE) AS metric_date, metric_name, metric_value, 'DailyOverview' AS source_note FROM cells""")
def ingest_daily_overview(spark, sf):
    return plain(I.ingest_daily_overview(melt_matrix(matrix(spark, sf, DAY))))


@QUERIES.add("ingest_weekly_overview", f"""WITH {matrix_sql(WEEK)}
SELECT CAST(left(label, 4) AS INTEGER) AS year, CAST(right(label, 2) AS INTEGER) AS week, metric_name, metric_value,
  'WeeklyOverview' AS source_note FROM cells""")
def ingest_weekly_overview(spark, sf):
    cells = melt_matrix(matrix(spark, sf, WEEK)).withColumn("file", F.length("metric") % 5)
    existing = spark.createDataFrame([], S.WEEKLY_OVERVIEW.schema())
    return plain(I.ingest_weekly_overview(cells, existing, 2030, ["file"]))


# I9 to I20 ----------------------------------------------------------------------

QUALITY = {
    "Reported date": date_text("l_partkey", "l_shipdate"),
    "DA Name": "'S' || " + as_text("l_suppkey"), "Driver ID": blotted("l_partkey", as_text("l_suppkey")),
    "Packages Delivered": dirty("l_partkey", money("l_quantity")),
    "Routes Completed": as_text("l_linenumber"),
    "DCR": dirty("l_partkey", money("100 - l_discount * 100")),
    "POD": money("100 - l_tax * 100") + " || '%%'",
    "DSB Count": "CASE WHEN l_linenumber = 2 THEN '3%' ELSE '1,002' END",
}
_pipeline("ingest_quality_daily", "lineitem", QUALITY, {
    "metric_date": d("Reported date"), "delivery_associate": t("DA Name"), "transporter_id": t("Driver ID"),
    "packages_delivered": ("Packages Delivered", lambda x: D.opt_int(D.plain_number(x))),
    "routes_completed": ("Routes Completed", lambda x: D.opt_int(D.plain_number(x))),
    "dcr_percent": ("DCR", D.percent_number), "pod_percent": ("POD", D.percent_number),
    "dsb_count": ("DSB Count", lambda x: D.opt_int(D.plain_number(x))),
}, I.ingest_quality_daily, "metric_date IS NOT NULL")

_WEEK_TEXT = as_text("year(l_shipdate)") + " || '-' || lpad(" + as_text("l_linenumber * 7") + ", 2, '0')"
DAILY_SCORE = {
    "Week": _WEEK_TEXT, "Delivery Associate Name": "'S' || " + as_text("l_suppkey"),
    "Delivery Associate ID": as_text("l_suppkey"),
    "Delivered Packages": dirty("l_partkey", whole("l_quantity")),
    "Packages Delivered Not Received (DNR)": whole("l_tax * 100"),
    "DSB Count": "'3.0'", "DSB DPMO": as_text("l_partkey"),
    "Dispatched Packages": "'1,' || lpad(" + whole("l_quantity") + ", 3, '0')",
    "Packages Returned to Station (RTS)": blotted("l_partkey", as_text("l_linenumber")),
    "Packages Returned to Station (RTS) %": dirty("l_orderkey", money("l_discount * 100")),
    "Return to Station DPMO": "'-'",
}
_pipeline("ingest_daily_scorecard", "lineitem", DAILY_SCORE, {
    "week_label": t("Week"), "delivery_associate_name": t("Delivery Associate Name"),
    "delivery_associate_id": t("Delivery Associate ID"), "delivered_packages": i("Delivered Packages"),
    "packages_dnr": i("Packages Delivered Not Received (DNR)"), "dsb_count": i("DSB Count"),
    "dsb_dpmo": i("DSB DPMO"), "dispatched_packages": i("Dispatched Packages"),
    "packages_rts": i("Packages Returned to Station (RTS)"),
    "packages_rts_percent": dec(9, 4)("Packages Returned to Station (RTS) %"),
    "rts_dpmo": i("Return to Station DPMO"),
}, lambda raw: I.ingest_table(S.DAILY_SCORECARD, raw))

_STATION = {
    "DSP": "'N' || " + as_text("l_suppkey % 25"), "Dispatched Packages": whole("l_quantity * 10"),
    "Delivered Packages": dirty("l_partkey", whole("l_quantity")),
    "Delivered Not Received (DNR)": whole("l_tax * 100"), "DNR DPMO": as_text("l_partkey"),
    "Returned to Station (RTS)": blotted("l_partkey", as_text("l_linenumber")),
    "RTS %": dirty("l_orderkey", money("l_discount * 100")), "RTS DPMO": "'12'",
}
_STATION_ORACLE: Oracle = {
    "dsp_code": t("DSP"), "dispatched_pkg": i("Dispatched Packages"),
    "delivered_pkg": i("Delivered Packages"), "dnr": i("Delivered Not Received (DNR)"),
    "dnr_dpmo": i("DNR DPMO"), "rts": i("Returned to Station (RTS)"),
    "rts_percent": dec(6, 3)("RTS %"), "rts_dpmo": i("RTS DPMO"),
}
_pipeline("ingest_station_daily", "lineitem", {"Date": date_text("l_partkey", "l_shipdate"), **_STATION},
          {"metric_date": d("Date"), **_STATION_ORACLE}, lambda raw: I.ingest_table(S.STATION_DAILY, raw))
_pipeline("ingest_station_weekly", "lineitem", {"Week": _WEEK_TEXT, **_STATION},
          {"iso_year_week": ("Week", D.week_label), **_STATION_ORACLE},
          lambda raw: I.ingest_table(S.STATION_WEEKLY, raw))

DELIVERED = {
    "Date": date_text("l_partkey", "l_shipdate"), "Station": "'Hub (n' || " + as_text("l_suppkey % 25") + " || ')'",
    "DSP Short Code": "'SFNL'", "Package Count": dirty("l_partkey", whole("l_quantity")),
    "Package Details": blotted("l_partkey", "l_linestatus"), "Package Type":
    "CASE l_returnflag WHEN 'N' THEN 'Delivered Package' WHEN 'A' THEN 'Pickup incentive' ELSE l_returnflag END",
}
_pipeline("ingest_delivered", "lineitem", DELIVERED, {
    "metric_date": d("Date"), "station": t("Station"), "dsp_short_code": t("DSP Short Code"),
    "package_count": i("Package Count"), "package_details": t("Package Details"),
    "package_type": t("Package Type"),
}, lambda raw: I.ingest_table(S.DELIVERED_PACKAGES, raw))

SERVICE = {
    "Date": iso_date("l_shipdate"), "Station": "'Hub (n' || " + as_text("l_suppkey % 25") + " || ')'",
    "DSP Short Code": "'SFNL'", "Delivery Associate": blotted("l_partkey", "'s' || " + as_text("l_suppkey")),
    "Route": "'CX' || " + as_text("l_orderkey"), "Service Type": "l_returnflag",
    "Planned Duration": as_text("l_linenumber + 4") + " || ' hr'",
    "Log In": iso_date("l_shipdate") + " || ' 07:' || lpad(" + as_text("l_partkey % 60") + ", 2, '0')",
    "Log Out": "CASE WHEN l_partkey % 9 = 0 THEN 'open' ELSE " + as_text("month(l_shipdate)") + " || '/' || "
               + as_text("day(l_shipdate)") + " || '/' || " + as_text("year(l_shipdate)") + " || ' 05:30 PM' END",
    "Total Distance Planned": dirty("l_partkey", whole("l_quantity * 3")),
    "Total Distance Allowance": whole("l_quantity * 4"), "Distance Unit": "'mi'",
    "Shipments Delivered": whole("l_quantity"), "Shipments Returned": as_text("l_linenumber"),
    "Pickup Packages": "''", "Excluded?": "CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 'Y' ELSE 'N/A' END",
}
_pipeline("ingest_service_details", "lineitem", SERVICE, {
    "row_date": d("Date"), "station": t("Station"), "dsp_short_code": t("DSP Short Code"),
    "delivery_associate": t("Delivery Associate"), "route_code": t("Route"),
    "service_type": t("Service Type"), "planned_duration_label": t("Planned Duration"),
    "login_ts": ("Log In", D.to_datetime), "logout_ts": ("Log Out", D.to_datetime),
    "total_distance_planned": i("Total Distance Planned"),
    "total_distance_allow": i("Total Distance Allowance"), "distance_unit": t("Distance Unit"),
    "shipments_delivered": i("Shipments Delivered"), "shipments_returned": i("Shipments Returned"),
    "pickup_packages": i("Pickup Packages"), "excluded_flag": t("Excluded?"),
}, lambda raw: I.ingest_table(S.SERVICE_DETAILS, raw))

TRAINING = {
    "Assignment Date": iso_date("o_orderdate"), "Payment Date": date_text("o_orderkey", "o_orderdate"),
    "Station": "'Hub (n' || " + as_text("o_custkey % 25") + " || ')'", "DSP Short Code": "'SFNL'",
    "Delivery Associate": "'C' || " + as_text("o_custkey"), "Service Type": "o_orderpriority",
    "Course Name": blotted("o_orderkey", "o_orderstatus"),
    "Total Duration": "CASE WHEN o_orderkey % 10 = 0 THEN 'none' ELSE " + as_text("o_orderkey % 12") + " || ' Hr' END",
    "DSP Payment Eligible": "CASE WHEN o_orderkey % 2 = 0 THEN 'yes' ELSE 'no' END",
}
_pipeline("ingest_training", "orders", TRAINING, {
    "assignment_date": d("Assignment Date"), "payment_date": d("Payment Date"), "station": t("Station"),
    "dsp_short_code": t("DSP Short Code"), "delivery_associate": t("Delivery Associate"),
    "service_type": t("Service Type"), "course_name": t("Course Name"),
    "chapter_name": ("Station", lambda x: "CAST(NULL AS VARCHAR)"),
    "total_duration_label": t("Total Duration"),
    "total_hours": ("Total Duration", lambda x: D.hours_label(D.null_like(x))),
    "dsp_payment_eligible": t("DSP Payment Eligible"),
}, lambda raw: I.ingest_table(S.TRAINING, raw))

DELAY = {
    "Date": date_text("o_orderkey", "o_orderdate"), "Station": "'n' || " + as_text("o_custkey % 25"),
    "DSP Short Code": "'SFNL'", "Unplanned Delay": "o_orderpriority",
    "Total Delay In Minutes": dirty("o_orderkey", whole("o_totalprice")),
    "Impacted Routes": as_text("o_custkey % 9"), "Notes": blotted("o_orderkey", "'late, ' || o_orderstatus"),
}
_pipeline("ingest_delay", "orders", DELAY, {
    "row_date": d("Date"), "station": t("Station"), "dsp_short_code": t("DSP Short Code"),
    "unplanned_delay": t("Unplanned Delay"), "total_delay_min": i("Total Delay In Minutes"),
    "impacted_routes": i("Impacted Routes"), "notes": t("Notes"),
}, lambda raw: I.ingest_table(S.UNPLANNED_DELAY, raw))

WORK = {
    "Date": iso_date("o_orderdate"), "Station": "'Hub (n' || " + as_text("o_custkey % 25") + " || ')'",
    "DSP Short Code": "'SFNL'", "Service Type": "o_orderpriority",
    "Planned Duration": as_text("o_orderkey % 12") + " || ' hr'",
    "Total Distance Planned": dirty("o_orderkey", whole("o_totalprice")),
    "Total Distance Allowance": whole("o_totalprice"), "Planned Distance Unit": "'mi'",
    "AMZL Late Cancel": dirty("o_custkey", as_text("o_orderkey % 4")),
    "DSP Late Cancel": as_text("o_orderkey % 2"), "Quick Coverage": "'NA'",
    "Accepted": blotted("o_orderkey", "'yes'"), "Completed Routes": as_text("o_custkey % 8"),
}
_pipeline("ingest_weekly_work", "orders", WORK, {
    "row_date": d("Date"), "station": t("Station"), "dsp_short_code": t("DSP Short Code"),
    "service_type": t("Service Type"), "planned_duration_label": t("Planned Duration"),
    "total_distance_planned": i("Total Distance Planned"),
    "total_distance_allow": i("Total Distance Allowance"),
    "planned_distance_unit": t("Planned Distance Unit"), "amzl_late_cancel": t("AMZL Late Cancel"),
    "dsp_late_cancel": t("DSP Late Cancel"), "quick_coverage": t("Quick Coverage"),
    "accepted": t("Accepted"), "completed_routes": i("Completed Routes"),
}, lambda raw: I.ingest_table(S.WEEKLY_WORK, raw))

# One scorecard row per event: metrics spread by its value and ids.
_RATE = money("value % 4")
WEEKLY_SCORE = {
    "Week": "'2024-W' || lpad(" + as_text("day(ts) % 53 + 1") + ", 2, '0')",
    "Delivery Associate": "'driver ' || " + as_text("user_id"), "Transporter ID": as_text("user_id"),
    "Overall Standing": "event_type",
    "Overall Score": "CASE event_id % 5 WHEN 0 THEN '-' WHEN 1 THEN 'score ' || " + money("value % 100")
                     + " || ' ok' ELSE " + money("value % 100") + " END",
    "FICO Metric": as_text("event_id % 300 + 550"), "FICO Tier": "'Great'", "FICO Score": _RATE,
    "Speeding Event Rate (per trip)": dirty("event_id", _RATE),
    "Speeding Event Rate Tier": blotted("event_id", "event_type"), "Speeding Event Rate Score": _RATE,
    "Seatbelt-Off Rate (per trip)": dirty("event_id + 1", _RATE),
    "Distractions Rate (per trip)": _RATE,
    "Sign / Signal Violations Rate (per trip)": dirty("event_id + 2", _RATE),
    "Sign/Signal Violations Rate Tier": "'Fair'",
    "Following Distance Rate (per trip)": _RATE,
    "CDF DPMO": whole("value * 20"), "CED": dirty("event_id + 3", money("value")),
    "DCR": money("100 - value % 5") + " || '%'", "DSB": whole("value * 2"), "DSB DPMO Tier": "'Poor'",
    "POD": dirty("event_id + 4", money("100 - value % 7")), "PSB": money("value % 12"),
    "Packages Delivered": "CASE event_id % 3 WHEN 0 THEN '1,200' WHEN 1 THEN '12.0' ELSE " + as_text("event_id") + " END",
}


def _scorecard_oracle() -> Oracle:
    out: dict = {
        "year_week_label": t("Week"), "delivery_associate_name": t("Delivery Associate"),
        "transporter_id": t("Transporter ID"), "overall_standing": t("Overall Standing"),
        "overall_score": ("Overall Score", lambda x: D.num_dec(x, 6, 2)),
        "fico_metric": t("FICO Metric"), "fico_tier": t("FICO Tier"), "fico_score": dec(6, 2)("FICO Score"),
    }
    for column, header in {
        "speeding_event_rate": "Speeding Event Rate (per trip)",
        "seatbelt_off_rate": "Seatbelt-Off Rate (per trip)",
        "distractions_rate": "Distractions Rate (per trip)",
        "sign_signal_viol_rate": "Sign / Signal Violations Rate (per trip)",
        "following_dist_rate": "Following Distance Rate (per trip)"}.items():
        out[column] = dec(9, 4)(header)
    for column, header in {"cdf_dpmo": "CDF DPMO", "ced_metric": "CED", "dcr_metric": "DCR",
                           "dsb_metric": "DSB", "pod_metric": "POD", "psb_metric": "PSB"}.items():
        out[column] = dec(9, 2)(header)
    out |= {
        "speeding_event_rate_tier": t("Speeding Event Rate Tier"),
        "speeding_event_rate_score": dec(6, 2)("Speeding Event Rate Score"),
        "sign_signal_viol_rate_tier": t("Sign/Signal Violations Rate Tier"),
        "dsb_dpmo_tier": t("DSB DPMO Tier"), "packages_delivered": ("Packages Delivered", D.strict_int),
    }
    nothing = ("Week", lambda x: "CAST(NULL AS VARCHAR)")
    no_score = ("Week", lambda x: "CAST(NULL AS DOUBLE)")
    out |= {f"{c}_tier": nothing for c in (
        "seatbelt_off_rate", "distractions_rate", "following_dist_rate", "cdf_dpmo", "ced", "dcr", "pod", "psb")}
    out |= {f"{c}_score": no_score for c in (
        "seatbelt_off_rate", "distractions_rate", "sign_signal_viol_rate", "following_dist_rate",
        "cdf_dpmo", "ced", "dcr", "dsb_dpmo", "pod", "psb")}
    return out


SCORECARD_ORACLE = _scorecard_oracle()
_pipeline("ingest_weekly_scorecard", "events", WEEKLY_SCORE, SCORECARD_ORACLE,
          lambda raw: I.ingest_table(S.WEEKLY_SCORECARD, raw))


def scorecard_rows(spark, sf) -> DataFrame:
    return I.ingest_table(S.WEEKLY_SCORECARD, raw_frame(table(spark, sf, "events"), WEEKLY_SCORE))


SCORECARD_SQL = (f"raw AS ({raw_sql('events', WEEKLY_SCORE)}), "
                 f"scorecard AS (SELECT {_select(SCORECARD_ORACLE)} FROM raw)")

TENURE = {
    "Row ID": as_text("o_orderkey"), "DSP": "'SFNL'", "Station": "' DSW' || " + as_text("o_custkey % 9"),
    "Year": as_text("year(o_orderdate)"), "Week": as_text("o_orderkey % 52 + 1"),
    "Employee ID": as_text("o_custkey + 70000"), "Transporter ID": "' T' || " + as_text("o_custkey") + " || ' '",
    "Name": "'name ' || " + as_text("o_custkey"), "Days Since Last Delivered": dirty("o_orderkey", as_text("o_custkey % 90")),
    "Delivery Status": "'N/A'", "Driver Status": "CASE WHEN o_orderstatus = 'O' THEN 'Active' ELSE 'Offboarded' END",
    "Driver Status Reason Code": "''", "Lifetime Routes": whole("o_totalprice"),
    "Routes In Week": "CASE WHEN o_orderkey % 8 = 0 THEN '1,000' ELSE " + as_text("o_orderkey % 7") + " END",
    "Tenure Status": "CASE WHEN o_totalprice > 100000 THEN 'Tenured' ELSE 'Not Tenured' END", "Country": "'US'",
}
TENURE_ORACLE: Oracle = {
    "row_id": ("Row ID", D.strict_int), "dsp": ("DSP", D.blank_to_null), "station": ("Station", D.blank_to_null),
    "year": ("Year", D.strict_int), "week": ("Week", D.strict_int),
    "employee_id": ("Employee ID", D.blank_to_null), "transporter_id": ("Transporter ID", D.blank_to_null),
    "name": ("Name", D.blank_to_null), "days_since_last_delivered": ("Days Since Last Delivered", D.strict_int),
    "delivery_status": ("Delivery Status", D.blank_to_null), "driver_status": ("Driver Status", D.blank_to_null),
    "driver_status_reason_code": ("Driver Status Reason Code", D.blank_to_null),
    "lifetime_routes": ("Lifetime Routes", D.strict_int), "routes_in_week": ("Routes In Week", D.strict_int),
    "tenure_status": ("Tenure Status", D.blank_to_null), "country": ("Country", D.blank_to_null),
}
_pipeline("ingest_tenure_report", "orders", TENURE, TENURE_ORACLE,
          lambda raw: I.ingest_table(S.TENURE_REPORT, raw))


def tenure_rows(spark, sf) -> DataFrame:
    return I.ingest_table(S.TENURE_REPORT, raw_frame(table(spark, sf, "orders"), TENURE))


TENURE_SQL = f"raw AS ({raw_sql('orders', TENURE)}), report AS (SELECT {_select(TENURE_ORACLE)} FROM raw)"

# Rates: one export row per order, station and type from its keys.
RATE = {
    "Station": "CASE o_custkey % 26 WHEN 25 THEN ' ' ELSE 'Hub (n' || " + as_text("o_custkey % 26") + " || ')' END",
    "Service_type": "CASE o_orderkey % 4 WHEN 0 THEN 'Any Package ' || o_orderstatus WHEN 1 THEN 'incentives' "
                    "WHEN 2 THEN 'Amazon Cancellation' ELSE o_orderpriority END",
    "Billable hours": "'8'",
    "revenue_rate": "CASE WHEN o_orderkey % 9 = 0 THEN ' ' ELSE " + money("o_totalprice") + " END",
}
RATE_ORACLE: Oracle = {
    "station_code": ("Station", D.station_code), "service_type": ("Service_type", D.service_type),
    "revenue_rate": ("revenue_rate", lambda x: D.to_float(x)),
}
_pipeline("ingest_rates", "orders", RATE, {
    "iso_year_week": ("Station", lambda x: "'2025-W36'"), **RATE_ORACLE,
}, lambda raw: I.ingest_rates(raw, "2025-W36"),
    "station_code IS NOT NULL AND service_type IS NOT NULL AND revenue_rate IS NOT NULL")
