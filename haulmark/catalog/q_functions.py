"""Scalar functions applied to whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

from haulmark import functions as H
from haulmark.catalog import duck as D
from haulmark.catalog.base import (
    Registry, as_text, date_text, dirty, money, plain, raw_frame, raw_sql, table, whole,
)

QUERIES = Registry()

_LINE = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "price": dirty("l_partkey", money("l_extendedprice")),
    "qty": dirty("l_partkey + l_suppkey", whole("l_quantity")),
    "grouped": "CASE WHEN l_linenumber % 2 = 0 THEN '1,' || " + money("l_extendedprice % 1000 + 1000")
               + " ELSE 'score ' || " + money("l_discount * 100") + " || ' ok' END",
}


def _scalar(name: str, source: str, raw: dict[str, str], keep: tuple[str, ...],
            outputs: dict[str, tuple[Callable[[], Column], str]]) -> None:
    """Register a query that keeps some columns and applies functions to others."""
    columns = [*(f'"{k}"' for k in keep), *(f"{sql} AS {out}" for out, (_, sql) in outputs.items())]
    sql = f"WITH raw AS ({raw_sql(source, raw)}) SELECT {', '.join(columns)} FROM raw"

    def run(spark, sf):
        frame = raw_frame(table(spark, sf, source), raw)
        return plain(frame.select(*keep, *[make().alias(o) for o, (make, _) in outputs.items()]))

    QUERIES.add(name, sql)(run)


def _c(name: str) -> Column:
    return F.col(name)


_KEYS = ("l_orderkey", "l_linenumber")

_scalar("fn_null_like", "lineitem", _LINE, _KEYS, {
    "price_text": (lambda: H.null_like(_c("price")), D.null_like("price")),
    "qty_text": (lambda: H.null_like(_c("qty")), D.null_like("qty")),
})
_scalar("fn_to_int", "lineitem", _LINE, _KEYS, {
    "qty_int": (lambda: H.to_int(_c("qty")), D.to_int("qty")),
    "price_int": (lambda: H.to_int(_c("price")), D.to_int("price")),
})
_scalar("fn_to_decimal", "lineitem", _LINE, _KEYS, {
    "price_dec": (lambda: H.to_decimal(_c("price"), 18, 1), D.to_decimal("price", 18, 1)),
    "qty_dec": (lambda: H.to_decimal(_c("qty"), 9, 4), D.to_decimal("qty", 9, 4)),
})
_scalar("fn_num_dec", "lineitem", _LINE, _KEYS, {
    "grouped_dec": (lambda: H.num_dec(_c("grouped")), D.num_dec("grouped")),
    "price_dec": (lambda: H.num_dec(_c("price")), D.num_dec("price")),
})
_scalar("fn_to_float", "lineitem", _LINE, _KEYS, {
    "price_float": (lambda: H.to_float(_c("price")), D.to_float("price")),
})
_scalar("fn_percent", "lineitem", {**_LINE, "qty": dirty("l_partkey", whole("l_quantity") + " || '%'")}, _KEYS, {
    "price_pct": (lambda: H.percent_number(_c("price")), D.percent_number("price")),
    "qty_pct": (lambda: H.percent_number(_c("qty")), D.percent_number("qty")),
})
_scalar("fn_opt_int", "lineitem", _LINE, _KEYS, {
    "price_whole": (lambda: H.opt_int(H.plain_number(_c("price"))), D.opt_int(D.plain_number("price"))),
    "qty_strict": (lambda: H.strict_int(_c("qty")), D.strict_int("qty")),
})

_DATES = {
    "o_orderkey": "o_orderkey",
    "day": date_text("o_orderkey", "o_orderdate"),
    "moment": "CASE o_orderkey % 4 WHEN 0 THEN " + as_text("CAST(o_orderdate AS date)")
              + " || ' ' || lpad(" + as_text("o_custkey % 24") + ", 2, '0') || ':05:09.25'"
              + " WHEN 1 THEN " + as_text("month(o_orderdate)") + " || '/' || " + as_text("day(o_orderdate)")
              + " || '/' || " + as_text("year(o_orderdate)") + " || ' ' || lpad(" + as_text("o_custkey % 24")
              + ", 2, '0') || ':30'"
              + " WHEN 2 THEN " + as_text("month(o_orderdate)") + " || '/' || " + as_text("day(o_orderdate)")
              + " || '/' || " + as_text("year(o_orderdate)") + " || ' ' || lpad(" + as_text("o_custkey % 12 + 1")
              + ", 2, '0') || ':07 PM'"
              + " ELSE 'later' END",
    "serial": "CASE WHEN o_orderkey % 2 = 0 THEN " + as_text("34700 + o_custkey % 3000") + " ELSE "
              + date_text("o_orderkey", "o_orderdate") + " END",
}
_scalar("fn_to_date", "orders", _DATES, ("o_orderkey",), {
    "order_day": (lambda: H.to_date(_c("day")), D.to_date("day")),
})
_scalar("fn_to_datetime", "orders", _DATES, ("o_orderkey",), {
    "order_moment": (lambda: H.to_datetime(_c("moment")), D.to_datetime("moment")),
    "order_second": (lambda: H.round_to_second(H.to_datetime(_c("moment"))),
                     D.round_second(D.to_datetime("moment"))),
})
_scalar("fn_day_stamp", "orders", _DATES, ("o_orderkey",), {
    "stamp": (lambda: H.day_stamp(_c("serial")),
              r"CASE WHEN regexp_full_match(serial, '\d{1,6}') THEN CAST(DATE '1899-12-30' + CAST(serial AS INTEGER) AS TIMESTAMP) "
              f"+ INTERVAL 23 HOUR ELSE CAST({D.to_date('serial')} AS TIMESTAMP) + INTERVAL 23 HOUR END"),
})

_LABELS = {
    "p_partkey": "p_partkey",
    "hours": "CASE p_partkey % 3 WHEN 0 THEN " + as_text("p_size") + " || ' hr' WHEN 1 THEN "
             + as_text("p_size") + " || 'HR route' ELSE p_type END",
    "station": "CASE p_partkey % 4 WHEN 0 THEN p_name || ' (dsw' || " + as_text("p_size % 9")
               + " || ')' WHEN 1 THEN 'at dsw' || " + as_text("p_size") + " || ' hub' WHEN 2 THEN '  ' || p_name "
               "|| ' ' ELSE p_brand || ' the long name of a station that is cut off' END",
    "route": "CASE p_partkey % 5 WHEN 0 THEN 'is' || " + as_text("p_size") + " WHEN 1 THEN ' IS' || "
             + as_text("p_size") + " WHEN 2 THEN NULL ELSE 'CX' || " + as_text("p_size") + " END",
    "person": "CASE p_partkey % 6 WHEN 0 THEN ' A' || " + as_text("p_partkey") + " || ' | B2 ' WHEN 1 THEN 'N/A' "
              "WHEN 2 THEN 'None' WHEN 3 THEN 'a' || " + as_text("p_size") + " || ',b' WHEN 4 THEN '  ' ELSE p_name END",
    "items": "CASE p_partkey % 4 WHEN 0 THEN ' a | ' || p_brand || '||c' WHEN 1 THEN '|' || p_type || '|' "
             "WHEN 2 THEN ' ' ELSE 'x, ' || p_name || '|y' END",
    "week": "CASE p_partkey % 4 WHEN 0 THEN '2025-' || lpad(" + as_text("p_size") + ", 2, '0') WHEN 1 THEN '2025-W'"
            " || lpad(" + as_text("p_size") + ", 2, '0') WHEN 2 THEN 'Week ' || " + as_text("p_size") + " ELSE ' ' END",
    "kind": "CASE p_partkey % 4 WHEN 0 THEN 'Delivered Package ' || p_type WHEN 1 THEN p_type || ' incentives' "
            "WHEN 2 THEN ' 10Hr Rt ' ELSE p_type END",
}
_scalar("fn_hours_label", "part", _LABELS, ("p_partkey",), {
    "hours": (lambda: H.hours_label(_c("hours")), D.hours_label("hours")),
})
_scalar("fn_station_code", "part", _LABELS, ("p_partkey",), {
    "station_code": (lambda: H.station_code(_c("station")), D.station_code("station")),
})
_scalar("fn_route_station", "part", _LABELS, ("p_partkey",), {
    "station_code": (lambda: H.route_station(_c("route")), D.route_station("route")),
})
_scalar("fn_normalize_id", "part", _LABELS, ("p_partkey",), {
    "live_id": (lambda: H.normalize_id(_c("person")), D.normalize_id("person")),
    "backlog_id": (lambda: H.normalize_id(_c("person"), separators="|,"), D.normalize_id("person", "|,")),
})
_scalar("fn_length_strategy", "part", _LABELS, ("p_partkey",), {
    "cut": (lambda: H.limit_length(_c("station"), 12), "left(station, 12)"),
    "checked": (lambda: H.limit_length(_c("kind"), 200, "error", "kind"), "kind"),
})
_scalar("fn_split_list", "part", _LABELS, ("p_partkey",), {
    "pipe_items": (lambda: F.concat_ws(";", H.split_list(_c("items"))),
                   f"array_to_string({D.split_list('items')}, ';')"),
    "any_items": (lambda: F.concat_ws(";", H.split_list(_c("items"), "|,")),
                  f"array_to_string({D.split_list('items', '|,')}, ';')"),
    "n_items": (lambda: F.size(H.split_list(_c("items"))).cast("bigint"), f"len({D.split_list('items')})"),
})
_scalar("fn_week_label", "part", _LABELS, ("p_partkey",), {
    "week_label": (lambda: H.week_label(_c("week")), D.week_label("week")),
    "label_year": (lambda: H.label_year(H.week_label(_c("week"))),
                   D.strict_int(f"left({D.week_label('week')}, 4)")),
    "last_number": (lambda: H.trailing_digits(H.week_label(_c("week"))),
                    D.trailing_digits(D.week_label("week"))),
})
_scalar("fn_service_type", "part", _LABELS, ("p_partkey",), {
    "service_type": (lambda: H.service_type(_c("kind")), D.service_type("kind")),
})

_ORDER_DAY = {"o_orderkey": "o_orderkey", "d": "CAST(o_orderdate AS date)"}
_scalar("fn_iso_week", "orders", _ORDER_DAY, ("o_orderkey",), {
    "iso_week": (lambda: H.iso_week_label(_c("d")), D.iso_week("d")),
})
_scalar("fn_week_bounds", "orders", _ORDER_DAY, ("o_orderkey",), {
    "monday": (lambda: H.week_monday(_c("d")), "CAST(date_trunc('week', d) AS DATE)"),
    "sunday": (lambda: H.week_sunday(_c("d")), "CAST(date_trunc('week', d) AS DATE) + 6"),
})
_scalar("fn_week_monday", "orders", _ORDER_DAY, ("o_orderkey",), {
    "monday": (lambda: H.label_monday(H.iso_week_label(_c("d"))), "CAST(date_trunc('week', d) AS DATE)"),
})
_scalar("fn_date_parts", "orders", _ORDER_DAY, ("o_orderkey",), {
    "year": (lambda: F.year("d"), "CAST(year(d) AS INTEGER)"),
    "month": (lambda: F.month("d"), "CAST(month(d) AS INTEGER)"),
    "day_of_month": (lambda: F.dayofmonth("d"), "CAST(day(d) AS INTEGER)"),
    "day_name": (lambda: F.date_format("d", "EEEE"), "dayname(d)"),
    "iso_week": (lambda: F.weekofyear("d"), "CAST(weekofyear(d) AS INTEGER)"),
})

# File names over every naming rule, with dates that are sometimes impossible.
FILE_NAME = (
    "CASE o_orderkey % 14 WHEN 0 THEN 'AssociateData.csv' "
    "WHEN 1 THEN 'Routes_DSW3_' || {d} || '_14_11 (PDT).csv' "
    "WHEN 2 THEN 'DSP_Overview_Dashboard_' || {w} || '.csv' "
    "WHEN 3 THEN 'Itineraries_DSW3_' || {d} || '_23-' || {n} || '.xlsx' "
    "WHEN 4 THEN 'Safety_Dashboard_' || o_orderstatus || '.csv' "
    "WHEN 5 THEN 'x_VehiclesData_' || o_orderstatus || '.xlsm' "
    "WHEN 6 THEN 'DSP_Delivery_Overview_ALL_' || {d} || '.csv' "
    "WHEN 7 THEN 'DSP_Associates_Concessions_DSW3_' || {d} || '.csv' "
    "WHEN 8 THEN 'Station_Level_Metrics_' || {d} || '.csv' "
    "WHEN 9 THEN 'Station_Level_Metrics_' || {w} || '.csv' "
    "WHEN 10 THEN 'DSP_Delivery_Overview_ALL_' || {w} || '.csv' "
    "WHEN 11 THEN 'x_Tenure_Workforce_DAS_Report.csv' "
    "WHEN 12 THEN 'Routes_DSW2_2025-' || {n} || '-31_7:05:59.csv' "
    "ELSE 'notes_' || {d} || '.txt' END"
).format(
    d=as_text("CAST(o_orderdate AS date)"),
    w=as_text("year(o_orderdate)") + " || '-W' || lpad(" + as_text("o_custkey % 52 + 1") + ", 2, '0')",
    n="lpad(" + as_text("o_custkey % 70") + ", 2, '0')")

FILES = {"o_orderkey": "o_orderkey", "file_name": FILE_NAME}

_FILE_TIME = r"(\d{4})[-_](\d{2})[-_](\d{2})[_\-\s](\d{1,2})[:_\-](\d{2})(?:[:_\-](\d{2}))?"


def _file_part(i: int) -> str:
    return f"regexp_extract(file_name, '{_FILE_TIME}', {i})"


_scalar("filename_timestamp", "orders", FILES, ("o_orderkey", "file_name"), {
    "file_datetime": (
        lambda: H.filename_timestamp(_c("file_name")),
        f"try_cast({_file_part(1)} || '-' || {_file_part(2)} || '-' || {_file_part(3)} || ' ' || "
        f"lpad({_file_part(4)}, 2, '0') || ':' || {_file_part(5)} || ':' || "
        f"coalesce(nullif({_file_part(6)}, ''), '00') AS TIMESTAMP)"),
})
_scalar("filename_week_year", "orders", FILES, ("o_orderkey", "file_name"), {
    "file_year": (lambda: H.filename_week_year(_c("file_name")),
                  r"CAST(nullif(regexp_extract(lower(file_name), '(\d{4})-w(\d{1,2})', 1), '') AS INTEGER)"),
})

_VALUES = {
    "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "v": "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE CAST(l_quantity + l_discount * 10 AS decimal(18,4)) END",
}


def _band(op: str) -> str:
    return (f"CASE WHEN v IS NULL THEN NULL WHEN v {op} 40 THEN 1.0 WHEN v {op} 25 THEN 0.8 "
            f"WHEN v {op} 10 THEN 0.6 ELSE 0.4 END")


_scalar("score_higher", "lineitem", _VALUES, _KEYS, {
    "score": (lambda: H.score_higher(_c("v"), F.lit(40), F.lit(25), F.lit(10)),
              f"CAST({_band('>=')} AS DOUBLE)"),
})
_scalar("score_lower", "lineitem", _VALUES, _KEYS, {
    "score": (lambda: H.score_lower(_c("v"), F.lit(10), F.lit(25), F.lit(40)),
              "CAST(CASE WHEN v IS NULL THEN NULL WHEN v <= 10 THEN 1.0 WHEN v <= 25 THEN 0.8 "
              "WHEN v <= 40 THEN 0.6 ELSE 0.4 END AS DOUBLE)"),
})
_scalar("safe_divide", "lineitem", {
    **_VALUES, "a": "l_extendedprice", "b": "CASE WHEN l_linenumber = 3 THEN 0 ELSE l_quantity END"}, _KEYS, {
    "ratio": (lambda: H.safe_divide(_c("a"), _c("b")), "a / nullif(b, 0)"),
})

_EVENT_KEYS = {
    "event_id": "event_id", "id": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END",
    "moment": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE CAST(ts AS date) END",
    "person": "CASE WHEN event_id % 5 = 0 THEN NULL ELSE ' u' || " + as_text("user_id") + " || ' ' END",
    "kind": "event_type",
}
_scalar("row_signature", "events", _EVENT_KEYS, ("event_id",), {
    "row_sig": (
        lambda: H.row_signature(H.id_text(_c("id")), H.time_text(_c("moment")),
                                H.key_text(_c("person")), H.key_text(_c("kind"))),
        D.signature(["coalesce(CAST(id AS VARCHAR), '#NOID#')", D.time_text("moment"),
                     D.key_text("person"), D.key_text("kind")])),
})
