"""Row shaping, filters, joins and ordinals."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark import functions as H
from haulmark.catalog import duck as D
from haulmark.catalog.base import Registry, as_text, blotted, plain, raw_frame, raw_sql, table
from haulmark.catalog.q_ingest import (
    DAY, ROUTES, SERVICE, WEEK, _ROUTE_ROWS, matrix, matrix_sql,
)
from haulmark.operators.checks import drop_null_keys, failed_checks, fk_orphans, not_blank
from haulmark.operators.reshape import (
    classify_helpers, explode_participants, helper_suffix, metrics_wide, resolve_year,
    unpivot_daily, unpivot_weekly,
)
from haulmark.operators.ranking import slice_dense_rank
from haulmark.plans import specs as S, tenure as TN
from haulmark.plans.ingest import ingest_table

QUERIES = Registry()


def _typed_routes(spark, sf):
    raw = raw_frame(table(spark, sf, "orders"), ROUTES)
    return S.apply_spec(S.ROUTES, raw, carry=("file", "line"))


def _participants(spark, sf):
    return explode_participants(_typed_routes(spark, sf))


@QUERIES.add("explode_participants", f"""WITH {_ROUTE_ROWS}
SELECT line, CAST(participant_index AS INTEGER) AS participant_index, transporter_id, driver_name FROM people""")
def q_explode(spark, sf):
    return _participants(spark, sf).select("line", "participant_index", "transporter_id", "driver_name")


@QUERIES.add("helper_suffix", f"""WITH {_ROUTE_ROWS}
SELECT file, line, CAST(participant_index AS INTEGER) AS participant_index,
  CASE WHEN is_helper = 1 THEN route_code || '(' || CAST(helper_no AS BIGINT) || ')' ELSE route_code END AS route_code
FROM counted""")
def q_suffix(spark, sf):
    return helper_suffix(_participants(spark, sf), ["file"], ["line"]).select(
        "file", "line", "participant_index", "route_code")


@QUERIES.add("classify_helpers", f"""WITH {_ROUTE_ROWS}
SELECT file, line, CAST(participant_index AS INTEGER) AS participant_index, driver_name, helper_tag FROM tagged""")
def q_classify(spark, sf):
    return classify_helpers(_participants(spark, sf), ["file"]).select(
        "file", "line", "participant_index", "driver_name", "helper_tag")


@QUERIES.add("unpivot_daily", f"""WITH {matrix_sql(DAY)}
SELECT CAST(label AS DATE) AS metric_date, metric_name, metric_value FROM cells""")
def q_daily(spark, sf):
    return unpivot_daily(matrix(spark, sf, DAY))


@QUERIES.add("unpivot_weekly", f"""WITH {matrix_sql(WEEK)}
SELECT label AS iso_year_week, CAST(right(label, 2) AS INTEGER) AS week, metric_name, metric_value FROM cells""")
def q_weekly(spark, sf):
    return unpivot_weekly(matrix(spark, sf, WEEK))


# Labels of four files: all with a year, some without, none, and a year in the name.
_LABELS = {
    "id": "o_orderkey", "file": "'f' || " + as_text("o_custkey % 4"),
    "iso_year_week": "CASE o_custkey % 4 WHEN 0 THEN '2023-W' || lpad(" + as_text("o_orderkey % 52 + 1") + ", 2, '0') "
                     "WHEN 1 THEN CASE WHEN o_orderkey % 2 = 0 THEN '2022-W07' ELSE 'Week ' || "
                     + as_text("o_orderkey % 80") + " END ELSE 'Week ' || " + as_text("o_orderkey % 60") + " END",
    "file_year": "CASE WHEN o_custkey % 4 = 3 THEN 2021 END",
}
_STORED = {"year": "CAST(year(o_orderdate) AS int)", "week": "CAST(o_custkey % 50 AS int)"}


@QUERIES.add("resolve_year", f"""
WITH raw AS ({raw_sql("orders", _LABELS)}),
labelled AS (SELECT *, {D.trailing_digits("iso_year_week")} AS week,
  CAST(nullif(regexp_extract(iso_year_week, '(\\d{{4}})', 1), '') AS INTEGER) AS own FROM raw),
files AS (SELECT file, bool_and(own IS NOT NULL) AS whole FROM labelled GROUP BY file),
stored AS (SELECT week, max(year) AS y FROM ({raw_sql("orders", _STORED)}) GROUP BY week)
SELECT l.id, l.file, l.iso_year_week, l.week,
  coalesce(l.file_year, CASE WHEN f.whole THEN l.own END, s.y, (SELECT max(y) FROM stored), 2030) AS year
FROM labelled l JOIN files f ON f.file = l.file LEFT JOIN stored s ON s.week = l.week""")
def q_resolve(spark, sf):
    orders = table(spark, sf, "orders")
    rows = raw_frame(orders, _LABELS).withColumn("week", H.trailing_digits(F.col("iso_year_week")))
    return resolve_year(rows, raw_frame(orders, _STORED), 2030, ["file"], "file_year").drop("file_year")


@QUERIES.add("metrics_wide", """
SELECT user_id, CAST(ts AS DATE) AS day,
  max(CASE WHEN event_type = 'click' THEN value END) AS click, max(CASE WHEN event_type = 'view' THEN value END) AS viewed,
  max(CASE WHEN event_type = 'error' THEN value END) AS failed FROM events GROUP BY ALL""")
def q_wide(spark, sf):
    rows = table(spark, sf, "events").select("user_id", F.col("ts").cast("date").alias("day"), "event_type", "value")
    return metrics_wide(rows, ["user_id", "day"], {"click": "click", "view": "viewed", "error": "failed"},
                        "event_type", "value")


# Filters and checks ---------------------------------------------------------------

_KEYED = {
    "l_orderkey": "CASE WHEN l_partkey % 13 = 0 THEN NULL ELSE l_orderkey END",
    "l_linenumber": "CASE WHEN l_partkey % 17 = 0 THEN NULL ELSE l_linenumber END",
    "l_shipdate": "CAST(l_shipdate AS date)", "status": blotted("l_partkey", "l_linestatus"),
    "quantity": "l_quantity",
}


@QUERIES.add("drop_null_keys", f"""WITH raw AS ({raw_sql("lineitem", _KEYED)})
SELECT * FROM raw WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL""")
def q_drop(spark, sf):
    return drop_null_keys(raw_frame(table(spark, sf, "lineitem"), _KEYED), ["l_orderkey", "l_linenumber"])


@QUERIES.add("quality_checks", f"""WITH raw AS ({raw_sql("lineitem", _KEYED)})
SELECT l_orderkey, l_linenumber, quantity, nullif(concat_ws(';',
  CASE WHEN l_orderkey IS NULL THEN 'order missing' END,
  CASE WHEN nullif(trim(status), '') IS NULL THEN 'status blank' END,
  CASE WHEN trim(status) NOT IN ('F', 'O') THEN 'status unknown' END), '') AS failed FROM raw""")
def q_quality(spark, sf):
    raw = raw_frame(table(spark, sf, "lineitem"), _KEYED)
    checks = {
        "order missing": F.col("l_orderkey").isNotNull(), "status blank": not_blank(F.col("status")),
        "status unknown": F.trim("status").isin("F", "O")}
    return raw.select("l_orderkey", "l_linenumber", "quantity",
                      F.nullif(F.concat_ws(";", failed_checks(checks)), F.lit("")).alias("failed"))


@QUERIES.add("fk_orphans", """
SELECT l_suppkey, count(*) AS "rows" FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 3000) GROUP BY 1""")
def q_orphans(spark, sf):
    people = table(spark, sf, "supplier").filter("s_acctbal > 3000")
    return fk_orphans(table(spark, sf, "lineitem"), people, "l_suppkey", "s_suppkey")


@QUERIES.add("distinct_weeks", f"""
SELECT DISTINCT CAST(isoyear(l_shipdate) AS INTEGER) AS year, CAST(weekofyear(l_shipdate) AS INTEGER) AS week FROM lineitem""")
def q_weeks(spark, sf):
    day = F.col("l_shipdate").cast("date")
    return table(spark, sf, "lineitem").select(
        F.extract(F.lit("YEAROFWEEK"), day).alias("year"), F.weekofyear(day).alias("week")).distinct()


# Service rows and people -----------------------------------------------------------

PEOPLE = {
    "transporter_id": "'T' || " + as_text("s_suppkey"),
    "full_name": "CASE WHEN s_suppkey % 2 = 0 THEN ' S' || " + as_text("s_suppkey") + " || ' ' ELSE 's' || "
                 + as_text("s_suppkey") + " END",
    "working_status": "CASE WHEN s_acctbal <= 1000 THEN 'Inactive' WHEN s_suppkey % 3 = 0 THEN 'ACTIVE' ELSE 'Active' END",
}
# Service rows before parsing: the name is dirty in one of five rows.
SERVICE_ROWS = {
    "row_date": "CAST(l_shipdate AS date)", "l_orderkey": "l_orderkey", "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey", "l_extendedprice": "l_extendedprice", "l_quantity": "l_quantity",
    "delivery_associate": blotted("l_partkey", "'s' || " + as_text("l_suppkey")),
    "excluded_flag": "CASE WHEN l_linestatus = 'F' AND l_linenumber = 7 THEN 'Y' WHEN l_linenumber = 2 THEN 'N' END",
}
JOINED_SQL = f"""service AS ({raw_sql("lineitem", SERVICE_ROWS)}), people AS ({raw_sql("supplier", PEOPLE)}),
joined AS (SELECT s.*, p.transporter_id, p.full_name FROM service s JOIN people p
  ON upper(trim(s.delivery_associate)) = upper(trim(p.full_name))
  WHERE (s.excluded_flag IS NULL OR s.excluded_flag <> 'Y') AND p.working_status IN ('Active', 'ACTIVE'))"""


def service_rows(spark, sf):
    return raw_frame(table(spark, sf, "lineitem"), SERVICE_ROWS)


def people_rows(spark, sf):
    return raw_frame(table(spark, sf, "supplier"), PEOPLE)


@QUERIES.add("join_on_name", f"""WITH {JOINED_SQL}
SELECT transporter_id, full_name, row_date, l_orderkey, l_linenumber, l_partkey FROM joined""")
def q_join(spark, sf):
    return TN.service_with_people(service_rows(spark, sf), people_rows(spark, sf)).select(
        "transporter_id", "full_name", "row_date", "l_orderkey", "l_linenumber", "l_partkey")


@QUERIES.add("route_ordinal", f"""WITH {JOINED_SQL}
SELECT transporter_id, row_date, l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_quantity,
  row_number() OVER (PARTITION BY transporter_id ORDER BY row_date, l_orderkey, l_linenumber, l_partkey,
    l_extendedprice, l_quantity) AS route_ordinal,
  count(*) OVER (PARTITION BY transporter_id) AS total_routes FROM joined""")
def q_ordinal(spark, sf):
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity")]
    rows = TN.service_with_people(service_rows(spark, sf), people_rows(spark, sf))
    block = F.floor(F.col("l_orderkey") / 1024)
    return TN.route_ordinal(rows, order, block).select(
        "transporter_id", "row_date", *order, "route_ordinal", "total_routes")
