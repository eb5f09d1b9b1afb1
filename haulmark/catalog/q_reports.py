"""Scorecards, tenure, revenue and dashboard aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark import functions as H
from haulmark.catalog import duck as D
from haulmark.catalog.base import Registry, as_text, plain, raw_frame, raw_sql, table
from haulmark.catalog.q_ingest import (
    DELIVERED, FLEET, SCORECARD_SQL, SERVICE, TRAINING, WORK, scorecard_rows,
)
from haulmark.catalog.q_shaping import JOINED_SQL, people_rows, service_rows
from haulmark.operators.reshape import long_metrics
from haulmark.plans import dashboards as DB, revenue as R, scorecard as SC, specs as S, tenure as TN
from haulmark.plans.ingest import ingest_table, ingest_totals

QUERIES = Registry()

# Weekly scorecard ---------------------------------------------------------------

_RATE_COLUMNS = ("speeding_event_rate", "seatbelt_off_rate", "sign_signal_viol_rate", "distractions_rate",
                 "following_dist_rate")
# Output, source column, digits of the source column.
_AVERAGES = tuple(
    (out, source, 4 if source in _RATE_COLUMNS else 2) for out, source in (
        ("overall_score_avg", "overall_score"), ("speeding_event_rate_avg", "speeding_event_rate"),
        ("seatbelt_off_event_rate_avg", "seatbelt_off_rate"),
        ("sign_signal_violation_rate_avg", "sign_signal_viol_rate"),
        ("distraction_event_rate_avg", "distractions_rate"),
        ("following_distance_event_rate_avg", "following_dist_rate"), ("dcr_avg", "dcr_metric"),
        ("dsb_dpmo_avg", "dsb_metric"), ("pod_avg", "pod_metric"), ("cdf_dpmo_avg", "cdf_dpmo"),
        ("ced_dpmo_avg", "ced_metric"), ("psb_avg", "psb_metric")))


def _average_units(source: str, places: int) -> str:
    """Average in units of its last digit: decimal averages keep four digits more than their input."""
    units = f"sum(CAST(round({source} * {10 ** places}) AS BIGINT))"
    return f"CASE WHEN count({source}) > 0 THEN {D.average(units, f'count({source})', places, places + 4)} END"


_WEEKLY = (f"{SCORECARD_SQL}, weekly AS (SELECT year_week_label, count(*) AS drivers_on_route, "
           + ", ".join(f"{_average_units(source, places)} AS {out}" for out, source, places in _AVERAGES)
           + " FROM scorecard WHERE overall_score IS NOT NULL GROUP BY year_week_label)")
_YEAR_WEEK = ("CAST(left(year_week_label, 4) AS INTEGER) AS year, CAST(right(year_week_label, 2) AS INTEGER) AS week")


@QUERIES.add("weekly_aggregates", f"""WITH {_WEEKLY} SELECT {_YEAR_WEEK}, drivers_on_route, """ + ", ".join(
    f"CAST({out} AS DOUBLE) / {10 ** (places + 4)} AS {out}" for out, _, places in _AVERAGES) + " FROM weekly")
def q_weekly(spark, sf):
    return plain(SC.weekly_aggregates(scorecard_rows(spark, sf)))


_LONG_NAMES = tuple(zip((
    "DSP Overall Average Safty Score", "Speeding Event Rate", "Seatbelt Off Event Rate", "Sign/Signal Violation Rate",
    "Distraction Event Rate", "Following Distance Event Rate", "Delivery Completion Rate %", "DSB DPMO",
    "POD Success Rate", "CDF DPMO", "CED DPMO"), _AVERAGES))
_LONG = " UNION ALL ".join(
    f"SELECT {_YEAR_WEEK}, '{name}' AS metric_name, CAST({D.half_up(out, str(10 ** places))} AS DOUBLE) / 10000 AS metric_value FROM weekly"
    for name, (out, _, places) in _LONG_NAMES) + "".join(
    f" UNION ALL SELECT {_YEAR_WEEK}, '{name}', NULL FROM weekly" for name in ("Tenured Workforce %", "Fleet Defect Rate"))


@QUERIES.add("scorecard_long", f"WITH {_WEEKLY} {_LONG}")
def q_long(spark, sf):
    return plain(SC.scorecard_long(SC.weekly_aggregates(scorecard_rows(spark, sf))))


_POLICY_SQL = ("policy(code, name, weight, direction, fantastic, great, fair) AS (VALUES " + ", ".join(
    f"('{r[0]}', '{r[1]}', {round(float(r[4]) * 100)}, '{r[5]}', {r[6]}, {r[7]}, {r[8]})" for r in SC.POLICY_ROWS) + ")")


def _tenths(v: str) -> str:
    """Band score in tenths."""
    return (f"CASE WHEN {v} IS NULL THEN NULL WHEN direction = 'H' THEN CASE WHEN {v} >= fantastic THEN 10 "
            f"WHEN {v} >= great THEN 8 WHEN {v} >= fair THEN 6 ELSE 4 END ELSE CASE WHEN {v} <= fantastic THEN 10 "
            f"WHEN {v} <= great THEN 8 WHEN {v} <= fair THEN 6 ELSE 4 END END")


@QUERIES.add("policy_by_name", f"""WITH {_WEEKLY}, long AS ({_LONG}), {_POLICY_SQL}
SELECT year, week, metric_name, metric_value, code AS metric_code,
  CAST({_tenths("metric_value")} AS DOUBLE) / 10 AS metric_score FROM long JOIN policy ON name = metric_name""")
def q_by_name(spark, sf):
    long = SC.scorecard_long(SC.weekly_aggregates(scorecard_rows(spark, sf)))
    return plain(SC.policy_by_name(long, SC.policy(spark)).select(
        "year", "week", "metric_name", "metric_value", "metric_code", "metric_score"))


# Metrics per supplier and year from whole-number facts of its lines.
_FACTS = ("SELECT l_suppkey, year(l_shipdate) AS year, count(*) AS n, "
          "sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS r, "
          "sum(CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END) AS f, "
          "sum(CAST(l_quantity AS bigint)) AS q FROM lineitem GROUP BY l_suppkey, year(l_shipdate)")
METRICS = {
    "DCR": "100 - (r % 9) * 0.25", "DSB_DPMO": "q % 600", "POD": "100 - (f % 13) * 0.5",
    "CDF_DPMO": "q * 7 % 9000", "CED_DPMO": "q % 120", "SPD_RATE": "(n % 8) * 0.5", "SEAT_RATE": "(r % 7) * 0.5001",
    "SSV_RATE": "(f % 7) * 0.5", "DIST_RATE": "(q % 5) * 0.75", "FD_RATE": "(q % 11) * 0.3",
    "TENURED": "CASE WHEN q % 6 = 0 THEN NULL ELSE 65 + q % 30 END", "FLEET": "n % 12", "PSB": "r % 12",
}
_BREACH = "CASE WHEN l_suppkey % 17 = 0 THEN 1 ELSE 0 END"
_COMPLIANT = "CASE WHEN l_suppkey % 19 = 3 THEN 0 ELSE 1 END"
_SCORE_SQL = f"""WITH facts AS ({_FACTS}), {_POLICY_SQL},
wide AS (SELECT l_suppkey, CAST(year AS INTEGER) AS year, {_BREACH} AS breach, {_COMPLIANT} AS compliant, """ + ", ".join(
    f"CAST({e} AS DECIMAL(18,4)) AS {c}" for c, e in METRICS.items()) + f""" FROM facts),
long AS (""" + " UNION ALL ".join(
    f"SELECT l_suppkey, year, breach, compliant, '{c}' AS code, {c} AS v FROM wide" for c in METRICS) + f"""),
scored AS (SELECT l_suppkey, year, breach, compliant, weight, {_tenths("v")} AS tenths FROM long JOIN policy USING (code)),
sums AS (SELECT l_suppkey, year, breach, compliant, sum(weight * tenths) AS points, sum(weight) AS weights,
  count(*) = count(tenths) AS complete FROM scored GROUP BY ALL)
SELECT l_suppkey, year, CASE WHEN breach = 1 OR compliant = 0 THEN 0.0
  WHEN complete THEN CAST({D.half_up("points * 1000", "CAST(weights AS HUGEINT)")} AS DOUBLE) / 100 END
  AS projected_overall_score_pct FROM sums"""


def _wide_metrics(spark, sf):
    lines = table(spark, sf, "lineitem")
    facts = lines.groupBy("l_suppkey", F.year("l_shipdate").alias("year")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.expr("CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END")).alias("r"),
        F.sum(F.expr("CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END")).alias("f"),
        F.sum(F.col("l_quantity").cast("bigint")).alias("q"))
    return facts.select("l_suppkey", "year", *[
        F.expr(e).cast("decimal(18,4)").alias(c) for c, e in METRICS.items()])


@QUERIES.add("projected_score", _SCORE_SQL)
def q_score(spark, sf):
    long = long_metrics(_wide_metrics(spark, sf), ["l_suppkey", "year"], {c: c for c in METRICS}, "metric_code")
    flags = table(spark, sf, "lineitem").select("l_suppkey", F.year("l_shipdate").alias("year")).distinct().select(
        "l_suppkey", "year", F.expr(_BREACH).alias("breach_of_contract"), F.expr(_COMPLIANT).alias("cas_compliant"))
    return plain(SC.projected_score(long, SC.policy(spark), ["l_suppkey", "year"], flags))


@QUERIES.add("projected_score_wide", _SCORE_SQL)
def q_score_wide(spark, sf):
    scored = SC.projected_score_wide(
        _wide_metrics(spark, sf), {c: c for c in METRICS}, breach=F.expr(_BREACH), compliant=F.expr(_COMPLIANT))
    return plain(scored.select("l_suppkey", "year", "projected_overall_score_pct"))


# Tenure -------------------------------------------------------------------------

@QUERIES.add("tenure_from_service", f"""WITH {JOINED_SQL},
ranked AS (SELECT *, row_number() OVER (PARTITION BY transporter_id ORDER BY row_date, l_orderkey, l_linenumber, l_partkey) AS rn,
  count(*) OVER (PARTITION BY transporter_id) AS total FROM joined),
found AS (SELECT transporter_id, full_name, min(CASE WHEN rn = 30 THEN row_date END) AS tenured_date, max(total) AS total
  FROM ranked GROUP BY ALL),
t AS (SELECT 'T' || s_suppkey AS transporter_id, s_name FROM supplier WHERE s_suppkey % 4 = 0)
SELECT transporter_id, s_name AS full_name, CAST(NULL AS DATE) AS tenured_date, 'OLD' AS tenured_source,
  CAST(NULL AS INTEGER) AS tenured_year, CAST(NULL AS INTEGER) AS tenured_week, 40 AS routes_at_tenure, true AS is_active FROM t
UNION ALL SELECT transporter_id, full_name, tenured_date, 'WST_SERVICEDETAILS', CAST(year(tenured_date) AS INTEGER),
  CAST(weekofyear(tenured_date) AS INTEGER), CAST(total AS INTEGER), true FROM found
  WHERE total >= 30 AND tenured_date IS NOT NULL AND transporter_id NOT IN (SELECT transporter_id FROM t)""")
def q_tenure(spark, sf):
    target = table(spark, sf, "supplier").filter("s_suppkey % 4 = 0").select(
        F.concat(F.lit("T"), F.col("s_suppkey").cast("string")).alias("transporter_id"),
        F.col("s_name").alias("full_name"), F.lit(None).cast("date").alias("tenured_date"),
        F.lit("OLD").alias("tenured_source"), F.lit(None).cast("int").alias("tenured_year"),
        F.lit(None).cast("int").alias("tenured_week"), F.lit(40).alias("routes_at_tenure"),
        F.lit(True).alias("is_active"))
    return TN.tenure_from_service(service_rows(spark, sf), people_rows(spark, sf), target)


# Revenue ------------------------------------------------------------------------

def _hub(key: str) -> str:
    return f"'n' || {as_text(f'{key} % 25')}"


_RATES = {
    "station_code": "'N' || " + as_text("n_nationkey"), "rate": "CAST(n_nationkey AS decimal(18,4)) / 100 + 1"}
_LOG_RANGE = ("1995-01-01", "2001-12-31")


def _typed(spark, sf, spec, source, raw):
    return ingest_table(spec, raw_frame(table(spark, sf, source), raw))


def _rates(spark, sf):
    """One rate per station, service type and ISO week that has orders; every seventh is absent."""
    weeks = table(spark, sf, "orders").select(
        H.iso_week_label(F.col("o_orderdate").cast("date")).alias("iso_year_week"),
        (F.col("o_custkey") % 25).alias("n")).distinct()
    kinds = F.explode(F.array(*[F.lit(x) for x in (
        "A", "N", "R", R.CANCEL, R.PACKAGE, R.INCENTIVE, R.TRAINING)])).alias("service_type")
    return weeks.filter("n % 7 <> 3").select(
        F.concat(F.lit("N"), F.col("n").cast("string")).alias("station_code"), "iso_year_week", kinds,
        (F.col("n") * F.lit("0.25").cast("decimal(9,4)") + 1).cast("decimal(18,4)").alias("revenue_rate"))


def _log(spark, sf):
    def totals(spec, source, raw, by, sums=()):
        return ingest_totals(spec, raw_frame(table(spark, sf, source), raw), by, sums)

    return R.build_revenue_log(
        totals(S.SERVICE_DETAILS, "lineitem", SERVICE, ["row_date", "station", "service_type", "planned_duration_label"]),
        totals(S.WEEKLY_WORK, "orders", WORK, ["row_date", "station", "amzl_late_cancel"]),
        totals(S.DELIVERED_PACKAGES, "lineitem", DELIVERED, ["metric_date", "station", "package_type"], ["package_count"]),
        totals(S.TRAINING, "orders", TRAINING, ["assignment_date", "station", "total_hours"]),
        _rates(spark, sf), *_LOG_RANGE, n_rows="n_rows")


_LOG_SQL = f"""service AS (SELECT * FROM ({raw_sql("lineitem", SERVICE)})), work AS ({raw_sql("orders", WORK)}),
parcels AS ({raw_sql("lineitem", DELIVERED)}), lessons AS ({raw_sql("orders", TRAINING)}),
pieces AS (
  SELECT {D.to_date('"Date"')} AS row_date, {D.station_code('"Station"')} AS station_code, {D.service_type('"Service Type"')} AS service_type,
    coalesce({D.hours_label('"Planned Duration"')}, 0) AS hours, true AS hourly, 1 AS pieces FROM service
  UNION ALL SELECT {D.to_date('"Date"')}, {D.station_code('"Station"')}, 'Amazon Cancellation', 0, false,
    coalesce({D.to_int('"AMZL Late Cancel"')}, 0) FROM work
  UNION ALL SELECT {D.to_date('"Date"')}, {D.station_code('"Station"')}, {D.service_type('"Package Type"')}, 0, false,
    coalesce({D.to_int('"Package Count"')}, 0) FROM parcels WHERE {D.service_type('"Package Type"')} IN ('Package', 'Incentive')
  UNION ALL SELECT {D.to_date('"Assignment Date"')}, {D.station_code('"Station"')}, 'Training Classes',
    coalesce({D.hours_label(D.null_like('"Total Duration"'))}, 0), true, 1 FROM lessons),
counted AS (SELECT row_date, station_code, service_type, hours, hourly, sum(pieces) AS route_total FROM pieces
  WHERE row_date BETWEEN DATE '{_LOG_RANGE[0]}' AND DATE '{_LOG_RANGE[1]}' GROUP BY ALL HAVING sum(pieces) > 0),
rates AS (SELECT DISTINCT 'N' || (o_custkey % 25) AS station_code, {D.iso_week("CAST(o_orderdate AS DATE)")} AS iso_year_week,
  (o_custkey % 25) * 25 + 100 AS cents FROM orders WHERE o_custkey % 25 % 7 <> 3),
log AS (SELECT {D.iso_week("c.row_date")} AS iso_year_week, c.*, cents,
    CASE WHEN hourly THEN hours * route_total ELSE 0 END AS billable,
    CASE WHEN hourly THEN hours * route_total ELSE route_total END * cents AS revenue
  FROM counted c LEFT JOIN rates r ON r.station_code = c.station_code AND r.iso_year_week = {D.iso_week("c.row_date")}
    AND c.service_type IN ('A', 'N', 'R', 'Amazon Cancellation', 'Package', 'Incentive', 'Training Classes'))"""


@QUERIES.add("revenue_log", f"""WITH {_LOG_SQL}
SELECT iso_year_week, row_date, station_code, service_type, CAST(route_total AS BIGINT) AS route_total,
  CAST(hours AS INTEGER) AS route_total_duration, CAST(cents AS DOUBLE) / 100 AS revenue_rate,
  CAST(billable AS DOUBLE) AS billable_hours, CAST(revenue AS DOUBLE) / 100 AS revenue_total FROM log""")
def q_log(spark, sf):
    return plain(_log(spark, sf))


@QUERIES.add("revenue_daily", f"""WITH {_LOG_SQL}
SELECT row_date, station_code, CAST(sum(revenue) AS DOUBLE) / 100 AS revenue_total, CAST(sum(billable) AS DOUBLE) AS billable_hours,
  CAST(sum(CASE WHEN service_type = 'Amazon Cancellation' THEN route_total ELSE 0 END) AS BIGINT) AS cancels,
  CAST(sum(CASE WHEN service_type = 'Package' THEN route_total ELSE 0 END) AS BIGINT) AS packages,
  CAST(sum(CASE WHEN service_type = 'Incentive' THEN route_total ELSE 0 END) AS BIGINT) AS incentives
FROM log GROUP BY row_date, station_code""")
def q_daily(spark, sf):
    return plain(R.revenue_daily(_log(spark, sf)))


@QUERIES.add("revenue_weekly", f"""WITH {_LOG_SQL}
SELECT iso_year_week, station_code, CAST(sum(revenue) AS DOUBLE) / 100 AS revenue_total,
  CAST(sum(billable) AS DOUBLE) AS billable_hours FROM log GROUP BY iso_year_week, station_code""")
def q_weekly_revenue(spark, sf):
    return plain(R.revenue_weekly(_log(spark, sf)))


# Dashboards -----------------------------------------------------------------------

@QUERIES.add("fleet_status", f"""WITH raw AS ({raw_sql("part", FLEET)}), f AS (SELECT {D.null_like('"operationalStatus"')} AS operational_status,
  {D.null_like('"serviceType"')} AS service_type, {D.null_like('"status"')} AS vehicle_status FROM raw)
SELECT operational_status, service_type, count(*) AS vehicles,
  CAST(sum(CASE WHEN vehicle_status = 'ACTIVE' THEN 1 ELSE 0 END) AS BIGINT) AS active_vehicles,
  CAST(sum(CASE WHEN vehicle_status = 'ACTIVE' THEN 0 ELSE 1 END) AS BIGINT) AS inactive_vehicles,
  CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM f) AS fleet_share FROM f GROUP BY operational_status, service_type""")
def q_fleet(spark, sf):
    return DB.fleet_status(_typed(spark, sf, S.FLEET, "part", FLEET))


_PARCELS = (f"raw AS ({raw_sql('lineitem', DELIVERED)}), parcels AS (SELECT {D.to_date('\"Date\"')} AS metric_date, "
            f"{D.null_like('\"Station\"')} AS station, {D.to_int('\"Package Count\"')} AS package_count, "
            f"{D.null_like('\"Package Type\"')} AS package_type FROM raw)")


@QUERIES.add("package_volume", f"""WITH {_PARCELS}
SELECT {D.iso_week("metric_date")} AS period, station, package_type, CAST(sum(package_count) AS BIGINT) AS packages
FROM parcels GROUP BY ALL""")
def q_volume(spark, sf):
    rows = _typed(spark, sf, S.DELIVERED_PACKAGES, "lineitem", DELIVERED)
    return DB.package_volume(rows, H.iso_week_label(F.col("metric_date")))


@QUERIES.add("package_peaks", f"""WITH {_PARCELS},
days AS (SELECT station, metric_date, CAST(sum(package_count) AS BIGINT) AS packages FROM parcels WHERE metric_date IS NOT NULL GROUP BY ALL)
SELECT station, metric_date AS peak_date, packages AS peak_packages FROM days WHERE packages IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY station ORDER BY packages DESC, metric_date) = 1""")
def q_peaks(spark, sf):
    rows = _typed(spark, sf, S.DELIVERED_PACKAGES, "lineitem", DELIVERED).filter("metric_date IS NOT NULL")
    return DB.peak_days(rows)


_FAILED = {
    "station": _hub("l_suppkey"), "reason": "CASE l_returnflag WHEN 'R' THEN 'returned' WHEN 'A' THEN 'no access' ELSE 'not received' END",
    "driver": "l_suppkey", "route": "l_partkey % 200", "packages": "CAST(l_quantity AS bigint)"}


@QUERIES.add("not_delivered", f"""WITH f AS ({raw_sql("lineitem", _FAILED)}),
g AS (SELECT station, reason, CAST(sum(packages) AS BIGINT) AS packages, count(*) AS incidents FROM f GROUP BY ALL)
SELECT station, reason, packages, incidents, CAST(packages AS DOUBLE) / CAST(sum(packages) OVER (PARTITION BY station) AS DOUBLE) AS share FROM g""")
def q_failed(spark, sf):
    return DB.failure_reasons(raw_frame(table(spark, sf, "lineitem"), _FAILED))


@QUERIES.add("repeat_failures", f"""WITH f AS ({raw_sql("lineitem", _FAILED)})
SELECT driver, route, count(*) AS incidents, CAST(sum(packages) AS BIGINT) AS packages FROM f GROUP BY ALL HAVING count(*) > 1""")
def q_repeat(spark, sf):
    return DB.repeat_failures(raw_frame(table(spark, sf, "lineitem"), _FAILED))


_SHIPPED = {"day": "CAST(l_shipdate AS date)", "station": _hub("l_suppkey"), "driver": "l_suppkey",
            "packages": "CAST(l_quantity AS bigint)"}


@QUERIES.add("week_detail", f"""WITH s AS ({raw_sql("lineitem", _SHIPPED)}),
d AS (SELECT station, {D.iso_week("day")} AS week, day, CAST(sum(packages) AS BIGINT) AS packages FROM s GROUP BY ALL)
SELECT station, week, day, packages, packages - lag(packages) OVER (PARTITION BY station, week ORDER BY day) AS change FROM d""")
def q_week(spark, sf):
    rows = raw_frame(table(spark, sf, "lineitem"), _SHIPPED).withColumn("week", H.iso_week_label(F.col("day")))
    return DB.week_by_day(rows, "day", ["station", "week"], "packages")


@QUERIES.add("week_ranking", f"""WITH s AS ({raw_sql("lineitem", _SHIPPED)}),
d AS (SELECT station, {D.iso_week("day")} AS week, driver, CAST(sum(packages) AS BIGINT) AS packages FROM s GROUP BY ALL)
SELECT station, week, driver, packages, dense_rank() OVER (PARTITION BY station, week ORDER BY packages DESC) AS rank FROM d""")
def q_ranking(spark, sf):
    rows = raw_frame(table(spark, sf, "lineitem"), _SHIPPED).withColumn("week", H.iso_week_label(F.col("day")))
    return DB.week_ranking(rows, ["station", "week"], "driver", "packages", 10000)


_STAFF = {"routes": "CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_custkey % 300 END", "active": "c_acctbal > 0"}


@QUERIES.add("tenure_brackets", f"""WITH p AS ({raw_sql("customer", _STAFF)}),
b AS (SELECT CASE WHEN routes IS NULL THEN 'unknown' WHEN routes >= 200 THEN '200+' WHEN routes >= 100 THEN '100-199'
  WHEN routes >= 30 THEN '30-99' ELSE '0-29' END AS bracket, active FROM p)
SELECT bracket, count(*) AS people, CAST(sum(CASE WHEN active THEN 1 ELSE 0 END) AS BIGINT) AS retained,
  CAST(sum(CASE WHEN active THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS retained_share FROM b GROUP BY bracket""")
def q_brackets(spark, sf):
    return DB.tenure_brackets(raw_frame(table(spark, sf, "customer"), _STAFF), "routes", "active")
