"""Calendars over the span of the order table, and date lookups."""

from __future__ import annotations

from pyspark.sql import functions as F

from haulmark.catalog.base import Registry, table
from haulmark.plans import calendar as CAL

QUERIES = Registry()

_SUNDAY = "({d} - CAST(dayofweek({d}) AS INTEGER))"


def _week_columns(d: str) -> str:
    start = _SUNDAY.format(d=d)
    year = f"CAST(year({start} + 6) AS INTEGER)"
    anchor = _SUNDAY.format(d=f"make_date({year}, 1, 1)")
    return (f"{start} AS week_start, {start} + 6 AS week_end, {year} AS week_year, "
            f"CAST(({start} - {anchor}) // 7 + 1 AS INTEGER) AS week_of_year")


_DAYS = f"""span AS (SELECT CAST(year(min(o_orderdate)) AS INTEGER) AS a, CAST(year(max(o_orderdate)) AS INTEGER) AS b FROM orders),
days AS (SELECT CAST(unnest(range(make_date(a, 1, 1), make_date(b, 12, 31) + 1, INTERVAL 1 DAY)) AS DATE) AS "date" FROM span),
calendar AS (SELECT "date", {_week_columns('"date"')} FROM days)"""


def _span(spark, sf):
    """First and last year with orders; stays a one-row frame."""
    day = F.col("o_orderdate")
    return table(spark, sf, "orders").agg(
        F.year(F.min(day)).alias("first_year"), F.year(F.max(day)).alias("last_year"))


@QUERIES.add("calendar_days", f"""WITH {_DAYS}, counts AS (SELECT CAST(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT calendar.*, CAST(year("date") AS INTEGER) AS year, CAST(month("date") AS INTEGER) AS month,
  CAST(day("date") AS INTEGER) AS day_of_month, dayname("date") AS day_name, coalesce(n, 0) AS orders
FROM calendar LEFT JOIN counts ON d = "date" """)
def q_days(spark, sf):
    """Every day of the years with orders, with the orders placed on it."""
    counts = table(spark, sf, "orders").groupBy(F.col("o_orderdate").cast("date").alias("date")).agg(
        F.count(F.lit(1)).alias("orders"))
    days = CAL.calendar_days(_span(spark, sf))
    return days.join(counts, "date", "left").fillna(0, ["orders"])


@QUERIES.add("calendar_weeks", f"""WITH {_DAYS}, more AS (SELECT CAST(unnest(range({_SUNDAY.format(d="make_date(a, 1, 1)")},
  {_SUNDAY.format(d="make_date(b + 1, 1, 1)")}, INTERVAL 7 DAY)) AS DATE) AS s FROM span),
weeks AS (SELECT {_week_columns("s")} FROM more),
counts AS (SELECT {_SUNDAY.format(d="CAST(o_orderdate AS DATE)")} AS d, count(*) AS n FROM orders GROUP BY 1)
SELECT week_year, week_of_year, week_start, week_end, coalesce(n, 0) AS orders FROM weeks LEFT JOIN counts ON d = week_start""")
def q_weeks(spark, sf):
    """Every week of the years with orders, with the orders placed in it."""
    from haulmark.functions import sunday_week_start
    counts = table(spark, sf, "orders").groupBy(
        sunday_week_start(F.col("o_orderdate").cast("date")).alias("week_start")).agg(
        F.count(F.lit(1)).alias("orders"))
    weeks = CAL.calendar_weeks(_span(spark, sf))
    return weeks.join(counts, "week_start", "left").fillna(0, ["orders"])


@QUERIES.add("weeks_per_year", f"""WITH {_DAYS}, more AS (SELECT CAST(unnest(range({_SUNDAY.format(d="make_date(a, 1, 1)")},
  {_SUNDAY.format(d="make_date(b + 1, 1, 1)")}, INTERVAL 7 DAY)) AS DATE) AS s FROM span),
weeks AS (SELECT {_week_columns("s")} FROM more)
SELECT week_year, count(*) AS weeks_in_year FROM weeks GROUP BY week_year""")
def q_per_year(spark, sf):
    return CAL.weeks_per_year(CAL.calendar_weeks(_span(spark, sf)))


@QUERIES.add("week_lookup", f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
w AS (SELECT o_orderkey, d, {_week_columns("d")} FROM o)
SELECT o_orderkey, d AS order_date, week_year, week_of_year FROM w""")
def q_lookup(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    return CAL.week_of_date(orders, "order_date")


@QUERIES.add("week_range_join", f"""WITH o AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS d FROM orders),
w AS (SELECT o_orderkey, d, {_week_columns("d")} FROM o)
SELECT o_orderkey, d AS order_date, week_year, week_of_year FROM w""")
def q_range(spark, sf):
    """The same lookup by joining the week table on its start and end."""
    orders = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_date"))
    weeks = CAL.calendar_weeks(_span(spark, sf))
    return CAL.lookup_range(orders, "order_date", weeks, "week_start", "week_end", ["week_year", "week_of_year"])
