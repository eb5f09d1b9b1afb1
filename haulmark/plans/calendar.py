"""Sunday-to-Saturday day and week calendars, and date-to-week lookup.

Week 1 of a year is the week that holds January 1. The other calendar in use,
ISO weeks, lives in ``haulmark.functions.dates``; the two are never mixed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from haulmark import functions as H

__all__ = ["calendar_days", "calendar_weeks", "weeks_per_year", "week_of_date", "lookup_range",
           "year_span"]


def year_span(spark: SparkSession, start_year: int, years_ahead: int = 10) -> DataFrame:
    """One row (first_year, last_year) for a fixed start; the clock is never read."""
    return spark.range(1).select(
        F.lit(start_year).alias("first_year"), F.lit(start_year + years_ahead).alias("last_year"))


def _weeks_columns(d: Column) -> dict[str, Column]:
    return {
        "week_start": H.sunday_week_start(d), "week_end": H.sunday_week_end(d),
        "week_year": H.sunday_week_year(d), "week_of_year": H.sunday_week_number(d),
    }


def calendar_days(span: DataFrame) -> DataFrame:
    """One row per day of the years in ``span`` (one row: first_year, last_year)."""
    days = span.select(F.explode(F.sequence(
        F.make_date("first_year", F.lit(1), F.lit(1)),
        F.make_date("last_year", F.lit(12), F.lit(31)))).alias("date"))
    d = F.col("date")
    return days.select(
        "date", *[e.alias(n) for n, e in _weeks_columns(d).items()],
        F.year(d).alias("year"), F.month(d).alias("month"),
        F.dayofmonth(d).alias("day_of_month"), F.date_format(d, "EEEE").alias("day_name"))


def calendar_weeks(span: DataFrame) -> DataFrame:
    """One row per week, from week 1 of the first year through the last year's last week."""
    new_year = F.make_date("first_year", F.lit(1), F.lit(1))
    after = F.make_date(F.col("last_year") + 1, F.lit(1), F.lit(1))
    weeks = span.select(F.explode(F.sequence(
        H.sunday_week_start(new_year), F.date_sub(H.sunday_week_start(after), 7),
        F.expr("INTERVAL 7 DAYS"))).alias("week_start"))
    parts = _weeks_columns(F.col("week_start"))
    return weeks.select(
        parts["week_year"].alias("week_year"), parts["week_of_year"].alias("week_of_year"),
        "week_start", parts["week_end"].alias("week_end"))


def weeks_per_year(weeks: DataFrame) -> DataFrame:
    return weeks.groupBy("week_year").agg(F.count(F.lit(1)).alias("weeks_in_year"))


def week_of_date(df: DataFrame, date: str) -> DataFrame:
    """Calendar week of each date by arithmetic: no join and no shuffle."""
    d = F.col(date)
    return df.withColumns({"week_year": H.sunday_week_year(d), "week_of_year": H.sunday_week_number(d)})


def lookup_range(df: DataFrame, date: str, ranges: DataFrame, start: str, end: str,
                 values: list[str]) -> DataFrame:
    """Rows joined to the range that holds their date (``date BETWEEN start AND end``).

    Ranges are opened into their days, which turns the range test into an
    equi-join; a date outside every range keeps null values.
    """
    days = ranges.select(F.explode(F.sequence(start, end)).alias(date), *values)
    return df.join(days, date, "left")
