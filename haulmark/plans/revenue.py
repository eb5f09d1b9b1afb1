"""Revenue rates, the daily revenue log and its roll-ups.

The body of the log builder is not specified beyond the meaning of its columns;
``build_revenue_log`` rests on that meaning and on these inferred rules: route and
training rows are billed by the hour, cancellations, packages and incentives by
the piece.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import functions as H
from haulmark.operators.changes import rebuild_window, upsert_overwrite

__all__ = ["upsert_rates", "revenue_daily", "revenue_weekly", "build_revenue_log",
           "rebuild_revenue_log", "default_window", "CANCEL", "PACKAGE", "INCENTIVE", "TRAINING"]

# Service types with their own rules.
CANCEL = "Amazon Cancellation"
PACKAGE = "Package"
INCENTIVE = "Incentive"
TRAINING = "Training Classes"

RATE_KEY = ["station_code", "service_type", "iso_year_week"]


def upsert_rates(target: DataFrame, source: DataFrame, order: list[str]) -> DataFrame:
    return upsert_overwrite(target, source, RATE_KEY, order)


def _sum_type(name: str) -> Column:
    return F.sum(F.when(F.col("service_type") == name, F.col("route_total")).otherwise(0))


def revenue_daily(log: DataFrame) -> DataFrame:
    return log.groupBy("row_date", "station_code").agg(
        F.sum("revenue_total").alias("revenue_total"),
        F.sum("billable_hours").alias("billable_hours"),
        _sum_type(CANCEL).alias("cancels"),
        _sum_type(PACKAGE).alias("packages"),
        _sum_type(INCENTIVE).alias("incentives"))


def revenue_weekly(log: DataFrame) -> DataFrame:
    return log.groupBy("iso_year_week", "station_code").agg(
        F.sum("revenue_total").alias("revenue_total"),
        F.sum("billable_hours").alias("billable_hours"))


def _pieces(df: DataFrame, date: str, kind: Column, count: Column, hours: Column,
            hourly: bool) -> DataFrame:
    return df.select(
        F.col(date).alias("row_date"), H.station_code(F.col("station")).alias("station_code"),
        kind.alias("service_type"), hours.cast("int").alias("hours"),
        F.lit(hourly).alias("hourly"), count.cast("bigint").alias("pieces"))


def build_revenue_log(service: DataFrame, weekly_work: DataFrame, delivered: DataFrame,
                      training: DataFrame, rates: DataFrame, date_from: dt.date | str,
                      date_to: dt.date | str, n_rows: str | None = None) -> DataFrame:
    """Daily revenue rows of the inclusive window.

    The four sources are filtered by date, stacked and counted per (day, station,
    service type, hours) before the rate lookup, so the join sees one row per
    group and not one per route or parcel. ``n_rows`` names the column that says for how many rows one of the
    sources stands, its parcels being their total (see ``ingest_totals``); without it each stands for itself.
    """
    def window(df: DataFrame, date: str) -> DataFrame:
        return df.filter(F.col(date).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date")))

    none = F.lit(0)
    one = F.col(n_rows) if n_rows else F.lit(1)
    routes = _pieces(
        window(service, "row_date"), "row_date", H.service_type(F.col("service_type")), one,
        F.coalesce(H.hours_label(F.col("planned_duration_label")), none), True)
    cancels = _pieces(
        window(weekly_work, "row_date"), "row_date", F.lit(CANCEL),
        F.coalesce(H.to_int(F.col("amzl_late_cancel")), none) * one, none, False)
    kind = H.service_type(F.col("package_type"))
    parcels = _pieces(
        window(delivered, "metric_date").filter(kind.isin(PACKAGE, INCENTIVE)), "metric_date", kind,
        F.coalesce("package_count", none), none, False)
    lessons = _pieces(
        window(training, "assignment_date"), "assignment_date", F.lit(TRAINING), one,
        F.coalesce("total_hours", none), True)
    stacked = routes.unionByName(cancels).unionByName(parcels).unionByName(lessons)
    counted = stacked.groupBy("row_date", "station_code", "service_type", "hours", "hourly").agg(
        F.sum("pieces").alias("route_total"))
    dated = counted.filter(F.col("route_total") > 0).withColumn(
        "iso_year_week", H.iso_week_label(F.col("row_date")))
    priced = dated.join(rates.select(*RATE_KEY, "revenue_rate"), RATE_KEY, "left")
    hours = F.when(F.col("hourly"), F.col("hours") * F.col("route_total")).otherwise(0)
    units = F.when(F.col("hourly"), hours).otherwise(F.col("route_total"))
    return priced.select(
        "iso_year_week", "row_date", "station_code", "service_type",
        F.col("route_total").cast("bigint").alias("route_total"),
        F.col("hours").alias("route_total_duration"), "revenue_rate",
        hours.cast("decimal(18,4)").alias("billable_hours"),
        (units.cast("decimal(18,0)") * F.col("revenue_rate")).cast("decimal(18,4)").alias("revenue_total"))


def rebuild_revenue_log(log: DataFrame, fresh: DataFrame, date_from: dt.date | str,
                        date_to: dt.date | str) -> DataFrame:
    """The log with the inclusive window replaced by ``fresh`` rows."""
    return rebuild_window(log, fresh, "row_date", date_from, date_to)


def default_window(today: dt.date, days: int = 14) -> tuple[dt.date, dt.date]:
    """From ``days`` before the given day to that day, both included."""
    return today - dt.timedelta(days=days), today
