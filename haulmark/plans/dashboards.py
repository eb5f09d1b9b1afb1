"""Aggregates behind the operations dashboards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark import functions as H
from haulmark.operators.ranking import slice_dense_rank

__all__ = ["fleet_status", "package_volume", "peak_days", "failure_reasons", "repeat_failures",
           "week_by_day", "week_ranking", "tenure_brackets", "TENURE_BRACKETS"]


def fleet_status(fleet: DataFrame) -> DataFrame:
    """Vehicles by operational status and service type, with the share of the whole fleet."""
    counted = fleet.groupBy("operational_status", "service_type").agg(
        F.count(F.lit(1)).alias("vehicles"),
        F.sum((F.upper("vehicle_status") == "ACTIVE").cast("long")).alias("active_vehicles"))
    total = fleet.agg(F.count(F.lit(1))).scalar()
    return counted.withColumns({
        "inactive_vehicles": F.col("vehicles") - F.coalesce("active_vehicles", F.lit(0)),
        "active_vehicles": F.coalesce("active_vehicles", F.lit(0)),
        "fleet_share": F.col("vehicles") / total})


def package_volume(delivered: DataFrame, period: Column) -> DataFrame:
    """Packages per period, station and type; ``period`` is a day or a week label."""
    return delivered.groupBy(period.alias("period"), "station", "package_type").agg(
        F.sum("package_count").alias("packages"))


def peak_days(delivered: DataFrame) -> DataFrame:
    """Each station's busiest day; the earliest wins a tie."""
    daily = delivered.groupBy("station", "metric_date").agg(F.sum("package_count").alias("packages"))
    rank = F.struct("packages", (-F.unix_date("metric_date")).alias("earlier"))
    return daily.groupBy("station").agg(
        F.max_by("metric_date", rank).alias("peak_date"), F.max("packages").alias("peak_packages"))


def failure_reasons(rows: DataFrame) -> DataFrame:
    """Not-delivered packages by station and reason, with the share of the station."""
    counted = rows.groupBy("station", "reason").agg(
        F.sum("packages").alias("packages"), F.count(F.lit(1)).alias("incidents"))
    station = counted.groupBy("station").agg(F.sum("packages").alias("station_packages"))
    return counted.join(station, "station").withColumn(
        "share", H.safe_divide(F.col("packages").cast("double"), F.col("station_packages").cast("double"))
    ).drop("station_packages")


def repeat_failures(rows: DataFrame) -> DataFrame:
    """Drivers and routes with more than one failure."""
    return rows.groupBy("driver", "route").agg(
        F.count(F.lit(1)).alias("incidents"), F.sum("packages").alias("packages"),
    ).filter(F.col("incidents") > 1)


def week_by_day(delivered: DataFrame, date: str, group: list[str], value: str) -> DataFrame:
    """Daily totals with the change from the day before; the first day has none."""
    daily = delivered.groupBy(*group, date).agg(F.sum(value).alias("packages"))
    before = F.lag("packages").over(Window.partitionBy(*group).orderBy(date))
    return daily.withColumn("change", F.col("packages") - before)


def week_ranking(delivered: DataFrame, scope: list[str], driver: str, value: str,
                 width: float) -> DataFrame:
    """Drivers ranked by their total inside each scope, best first, ties sharing a rank.

    ``width`` is the spread of totals one task may rank at a time.
    """
    totals = delivered.groupBy(*scope, driver).agg(F.sum(value).alias("packages"))
    return slice_dense_rank(totals, scope, "packages", width, "rank")


# Lower bound of each bracket in routes, largest first, and its label.
TENURE_BRACKETS = ((200, "200+"), (100, "100-199"), (30, "30-99"), (0, "0-29"))


def tenure_brackets(people: DataFrame, routes: str, active: str) -> DataFrame:
    """People per route bracket and the share still active."""
    bracket = F.when(F.col(routes).isNull(), "unknown")
    for bound, label in TENURE_BRACKETS:
        bracket = bracket.when(F.col(routes) >= bound, label)
    counted = people.groupBy(bracket.alias("bracket")).agg(
        F.count(F.lit(1)).alias("people"), F.sum(F.col(active).cast("long")).alias("retained"))
    return counted.withColumn("retained_share", F.col("retained") / F.col("people"))
