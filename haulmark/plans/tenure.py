"""Tenure from worked routes and from the external tenure report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark import functions as H
from haulmark.operators.changes import insert_new_only, merge_rows
from haulmark.operators.ranking import newest, slice_ordinal

__all__ = [
    "ROUTES_FOR_TENURE", "ACTIVE_STATUS", "service_with_people", "route_ordinal",
    "tenure_candidates", "tenure_from_service", "tenure_merge",
]

# Routes that make a person tenured, statuses that count as active.
ROUTES_FOR_TENURE = 30
ACTIVE_STATUS = ("Active", "ACTIVE")


def _counted(service: DataFrame) -> DataFrame:
    """Service rows that are not excluded, with the name in compared form."""
    kept = service.filter(F.col("excluded_flag").isNull() | (F.col("excluded_flag") != "Y"))
    return kept.withColumn("name_key", H.canonical_key(F.col("delivery_associate")))


def _active(people: DataFrame) -> DataFrame:
    active = people.filter(F.col("working_status").isin(*ACTIVE_STATUS))
    return active.select("transporter_id", "full_name",
                         H.canonical_key(F.col("full_name")).alias("name_key"))


def service_with_people(service: DataFrame, people: DataFrame) -> DataFrame:
    """Counted service rows joined to active people on the canonical name."""
    return _counted(service).join(_active(people), "name_key").drop("name_key")


def route_ordinal(rows: DataFrame, order: Sequence[Column], block: Column) -> DataFrame:
    """Number a person's routes by date, with the person's total.

    ``rows`` comes from ``service_with_people``; rows without a date come first.
    ``block`` cuts one person's day into bounded pieces and must ascend with
    ``order``.
    """
    return slice_ordinal(
        rows, ["transporter_id"], {"__day": F.col("row_date"), "__block": block},
        order, "route_ordinal", "total_routes")


def tenure_candidates(service: DataFrame, people: DataFrame,
                      routes: int = ROUTES_FOR_TENURE) -> DataFrame:
    """Per active person: total routes and the date of the ``routes``-th one.

    Rows collapse to one count per name and day before anything is joined or
    sorted, so a person with very many rows is a handful of rows afterwards. The
    date of the n-th route is the first day whose running count reaches n.
    """
    daily = _counted(service).groupBy("name_key", "row_date").agg(F.count(F.lit(1)).alias("n"))
    joined = daily.join(_active(people), "name_key")
    # Rows without a date sort first, as nulls do in the original ordering.
    running = (
        Window.partitionBy("transporter_id").orderBy(F.col("row_date").asc_nulls_first(), "name_key")
        .rowsBetween(Window.unboundedPreceding, 0))
    counted = joined.withColumn("done", F.sum("n").over(running))
    # Only the day that holds the n-th route qualifies.
    holds = (F.col("done") >= routes) & (F.col("done") - F.col("n") < routes)
    return counted.groupBy("transporter_id", "full_name").agg(
        F.min(F.when(holds, F.col("row_date"))).alias("tenured_date"),
        F.max("done").alias("total_routes"))


def tenure_from_service(service: DataFrame, people: DataFrame, target: DataFrame,
                        routes: int = ROUTES_FOR_TENURE) -> DataFrame:
    """Add people who crossed the route count and are not yet in the tenure table.

    The year is the calendar year while the week is the ISO week, as stored.
    """
    found = tenure_candidates(service, people, routes).filter(
        (F.col("total_routes") >= routes) & F.col("tenured_date").isNotNull())
    rows = found.select(
        "transporter_id", "full_name", "tenured_date",
        F.lit("WST_SERVICEDETAILS").alias("tenured_source"),
        F.year("tenured_date").alias("tenured_year"),
        F.weekofyear("tenured_date").alias("tenured_week"),
        F.col("total_routes").cast("int").alias("routes_at_tenure"), F.lit(True).alias("is_active"))
    return insert_new_only(target, rows, ["transporter_id"])


def tenure_merge(target: DataFrame, report: DataFrame, updated: Column) -> DataFrame:
    """Merge the external report: tenured people are added, known ones refreshed.

    Several report rows per person are reduced to the latest (year, week); ties
    fall to the larger remaining values. An active flag is only ever switched on.
    """
    source = report.select(
        F.trim("transporter_id").alias("transporter_id"), F.col("name").alias("full_name"),
        "year", "week", "lifetime_routes", "tenure_status", "driver_status"
    ).filter(F.col("transporter_id").isNotNull())
    latest = newest(source, ["transporter_id"], [
        "year", "week", "lifetime_routes", "full_name", "tenure_status", "driver_status"])
    active = F.coalesce(F.upper("s.driver_status") == "ACTIVE", F.lit(False))
    return merge_rows(
        target, latest, ["transporter_id"],
        on_match={
            "full_name": F.col("s.full_name"),
            "routes_at_tenure": F.coalesce("t.routes_at_tenure", "s.lifetime_routes"),
            "is_active": F.when(active, F.lit(True)).otherwise(F.col("t.is_active")),
            "updated_utc": updated,
        },
        on_insert={
            "full_name": F.col("s.full_name"), "tenured_date": F.lit(None),
            "tenured_source": F.lit("AMZ_TENURE_REPORT"), "tenured_year": F.col("s.year"),
            "tenured_week": F.col("s.week"), "routes_at_tenure": F.col("s.lifetime_routes"),
            "is_active": active, "updated_utc": F.lit(None),
        },
        insert_when=F.upper("s.tenure_status") == "TENURED",
    )
