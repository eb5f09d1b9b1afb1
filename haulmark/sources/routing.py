"""Which table a file or an archive member belongs to, by its name."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = ["UNMATCHED", "is_workbook", "route_file", "route_member", "is_bundle"]

UNMATCHED = "(unmatched)"

# File endings of workbooks.
_WORKBOOKS = ("xlsx", "xlsm", "xls")


def route_file(name: Column) -> Column:
    """Table of a file; the first rule that matches wins and the order matters.

    A workbook saved as CSV keeps its name and so its table.
    """
    n = F.lower(name)
    csv = F.endswith(n, F.lit(".csv"))
    book = n.rlike(r"\.(" + "|".join(_WORKBOOKS) + r")$")
    weekly = F.contains(n, F.lit("-w"))

    def starts(prefix: str) -> Column:
        return F.startswith(n, F.lit(prefix))

    # The names of the exports, in the order in which the rules apply.
    return (
        F.when(n == "associatedata.csv", "associate")
        .when(starts("routes_") & (csv | book), "routes")
        .when(starts("dsp_overview_dashboard_") & csv, "weekly_scorecard")
        .when(starts("itineraries_") & (csv | book), "itineraries")
        .when(starts("safety_dashboard") & csv, "safety_events")
        .when(n.isin("vehiclesdata.xlsx", "fleet.xlsx", "fleet.csv")
              | (F.contains(n, F.lit("vehiclesdata")) & (book | csv)), "fleet_vehicles")
        .when(starts("dsp_delivery_overview_all_") & ~weekly & csv, "daily_overview")
        .when(starts("dsp_associates_concessions_dsw3") & csv & ~weekly, "daily_scorecard")
        .when(starts("station_level_metrics") & csv & ~weekly, "station_metrics_daily")
        .when(starts("station_level_metrics") & csv & weekly, "station_metrics_weekly")
        .when(starts("dsp_delivery_overview_all_") & csv, "weekly_overview")
        .when(F.contains(n, F.lit("tenure_workforce_das_report")) & csv, "tenure_backlog_raw")
        .otherwise(UNMATCHED)
    )


def is_workbook(name: Column) -> Column:
    """Files that are listed in reports but not read; saved as CSV they are."""
    return F.lower(name).rlike(r"\.(" + "|".join(_WORKBOOKS) + r")$")


def is_bundle(name: Column) -> Column:
    """Archives of work reports are recognised by their name."""
    n = F.lower(name)
    return F.endswith(n, F.lit(".zip")) & F.contains(n, F.lit("weekly report"))


def route_member(name: Column) -> Column:
    """Table of an archive member; the plain weekly report is the last resort."""
    n = F.lower(name)
    rules = {
        "delivered packages report": "wst_delivered_packages",
        "service details report": "wst_service_details",
        "training weekly report": "wst_training_weekly_report",
        "unplanned delay weekly report": "wst_unplanned_delay",
        "weekly report": "wst_weekly_report",
    }
    out = None
    for part, table in rules.items():
        hit = F.contains(n, F.lit(part))
        out = F.when(hit, table) if out is None else out.when(hit, table)
    return out.otherwise(UNMATCHED)
