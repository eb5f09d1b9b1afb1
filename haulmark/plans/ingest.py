"""Ingest pipelines: raw text frames to typed table rows.

A raw frame has one text column per header. Frames read from files also carry
their file and row order (``haulmark.sources.exports.ORIGIN``); pass those names in
``carry`` to keep them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark import functions as H
from haulmark.operators.checks import drop_null_keys
from haulmark.operators.columns import col
from haulmark.operators.headers import canonical_headers, require_columns
from haulmark.operators.reshape import (
    blank_helper_columns, daily_metrics, explode_list, explode_participants, number_helpers,
    resolve_year, tag_helpers, weekly_metrics,
)
from haulmark.plans import specs as S


def ingest_people(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """People master rows; the name is composed from its parts where it is missing."""
    frame = canonical_headers(raw, S.PEOPLE.aliases)
    if "first_name" in frame.columns and "last_name" in frame.columns:
        name = H.name_text(col("full_name")) if "full_name" in frame.columns else F.lit(None).cast("string")
        frame = frame.withColumn("full_name", H.full_name(
            name, H.name_text(col("first_name")), H.name_text(col("last_name"))))
    typed = S.apply_spec(S.PEOPLE, frame, carry=tuple(carry))
    return drop_null_keys(typed, ["transporter_id", "full_name"])


def ingest_routes(raw: DataFrame, snapshot: Column, scope: Sequence[str],
                  arrival: Sequence[str], helper_tags: bool = False, carry: Sequence[str] = ()) -> DataFrame:
    """Route snapshot rows, one per participant.

    ``scope`` names the columns that identify a file and ``arrival`` the columns
    that order its rows, the last one a row number. ``helper_tags`` replaces the service type of tagged helpers.
    """
    keep = tuple(dict.fromkeys([*carry, *scope, *arrival]))
    typed = S.apply_spec(S.ROUTES, raw, {"snapshot_dt": snapshot}, keep)
    rows = explode_participants(typed)
    first = rows.filter("participant_index = 0").withColumn("route_code", F.coalesce("route_code", F.lit("")))
    # each use of the rows parses the texts anew, so helpers are told from the others once
    helpers = blank_helper_columns(
        number_helpers(rows.filter("participant_index > 0"), scope, arrival),
        ["route_duration_min", "all_stops", "stops_complete", "not_started_stops"])
    if helper_tags:
        helpers = tag_helpers(helpers, rows, scope).withColumn(
            "delivery_service_type", F.coalesce("helper_tag", "delivery_service_type")).drop("helper_tag")
    return first.unionByName(helpers).select(*[col(c) for c in carry], *[col(c) for c in S.ROUTES.schema().names])


def ingest_itineraries(raw: DataFrame, file_datetime: Column, split_routes: bool = False,
                       carry: Sequence[str] = (), max_len: int = 200, strategy: str = "truncate") -> DataFrame:
    """Itinerary snapshot rows; the route list stays whole unless ``split_routes``.

    ``strategy`` says what happens to a list of more than ``max_len`` characters (see ``limit_length``).
    """
    spec = S.itineraries(max_len, strategy)
    typed = S.apply_spec(spec, raw, {"file_datetime": file_datetime}, tuple(carry))
    return explode_list(typed, "route_code", "|") if split_routes else typed


def ingest_backlog(raw: DataFrame, max_len: int = 32, carry: Sequence[str] = (),
                   strategy: str = "truncate") -> DataFrame:
    """Backlog itineraries, one row per route code, stamped 23:00 of their day.

    The station follows from the list before it is split. ``strategy`` says what happens to a
    code of more than ``max_len`` characters.
    """
    typed = drop_null_keys(S.apply_spec(S.BACKLOG, raw, carry=tuple(carry)), ["transporter_id"])
    rows = explode_list(typed, "route_code")
    return rows.withColumn("route_code", H.limit_length(col("route_code"), max_len, strategy, "route_code"))


def ingest_table(spec: S.TableSpec, raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Any pipeline that is only headers, parsers and the NOT NULL rows of a spec."""
    return S.apply_spec(spec, raw, carry=tuple(carry))


def ingest_totals(spec: S.TableSpec, raw: DataFrame, by: Sequence[str], sums: Sequence[str] = ()) -> DataFrame:
    """Typed columns ``by`` of ``ingest_table``, with ``n_rows``, the rows that have such texts, and the totals of ``sums``.

    Texts are counted before they are parsed, so each different row of texts is parsed once. Rows that differ in
    spelling only stay apart. A total is null where no row has a number.
    """
    fields = {f.name: f for f in spec.fields}
    frame = canonical_headers(raw, spec.aliases, spec.date_column)
    texts = list(dict.fromkeys(c for c in (fields[n].source or n for n in by) if c in frame.columns))
    added = [n for n in sums if (fields[n].source or n) in frame.columns]
    numbers = [fields[n].parse(col(fields[n].source or n).cast("string")).cast(fields[n].dtype).alias(f"__sum_{n}") for n in added]
    counted = frame.select(*[col(c) for c in texts], *numbers).groupBy(*[col(c) for c in texts]).agg(
        F.count(F.lit(1)).alias("n_rows"), *[F.sum(f"__sum_{n}").alias(f"__sum_{n}") for n in added])
    typed = S.apply_spec(spec, counted, carry=("n_rows", *[f"__sum_{n}" for n in added]))
    return typed.select(*[col(n) for n in by], *[
        (col(f"__sum_{n}") if n in added else F.lit(None).cast("long")).alias(n) for n in sums], "n_rows")


def ingest_quality_daily(raw: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Daily quality rows; rows without a date are dropped."""
    return drop_null_keys(S.apply_spec(S.QUALITY_DAILY, raw, carry=tuple(carry)), ["metric_date"])


def ingest_daily_overview(cells: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Daily metric rows from matrix cells (metric, label, cell)."""
    return daily_metrics(cells, carry).withColumns({
        "metric_value": col("metric_value").try_cast("decimal(18,4)"),
        "source_note": F.lit("DailyOverview")})


def ingest_weekly_overview(cells: DataFrame, existing: DataFrame, this_year: int,
                           scope: Sequence[str], file_year: str | None = None,
                           carry: Sequence[str] = ()) -> DataFrame:
    """Weekly metric rows keyed by (year, week, metric) from matrix cells.

    Labels that end in no digits have no week and are left out here;
    ``weekly_metrics`` shows them.
    """
    kept = list(dict.fromkeys([*carry, *scope, *([file_year] if file_year else [])]))
    dated = resolve_year(weekly_metrics(cells, kept), existing, this_year, scope, file_year)
    return dated.filter(col("week").isNotNull()).select(
        *[col(c) for c in carry], "year", "week", "metric_name",
        col("metric_value").try_cast("decimal(18,4)").alias("metric_value"),
        F.lit("WeeklyOverview").alias("source_note"))


def ingest_rates(raw: DataFrame, iso_year_week: str | Column) -> DataFrame:
    """Revenue rates of one week; rows with any part missing are skipped.

    The four headers are required exactly as written.
    """
    require_columns(raw, ["Station", "Service_type", "Billable hours", "revenue_rate"])
    week = F.lit(iso_year_week) if isinstance(iso_year_week, str) else iso_year_week
    typed = S.apply_spec(S.RATES, raw, {"iso_year_week": week})
    return drop_null_keys(typed, ["station_code", "service_type", "revenue_rate"])
