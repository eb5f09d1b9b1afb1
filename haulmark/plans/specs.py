"""Declared ingest pipelines: header aliases, column parsers, keys and write modes.

One interpreter (``apply_spec``) turns a spec and an all-text frame into one
``select``; pipelines with row shaping add it around that select in
``haulmark.plans.ingest``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F, types as T

from haulmark import functions as H
from haulmark.operators.columns import col
from haulmark.operators.headers import canonical_headers

Parser = Callable[[Column], Column]


@dataclass(frozen=True)
class Field:
    name: str
    parse: Parser
    dtype: str
    source: str | None = None  # canonical raw column when it differs from the name
    required: bool = False  # NOT NULL in the target


@dataclass(frozen=True)
class TableSpec:
    table: str
    aliases: Mapping[str, str]
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()
    mode: str = "ignore_dups"  # ignore_dups | overwrite | coalesce | append
    signature: Mapping[str, Callable[[Column], Column]] = field(default_factory=dict)
    null_safe: tuple[str, ...] = ()
    date_column: str | None = None
    context: Mapping[str, str] = field(default_factory=dict)  # columns set by the run
    lengths: Mapping[str, int] = field(default_factory=dict)  # instead of the declared ones

    def schema(self) -> T.StructType:
        """The columns; the metadata of a text column has its greatest length as ``max_length``."""
        ddl = [f"`{n}` {t}" for n, t in self.context.items()]
        plain = T.StructType.fromDDL(", ".join(ddl + [f"`{f.name}` {f.dtype}" for f in self.fields]))
        lengths = {**LENGTHS.get(self.table, {}), **self.lengths}
        return T.StructType([T.StructField(f.name, f.dataType, True, {"max_length": lengths[f.name]} if f.name in lengths else None)
                             for f in plain.fields])

    def part(self) -> Column | None:
        """The partition of a stored row, a function of its key; none for tables that are small or only appended to."""
        if self.table not in PARTS:
            return None
        name, form = PARTS[self.table]
        return form(col(name))

    def checks(self) -> dict[str, Column]:
        """What a stored row must satisfy: columns that may not be null, and greatest lengths."""
        found = {f"{f.name} missing": col(f.name).isNotNull() for f in self.fields if f.required}
        for f in self.schema().fields:
            if "max_length" in f.metadata:
                most = f.metadata["max_length"]
                found[f"{f.name} longer than {most}"] = F.char_length(col(f.name)) <= most
        return found

    def signature_parts(self) -> list[Column]:
        return [form(col(name)) for name, form in self.signature.items()]


def apply_spec(spec: TableSpec, raw: DataFrame, context: Mapping[str, Column] | None = None,
               carry: tuple[str, ...] = ()) -> DataFrame:
    """Typed projection of a raw text frame; absent optional columns become null."""
    aliases = {**spec.aliases, **{c.lower(): c for c in carry}}
    canonical = canonical_headers(raw, aliases, spec.date_column)
    present = set(canonical.columns)
    out = [col(c) for c in carry]
    for name, dtype in spec.context.items():
        value = (context or {}).get(name, F.lit(None))
        out.append(value.cast(dtype).alias(name))
    for f in spec.fields:
        source = f.source or f.name
        text = col(source).cast("string") if source in present else F.lit(None).cast("string")
        out.append(f.parse(text).cast(f.dtype).alias(f.name))
    return canonical.select(*out)


# --- parsers by short name ---------------------------------------------------

def _dec(precision: int, places: int) -> tuple[Parser, str]:
    return (lambda c: H.to_decimal(c, precision, places)), f"decimal({precision},{places})"


def text(name: str, source: str | None = None, required: bool = False) -> Field:
    return Field(name, H.null_like, "string", source, required)


def integer(name: str, source: str | None = None, dtype: str = "int") -> Field:
    return Field(name, lambda c: H.to_int(c, dtype), dtype, source)


def exact(name: str, source: str | None = None) -> Field:
    return Field(name, H.strict_int, "int", source)


def plain(name: str, source: str | None = None) -> Field:
    return Field(name, H.blank_to_null, "string", source)


def decimal(name: str, precision: int, places: int, source: str | None = None) -> Field:
    parse, dtype = _dec(precision, places)
    return Field(name, parse, dtype, source)


def day(name: str, source: str | None = None, required: bool = False) -> Field:
    return Field(name, H.to_date, "date", source, required)


def moment(name: str, source: str | None = None) -> Field:
    return Field(name, H.to_datetime, "timestamp_ntz", source)


def second(name: str, source: str | None = None) -> Field:
    return Field(name, lambda c: H.round_to_second(H.to_datetime(c)), "timestamp_ntz", source)


def identifier(name: str, separators: str = "|") -> Field:
    return Field(name, lambda c: H.normalize_id(c, separators=separators), "string", required=True)


# --- specs -------------------------------------------------------------------
# The headers, column names and precisions below are fixed values of the data model.

PEOPLE = TableSpec(
    "associate",
    {
        "name and id": "full_name", "full name": "full_name", "fullname": "full_name",
        "name": "full_name", "associate name": "full_name", "driver name": "full_name",
        "delivery associate": "full_name", "employee name": "full_name",
        "display name": "full_name", "preferred name": "full_name",
        "transporter id": "transporter_id", "transporterid": "transporter_id",
        "driver id": "transporter_id", "driverid": "transporter_id",
        "delivery associate id": "transporter_id", "da id": "transporter_id",
        "employee id": "transporter_id", "amazon id": "transporter_id",
        "position": "position_title", "id expiration": "id_expiration_date",
        "id_expiration": "id_expiration_date", "personal phone number": "personal_phone",
        "work phone number": "work_phone", "status": "working_status",
        "first_name": "first_name", "first name": "first_name", "firstname": "first_name",
        "given name": "first_name", "f_name": "first_name",
        "last_name": "last_name", "last name": "last_name", "lastname": "last_name",
        "surname": "last_name", "l_name": "last_name",
    },
    (
        identifier("transporter_id"),
        Field("full_name", H.name_text, "string", required=True),
        text("position_title"), text("qualifications"), day("id_expiration_date"),
        text("personal_phone"), text("work_phone"), text("email"), text("working_status"),
    ),
    key=("transporter_id",), mode="coalesce",
)

ROUTES = TableSpec(
    "routes",
    {
        "route code": "route_code", "dsp": "dsp_name", "transporter id": "transporter_id",
        "driver name": "driver_name", "route progress": "route_progress",
        "delivery service type": "delivery_service_type", "route duration": "route_duration_min",
        "all stops": "all_stops", "stops complete": "stops_complete",
        "not started stops": "not_started_stops",
    },
    (
        text("route_code"), text("dsp_name"), text("transporter_id"), text("driver_name"),
        text("route_progress"), text("delivery_service_type"), integer("route_duration_min"),
        integer("all_stops"), integer("stops_complete"), integer("not_started_stops"),
    ),
    key=("snapshot_dt", "route_code", "transporter_id"), mode="overwrite",
    null_safe=("transporter_id",),
    signature={"snapshot_dt": H.time_text, "route_code": H.key_text, "transporter_id": H.key_text},
    context={"snapshot_dt": "timestamp_ntz"},
)

_ITINERARY_HEADERS = {
    "transporter id": "transporter_id", "driver name": "driver_name", "dsp": "dsp_name",
    "da activity": "da_activity", "route code": "route_code", "progress status": "progress_status",
    "projected return to station": "projected_rts",
    "projected overtime duration (minutes)": "projected_ot_min",
    "delivery service type": "delivery_service_type", "cortex_vin_number": "cortex_vin_number",
    "all stops": "all_stops", "stops complete": "stops_complete",
    "not started stops": "not_started_stops", "total packages": "total_packages",
    "cortex_avg_pace_stops_per_hour": "cortex_avg_pace_sph",
    "cortex_remaining_state_of_charge": "cortex_remaining_soc",
    "cortex_last_stop_execution_time": "cortex_last_stop_exec_time",
    "cortex_total_break_time_used": "cortex_total_break_min",
}


def _itinerary_fields(separators: str, route: Field) -> tuple[Field, ...]:
    return (
        identifier("transporter_id", separators), text("driver_name"), text("dsp_name"),
        text("da_activity"), route, text("progress_status"), integer("projected_rts"),
        integer("projected_ot_min"), text("delivery_service_type"), text("cortex_vin_number"),
        integer("all_stops"), integer("stops_complete"), integer("not_started_stops"),
        integer("total_packages"), decimal("cortex_avg_pace_sph", 9, 2),
        decimal("cortex_remaining_soc", 9, 2), second("app_sign_in_time"),
        second("app_sign_out_time"), second("cortex_last_stop_exec_time"),
        integer("cortex_total_break_min"),
        Field("station_code", lambda c: H.route_station(H.null_like(c)), "string", "route_code"),
    )


_ITINERARY_SIGNATURE = {
    "file_datetime": H.time_text, "transporter_id": H.key_text, "route_code": H.key_text}


def itineraries(max_len: int = 200, strategy: str = "truncate") -> TableSpec:
    """The itinerary table, with the limit of its route list and what happens past it."""
    return TableSpec(
        "itineraries",
        {**_ITINERARY_HEADERS, "app sign in:": "app_sign_in_time", "app sign out:": "app_sign_out_time"},
        _itinerary_fields("|", Field(
            "route_code", lambda c: H.limit_length(H.null_like(c), max_len, strategy, "route_code"), "string")),
        key=("file_datetime", "transporter_id", "route_code"), mode="overwrite",
        null_safe=("route_code",), signature=_ITINERARY_SIGNATURE,
        context={"file_datetime": "timestamp_ntz"}, lengths={"route_code": max_len},
    )


ITINERARIES = itineraries()

BACKLOG = TableSpec(
    "itineraries",
    {"day": "row_date", **_ITINERARY_HEADERS,
     "app sign in": "app_sign_in_time", "app sign out": "app_sign_out_time"},
    (Field("file_datetime", H.day_stamp, "timestamp_ntz", "row_date"),
     *_itinerary_fields("|,", text("route_code"))),
    key=("file_datetime", "transporter_id", "route_code"), mode="ignore_dups",
    null_safe=("route_code",), signature=_ITINERARY_SIGNATURE,
)

SAFETY_EVENTS = TableSpec(
    "safety_events",
    {
        "date": "event_date", "delivery associate": "delivery_associate",
        "transporter id": "transporter_id", "event id": "event_id",
        "date time (pdt/pst)": "event_datetime", "vin": "vin", "oss impact": "oss_impact",
        "metric type": "metric_type", "metric subtype": "metric_subtype", "source": "source",
        "video link": "video_link", "review details": "review_details",
    },
    (
        day("event_date", required=True), text("delivery_associate"), text("transporter_id"),
        integer("event_id", dtype="bigint"), second("event_datetime"), text("vin"),
        text("oss_impact"), text("metric_type"), text("metric_subtype"), text("source"),
        text("video_link"), text("review_details"),
    ),
    key=("event_id", "event_datetime", "transporter_id", "metric_type", "metric_subtype", "vin"),
    signature={"event_id": H.id_text, "event_datetime": H.time_text, "transporter_id": H.key_text,
               "metric_type": H.key_text, "metric_subtype": H.key_text, "vin": H.key_text},
)

FLEET = TableSpec(
    "fleet_vehicles",
    {
        "vin": "vin", "servicetype": "service_type", "vehiclename": "vehicle_name",
        "licenseplatenumber": "license_plate", "make": "make", "model": "model",
        "submodel": "sub_model", "status": "vehicle_status", "statuspriority": "status_priority",
        "statusreasoncode": "status_reason_code", "statusreasonmessage": "status_reason_msg",
        "operationalstatus": "operational_status", "statussearchvalue": "status_search_value",
        "subcontractorname": "subcontractor_name", "vehicleprovider": "vehicle_provider",
        "vehicleregistrationtype": "vehicle_reg_type", "year": "vehicle_year",
        "type": "vehicle_type", "ownershiptype": "ownership_type",
        "ownershipstartdate": "ownership_start", "ownershipenddate": "ownership_end",
        "pmstats": "pm_stats", "registrationexpirydate": "registration_expiry",
        "registeredstate": "registered_state", "servicetier": "service_tier",
        "stationcode": "station_code", "payload": "payload", "cubiccapacity": "cubic_capacity",
    },
    (
        text("vin", required=True), text("service_type"), text("vehicle_name"),
        text("license_plate"), text("make"), text("model"), text("sub_model"),
        text("vehicle_status"), integer("status_priority"), text("status_reason_code"),
        text("status_reason_msg"), text("operational_status"), text("status_search_value"),
        text("subcontractor_name"), text("vehicle_provider"), text("vehicle_reg_type"),
        integer("vehicle_year"), text("vehicle_type"), text("ownership_type"),
        day("ownership_start"), day("ownership_end"), text("pm_stats"),
        day("registration_expiry"), text("registered_state"), text("service_tier"),
        text("station_code"), text("payload"), text("cubic_capacity"),
    ),
    key=("vin",), mode="overwrite",
)

DAILY_OVERVIEW = TableSpec(
    "daily_overview", {},
    (
        Field("metric_date", H.to_date, "date", required=True), text("metric_name", required=True),
        Field("metric_value", H.percent_number, "decimal(18,4)"), text("source_note"),
    ),
    key=("metric_date", "metric_name"), mode="overwrite",
)

WEEKLY_OVERVIEW = TableSpec(
    "weekly_overview", {},
    (
        integer("year"), integer("week"), text("metric_name", required=True),
        Field("metric_value", H.percent_number, "decimal(18,4)"), text("source_note"),
    ),
    key=("year", "week", "metric_name"), mode="overwrite",
)

QUALITY_DAILY = TableSpec(
    "quality_overview_daily",
    {
        "date": "metric_date", "delivery date": "metric_date", "metric date": "metric_date",
        "delivery associate": "delivery_associate", "da name": "delivery_associate",
        "driver name": "delivery_associate", "transporter id": "transporter_id",
        "driver id": "transporter_id", "da id": "transporter_id",
        "packages delivered": "packages_delivered", "routes completed": "routes_completed",
        "dcr": "dcr_percent", "pod": "pod_percent", "dsb count": "dsb_count",
    },
    (
        day("metric_date", required=True), text("delivery_associate"), text("transporter_id"),
        Field("packages_delivered", lambda c: H.opt_int(H.plain_number(c)), "int"),
        Field("routes_completed", lambda c: H.opt_int(H.plain_number(c)), "int"),
        Field("dcr_percent", lambda c: H.percent_number(c).try_cast("decimal(6,2)"), "decimal(6,2)"),
        Field("pod_percent", lambda c: H.percent_number(c).try_cast("decimal(6,2)"), "decimal(6,2)"),
        Field("dsb_count", lambda c: H.opt_int(H.plain_number(c)), "int"),
    ),
    key=("metric_date", "transporter_id"), date_column="metric_date",
    signature={"metric_date": H.time_text, "transporter_id": H.key_text},
)

DAILY_SCORECARD = TableSpec(
    "daily_scorecard",
    {
        "week": "week_label", "delivery associate name": "delivery_associate_name",
        "delivery associate id": "delivery_associate_id", "delivered packages": "delivered_packages",
        "packages delivered not received (dnr)": "packages_dnr", "dsb count": "dsb_count",
        "dsb dpmo": "dsb_dpmo", "dispatched packages": "dispatched_packages",
        "packages returned to station (rts)": "packages_rts",
        "packages returned to station (rts) %": "packages_rts_percent",
        "return to station dpmo": "rts_dpmo",
    },
    (
        text("week_label"), text("delivery_associate_name"), text("delivery_associate_id"),
        integer("delivered_packages"), integer("packages_dnr"), integer("dsb_count"),
        integer("dsb_dpmo"), integer("dispatched_packages"), integer("packages_rts"),
        decimal("packages_rts_percent", 9, 4), integer("rts_dpmo"),
    ),
    key=("week_label", "delivery_associate_id"),
    signature={"week_label": H.key_text, "delivery_associate_id": H.key_text},
)

_STATION_HEADERS = {
    "dsp": "dsp_code", "dispatched packages": "dispatched_pkg",
    "delivered packages": "delivered_pkg", "delivered not received (dnr)": "dnr",
    "dnr dpmo": "dnr_dpmo", "returned to station (rts)": "rts", "rts %": "rts_percent",
    "rts dpmo": "rts_dpmo",
}
_STATION_FIELDS = (
    text("dsp_code"), integer("dispatched_pkg"), integer("delivered_pkg"), integer("dnr"),
    integer("dnr_dpmo"), integer("rts"), decimal("rts_percent", 6, 3), integer("rts_dpmo"),
)

STATION_DAILY = TableSpec(
    "station_metrics_daily", {"date": "metric_date", **_STATION_HEADERS},
    (day("metric_date", required=True), *_STATION_FIELDS), key=("metric_date", "dsp_code"),
    signature={"metric_date": H.time_text, "dsp_code": H.key_text},
)

STATION_WEEKLY = TableSpec(
    "station_metrics_weekly", {"week": "iso_year_week", **_STATION_HEADERS},
    (Field("iso_year_week", lambda c: H.null_like(H.week_label(c)), "string", required=True),
     *_STATION_FIELDS),
    key=("iso_year_week", "dsp_code"),
    signature={"iso_year_week": H.key_text, "dsp_code": H.key_text},
)

DELIVERED_PACKAGES = TableSpec(
    "wst_delivered_packages",
    {
        "date": "metric_date", "station": "station", "dsp short code": "dsp_short_code",
        "package count": "package_count", "package details": "package_details",
        "package type": "package_type",
    },
    (
        day("metric_date", required=True), text("station"), text("dsp_short_code"),
        integer("package_count"), text("package_details"), text("package_type"),
    ),
    key=("metric_date", "station", "package_type", "package_details"),
    signature={"metric_date": H.time_text, "station": H.key_text, "package_type": H.key_text,
               "package_details": H.key_text},
)

SERVICE_DETAILS = TableSpec(
    "wst_service_details",
    {
        "date": "row_date", "station": "station", "dsp short code": "dsp_short_code",
        "delivery associate": "delivery_associate", "route": "route_code",
        "service type": "service_type", "planned duration": "planned_duration_label",
        "log in": "login_ts", "log out": "logout_ts",
        "total distance planned": "total_distance_planned",
        "total distance allowance": "total_distance_allow", "distance unit": "distance_unit",
        "shipments delivered": "shipments_delivered", "shipments returned": "shipments_returned",
        "pickup packages": "pickup_packages", "excluded?": "excluded_flag",
    },
    (
        day("row_date"), text("station"), text("dsp_short_code"), text("delivery_associate"),
        text("route_code"), text("service_type"), text("planned_duration_label"),
        moment("login_ts"), moment("logout_ts"), integer("total_distance_planned"),
        integer("total_distance_allow"), text("distance_unit"), integer("shipments_delivered"),
        integer("shipments_returned"), integer("pickup_packages"), text("excluded_flag"),
    ),
    key=("row_date", "route_code", "delivery_associate", "station"),
    signature={"row_date": H.time_text, "route_code": H.key_text,
               "delivery_associate": H.key_text, "station": H.key_text},
)

TRAINING = TableSpec(
    "wst_training_weekly_report",
    {
        "assignment date": "assignment_date", "payment date": "payment_date", "station": "station",
        "dsp short code": "dsp_short_code", "delivery associate": "delivery_associate",
        "service type": "service_type", "course name": "course_name", "chapter name": "chapter_name",
        "total duration": "total_duration_label", "dsp payment eligible": "dsp_payment_eligible",
    },
    (
        day("assignment_date"), day("payment_date"), text("station"), text("dsp_short_code"),
        text("delivery_associate"), text("service_type"), text("course_name"),
        text("chapter_name"), text("total_duration_label"),
        Field("total_hours", lambda c: H.hours_label(H.null_like(c)), "int", "total_duration_label"),
        text("dsp_payment_eligible"),
    ),
    mode="append",
)

UNPLANNED_DELAY = TableSpec(
    "wst_unplanned_delay",
    {
        "date": "row_date", "station": "station", "dsp short code": "dsp_short_code",
        "unplanned delay": "unplanned_delay", "total delay in minutes": "total_delay_min",
        "impacted routes": "impacted_routes", "notes": "notes",
    },
    (
        day("row_date"), text("station"), text("dsp_short_code"), text("unplanned_delay"),
        integer("total_delay_min"), integer("impacted_routes"), text("notes"),
    ),
    key=("row_date", "station", "unplanned_delay"),
    signature={"row_date": H.time_text, "station": H.key_text, "unplanned_delay": H.key_text},
)

WEEKLY_WORK = TableSpec(
    "wst_weekly_report",
    {
        "date": "row_date", "station": "station", "dsp short code": "dsp_short_code",
        "service type": "service_type", "planned duration": "planned_duration_label",
        "total distance planned": "total_distance_planned",
        "total distance allowance": "total_distance_allow",
        "planned distance unit": "planned_distance_unit", "amzl late cancel": "amzl_late_cancel",
        "dsp late cancel": "dsp_late_cancel", "quick coverage": "quick_coverage",
        "accepted": "accepted", "completed routes": "completed_routes",
    },
    (
        day("row_date", required=True), text("station"), text("dsp_short_code"),
        text("service_type"), text("planned_duration_label"), integer("total_distance_planned"),
        integer("total_distance_allow"), text("planned_distance_unit"), text("amzl_late_cancel"),
        text("dsp_late_cancel"), text("quick_coverage"), text("accepted"),
        integer("completed_routes"),
    ),
    mode="append",
)

# Scorecard metric groups: (column stem, headers of the metric, tier and score,
# digits of the metric column). The FICO metric is text.
_SIGNAL_SPELLINGS = ("sign/ signal", "sign/signal", "sign / signal")
_WEEKLY_GROUPS = (
    ("fico_metric", "fico", "fico metric", "fico", None),
    ("speeding_event_rate", "speeding_event_rate", "speeding event rate (per trip)",
     "speeding event rate", (9, 4)),
    ("seatbelt_off_rate", "seatbelt_off_rate", "seatbelt-off rate (per trip)",
     "seatbelt-off rate", (9, 4)),
    ("distractions_rate", "distractions_rate", "distractions rate (per trip)",
     "distractions rate", (9, 4)),
    ("sign_signal_viol_rate", "sign_signal_viol_rate", "sign/ signal violations rate (per trip)",
     "sign/ signal violations rate", (9, 4)),
    ("following_dist_rate", "following_dist_rate", "following distance rate (per trip)",
     "following distance rate", (9, 4)),
    ("cdf_dpmo", "cdf_dpmo", "cdf dpmo", "cdf dpmo", (9, 2)),
    ("ced_metric", "ced", "ced", "ced", (9, 2)),
    ("dcr_metric", "dcr", "dcr", "dcr", (9, 2)),
    ("dsb_metric", "dsb_dpmo", "dsb", "dsb dpmo", (9, 2)),
    ("pod_metric", "pod", "pod", "pod", (9, 2)),
    ("psb_metric", "psb", "psb", "psb", (9, 2)),
)


def _weekly_scorecard() -> TableSpec:
    aliases = {
        "week": "year_week_label", "delivery associate": "delivery_associate_name",
        "transporter id": "transporter_id", "overall standing": "overall_standing",
        "overall score": "overall_score",
    }
    fields: list[Field] = [
        text("year_week_label"), text("delivery_associate_name"), text("transporter_id"),
        text("overall_standing"), Field("overall_score", lambda c: H.num_dec(c, 6, 2), "decimal(6,2)"),
    ]
    for metric, stem, header, prefix, digits in _WEEKLY_GROUPS:
        headers = {header: metric, f"{prefix} tier": f"{stem}_tier", f"{prefix} score": f"{stem}_score"}
        for name, target in headers.items():
            aliases[name] = target
            if name.startswith(_SIGNAL_SPELLINGS[0]):
                for other in _SIGNAL_SPELLINGS[1:]:
                    aliases[name.replace(_SIGNAL_SPELLINGS[0], other)] = target
        fields.append(decimal(metric, *digits) if digits else text(metric))
        fields += [text(f"{stem}_tier"), decimal(f"{stem}_score", 6, 2)]
    aliases["packages delivered"] = "packages_delivered"
    fields.append(exact("packages_delivered"))
    return TableSpec(
        "weekly_scorecard", aliases, tuple(fields), key=("year_week_label", "transporter_id"),
        signature={"year_week_label": H.key_text, "transporter_id": H.key_text})


WEEKLY_SCORECARD = _weekly_scorecard()

TENURE_REPORT = TableSpec(
    "tenure_backlog_raw",
    {
        "row id": "row_id", "dsp": "dsp", "station": "station", "year": "year", "week": "week",
        "employee id": "employee_id", "transporter id": "transporter_id", "name": "name",
        "days since last delivered": "days_since_last_delivered",
        "delivery status": "delivery_status", "driver status": "driver_status",
        "driver status reason code": "driver_status_reason_code",
        "lifetime routes": "lifetime_routes", "routes in week": "routes_in_week",
        "tenure status": "tenure_status", "country": "country",
    },
    (
        exact("row_id"), plain("dsp"), plain("station"), exact("year"), exact("week"),
        plain("employee_id"), plain("transporter_id"), plain("name"),
        exact("days_since_last_delivered"), plain("delivery_status"), plain("driver_status"),
        plain("driver_status_reason_code"), exact("lifetime_routes"), exact("routes_in_week"),
        plain("tenure_status"), plain("country"),
    ),
    mode="append",
)

RATES = TableSpec(
    "revenue_rate", {},
    (
        Field("station_code", H.station_code, "string", "station", True),
        Field("service_type", H.service_type, "string", required=True),
        Field("revenue_rate", lambda c: H.to_float(c).try_cast("decimal(18,4)"), "decimal(18,4)",
              required=True),
    ),
    key=("station_code", "service_type", "iso_year_week"), mode="overwrite",
    context={"iso_year_week": "string"},
)

ALL_SPECS = {
    "associate": PEOPLE, "routes": ROUTES, "itineraries": ITINERARIES, "backlog": BACKLOG,
    "safety_events": SAFETY_EVENTS, "fleet_vehicles": FLEET, "daily_overview": DAILY_OVERVIEW,
    "weekly_overview": WEEKLY_OVERVIEW, "quality_overview_daily": QUALITY_DAILY,
    "daily_scorecard": DAILY_SCORECARD, "station_metrics_daily": STATION_DAILY,
    "station_metrics_weekly": STATION_WEEKLY, "wst_delivered_packages": DELIVERED_PACKAGES,
    "wst_service_details": SERVICE_DETAILS, "wst_training_weekly_report": TRAINING,
    "wst_unplanned_delay": UNPLANNED_DELAY, "wst_weekly_report": WEEKLY_WORK,
    "weekly_scorecard": WEEKLY_SCORECARD, "tenure_backlog_raw": TENURE_REPORT,
    "revenue_rate": RATES,
}

#: Stored tables that are partitioned: the column that says where a row is, which is part of its key, and how.
PARTS: dict[str, tuple[str, Callable[[Column], Column]]] = {
    "routes": ("snapshot_dt", H.day_part), "itineraries": ("file_datetime", H.day_part), "safety_events": ("event_datetime", H.day_part),
    "daily_overview": ("metric_date", H.day_part), "weekly_overview": ("year", H.text_part),
    "quality_overview_daily": ("metric_date", H.day_part), "daily_scorecard": ("week_label", H.text_part),
    "weekly_scorecard": ("year_week_label", H.text_part), "station_metrics_daily": ("metric_date", H.day_part),
    "station_metrics_weekly": ("iso_year_week", H.text_part), "wst_delivered_packages": ("metric_date", H.day_part),
    "wst_service_details": ("row_date", H.day_part), "wst_unplanned_delay": ("row_date", H.day_part),
    "revenue_log": ("row_date", H.day_part),
}

# Declared lengths of text columns.
LENGTHS: dict[str, dict[str, int]] = {
    "associate": {"transporter_id": 16, "full_name": 200, "position_title": 200, "qualifications": 400, "personal_phone": 32,
                  "work_phone": 32, "email": 256, "working_status": 64},
    "routes": {"route_code": 32, "dsp_name": 200, "transporter_id": 16, "driver_name": 200, "route_progress": 64,
               "delivery_service_type": 200},
    "itineraries": {"transporter_id": 64, "driver_name": 128, "dsp_name": 128, "da_activity": 64, "route_code": 64,
                    "progress_status": 64, "delivery_service_type": 200, "cortex_vin_number": 64, "station_code": 32},
    "safety_events": {"delivery_associate": 200, "transporter_id": 16, "vin": 32, "oss_impact": 8, "metric_type": 100,
                      "metric_subtype": 100, "source": 64, "video_link": 512, "review_details": 1000},
    "daily_overview": {"metric_name": 128, "source_note": 64},
    "weekly_overview": {"metric_name": 128, "source_note": 64},
    "quality_overview_daily": {"delivery_associate": 200, "transporter_id": 16},
    "daily_scorecard": {"week_label": 32, "delivery_associate_name": 200, "delivery_associate_id": 64},
    "station_metrics_daily": {"dsp_code": 32},
    "station_metrics_weekly": {"iso_year_week": 16, "dsp_code": 32},
    "wst_delivered_packages": {"station": 128, "dsp_short_code": 32, "package_details": 128, "package_type": 128},
    "wst_service_details": {"station": 128, "dsp_short_code": 32, "delivery_associate": 200, "route_code": 32, "service_type": 200,
                            "planned_duration_label": 32, "distance_unit": 32, "excluded_flag": 8},
    "wst_unplanned_delay": {"station": 128, "dsp_short_code": 32, "unplanned_delay": 256, "notes": 1000},
    "wst_weekly_report": {"station": 128, "dsp_short_code": 32, "service_type": 200, "planned_duration_label": 32,
                          "planned_distance_unit": 32, "amzl_late_cancel": 32, "dsp_late_cancel": 32, "quick_coverage": 32, "accepted": 32},
    "weekly_scorecard": {"year_week_label": 16, "delivery_associate_name": 200, "transporter_id": 32, "overall_standing": 50,
                         "fico_metric": 64, "fico_tier": 50},
}
