"""Dates, timestamps, file-name times and the two week calendars' labels.

All timestamps are zone-free (``timestamp_ntz``): file names and exports carry
local wall-clock time and it is kept as written.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from haulmark.functions.text import strip_common

__all__ = [
    "to_datetime", "to_date", "round_to_second", "day_stamp", "filename_timestamp",
    "filename_week_year", "iso_week_label", "week_monday", "week_sunday", "label_monday",
    "label_year", "label_week", "sunday_week_start", "sunday_week_end", "sunday_week_year",
    "sunday_week_number",
]

# Accepted spellings besides year-month-day with dashes, rewritten to that form.
# Where both readings fit the month comes first; a first number above 12 is a day.
# Two-digit years up to 75 belong to this century.
_NUMERIC = (
    r"^(?:(0?[1-9]|1[0-2])[/.-](\d{1,2})[/.-](\d{4})|(1[3-9]|2\d|3[01])[/.-](\d{1,2})[/.-](\d{4})"
    r"|(\d{4})[/.]?(\d{1,2})[/.]?(\d{1,2}))(?=[ T]|$)")
_NUMERIC_FORM = "$3$6$7-$1$5$8-$2$4$9"
_SHORT_YEAR = r"^(\d{1,2}[/.-]\d{1,2}[/.-])(\d{2})(?=[ T]|$)"
_OLD_YEAR = r"^(\d{1,2}[/.-]\d{1,2}[/.-])20(7[6-9]|[89]\d)(?=[ T]|$)"

# Month names by their first three letters, in order.
_MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
_MONTH = "(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*"
_NAMED_MONTH_FIRST = r"(?i)^(?:[a-z]+,?\s+)?" + _MONTH + r"\.?\s+(\d{1,2})(?:st|nd|rd|th)?,?\s+(\d{4})(?:,?\s+(?=\S)|$)"
_NAMED_DAY_FIRST = r"(?i)^(?:[a-z]+,?\s+)?(\d{1,2})(?:st|nd|rd|th)?[\s-]+" + _MONTH + r"[\s.,-]+(\d{4})(?:,?\s+(?=\S)|$)"

_MARKED_HOUR = r"(?i)(\d{1,2}):\d{2}(?::\d{2}(?:\.\d+)?)?\s*[ap]\.?m\.?$"
_HALF_DAY = r"(?i)\s*([ap])\.?m\.?$"


def _numeric_forms(s: Column) -> Column:
    """Numeric spellings to year-month-day, null where none fits."""
    full = F.regexp_replace(F.regexp_replace(s, _SHORT_YEAR, "$120$2"), _OLD_YEAR, "$119$2")
    dated = F.when(s.rlike(_SHORT_YEAR), full).otherwise(s)
    return F.nullif(F.regexp_replace(dated, _NUMERIC, _NUMERIC_FORM), s)


def _named_forms(s: Column) -> Column:
    """Spellings with a month name to year-month-day."""
    marked = F.regexp_replace(
        F.regexp_replace(s, _NAMED_MONTH_FIRST, "$3-#$1-$2 "), _NAMED_DAY_FIRST, "$3-#$2-$1 ")
    name = F.lower(F.regexp_extract(marked, "#([A-Za-z]{3})", 1))
    number = ((F.instr(F.lit(_MONTHS), name) + 2) / 3).cast("int").cast("string")
    return F.regexp_replace(marked, F.lit("#[A-Za-z]+"), number)


def _wall_clock(s: Column) -> Column:
    """Timestamp of the text without its AM or PM mark.

    ISO text, the usual case, goes straight to the cast, which is null for bad text
    and never raises. It would accept a bare year and month, so short text is not ISO.
    """
    iso = (F.substring(s, 5, 1) == "-") & (F.length(s) >= 8)
    named = s.rlike("[A-Za-z]{3}")
    text = F.when(iso, s).when(named, _named_forms(s)).otherwise(_numeric_forms(s))
    return F.regexp_replace(text, _HALF_DAY, "").try_cast("timestamp_ntz")


def to_datetime(c: Column) -> Column:
    """Free-form date and time; anything outside the accepted spellings becomes null.

    The hours to add for an AM or PM mark come from the text, so the parsed
    timestamp appears once in the expression.
    """
    s = strip_common(c)
    hour = F.nullif(F.regexp_extract(s, _MARKED_HOUR, 1), F.lit("")).try_cast("int")
    morning = F.lower(F.regexp_extract(s, _HALF_DAY, 1)) == "a"
    shift = F.when(s.rlike(_HALF_DAY), F.when(hour > 12, None).when(
        hour == 12, F.when(morning, -12).otherwise(0)).otherwise(
        F.when(morning, 0).otherwise(12))).otherwise(0)
    return _wall_clock(s) + F.make_dt_interval(F.lit(0), shift)


def to_date(c: Column) -> Column:
    return _wall_clock(strip_common(c)).cast("date")


def round_to_second(c: Column) -> Column:
    """Timestamp rounded half up to the second, without passing through a time zone."""
    moved = (c + F.expr("INTERVAL '0.5' SECOND")).cast("string")
    return F.left(moved, F.lit(19)).try_cast("timestamp_ntz")


def day_stamp(c: Column) -> Column:
    """23:00 on the given day; a bare number counts days from 1899-12-30."""
    s = strip_common(c)
    serial = F.date_add(F.lit("1899-12-30").cast("date"),
                        F.floor(s.try_cast("double")).cast("int"))
    day = F.when(s.rlike(r"^\d{1,6}(\.\d+)?$"), serial).otherwise(to_date(c))
    return day.cast("timestamp_ntz") + F.expr("INTERVAL 23 HOURS")


_FILE_TIME = r"(\d{4})[-_](\d{2})[-_](\d{2})[_\-\s](\d{1,2})[:_\-](\d{2})(?:[:_\-](\d{2}))?"


def filename_timestamp(name: Column) -> Column:
    """Time written in a file name; seconds are optional, an impossible time is null."""
    part = [F.regexp_extract(name, _FILE_TIME, i) for i in range(1, 7)]
    day = F.concat_ws("-", part[0], part[1], part[2])
    clock = F.concat_ws(":", part[3], part[4], F.when(part[5] != "", part[5]).otherwise("00"))
    return F.concat_ws(" ", day, clock).try_cast("timestamp_ntz")


def filename_week_year(name: Column) -> Column:
    """Year of a ``YYYY-Www`` mark in a file name."""
    year = F.regexp_extract(F.lower(name), r"(\d{4})-w(\d{1,2})", 1)
    return F.nullif(year, F.lit("")).try_cast("int")


def iso_week_label(d: Column) -> Column:
    """``YYYY-Www`` with the ISO year."""
    year = F.extract(F.lit("YEAROFWEEK"), d).cast("string")
    return F.concat(year, F.lit("-W"), F.lpad(F.weekofyear(d).cast("string"), 2, "0"))


def week_monday(d: Column) -> Column:
    return F.trunc(d, "week")


def week_sunday(d: Column) -> Column:
    return F.date_add(F.trunc(d, "week"), 6)


def label_monday(label: Column) -> Column:
    """Monday of an ISO week label; January 4 always lies in week 1."""
    pattern = r"^(\d{4})-W(\d{1,2})$"
    year = F.nullif(F.regexp_extract(label, pattern, 1), F.lit("")).try_cast("int")
    week = F.nullif(F.regexp_extract(label, pattern, 2), F.lit("")).try_cast("int")
    first = F.trunc(F.make_date(year, F.lit(1), F.lit(4)), "week")
    return F.date_add(first, (week - 1) * 7)


def label_year(label: Column) -> Column:
    return F.left(label, F.lit(4)).try_cast("int")


def label_week(label: Column) -> Column:
    return F.right(label, F.lit(2)).try_cast("int")


# Sunday-to-Saturday calendar. A week belongs to the year whose January 1 it
# holds, which is the year of its Saturday.
def sunday_week_start(d: Column) -> Column:
    return F.date_sub(d, F.dayofweek(d) - 1)


def sunday_week_end(d: Column) -> Column:
    return F.date_add(d, 7 - F.dayofweek(d))


def sunday_week_year(d: Column) -> Column:
    return F.year(sunday_week_end(d))


def sunday_week_number(d: Column) -> Column:
    new_year = F.make_date(sunday_week_year(d), F.lit(1), F.lit(1))
    days = F.datediff(sunday_week_start(d), sunday_week_start(new_year))
    return (days / 7).cast("int") + 1
