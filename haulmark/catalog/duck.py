"""SQL text of the parsers, written for DuckDB, for checking the Spark functions."""

from __future__ import annotations

from collections.abc import Sequence

_NUMBER = r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?"


def strip(x: str) -> str:
    return rf"regexp_replace({x}, '^\s+|\s+$', '', 'g')"


def null_like(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN {s} IN ('', 'null', 'none', 'n/a', 'na', 'missing', 'NULL', 'Missing', "
            f"'N/A', 'NA') THEN NULL ELSE {s} END)")


def name_text(x: str) -> str:
    s = strip(x)
    return f"(CASE WHEN {s} IN ('', 'N/A', 'Missing', 'NULL') THEN NULL ELSE {s} END)"


def blank_to_null(x: str) -> str:
    return f"nullif({strip(x)}, '')"


def _no_commas(x: str) -> str:
    return f"replace({strip(x)}, ',', '')"


def to_int(x: str, dtype: str = "INTEGER") -> str:
    s = strip(_no_commas(x))
    return rf"(CASE WHEN regexp_full_match({s}, '[+-]?\d+') THEN try_cast({s} AS {dtype}) END)"


def strict_int(x: str) -> str:
    s = strip(x)
    return rf"(CASE WHEN regexp_full_match({s}, '[+-]?\d+') THEN try_cast({s} AS INTEGER) END)"


def _number(s: str, dtype: str) -> str:
    return f"(CASE WHEN regexp_full_match({strip(s)}, '{_NUMBER}') THEN try_cast({strip(s)} AS {dtype}) END)"


def to_decimal(x: str, precision: int = 18, places: int = 2) -> str:
    s = f"regexp_replace({_no_commas(x)}, '%$', '')"
    return f"CAST({_number(s, f'DECIMAL({precision},{places})')} AS DOUBLE)"


def num_dec(x: str, precision: int = 18, places: int = 2) -> str:
    s = strip(f"regexp_replace({_no_commas(x)}, '%$', '')")
    dtype = f"DECIMAL({precision},{places})"
    token = rf"nullif(regexp_extract({s}, '[-+]?\d+(?:\.\d+)?'), '')"
    return f"CAST(coalesce({_number(s, dtype)}, try_cast({token} AS {dtype})) AS DOUBLE)"


def to_float(x: str) -> str:
    return _number(f"regexp_replace({_no_commas(x)}, '%$', '')", "DOUBLE")


def percent_number(x: str) -> str:
    return _number(f"regexp_replace({_no_commas(x)}, '%+$', '')", "DOUBLE")


def plain_number(x: str) -> str:
    return _number(_no_commas(x), "DOUBLE")


def opt_int(x: str) -> str:
    return f"CAST(trunc({x}) AS INTEGER)"


def to_date(x: str) -> str:
    s = strip(x)
    return (rf"(CASE WHEN regexp_full_match({s}, '\d{{4}}-\d{{1,2}}-\d{{1,2}}') THEN try_cast({s} AS DATE) "
            rf"WHEN regexp_full_match({s}, '\d{{1,2}}/\d{{1,2}}/\d{{4}}') "
            f"THEN CAST(try_strptime({s}, '%m/%d/%Y') AS DATE) END)")


def to_datetime(x: str) -> str:
    s = strip(x)
    return (rf"(CASE WHEN regexp_full_match({s}, '\d{{4}}-\d{{1,2}}-\d{{1,2}}( .*)?') THEN try_cast({s} AS TIMESTAMP) "
            rf"WHEN regexp_full_match({s}, '\d{{1,2}}/\d{{1,2}}/\d{{4}} \d{{1,2}}:\d{{2}}') "
            f"THEN try_strptime({s}, '%m/%d/%Y %H:%M') "
            rf"WHEN regexp_full_match({s}, '\d{{1,2}}/\d{{1,2}}/\d{{4}} \d{{1,2}}:\d{{2}} [AP]M') "
            f"THEN try_strptime({s}, '%m/%d/%Y %I:%M %p') END)")


def round_second(x: str) -> str:
    return f"date_trunc('second', {x} + INTERVAL 500 MILLISECONDS)"


def hours_label(x: str) -> str:
    return rf"CAST(nullif(regexp_extract({x}, '(?i)(\d+)\s*hr', 1), '') AS INTEGER)"


def station_code(x: str) -> str:
    return (rf"coalesce(upper(nullif(regexp_extract({x}, '\(([A-Za-z0-9]+)\)', 1), '')), "
            rf"upper(nullif(regexp_extract({x}, '(?i)\b(DSW\d+)\b', 1), '')), "
            f"nullif(left(upper({strip(x)}), 32), ''))")


def service_type(x: str) -> str:
    s = strip(x)
    return (f"(CASE WHEN contains(lower({s}), 'package') THEN 'Package' "
            f"WHEN contains(lower({s}), 'incentive') THEN 'Incentive' ELSE nullif({s}, '') END)")


def normalize_id(x: str, separators: str = "|", max_len: int = 64) -> str:
    s = strip(x)
    one = s
    for c in separators:
        one = f"replace({one}, '{c}', '|')"
    return (f"(CASE WHEN lower({s}) IN ('', 'null', 'none', 'n/a', 'missing') THEN NULL "
            f"ELSE left({strip(f'''split_part({one}, '|', 1)''')}, {max_len}) END)")


def split_list(x: str, separators: str = "|") -> str:
    one = x
    for c in separators:
        one = f"replace({one}, '{c}', '|')"
    return f"list_filter(list_transform(string_split({one}, '|'), lambda p: {strip('p')}), lambda p: p <> '')"


def route_station(x: str) -> str:
    return f"(CASE WHEN {x} IS NULL THEN NULL WHEN upper(trim({x})) LIKE 'IS%' THEN 'dsw2' ELSE 'dsw3' END)"


def week_label(x: str) -> str:
    s = strip(x)
    pattern = r"(\d{4}).*?(\d{2})"
    return (f"nullif(CASE WHEN regexp_matches({s}, '{pattern}') THEN regexp_extract({s}, '{pattern}', 1) "
            f"|| '-W' || regexp_extract({s}, '{pattern}', 2) ELSE {s} END, '')")


def trailing_digits(x: str) -> str:
    return rf"CAST(nullif(regexp_extract({x}, '(\d+)$', 1), '') AS INTEGER)"


def iso_week(d: str) -> str:
    return f"CAST(isoyear({d}) AS VARCHAR) || '-W' || lpad(CAST(weekofyear({d}) AS VARCHAR), 2, '0')"


def key_text(x: str) -> str:
    return f"coalesce(upper(trim({x})), '#NULL#')"


def time_text(x: str) -> str:
    return f"coalesce(replace(CAST({x} AS VARCHAR), ' ', 'T'), '')"


def signature(parts: Sequence[str]) -> str:
    return "sha256(" + " || '|' || ".join(parts) + ")"


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient rounded half up, for non-negative whole numbers."""
    return f"((2 * CAST({numerator} AS HUGEINT) + {denominator}) // (2 * {denominator}))"


def average(cents: str, count: str, in_places: int, out_places: int = 6) -> str:
    """Average of scaled whole numbers rounded half up to ``out_places``, scaled by 10^out_places."""
    return half_up(f"{cents} * {10 ** (out_places - in_places)}", count)
