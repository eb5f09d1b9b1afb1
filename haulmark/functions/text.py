"""Text cleaning, identifiers, labels and row signatures."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

__all__ = [
    "NULL_WORDS", "NAME_NULL_WORDS", "ID_NULL_WORDS", "strip", "strip_common", "null_like", "blank_to_null",
    "name_text", "limit_length", "normalize_id", "split_list", "station_code",
    "route_station", "week_label", "service_type", "full_name", "canonical_key",
    "row_signature", "key_text", "time_text", "id_text", "NO_PART", "day_part", "text_part",
]

# Cells that mean "no value". The comparison is case-sensitive.
NULL_WORDS = ("", "null", "none", "n/a", "na", "missing", "NULL", "Missing", "N/A", "NA")
# The shorter list that applies to a person's name.
NAME_NULL_WORDS = ("", "N/A", "Missing", "NULL")
# Identifiers that mean "no identifier", compared in lower case.
ID_NULL_WORDS = ("", "null", "none", "n/a", "missing")

# Space characters that trimming removes: ASCII controls and Unicode separators.
_COMMON_SPACES = " \t\n\x0b\x0c\r\xa0"
_SPACE = r"[\s\p{Z}\x1c-\x1f\x85]"


def strip_common(c: Column) -> Column:
    """Trim ASCII white space and no-break spaces."""
    return F.btrim(c, F.lit(_COMMON_SPACES))


def strip(c: Column) -> Column:
    """Trim every kind of space at both ends (SQL ``trim`` removes blanks only)."""
    return F.regexp_replace(c, f"^{_SPACE}+|{_SPACE}+$", "")


def null_like(c: Column, words: Sequence[str] = NULL_WORDS) -> Column:
    """Trimmed text, or null where the trimmed text is one of ``words``.

    One pattern removes the spaces or a whole null word, so the cell is scanned
    and mentioned once.
    """
    word = "|".join(w for w in words if w)
    pattern = f"^{_SPACE}*(?:{word})?{_SPACE}*$|^{_SPACE}+|{_SPACE}+$"
    return F.nullif(F.regexp_replace(c, pattern, ""), F.lit(""))


def blank_to_null(c: Column) -> Column:
    """Trimmed text, or null where nothing is left."""
    return F.nullif(strip(c), F.lit(""))


def name_text(c: Column) -> Column:
    return null_like(c, NAME_NULL_WORDS)


def limit_length(c: Column, max_len: int, strategy: str = "truncate",
                 field: str = "value") -> Column:
    """Cut text longer than ``max_len``; with ``strategy='error'`` fail the job, with ``'keep'`` leave it to the table's checks."""
    if strategy == "truncate":
        return F.left(c, F.lit(max_len))
    if strategy == "keep":
        return c
    if strategy != "error":
        raise ValueError(f"unknown length strategy: {strategy}")
    message = F.concat(F.lit(f"{field} is longer than {max_len}: "), c)
    return F.when(F.length(c) > max_len, F.raise_error(message).cast("string")).otherwise(c)


def normalize_id(c: Column, max_len: int = 64, strategy: str = "error",
                 separators: str = "|", field: str = "transporter_id") -> Column:
    """One identifier: trimmed, null words out, first token of a stray list, length checked."""
    s = strip(c)
    first = strip(F.split_part(F.translate(s, separators, "|" * len(separators)),
                               F.lit("|"), F.lit(1)))
    kept = F.when(~F.lower(s).isin(*ID_NULL_WORDS), first)
    return limit_length(kept, max_len, strategy, field)


def split_list(c: Column, separators: str = "|") -> Column:
    """Array of the trimmed, non-blank items of a delimited list; null stays null."""
    pattern = r"(?U)\s*[" + "".join("\\" + x for x in separators) + r"]\s*"
    return F.array_remove(F.split(F.regexp_replace(strip(c), pattern, "|"), r"\|"), "")


def station_code(c: Column) -> Column:
    """Code in parentheses, else a DSW token, else the first 32 characters; upper case."""
    in_parentheses = F.nullif(F.regexp_extract(c, r"\(([A-Za-z0-9]+)\)", 1), F.lit(""))
    token = F.nullif(F.regexp_extract(c, r"(?i)\b(DSW\d+)\b", 1), F.lit(""))
    whole = F.nullif(F.left(F.upper(strip(c)), F.lit(32)), F.lit(""))
    return F.coalesce(F.upper(in_parentheses), F.upper(token), whole)


def route_station(c: Column) -> Column:
    """Station that owns a route code: codes starting with IS belong to dsw2, others to dsw3."""
    return F.when(F.startswith(F.upper(strip(c)), F.lit("IS")), F.lit("dsw2")).when(
        c.isNotNull(), F.lit("dsw3"))


def week_label(c: Column) -> Column:
    """``YYYY-Www`` from the first four digits and the two digits that follow; else the text."""
    pattern = r"(?s)^.*?(\d{4}).*?(\d{2}).*$"
    s = strip(c)
    return F.nullif(
        F.when(s.rlike(pattern), F.regexp_replace(s, pattern, "$1-W$2")).otherwise(s), F.lit(""))


def service_type(c: Column) -> Column:
    """Collapse package and incentive spellings to one name each, trim the rest."""
    s = strip(c)
    low = F.lower(s)
    return (
        F.when(F.contains(low, F.lit("package")), F.lit("Package"))
        .when(F.contains(low, F.lit("incentive")), F.lit("Incentive"))
        .otherwise(F.nullif(s, F.lit("")))
    )


def full_name(name: Column, first: Column, last: Column) -> Column:
    """The name, or first and last name joined where the name is missing."""
    composed = F.nullif(F.trim(F.concat_ws(" ", first, last)), F.lit(""))
    return F.coalesce(name, composed)


def canonical_key(c: Column) -> Column:
    """Text as compared in keys: blanks trimmed, upper case."""
    return F.upper(F.trim(c))


def key_text(c: Column) -> Column:
    """Canonical key text inside a row signature."""
    return F.coalesce(canonical_key(c), F.lit("#NULL#"))


def time_text(c: Column) -> Column:
    """Date or timestamp inside a row signature, ISO form; missing is empty."""
    return F.coalesce(F.translate(c.cast("string"), " ", "T"), F.lit(""))


def id_text(c: Column) -> Column:
    """Numeric id inside a row signature."""
    return F.coalesce(c.cast("string"), F.lit("#NOID#"))


def row_signature(*parts: Column) -> Column:
    """SHA-256 over the joined parts, which must already be non-null text."""
    return F.sha2(F.concat_ws("|", *parts), 256)


#: Partition of stored rows without a date or label.
NO_PART = "none"


def day_part(c: Column) -> Column:
    """Partition of a date or time: its day."""
    return F.coalesce(F.date_format(c, "yyyy-MM-dd"), F.lit(NO_PART))


def text_part(c: Column) -> Column:
    """Partition of a label: as it is compared, cut to what a folder name holds. Equal keys have equal partitions."""
    return F.coalesce(F.nullif(F.left(canonical_key(c.cast("string")), F.lit(40)), F.lit("")), F.lit(NO_PART))
