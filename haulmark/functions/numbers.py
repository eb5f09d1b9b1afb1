"""Number parsing, guarded arithmetic and threshold scores. Bad input becomes null."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


__all__ = [
    "to_int", "strict_int", "to_decimal", "num_dec", "to_float", "percent_number",
    "plain_number", "opt_int", "hours_label", "trailing_digits", "safe_divide",
    "score_higher", "score_lower",
]


# A failed cast costs an exception per row, which dirty text would raise for every
# second cell. Numbers are therefore recognised by pattern first, and only text that
# is one reaches the cast; ``nullif`` turns "no match" into null without repeating
# the expression.
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_WHOLE = "[+-]?[0-9]+"
_SPACE = r"[\s\p{Z}\x1c-\x1f\x85]*"


def _no_commas(c: Column) -> Column:
    return F.replace(c, F.lit(","), F.lit(""))


def _matched(text: Column, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))


def to_int(c: Column, dtype: str = "int") -> Column:
    """Integer literal after dropping commas; ``3.0`` is not one."""
    return _matched(_no_commas(c), f"^{_SPACE}({_WHOLE}){_SPACE}$").try_cast(dtype)


def strict_int(c: Column, dtype: str = "int") -> Column:
    """Integer literal as it stands; a comma makes it null."""
    return _matched(c, f"^{_SPACE}({_WHOLE}){_SPACE}$").try_cast(dtype)


def to_decimal(c: Column, precision: int = 18, places: int = 2) -> Column:
    """Decimal after dropping commas and one ``%`` (95% stays 95), rounded half up."""
    return _matched(_no_commas(c), f"^{_SPACE}({_NUMBER}){_SPACE}%?{_SPACE}$").try_cast(
        f"decimal({precision},{places})")


def num_dec(c: Column, precision: int = 18, places: int = 2) -> Column:
    """As ``to_decimal``; text around the number is ignored and the first number taken.

    A whole number with an exponent is read as such, otherwise digits and one point.
    """
    token = _matched(
        _no_commas(c), rf"(^{_SPACE}{_NUMBER}(?={_SPACE}%?{_SPACE}$)|[-+]?[0-9]+(?:\.[0-9]+)?)")
    return token.try_cast(f"decimal({precision},{places})")


def to_float(c: Column) -> Column:
    """Double after dropping commas and one ``%``."""
    return _matched(_no_commas(c), f"^{_SPACE}({_NUMBER}){_SPACE}%?{_SPACE}$").try_cast("double")


def percent_number(c: Column) -> Column:
    """Double after dropping commas and every trailing ``%``."""
    return _matched(_no_commas(c), f"^{_SPACE}({_NUMBER}){_SPACE}%*{_SPACE}$").try_cast("double")


def plain_number(c: Column) -> Column:
    """Double after dropping commas; a percent sign makes it null."""
    return _matched(_no_commas(c), f"^{_SPACE}({_NUMBER}){_SPACE}$").try_cast("double")


def opt_int(c: Column, dtype: str = "int") -> Column:
    """A double cut to an integer; NaN, infinity and overflow become null."""
    return c.try_cast(dtype)


def hours_label(c: Column) -> Column:
    """Hours from a label such as ``8 hr`` or ``10HR``."""
    return _matched(c, r"(?i)(\d+)\s*hr").try_cast("int")


def trailing_digits(c: Column) -> Column:
    return _matched(c, r"(\d+)$").try_cast("int")


def safe_divide(a: Column, b: Column) -> Column:
    return F.try_divide(a, F.nullif(b, F.lit(0)))


# The score of each band, best first.
_BANDS = ("1.0000", "0.8000", "0.6000", "0.4000")


def _score(met, value: Column, *thresholds: Column) -> Column:
    v = value.cast("decimal(18,4)")
    band = [F.lit(b).cast("decimal(5,4)") for b in _BANDS]
    out = F.when(v.isNull(), F.lit(None).cast("decimal(5,4)"))
    for limit, points in zip(thresholds, band):
        out = out.when(met(v, limit.cast("decimal(18,4)")), points)
    return out.otherwise(band[-1])


def score_higher(value: Column, fantastic: Column, great: Column, fair: Column) -> Column:
    """Band score where a larger value is better."""
    return _score(lambda v, limit: v >= limit, value, fantastic, great, fair)


def score_lower(value: Column, fantastic: Column, great: Column, fair: Column) -> Column:
    """Band score where a smaller value is better."""
    return _score(lambda v, limit: v <= limit, value, fantastic, great, fair)
