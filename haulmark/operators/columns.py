"""Small helpers for column references."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F


def col(name: str, alias: str | None = None) -> Column:
    """Reference a column whose name may hold dots, colons or brackets."""
    quoted = "`" + name.replace("`", "``") + "`"
    return F.col(f"{alias}.{quoted}" if alias else quoted)


def key_match(left: str, right: str, keys: Iterable[str], null_safe: Iterable[str] = ()) -> Column:
    """Equality of the key columns of two aliased frames; null equals null where listed."""
    safe = set(null_safe)
    condition = None
    for k in keys:
        a, b = col(k, left), col(k, right)
        part = a.eqNullSafe(b) if k in safe else a == b
        condition = part if condition is None else condition & part
    return condition
