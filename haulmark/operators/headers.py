"""Header canonicalisation and required or optional columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark.operators.columns import col

__all__ = ["canonical_headers", "fill_missing_columns", "require_columns"]


def canonical_headers(df: DataFrame, aliases: Mapping[str, str],
                      date_column: str | None = None) -> DataFrame:
    """Rename columns by their trimmed lower-case header.

    Several headers may stand for one column; where more than one is present the
    first alias listed wins and the others fill its nulls. Headers without an
    alias keep their lower-case form. If ``date_column`` is still absent, the
    first header that contains "date" takes its place.
    """
    rank = {alias: i for i, alias in enumerate(aliases)}
    found: dict[str, list[tuple[int, Column]]] = {}
    for name in df.columns:
        header = name.strip().lower()
        found.setdefault(aliases.get(header, header), []).append(
            (rank.get(header, len(rank)), col(name)))
    if date_column and date_column not in found:
        stand_in = next((h for h in found if "date" in h), None)
        if stand_in:
            found = {date_column if h == stand_in else h: v for h, v in found.items()}
    out = []
    for target, candidates in found.items():
        ordered = [c for _, c in sorted(candidates, key=lambda x: x[0])]
        value = ordered[0] if len(ordered) == 1 else F.coalesce(*ordered)
        out.append(value.alias(target))
    return df.select(*out)


def require_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    missing = sorted(set(names) - set(df.columns))
    if missing:
        raise ValueError(f"Missing expected column(s): {', '.join(missing)}")
    return df


def fill_missing_columns(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add absent columns as typed nulls, so that every file has the same width."""
    absent = {c: F.lit(None).cast(t) for c, t in columns.items() if c not in df.columns}
    return df.withColumns(absent) if absent else df
