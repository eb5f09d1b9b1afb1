"""Shared pieces of the query catalogue."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from haulmark.operators.columns import col

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    run: Run
    sql: str | None


class Registry(dict):
    """Collects queries; ``sql=None`` marks one that SQL cannot express."""

    def add(self, name: str, sql: str | None) -> Callable[[Run], Run]:
        def register(run: Run) -> Run:
            if name in self:
                raise ValueError(f"query {name} registered twice")
            self[name] = Query(run, sql)
            return run
        return register


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def raw_frame(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """A text frame as an export would hold it: header to SQL expression."""
    return df.select(*[F.expr(e).alias(h) for h, e in columns.items()])


def raw_sql(source: str, columns: Mapping[str, str]) -> str:
    """The same frame in SQL."""
    return "SELECT " + ", ".join(f'{e} AS "{h}"' for h, e in columns.items()) + f" FROM {source}"


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, so that both engines return the same type."""
    return df.select(*[
        col(f.name).cast("double").alias(f.name) if isinstance(f.dataType, T.DecimalType)
        else col(f.name) for f in df.schema.fields])


# --- dirty text, valid in both engines ----------------------------------------

def dirty(key: str, text: str) -> str:
    """Text that is missing, padded or marked with % depending on a key."""
    return (
        f"(CASE CAST({key} AS bigint) % 7 WHEN 0 THEN 'N/A' WHEN 1 THEN ' ' "
        f"WHEN 2 THEN ' ' || {text} || ' ' WHEN 3 THEN {text} || '%' "
        f"WHEN 4 THEN 'missing' ELSE {text} END)")


def blotted(key: str, text: str) -> str:
    """Text that is missing or padded depending on a key; never altered otherwise."""
    return (
        f"(CASE CAST({key} AS bigint) % 5 WHEN 0 THEN 'NA' WHEN 1 THEN '  ' || {text} "
        f"WHEN 2 THEN {text} || ' ' ELSE {text} END)")


def as_text(expr: str) -> str:
    return f"CAST({expr} AS string)"


def money(expr: str) -> str:
    return as_text(f"CAST({expr} AS decimal(18,2))")


def whole(expr: str) -> str:
    return as_text(f"CAST(floor({expr}) AS bigint)")


def date_text(key: str, date: str) -> str:
    """A date in one of three spellings or not a date at all, depending on a key."""
    d = f"CAST({date} AS date)"
    month, dom, year = (as_text(f"{f}({d})") for f in ("month", "day", "year"))
    return (
        f"(CASE CAST({key} AS bigint) % 4 WHEN 0 THEN {as_text(d)} "
        f"WHEN 1 THEN lpad({month}, 2, '0') || '/' || lpad({dom}, 2, '0') || '/' || {year} "
        f"WHEN 2 THEN {month} || '/' || {dom} || '/' || {year} ELSE 'not a date' END)")


def iso_date(date: str) -> str:
    return as_text(f"CAST({date} AS date)")
