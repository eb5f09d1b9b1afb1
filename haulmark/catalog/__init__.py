"""Every operator as a query over the test tables, each with equal SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from haulmark.catalog import (
    q_calendar, q_changes, q_functions, q_ingest, q_reports, q_shaping, q_sources, q_stored,
)

from haulmark.catalog.base import Run
from haulmark.session import tune

_MODULES = (q_functions, q_sources, q_ingest, q_shaping, q_changes, q_calendar, q_reports, q_stored)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _tuned(q.run) for m in _MODULES for name, q in m.QUERIES.items()}


def _tuned(run: Run) -> Run:
    def call(spark: SparkSession, sf: str) -> DataFrame:
        return run(tune(spark), sf)
    call.__doc__ = run.__doc__
    return call


def all_sql() -> dict[str, str]:
    return {name: q.sql for m in _MODULES for name, q in m.QUERIES.items() if q.sql}
