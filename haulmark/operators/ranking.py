"""Ordinals, newest and oldest rows per key.

A key may hold a large share of all rows, so nothing here sorts a whole key in
one task. ``newest`` and ``oldest`` filter ``row_number`` to 1, which Spark
evaluates as a group limit on each map task before the shuffle: at most one row
per key and task crosses the network. ``slice_ordinal`` numbers every row by
cutting a key into ordered slices.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.operators.columns import col

__all__ = ["newest", "oldest", "slice_ordinal", "slice_dense_rank"]

_RANK = "__rank"


def _first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*[col(k) if isinstance(k, str) else k for k in keys]).orderBy(*order)
    return df.withColumn(_RANK, F.row_number().over(window)).filter(F.col(_RANK) == 1).drop(_RANK)


def newest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The last row per key; null keys form one key."""
    return _first(df, keys, [col(c).desc() for c in order])


def oldest(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """The first row per key; null keys form one key."""
    return _first(df, keys, [col(c).asc() for c in order])


def slice_ordinal(df: DataFrame, keys: Sequence[str], slices: Mapping[str, Column],
                  order: Sequence[Column], out: str = "ordinal",
                  total: str | None = None) -> DataFrame:
    """``row_number`` per key without bringing a key together in one task.

    ``slices`` are leading order columns, coarse to fine; the finest one must
    bound the rows of one slice (for example a block of arrival numbers). Rows
    per slice are counted with map-side aggregation, and a running total over the
    counts, a row per key and slice, gives each slice its offset. Only a slice is sorted, by
    ``order``. Null keys form one key and null slices come first. ``total``
    names an extra column with the rows of the whole key. The input is read twice:
    once for the counts and once for the rows.
    """
    names = list(slices)
    work = df.withColumns(dict(slices))
    level = [*keys, *names]
    counts = work.groupBy(*level).agg(F.count(F.lit(1)).alias("__n"))
    running = Window.partitionBy(*keys).orderBy(*[F.col(n).asc_nulls_first() for n in names])
    columns = {"__before": F.sum("__n").over(running) - F.col("__n")}
    if total:
        columns[total] = F.sum("__n").over(Window.partitionBy(*keys))
    offsets = counts.withColumns(columns).select(
        *[col(c).alias(f"__of_{i}") for i, c in enumerate(level)], "__before", *([total] if total else []))
    same = [col(c).eqNullSafe(F.col(f"__of_{i}")) for i, c in enumerate(level)]
    inside = Window.partitionBy(*level).orderBy(*order)
    return (
        work.join(offsets, same)
        .withColumn(out, F.col("__before") + F.row_number().over(inside))
        .drop("__before", *[f"__of_{i}" for i in range(len(level))], *[n for n in names if n not in df.columns])
    )


def slice_dense_rank(df: DataFrame, keys: Sequence[str], value: str, width: float,
                     out: str = "rank") -> DataFrame:
    """``dense_rank`` of ``value`` per key, largest first and null last.

    Distinct values are numbered in slices ``width`` apart, then joined back. Null
    keys form one key.
    """
    distinct = df.select(*keys, value).distinct()
    ranked = slice_ordinal(
        distinct, keys, {"__none": col(value).isNull(), "__band": -F.floor(col(value) / F.lit(width))},
        [col(value).desc_nulls_last()], out)
    level = [*keys, value]
    ranked = ranked.select(*[col(c).alias(f"__of_{i}") for i, c in enumerate(level)], out)
    same = [col(c).eqNullSafe(F.col(f"__of_{i}")) for i, c in enumerate(level)]
    return df.join(ranked, same).drop(*[f"__of_{i}" for i in range(len(level))])
