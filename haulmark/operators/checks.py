"""Row filters, data checks and reference checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, functions as F

from haulmark.operators.columns import col

__all__ = ["drop_null_keys", "failed_checks", "split_valid", "fk_orphans", "not_blank"]


def drop_null_keys(df: DataFrame, columns: Sequence[str],
                   observation: Observation | None = None) -> DataFrame:
    """Keep rows with every listed column, dropping in the order listed.

    With an ``observation`` the rows dropped at each column are counted during
    the job itself, without a second pass.
    """
    if observation is not None:
        earlier = F.lit(True)
        metrics = []
        for c in columns:
            metrics.append(F.coalesce(F.sum((earlier & col(c).isNull()).cast("long")), F.lit(0))
                           .alias(f"dropped_{c}"))
            earlier = earlier & col(c).isNotNull()
        df = df.observe(observation, *metrics)
    return df.dropna(subset=list(columns))


def not_blank(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit("")).isNotNull()


def failed_checks(checks: Mapping[str, Column]) -> Column:
    """Names of the checks a row fails; as in SQL, an unknown result does not fail a check."""
    found = [F.when(~rule, F.lit(name)) for name, rule in checks.items()]
    return F.array_compact(F.array(*found))


def split_valid(df: DataFrame, checks: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, quarantined rows with the failed checks in ``failed``)."""
    judged = df.withColumn("failed", failed_checks(checks))
    good = F.size("failed") == 0
    return judged.filter(good).drop("failed"), judged.filter(~good)


def fk_orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str,
               rows: str = "rows") -> DataFrame:
    """Foreign keys without a parent, with the rows that carry them.

    The child is reduced to one row per key before the join. Null is no reference.
    """
    used = child.filter(col(child_key).isNotNull()).groupBy(child_key).agg(
        F.count(F.lit(1)).alias(rows))
    return used.join(parent.select(col(parent_key).alias(child_key)), child_key, "left_anti")
