"""Table changes as functions from (target, source) to the new target.

Plain files offer no MERGE or DELETE, so each change returns the whole new table
as a lazy frame; ``haulmark.sources.sinks`` writes it beside the old one and
swaps. Every side is shuffled once: source rows are reduced per key first and the
join uses the same key columns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
import datetime as dt

from pyspark.sql import Column, DataFrame, functions as F

from haulmark.functions.text import row_signature
from haulmark.operators.columns import col, key_match
from haulmark.operators.ranking import newest, oldest

__all__ = [
    "dedup_keep_last", "dedup_keep_first", "upsert_overwrite", "upsert_coalesce",
    "insert_new_only", "insert_ignore_dups", "rebuild_window", "merge_rows", "with_signature",
]

_PRESENT = "__present"


def dedup_keep_last(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """Purge of stored duplicates: the newest row per key stays."""
    return newest(df, keys, order)


def dedup_keep_first(df: DataFrame, keys: Sequence[str | Column], order: Sequence[str]) -> DataFrame:
    """What a unique index that ignores duplicates lets in: the first row per key."""
    return oldest(df, keys, order)


def _require_keys(df: DataFrame, keys: Sequence[str], null_safe: Sequence[str]) -> DataFrame:
    """Key columns that are NOT NULL in the target make the job fail on a null."""
    checks = {}
    for k in keys:
        if k not in null_safe:
            dtype = df.schema[k].dataType
            failure = F.raise_error(F.lit(f"null in key column {k}")).cast(dtype)
            checks[k] = F.coalesce(col(k), failure)
    return df.withColumns(checks)


def _canonical(df: DataFrame, keys: Mapping[str, Column | None]) -> tuple[DataFrame, list[str]]:
    """Add the compared form of each key before the join, so it stays an equi-join; forms already there are kept."""
    extra = {f"__key_{k}": e for k, e in keys.items() if e is not None and f"__key_{k}" not in df.columns}
    names = [f"__key_{k}" if e is not None else k for k, e in keys.items()]
    return df.withColumns(extra) if extra else df, names


def _forms(keys: Sequence[str], null_safe: Sequence[str],
           compare: Mapping[str, Column] | None) -> dict[str, Column | None]:
    """The compared form of each key. One that may be null is wrapped: equal wraps of null are equal."""
    forms = {k: (compare or {}).get(k) for k in keys}
    return {k: F.struct((f if f is not None else col(k)).alias("value")) if k in null_safe else f
            for k, f in forms.items()}


def merge_rows(target: DataFrame, source: DataFrame, keys: Sequence[str],
               on_match: Mapping[str, Column], on_insert: Mapping[str, Column] | None = None,
               insert_when: Column | None = None, null_safe: Sequence[str] = (),
               compare: Mapping[str, Column] | None = None) -> DataFrame:
    """Full-outer merge of a source that has one row per key.

    Expressions address the sides as ``t.<column>`` and ``s.<column>``. Columns
    without a rule keep the target's value. ``insert_when`` limits the inserts.
    ``compare`` gives the compared form of a key, such as its canonical text; it
    must be a function of the column of that name.
    """
    forms = _forms(keys, null_safe, compare)
    t, names = _canonical(target, forms)
    s, _ = _canonical(source, forms)
    t = t.withColumn(_PRESENT, F.lit(True)).alias("t")
    s = s.withColumn(_PRESENT, F.lit(True)).alias("s")
    joined = t.join(s, key_match("t", "s", names), "full_outer")
    in_target = col(_PRESENT, "t").isNotNull()
    in_source = col(_PRESENT, "s").isNotNull()
    if insert_when is not None:
        joined = joined.filter(in_target | insert_when)
    on_insert = on_insert or {}
    out = []
    for name in target.columns:
        dtype = target.schema[name].dataType
        if name in keys:
            value = F.when(in_target, col(name, "t")).otherwise(col(name, "s"))
        else:
            # A row of the source alone is inserted, a row of both is updated.
            inserted = on_insert.get(name, on_match.get(name, F.lit(None)))
            updated = on_match.get(name, col(name, "t"))
            value = F.when(~in_target, inserted).when(in_source, updated).otherwise(col(name, "t"))
        out.append(value.cast(dtype).alias(name))
    return joined.select(*out)


def upsert_overwrite(target: DataFrame, source: DataFrame, keys: Sequence[str],
                     order: Sequence[str], null_safe: Sequence[str] = (),
                     compare: Mapping[str, Column] | None = None) -> DataFrame:
    """Matched rows take every source value, nulls included; other rows are inserted.

    Source rows apply in ``order``, so the last row of a key wins. Order columns
    that the target lacks are not stored.
    """
    source = _require_keys(source, keys, null_safe)
    # reduced and joined on the same columns, so the source moves once
    keyed, names = _canonical(source, _forms(keys, null_safe, compare))
    last = newest(keyed, names, order)
    rules = {c: col(c, "s") for c in target.columns if c not in keys and c in source.columns}
    return merge_rows(target, last, keys, rules, null_safe=null_safe, compare=compare)


def upsert_coalesce(target: DataFrame, source: DataFrame, keys: Sequence[str],
                    order: Sequence[str], required: str | None = None) -> DataFrame:
    """Matched rows take the source value where it is not null; a new key needs ``required``.

    Source rows apply in ``order``: per column the last non-null value wins. Rows
    without the required value must have been dropped before, as the people
    pipeline does.
    """
    source = _require_keys(source, keys, ())
    columns = [c for c in target.columns if c not in keys and c in source.columns]
    position = F.struct(*[col(c) for c in order])
    last = source.groupBy(*[col(k) for k in keys]).agg(
        *[F.max_by(col(c), F.when(col(c).isNotNull(), position)).alias(c) for c in columns])
    on_match = {c: F.coalesce(col(c, "s"), col(c, "t")) for c in columns}
    on_insert = {c: col(c, "s") for c in columns}
    insert_when = col(required, "s").isNotNull() if required else None
    return merge_rows(target, last, keys, on_match, on_insert, insert_when)


def insert_new_only(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add the source rows whose key the target lacks; stored rows never change."""
    fresh = source.alias("s").join(
        target.select(*[col(k) for k in keys]).alias("t"), key_match("s", "t", keys), "left_anti")
    return target.unionByName(fresh, allowMissingColumns=True)


def with_signature(df: DataFrame, parts: Sequence[Column], name: str = "row_sig") -> DataFrame:
    return df.withColumn(name, row_signature(*parts))


def insert_ignore_dups(target: DataFrame, source: DataFrame, signature: str,
                       order: Sequence[str]) -> DataFrame:
    """The source rows a unique index on ``signature`` would let in.

    A stored row, then the earliest row of the batch, wins without an error.
    """
    first = oldest(source, [signature], order)
    return first.join(target.select(signature), signature, "left_anti").select(*source.columns)


def rebuild_window(target: DataFrame, refill: DataFrame, date_column: str,
                   date_from: dt.date | str, date_to: dt.date | str) -> DataFrame:
    """Replace the rows dated inside the inclusive window; all others stay."""
    inside = col(date_column).between(F.lit(date_from).cast("date"), F.lit(date_to).cast("date"))
    kept = target.filter(~F.coalesce(inside, F.lit(False)))
    return kept.unionByName(refill.filter(inside), allowMissingColumns=True)
