"""Row shaping: list explosion, helper numbering and tags, matrix and metric pivots."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from haulmark.functions.dates import to_date
from haulmark.functions.numbers import percent_number, trailing_digits
from haulmark.functions.text import normalize_id, null_like, split_list, strip, week_label
from haulmark.operators.columns import col
from haulmark.operators.ranking import slice_ordinal

__all__ = [
    "explode_participants", "helper_suffix", "number_helpers", "classify_helpers", "tag_helpers",
    "blank_helper_columns",
    "explode_list", "melt_matrix", "daily_metrics", "weekly_metrics", "unpivot_daily",
    "unpivot_weekly", "resolve_year", "long_metrics", "metrics_wide",
]


def explode_participants(df: DataFrame, ids: str = "transporter_id", names: str = "driver_name",
                         index: str = "participant_index", max_len: int = 64,
                         strategy: str = "error") -> DataFrame:
    """One row per participant of two pipe lists read side by side, the shorter padded.

    A row without any participant stays as one row with index 0.
    """
    empty = F.array().cast("array<string>")
    pairs = F.arrays_zip(
        F.coalesce(split_list(col(ids)), empty).alias("id"),
        F.coalesce(split_list(col(names)), empty).alias("name"))
    exploded = df.select("*", F.posexplode_outer(pairs).alias("__pos", "__pair"))
    return exploded.withColumns({
        ids: normalize_id(F.col("__pair.id"), max_len, strategy),
        names: null_like(F.col("__pair.name")),
        index: F.coalesce(F.col("__pos"), F.lit(0)),
    }).drop("__pos", "__pair")


def helper_suffix(df: DataFrame, scope: Sequence[str], arrival: Sequence[str],
                  code: str = "route_code", index: str = "participant_index",
                  block: int = 1 << 16) -> DataFrame:
    """Helpers get ``code(n)``; n counts the helpers of that code over the whole file.

    ``arrival`` orders the rows of a file, coarse to fine; the last column is a
    row number. The count runs in blocks of that number, so a code that fills a
    file is still split.
    """
    first = df.filter(col(index) == 0).withColumn(code, F.coalesce(col(code), F.lit("")))
    return first.unionByName(number_helpers(df.filter(col(index) > 0), scope, arrival, code, index, block))


def number_helpers(helpers: DataFrame, scope: Sequence[str], arrival: Sequence[str],
                   code: str = "route_code", index: str = "participant_index",
                   block: int = 1 << 16) -> DataFrame:
    """Rows that are all helpers, with ``code(n)`` as ``helper_suffix`` counts it."""
    helpers = helpers.withColumn(code, F.coalesce(col(code), F.lit("")))
    slices = {f"__slice{i}": col(c) for i, c in enumerate(arrival[:-1])}
    slices["__block"] = F.floor(col(arrival[-1]) / F.lit(block))
    numbered = slice_ordinal(
        helpers, [*scope, code], slices, [col(arrival[-1]), col(index)], "__helper")
    return numbered.withColumn(
        code, F.concat(col(code), F.lit("("), F.col("__helper").cast("string"), F.lit(")"))
    ).drop("__helper")


def classify_helpers(df: DataFrame, scope: Sequence[str], name: str = "driver_name",
                     index: str = "participant_index", tag: str = "helper_tag") -> DataFrame:
    """Tag helper rows.

    A name seen exactly twice and once as a helper is a Rescue; a name that is
    never first and at least once a helper is a Sweeper. First participants are not shuffled.
    """
    first = df.filter(col(index) <= 0).withColumn(tag, F.lit(None).cast("string"))
    return first.unionByName(tag_helpers(df.filter(col(index) > 0), df, scope, name, index, tag))


def tag_helpers(helpers: DataFrame, df: DataFrame, scope: Sequence[str], name: str = "driver_name",
                index: str = "participant_index", tag: str = "helper_tag") -> DataFrame:
    """``helpers`` with the tags that ``classify_helpers`` finds from all rows ``df``.

    Counts are aggregated per name on the map side, and only names that earn a tag are joined
    back. Helpers without a name, which would all meet in one partition, are spread over all.
    """
    key = [*scope, "__name"]
    named = F.nullif(strip(col(name)), F.lit(""))
    seen = df.withColumn("__name", named).filter(F.col("__name").isNotNull()).groupBy(*key).agg(
        F.count(F.lit(1)).alias("__all"),
        F.sum((col(index) > 0).cast("long")).alias("__late"))
    tagged = seen.select(*key, F.lit(0).cast("long").alias("__spread"), F.when(
        (F.col("__all") == 2) & (F.col("__late") == 1), F.lit("Rescue")
    ).when(F.col("__all") == F.col("__late"), F.lit("Sweeper")).alias(tag))
    tagged = tagged.filter(F.col(tag).isNotNull())
    rows = [col(c) for c in helpers.columns]
    work = helpers.withColumn("__name", named).withColumn(
        "__spread", F.when(F.col("__name").isNull(), F.xxhash64(*rows)).otherwise(F.lit(0).cast("long")))
    return work.join(tagged, [*key, "__spread"], "left").select(*rows, tag)


def blank_helper_columns(df: DataFrame, columns: Sequence[str],
                         index: str = "participant_index") -> DataFrame:
    """Counts belong to the first participant only."""
    return df.withColumns({c: F.when(col(index) == 0, col(c)) for c in columns})


def explode_list(df: DataFrame, column: str, separators: str = "|,") -> DataFrame:
    """One row per list item; a row with an empty list stays with a null item."""
    return df.withColumn(column, F.explode_outer(split_list(col(column), separators)))


def melt_matrix(df: DataFrame, metric: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Matrix columns to rows (metric, label, cell); the first column holds the metric name."""
    metric = metric or next(c for c in df.columns if c not in carry)
    values = [c for c in df.columns if c != metric and c not in carry]
    texts = df.select(*[col(c) for c in carry], col(metric).alias("metric"),
                      *[col(c).cast("string").alias(c) for c in values])
    return texts.unpivot([col(c) for c in [*carry, "metric"]], [col(c) for c in values],
                         "label", "cell")


def _metric_cells(long: DataFrame, carry: Sequence[str], **label: Column) -> DataFrame:
    return long.select(
        *[col(c) for c in carry], *[e.alias(n) for n, e in label.items()],
        strip(F.col("metric")).alias("metric_name"),
        percent_number(F.col("cell")).alias("metric_value"),
    ).dropna(subset=[next(iter(label)), "metric_name"])


def daily_metrics(long: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Matrix cells (metric, label, cell) whose label is a date."""
    return _metric_cells(long, carry, metric_date=to_date(F.col("label")))


def weekly_metrics(long: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """Matrix cells whose label is a week; ``week`` is null where it ends in no digits."""
    label = week_label(F.col("label"))
    return _metric_cells(long, carry, iso_year_week=label, week=trailing_digits(label))


def unpivot_daily(df: DataFrame, metric: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Matrix with one column per day to (metric_date, metric_name, metric_value)."""
    return daily_metrics(melt_matrix(df, metric, carry), carry)


def unpivot_weekly(df: DataFrame, metric: str | None = None, carry: Sequence[str] = ()) -> DataFrame:
    """Matrix with one column per week to (iso_year_week, week, metric_name, metric_value)."""
    return weekly_metrics(melt_matrix(df, metric, carry), carry)


def resolve_year(df: DataFrame, existing: DataFrame, this_year: int, scope: Sequence[str],
                 file_year: str | None = None) -> DataFrame:
    """Add ``year`` to weekly rows, file by file.

    The file's own year wins; else the year in the labels, if every label of the
    file has one; else the year stored for that week (the latest, where weeks
    repeat), else the latest stored year, else ``this_year``.
    """
    in_label = F.nullif(F.regexp_extract("iso_year_week", r"(\d{4})", 1), F.lit("")).try_cast("int")
    work = df.withColumn("__label_year", in_label)
    complete = work.groupBy(*scope).agg(
        F.every(F.col("__label_year").isNotNull()).alias("__complete"))
    # One row per stored week; Spark decides by its size whether to broadcast it.
    by_week = existing.groupBy("week").agg(F.max("year").alias("__week_year"))
    latest = existing.agg(F.max("year")).scalar()
    own = col(file_year).cast("int") if file_year else F.lit(None).cast("int")
    return (
        work.join(complete, list(scope), "left")
        .join(by_week, "week", "left")
        .withColumn("year", F.coalesce(
            own, F.when(F.col("__complete"), F.col("__label_year")),
            F.col("__week_year"), latest, F.lit(this_year)))
        .select(*[col(c) for c in df.columns], "year")
    )


def long_metrics(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str | None],
                 name: str = "metric_name", value: str = "metric_value",
                 dtype: str = "decimal(18,4)") -> DataFrame:
    """Wide metric columns to one row per metric in a single scan.

    ``metrics`` maps the metric name to its column; None yields a null value.
    """
    wide = df.select(*[col(k) for k in keys], *[
        (col(c) if c else F.lit(None)).cast(dtype).alias(m) for m, c in metrics.items()])
    return wide.unpivot([col(k) for k in keys], [col(m) for m in metrics], name, value)


def metrics_wide(df: DataFrame, keys: Sequence[str], metrics: Mapping[str, str],
                 name: str = "metric_name", value: str = "metric_value") -> DataFrame:
    """Long metric rows to one column each, by one aggregation over a fixed list of names."""
    cells: list[Column] = [
        F.max(F.when(col(name) == m, col(value))).alias(out) for m, out in metrics.items()]
    return df.groupBy(*[col(k) for k in keys]).agg(*cells)
