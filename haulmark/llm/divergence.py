"""How the word use of sources differs: exact distances between groups, and the terms a group has too often.

Terms are counted per (lang, source) group. Terms that stand in enough documents of a language are its
vocabulary and get ids, in blocks of ``BLOCK`` at most. Within a block each group is an array of (term id, count) sorted by
id, without the terms it lacks. Tasks take two bundles of groups and one block: each unordered pair
of groups is merged by a galloping intersection, which prices what both have, what only one has, and, by
number alone, what neither has. A pair's sums add up over the blocks and hold for both directions.

So a task holds ``2 * BUNDLE`` arrays of ``BLOCK`` entries at most, however large groups and vocabularies are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from haulmark.llm import words as W
from haulmark.llm.common import each, scratch, ship, stash

#: Terms of a language stand in so many of its documents at least.
LEAST_DOCS = 30
#: Added to each count, and the number of parts that a whole is divided into.
PRIOR, WHOLE = 5, 1_000_000_000
#: Terms listed per group.
LISTED = 50
#: Term ids in a block and groups in a bundle, at most (bundles: about).
BLOCK, BUNDLE = 1 << 16, 8
#: Bytes of text whose terms are counted together before rows are made of them.
SLICE = 8 << 20

_TERM = np.zeros(256, bool)
_TERM[ord("A"):ord("Z") + 1] = _TERM[ord("a"):ord("z") + 1] = _TERM[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32

_COUNTS = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("d", pa.int64())])
_PAIRS = pa.schema([("lang", pa.string()), ("a", pa.string()), ("b", pa.string()), ("v", pa.int64()), ("u", pa.int64()),
                    ("zero", pa.int64()), ("terms", pa.int64())])


def terms_of(column: pa.Array) -> tuple[pa.LargeStringArray, np.ndarray]:
    """All terms of a text column one after the other, and the row of each."""
    data, offsets = W.buffers(column)
    full = _TERM[data]
    first = full.copy()
    first[1:] &= ~full[:-1]
    inner = offsets[(offsets > 0) & (offsets < len(data))]
    first[inner] = full[inner]  # a text never goes on in the next one
    start = np.flatnonzero(first)
    kept = np.append(0, np.cumsum(full))
    ends = np.append(kept[start], kept[-1]).astype(np.int64)
    terms = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.tobytes()), pa.py_buffer(_LOWER[data[full]].tobytes()))
    return terms, np.searchsorted(offsets, start, "right") - 1


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in each(batches):
        for part in W.slices(batch, "text", SLICE):
            langs, sources = (part.column(c).dictionary_encode() for c in ("lang", "source"))
            group = langs.indices.to_numpy().astype(np.int64) * len(sources.dictionary) + sources.indices.to_numpy()
            found, row = terms_of(part.column("text"))
            coded = found.dictionary_encode()
            many = max(len(coded.dictionary), 1)
            # once per document, then once per group
            pair, times = np.unique(row * many + coded.indices.to_numpy(), return_counts=True)
            key, at = np.unique(group[pair // many] * many + pair % many, return_inverse=True)
            n = np.bincount(at, times, len(key)).astype(np.int64)
            d = np.bincount(at, minlength=len(key))
            seen = np.unique(group)
            where = np.append(key // many, seen)
            terms = pa.concat_arrays([coded.dictionary.take(pa.array(key % many)).cast(pa.string()), pa.nulls(len(seen), pa.string())])
            yield pa.RecordBatch.from_arrays([
                langs.dictionary.take(pa.array(where // len(sources.dictionary))),
                sources.dictionary.take(pa.array(where % len(sources.dictionary))),
                terms, pa.array(np.append(n, 0 * seen)), pa.array(np.append(d, 0 * seen))], schema=_COUNTS)


def price(count: np.ndarray | int, total: int) -> np.ndarray:
    """1 + floor(WHOLE * (count + PRIOR) / total), exactly, by long division: no product leaves 64 bits while total < 9e15."""
    left = np.asarray(count, np.int64) + PRIOR
    out = left // total
    left = left % total
    for _ in range(3):
        left = left * 1000
        out = out * 1000 + left // total
        left = left % total
    return out + 1


def gallop(few: np.ndarray, many: np.ndarray, stride: int = 512) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sorted arrays of the ids they share.

    The longer array is not read through: for each run of ``stride`` ids of the shorter one, steps that double
    from where the last run ended find a stretch that reaches past the run, and the search stays inside it.
    """
    base, mine, theirs = 0, [], []
    for a in range(0, len(few), stride):
        run = few[a:a + stride]
        step = len(run)
        while base + step < len(many) and many[base + step] < run[-1]:
            step *= 2
        stretch = many[base:base + step + 1]
        if not len(stretch):
            break
        at = np.searchsorted(stretch, run)
        hit = np.flatnonzero(stretch[np.minimum(at, len(stretch) - 1)] == run)
        mine.append(a + hit)
        theirs.append(base + at[hit])
        base += int(at[-1])
    none = np.zeros(0, np.int64)
    return np.concatenate(mine or [none]), np.concatenate(theirs or [none])


def merged(ids: tuple[np.ndarray, np.ndarray], prices: tuple[np.ndarray, np.ndarray], absent: tuple[int, int]) -> tuple[int, int]:
    """Sum of price differences over the terms that one group or both have, and the number of these terms."""
    x, y = (0, 1) if len(ids[0]) <= len(ids[1]) else (1, 0)
    i, j = gallop(ids[x], ids[y])
    (p, q), (p0, q0) = (prices[x], prices[y]), (absent[x], absent[y])
    # terms of one side alone: all of them, less those that both have
    value = int(np.abs(p[i] - q[j]).sum())
    value += int(np.abs(p - q0).sum()) - int(np.abs(p[i] - q0).sum())
    value += int(np.abs(q - p0).sum()) - int(np.abs(q[j] - p0).sum())
    return value, len(p) + len(q) - len(i)


def _pair_task(table: pa.Table) -> pa.Table:
    """All pairs of the groups of two bundles (or of one) in one block of terms."""
    low, high, lang = table.column("i")[0].as_py(), table.column("j")[0].as_py(), table.column("lang")[0].as_py()
    order = np.argsort(np.array(table.column("source").to_pylist(), object), kind="stable")
    source, bundle, whole, terms = (table.column(c).to_pylist() for c in ("source", "bundle", "whole", "terms"))
    lists = table.column("entries").combine_chunks()
    flat = lists.flatten()
    ids, counts = (flat.field(k).to_numpy(zero_copy_only=False) for k in (0, 1))
    ends = np.append(0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy()))
    rows: list[tuple] = []
    known = {k: (ids[ends[k]:ends[k + 1]], price(counts[ends[k]:ends[k + 1]], whole[k]) if whole[k] else counts[:0],
                 int(price(0, whole[k])) if whole[k] else 0) for k in range(len(source))}
    for x, k in enumerate(order):
        for m in order[x + 1:]:
            if low != high and bundle[k] == bundle[m]:
                continue  # pairs inside a bundle have a task of their own
            (a, p, p0), (b, q, q0) = known[k], known[m]
            value, union = merged((a, b), (p, q), (p0, q0))
            rows.append((lang, source[k], source[m], value, union, abs(p0 - q0), terms[k]))
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_PAIRS), _PAIRS)], schema=_PAIRS)


def _price(count: Column, total: Column) -> Column:
    """``price`` as a column."""
    parts = (count.cast("decimal(19,0)") + PRIOR) * F.lit(WHOLE).cast("decimal(10,0)")
    return F.call_function("div", parts, total.cast("decimal(19,0)")).cast("long") + 1


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, term, n, d): how often a group has a term, and in how many documents; a row without a term for each group."""
    ship(docs.sparkSession)
    text = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n)
                         for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    return (text.mapInArrow(_counted, "lang string, source string, term string, n long, d long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("d").alias("d")))


def source_divergence(docs: DataFrame, least_docs: int = LEAST_DOCS, listed: int = LISTED, text_col: str = "text",
                      lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank) for every group of documents with one lang and source.

    part ``pair``: each other source of the lang, with the sum over the vocabulary of the differences in
    price (see ``price``), 0 if there is no vocabulary; all ranks. part ``term``: terms the group has and that cost
    more in it than in its whole language, with the difference; the first ``listed``. Ranks begin at 1, largest value
    first, ties by item. Terms are runs of ASCII letters and characters beyond ASCII; A-Z
    count as a-z. Nulls in text, lang and source count as empty; every row is a document, equal rows and ids
    included; a language of one source has no pairs; texts count whole, whatever their length; an empty table gives no
    rows; other columns, whatever their names, are not read.
    """
    with scratch(docs.sparkSession):
        return stash(_ranked(docs, least_docs, listed, (text_col, lang_col, source_col)), "divergence", keep=True)


def _ranked(docs: DataFrame, least_docs: int, listed: int, columns: tuple[str, str, str]) -> DataFrame:
    counts = stash(term_counts(docs, *columns), "counts")
    words = counts.where("term is not null")
    vocabulary = stash(
        words.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("d").alias("d")).where(F.col("d") >= least_docs)
        .select("lang", "term", "all_n", F.monotonically_increasing_id().alias("id")), "vocabulary")
    kept = stash(words.join(vocabulary, ["lang", "term"]).select("lang", "source", "term", "id", "n", "all_n"), "kept")
    # a row per language, and one per group
    langs = vocabulary.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("all_n").alias("all_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stash(
        counts.where("term is null").select("lang", "source").join(langs, "lang", "left").join(totals, ["lang", "source"], "left")
        .na.fill(0).withColumn("whole", F.col("total") + PRIOR * F.col("terms"))
        .withColumn("all_whole", F.col("all_total") + PRIOR * F.col("terms")), "groups")

    dear = (kept.join(groups, ["lang", "source"])
            .withColumn("value", _price(F.col("n"), F.col("whole")) - _price(F.col("all_n"), F.col("all_whole")))
            .where("value > 0").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value"))

    # ids go up within a task that wrote them, whose number stands above bit 33
    block = F.shiftright("id", 33) * (1 << 17) + F.shiftright(F.col("id").bitwiseAND((1 << 33) - 1), BLOCK.bit_length() - 1)
    arrays = kept.groupBy("lang", "source", block.alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("entries"))
    # block -1 is empty; it makes every pair occur
    blocks = vocabulary.select("lang", block.alias("block")).distinct().unionByName(
        groups.select("lang", F.lit(-1).cast("long").alias("block")).distinct())
    bundles = groups.groupBy("lang").agg(F.ceil(F.count(F.lit(1)) / BUNDLE).alias("bundles"))
    grid = (groups.join(bundles, "lang").withColumn("bundle", F.pmod(F.xxhash64("source"), F.col("bundles")))
            .join(blocks, "lang").join(arrays, ["lang", "source", "block"], "left")
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bundles") - 1)))
            .select("lang", "block", F.least("bundle", "other").alias("i"), F.greatest("bundle", "other").alias("j"), "source", "bundle", "whole",
                    "terms", F.coalesce("entries", F.array().cast("array<struct<id:bigint,n:bigint>>")).alias("entries")))
    pairs = (grid.groupBy("lang", "block", "i", "j")
             .applyInArrow(_pair_task, "lang string, a string, b string, v long, u long, zero long, terms long")
             .groupBy("lang", "a", "b").agg(F.sum("v").alias("v"), F.sum("u").alias("u"), F.max("zero").alias("zero"), F.max("terms").alias("terms")))
    # what neither has differs by the price of nothing
    value = F.col("v") + (F.col("terms") - F.col("u")) * F.col("zero")
    both = F.explode(F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"))))
    apart = pairs.select("lang", value.alias("value"), both.alias("x")).select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")

    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.col("value").desc(), "item"))
    order = ["lang", "source", "part", "item", "value", "rank"]
    return (apart.withColumn("rank", rank).select(*order)
            .unionByName(dear.withColumn("rank", rank).where(F.col("rank") <= listed).select(*order)))
