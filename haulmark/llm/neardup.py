"""Near-duplicate groups: SuperMinHash signatures, banding, exact confirmation, grouping.

The set of a text holds its distinct word shingles (one shingle of all words if there are
fewer; no words, no set). Texts are linked if 100 * |A & B| >= percent * |A | B|.

1. One pass over the texts gives the size of the set, a 128-bit key of the set, and
   one key per signature band. Equal sets become one class, named by their least id.
2. Classes that share a band key are a bucket. A bucket is never paired up: its hub, the
   class with most bucket company over all bands, is compared with each member. Copies of
   one text with edits of their own differ from each other more than from the original,
   and that is the hub.
3. Members far from the hub are compared with one of themselves in its place, and so on; what is
   linked with the same one is a family. Links between members of different families are found without
   trying all pairs: written as differences from the hub, such members must share more than
   a certain number of differences, so they share one among the rarest few of either
   (prefix filter). What shares one is confirmed exactly.
4. Components of the links, see ``components``.

Candidates come from bands of ``ROWS`` rows; with ``BANDS`` of them a link at exactly 0.85
is missed with a probability of 4e-7. Everything after that is exact.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from haulmark.llm import words as W
from haulmark.llm.common import discard, each, id_text, likely, scratch, stash
from haulmark.llm.components import components
from haulmark.llm.superminhash import signatures

BANDS, ROWS = 20, 4
#: Bytes of text whose sets are held at once.
SLICE = 1 << 20

_FEATURES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key1", pa.int64()),
                       ("key2", pa.int64()), ("bands", pa.list_(pa.int64()))])
_SETS = pa.schema([("node", pa.int64()), ("items", pa.list_(pa.int64()))])
_U = np.uint64


def text_sets(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingle hashes of each text, one after the other, and where each begins."""
    hashes, first = W.rows_hashes(texts)
    sets = [np.unique(W.shingles(hashes[first[i]:first[i + 1]], size)) for i in range(len(texts))]
    return (np.concatenate(sets) if sets else np.zeros(0, _U),
            np.concatenate([[0], np.cumsum([len(s) for s in sets])]).astype(np.int64))


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values.view(np.int64)))


def set_keys(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 128-bit key of each set, in two halves."""
    zero = np.zeros(1, _U)  # of the same type, as the sums would become floats beside a signed one
    total = np.concatenate([zero, np.cumsum(W.mix(values), dtype=_U)])
    other = np.concatenate([zero, np.cumsum(W.mix(values ^ _U(0x5851F42D4C957F2D)), dtype=_U)])
    key1 = total[offsets[1:]] - total[offsets[:-1]]
    key2 = other[offsets[1:]] - other[offsets[:-1]] + np.diff(offsets).astype(_U)
    return key1.view(np.int64), key2.view(np.int64)


def _features(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for part in W.slices(batch, "text", SLICE):
                values, offsets = text_sets(part.column(1), size)
                count = np.diff(offsets)
                key1, key2 = set_keys(values, offsets)
                sig = signatures(values, offsets, bands * rows).reshape(-1, bands, rows)
                keys = np.zeros(sig.shape[:2], _U)
                for r in range(rows):
                    keys = W.mix(keys + sig[:, :, r])
                keys = W.mix(keys + np.arange(bands, dtype=_U))
                full = count > 0
                at = np.concatenate([[0], np.cumsum(np.where(full, bands, 0))])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(count), pa.array(key1), pa.array(key2),
                     _lists(keys[full].reshape(-1), at)], schema=_FEATURES)
    return run


def _sets(size: int):
    """The set of each row's text for its node, if it is the node's: a repeated id may have other texts too."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in each(batches):
            for part in W.slices(batch, "text", SLICE):
                values, offsets = text_sets(part.column(1), size)
                key1, key2 = set_keys(values, offsets)
                own = (key1 == part.column("key1").to_numpy()) & (key2 == part.column("key2").to_numpy())
                sets = pa.RecordBatch.from_arrays([part.column("node"), _lists(values, offsets)], schema=_SETS)
                yield sets if own.all() else sets.filter(pa.array(own))
    return run


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, kept.

    component_id is the least doc_id reachable over links, its own included; kept says
    that it is the row's own. A null or empty text, or one of white space only, has no
    shingles and stands alone. Rows with a null id are kept, with a null component.
    Rows with one id are one node, with the links of all their texts; each of them gets a row. Very long texts
    are read whole. An empty table gives none; other columns, whatever their names, are not read.
    """
    with scratch(docs.sparkSession):
        return stash(_groups(id_text(docs, id_col, text_col), shingle, percent, bands, rows), "groups", keep=True)


def _groups(texts: DataFrame, shingle: int, percent: int, bands: int, rows: int) -> DataFrame:
    features = stash(texts.mapInArrow(_features(shingle, bands, rows),
                                      "doc_id long, n_shingles long, key1 long, key2 long, bands array<long>"), "features")
    known = features.where("n_shingles > 0 and doc_id is not null")
    again = not known.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").isEmpty()
    # classes go by the least id that has them, or by numbers if an id may have several
    classes = known.groupBy("key1", "key2").agg(F.min("doc_id").alias("rep"))
    classes = stash(classes.withColumn("node", F.monotonically_increasing_id() if again else F.col("rep")), "classes")
    links = _links(texts, features, classes, again, shingle, percent)
    if again:
        own = stash(known.join(classes, ["key1", "key2"]).select("doc_id", "node").distinct(), "own")
        one = own.groupBy("doc_id").agg(F.min("node").alias("y"))
        links = links.unionByName(own.join(one, "doc_id").where("node <> y").select(F.col("node").alias("x"), "y"))
    roots = components(stash(links, "near"), "x", "y")
    named = classes.join(roots, "node", "left").select("key1", "key2", "node", "rep", F.coalesce("root", "node").alias("root"))
    if again:
        least = named.groupBy("root").agg(F.min("rep").alias("least"))
        of_id = own.join(named, "node").join(least, "root").select("doc_id", F.col("least").alias("root")).distinct()
        out = features.drop("bands").join(of_id, "doc_id", "left")
    else:
        out = features.drop("bands").join(named.select("key1", "key2", "root"), ["key1", "key2"], "left")
        out = out.withColumn("root", F.when(F.col("n_shingles") > 0, F.col("root")))
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("root", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def _links(texts: DataFrame, features: DataFrame, classes: DataFrame, again: bool, shingle: int, percent: int) -> DataFrame:
    """Links (x, y) between classes that hold the components together; none is missed that shares a band."""
    keyed = features.join(classes.withColumnRenamed("rep", "doc_id"), ["key1", "key2", "doc_id"])
    member = stash(keyed.select(F.col("node").alias("x"), F.explode("bands").alias("bucket")).distinct(), "buckets")
    size = member.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shared = stash(member.join(size, "bucket"), "shared")
    discard(member)
    company = shared.groupBy("x").agg(F.sum("size").alias("company"))
    hubs = (shared.join(company, "x").groupBy("bucket")
            .agg(F.max(F.struct("company", (-F.col("x")).alias("minus"))).alias("top"))
            .select("bucket", (-F.col("top.minus")).alias("hub")))
    pairs = stash(shared.join(hubs, "bucket").where("x <> hub").select("x", "hub").distinct(), "pairs")
    discard(shared)
    met_nodes = pairs.select(F.col("x").alias("node")).union(pairs.select("hub")).distinct()
    wanted = stash(classes.join(met_nodes, "node").select(F.col("rep").alias("doc_id"), "node", "key1", "key2"), "wanted")
    sets = (likely(texts, wanted).join(wanted, "doc_id").select("doc_id", "text", "node", "key1", "key2")
            .mapInArrow(_sets(shingle), "node long, items array<long>"))
    sets = stash(sets.dropDuplicates(["node"]) if again else sets, "sets")
    met = (pairs.join(sets.select(F.col("node").alias("x"), F.col("items").alias("xs")), "x")
           .join(sets.select(F.col("node").alias("hub"), F.col("items").alias("hs")), "hub")
           .withColumn("missing", F.array_except("hs", "xs")).withColumn("extra", F.array_except("xs", "hs"))
           .select("hub", "x", F.size("xs").alias("nx"), F.size("hs").alias("nh"), F.size("missing").alias("m"),
                   F.size("extra").alias("e"),
                   # a missing shingle and an extra one are told apart by the lowest bit
                   F.concat(F.transform("missing", lambda v: v.bitwiseOR(F.lit(1))),
                            F.transform("extra", lambda v: v.bitwiseAND(F.lit(-2)))).alias("diff"))
           .withColumn("near", (F.lit(100) * (F.col("nh") - F.col("m")) >= F.lit(percent) * (F.col("nh") + F.col("e")))))
    met = stash(met, "met")
    discard(sets)
    near = met.where("near").select("x", F.col("hub").alias("y"))
    return near.unionByName(_rest(met, percent))


def _rest(met: DataFrame, percent: int) -> DataFrame:
    """Links between members of one hub of which one at least isn't linked with the hub.

    With m shingles of the hub missing and e extra ones, two members share
    nh - m - m' + o shingles, o being the differences they share (a missing one must be
    missing in both). The link condition then asks for o >= w + w' - c with
    w = ((100 - s) m + s e) / 100, s = 100 percent / (100 + percent), c = nh (100 - 2 s) / 100.
    A member is linked with its hub if and only if w <= c.
    """
    s = percent / (100.0 + percent)
    met = met.withColumn("w", F.col("m") * (1 - s) + F.col("e") * s).withColumn("c", F.col("nh") * (1 - 2 * s))
    around = met.groupBy("hub").agg(F.min("w").alias("w_low"), F.min(F.when(~F.col("near"), F.col("w"))).alias("w_far"),
                                    F.count(F.lit(1)).alias("n")).where("n > 1 and w_far is not null").drop("n")
    met = stash(met.join(around, "hub"), "rest")
    held = _families(met.where("not near"), percent)
    # members of one family are linked already, so only differences that two families have in common can add anything
    family = F.coalesce("g", F.when(F.col("near"), F.col("hub")), F.col("x"))
    met = met.join(held, ["hub", "x"], "left").withColumn("g", family)
    item = met.select("hub", "x", F.explode("diff").alias("d"))
    often = item.groupBy("hub", "d").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    # differences that no other member has come first in the order, so they only use up places of the prefix
    ordered = (item.join(often, ["hub", "d"]).groupBy("hub", "x")
               .agg(F.sort_array(F.collect_list(F.struct("df", "d"))).alias("common")))
    size = F.col("m") + F.col("e")
    places = lambda least: (size - F.ceil(F.greatest(least, F.lit(1.0)) - F.lit(1e-6)) + 1) - (size - F.size("common"))
    ready = met.select("hub", "x", "g", "near", "m", "e", "w", "c", "w_low", "w_far").join(ordered, ["hub", "x"])
    first = lambda least: F.posexplode(F.slice("common", 1, F.greatest(places(least), F.lit(0)).cast("int"))).alias("k", "i")
    # of each difference in a prefix, how many of the member's common ones come after it
    after = (F.size("common") - F.col("k") - 1).alias("after")
    left = (ready.where("not near").select("hub", "x", "g", "m", "e", "w", "c", "common", first(F.col("w") - F.col("c") + F.col("w_low")))
            .select("hub", "x", "g", F.col("i.d").alias("d"), after, "m", "e", (F.col("w") - F.col("c")).alias("w")))
    right = stash(ready.select("hub", F.col("x").alias("y"), F.col("g").alias("gy"), "near", "m", "e", "w", "common", first(F.col("w") - F.col("c") + F.col("w_far")))
                  .select("hub", "y", "gy", "near", F.col("i.d").alias("d"), after.alias("after2"), F.col("m").alias("m2"), F.col("e").alias("e2"),
                          F.col("w").alias("w2")), "differences")
    mixed = right.groupBy("hub", "d").agg(F.min("gy").alias("low"), F.max("gy").alias("high")).where("low <> high").select("hub", "d")
    # a link needs w + w' - c shared differences: no more than either has of a kind, and of the first one that is shared, no more than come after it
    enough = F.expr("least(1 + least(after, after2), least(m, m2) + least(e, e2)) >= w + w2 - 1e-6")
    pairs = (left.join(right.join(mixed, ["hub", "d"]).withColumnsRenamed({"hub": "hub2", "d": "d2"}),
                       (F.col("hub") == F.col("hub2")) & (F.col("d") == F.col("d2")) & F.expr("near or x < y") & F.expr("g <> gy") & enough)
             .select("hub", "x", "y").distinct())
    facts = met.select("hub", "x", "nx", "nh", "m", "diff")
    other = met.select("hub", F.col("x").alias("y"), F.col("nx").alias("ny"), F.col("m").alias("m2"), F.col("diff").alias("diff2"))
    common = F.col("nh") - F.col("m") - F.col("m2") + F.size(F.array_intersect("diff", "diff2"))
    both = F.lit(100) * common >= F.lit(percent) * (F.col("nx") + F.col("ny") - common)
    crossing = pairs.join(facts, ["hub", "x"]).join(other, ["hub", "y"]).where(both).select("x", "y")
    return crossing.unionByName(held.where("x <> g").select("x", F.col("g").alias("y")))


def _families(far: DataFrame, percent: int) -> DataFrame:
    """(hub, x, g): members that aren't linked with their hub but with g, another such member of the hub.

    In each round the member least different from the hub is compared with all that have no family yet. Rounds go on while
    they place a tenth of these; members left over have no row and are looked for by their differences.
    """
    open_, rounds = far.select("hub", "x", "nx", "nh", "m", "w", "diff"), []
    while True:
        lead = (open_.groupBy("hub").agg(F.min(F.struct("w", "x", "nx", "m", "diff")).alias("s"), F.count(F.lit(1)).alias("n"))
                .where("n > 1").select("hub", "s"))
        common = F.col("nh") - F.col("m") - F.col("s.m") + F.size(F.array_intersect("diff", "s.diff"))
        near = F.lit(100) * common >= F.lit(percent) * (F.col("nx") + F.col("s.nx") - common)
        tried = stash(open_.join(lead, "hub").select(*open_.columns, F.col("s.x").alias("g"), near.alias("placed")), "families")
        rounds.append(tried.where("placed").select("hub", "x", "g"))
        size, placed = tried.agg(F.count(F.lit(1)), F.count_if(F.col("placed") & (F.col("x") != F.col("g")))).first()
        if 10 * placed <= size:
            return functools.reduce(DataFrame.unionByName, rounds)
        open_ = tried.where("not placed").select(*open_.columns)


def without_duplicates(docs: DataFrame, groups: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` whose group keeps them; rows with a null id stay."""
    gone = groups.where("not kept").select(F.col("doc_id").alias(id_col)).distinct()
    return docs.join(gone, id_col, "left_anti")
