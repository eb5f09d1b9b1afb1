"""SimHash fingerprints and their neighbours, in DataFrame functions only.

Terms are pairs of neighbouring words (runs without white space, lower case), each
weighted by how often it occurs. Every occurrence votes with the bits of its 64-bit hash; a bit
of the fingerprint is set if more votes are for it than against. Two votes are counted in one
long, 32 bits apart, so 32 sums per text are enough and aggregation stays in generated code.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Bits i and i + 32 of a hash shifted right by i.
_LANES = 0x0000000100000001


def words_of(text: Column) -> Column:
    """Lower-case runs without white space, of a text that has none at its ends."""
    return F.when(text == "", F.array().cast("array<string>")).otherwise(F.split(F.lower(text), r"\s+"))


def _trimmed(text: Column) -> Column:
    return F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\x0b\f\r"))


def _votes(term: str) -> list[Column]:
    return [F.sum(F.shiftrightunsigned(term, i).bitwiseAND(F.lit(_LANES))).alias(f"v{i}") for i in range(32)]


def _fingerprint(total: Column) -> Column:
    """The fingerprint of the counted votes v0..v31; 0 without terms."""
    out = F.lit(0).cast("long")
    for i in range(32):
        for lane, votes in ((i, F.col(f"v{i}").bitwiseAND(F.lit(0xFFFFFFFF))), (i + 32, F.shiftrightunsigned(F.col(f"v{i}"), 32))):
            out = out.bitwiseOR(F.when(votes * 2 > total, F.shiftleft(F.lit(1).cast("long"), lane)).otherwise(F.lit(0).cast("long")))
    return out


def fingerprints(rows: DataFrame, keys: list[str], texts: dict[str, str]) -> DataFrame:
    """``keys`` and, for each text column, the fingerprint (long) under the name it is given.

    ``keys`` must tell the rows apart. A text that is null, empty or white space has
    fingerprint 0; equal texts have equal ones.
    """
    names = list(texts)
    n = range(len(names))
    trimmed = rows.select(*keys, *[_trimmed(F.col(c)).alias(f"t{k}") for k, c in enumerate(texts.values())])
    split = trimmed.select(*keys, *[words_of(F.col(f"t{k}")).alias(f"w{k}") for k in n])
    # one pass over the words of all texts of a row: a word's place tells whose it is. The array stays
    # beside its words, so a pair is hashed in generated code, without a function over arrays.
    ends = [sum((F.size(f"w{j}") for j in range(1, k + 1)), F.size("w0")).alias(f"b{k}") for k in n]
    terms = split.select(*keys, *ends, F.concat(*[f"w{k}" for k in n]).alias("w"))
    terms = terms.select(*keys, *[f"b{k}" for k in n], "w", F.posexplode_outer("w").alias("at", "word"))
    last = F.lit(False)
    for k in n:
        last = last | (F.col("at") + 1 == F.col(f"b{k}"))
    after = F.when(~last, F.get("w", F.col("at") + 1))
    whose = F.lit(len(names) - 1)
    for k in reversed(range(len(names) - 1)):
        whose = F.when(F.col("at") < F.col(f"b{k}"), F.lit(k)).otherwise(whose)
    terms = terms.withColumn("term", F.when(F.col("word").isNotNull(), F.xxhash64("word", after)))
    voted = terms.select(*keys, F.coalesce(whose, F.lit(0)).alias("whose"), "term").groupBy(*keys, "whose").agg(F.count("term").alias("n"), *_votes("term"))
    done = voted.select(*keys, "whose", _fingerprint(F.col("n")).alias("fp"))
    return done.groupBy(*keys).agg(*[F.coalesce(F.max(F.when(F.col("whose") == k, F.col("fp"))), F.lit(0).cast("long")).alias(n)
                                     for k, n in enumerate(names)])


def likeness(a: Column, b: Column) -> Column:
    """The share of equal bits, 0 to 1."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(64.0)


def as_hex(fingerprint: Column) -> Column:
    return F.lpad(F.lower(F.hex(fingerprint)), 16, "0")


def within_radius(fingerprints_: DataFrame, queries: DataFrame, radius: int = 3, blocks: int = 6, fp: str = "fingerprint") -> DataFrame:
    """(query, found, distance): all distinct fingerprints within ``radius`` bits of a distinct query fingerprint.

    The 64 bits are cut into ``blocks`` blocks, of which ``radius`` differing bits leave at least
    blocks - radius untouched. For each choice of that many blocks a table keeps the chosen
    bits as key, so every pair in the radius meets in a table. Copies share a row; callers join ids back.
    """
    if not 0 <= radius < blocks <= 64:
        raise ValueError("0 <= radius < blocks <= 64 must hold")
    edges = [64 * k // blocks for k in range(blocks + 1)]
    block = [((1 << (edges[k + 1] - edges[k])) - 1) << edges[k] for k in range(blocks)]
    masks = [sum(block[k] for k in chosen) for chosen in combinations(range(blocks), blocks - radius)]
    signed = [m - (1 << 64) if m >= 1 << 63 else m for m in masks]

    def tables(df: DataFrame, name: str) -> DataFrame:
        one = df.select(F.col(fp).cast("long").alias(name)).where(F.col(name).isNotNull()).distinct()
        keys = F.array(*[F.struct(F.lit(k).alias("t"), F.col(name).bitwiseAND(F.lit(m).cast("long")).alias("key")) for k, m in enumerate(signed)])
        return one.select(name, F.explode(keys).alias("k")).select(name, "k.t", "k.key")

    distance = F.bit_count(F.col("query").bitwiseXOR(F.col("found")))
    return (tables(queries, "query").join(tables(fingerprints_, "found"), ["t", "key"]).where(distance <= radius)
            .select("query", "found", distance.alias("distance")).distinct())


def with_next(docs: DataFrame, buckets: int) -> DataFrame:
    """(bucket, place, sentinel, doc_id, text, next): rows in descending doc_id with the text of the row that follows.

    The first row follows the last; null ids come last; rows with one id stand in the order of a hash
    of their texts. Ids are cut at their approximate quantiles into ``buckets`` ranges, so a range can be
    sorted by itself. At its end a range holds, as a sentinel, a copy of the first row of the
    range after it; callers drop sentinels. The texts move once.
    """
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    shares = [k / buckets for k in range(1, buckets)]
    cuts = docs.agg(F.percentile_approx("doc_id", shares, 100 * buckets)).first()[0] if shares else []
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1)).otherwise(_range_of("doc_id", sorted(set(cuts or []))))
    heads = {r["bucket"]: r["head"] for r in docs.select("doc_id", bucket.alias("bucket")).groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()}
    order = sorted(heads, reverse=True)
    follow = [(b, heads[n]) for b, n in zip(order, order[1:] + order[:1])]  # a row per range
    spark = docs.sparkSession
    marks = F.broadcast(spark.createDataFrame(follow, "bucket int, head long"))
    extra = docs.join(marks, F.col("doc_id").eqNullSafe(F.col("head"))).select("doc_id", "text", "bucket", F.lit(1).alias("sentinel"))
    rows = docs.select("doc_id", "text", bucket.cast("int").alias("bucket"), F.lit(0).alias("sentinel")).unionByName(extra)
    w = Window.partitionBy("bucket").orderBy("sentinel", F.desc_nulls_last("doc_id"), F.xxhash64("text"))
    return rows.select("bucket", F.row_number().over(w).alias("place"), "sentinel", "doc_id", "text",
                       F.coalesce(F.lead("text").over(w), F.lit("")).alias("next"))


def _range_of(column: str, cuts: list[int]) -> Column:
    """How many of the sorted cuts are at or below the value, found in two steps."""
    if not cuts:
        return F.lit(0)
    step = max(1, int(len(cuts) ** 0.5))
    parts = [cuts[k:k + step] for k in range(0, len(cuts), step)]
    below = lambda values: F.size(F.filter(values, lambda c: c <= F.col(column)))
    first = below(F.array(*[F.lit(p[0]).cast("long") for p in parts]))
    rows = F.array(*[F.array(*[F.lit(c).cast("long") for c in p]) for p in parts])
    return F.when(first == 0, F.lit(0)).otherwise((first - 1) * step + below(F.get(rows, first - 1)))


def edited_likeness(docs: DataFrame, buckets: int | None = None) -> DataFrame:
    """Fingerprints of texts, of texts whose second half the next text's beginning replaces, and of the next text.

    (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next),
    one row per row; null texts count as empty, null ids stay. Alone in its table a document is its own next one.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    spark = docs.sparkSession
    buckets = buckets or min(1 << 14, 4 * max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism))
    keys = ["bucket", "place", "sentinel", "doc_id", "n_chars", "edited_sha256"]
    half = (F.col("n_chars") / 2).cast("long").cast("int")
    rows = (with_next(docs, buckets).withColumn("n_chars", F.char_length("text").cast("long"))
            .withColumn("edited", F.concat(F.substring("text", F.lit(1), (F.col("n_chars") - half).cast("int")), F.substring("next", F.lit(1), half)))
            .withColumn("edited_sha256", F.sha2(F.col("edited").cast("binary"), 256)))
    fps = fingerprints(rows, keys, {"fp": "text", "edited_fp": "edited"})
    w = Window.partitionBy("bucket").orderBy("place")
    fps = fps.withColumn("next_fp", F.lead("fp").over(w)).where("sentinel = 0")
    return fps.select("doc_id", "n_chars", "edited_sha256", as_hex(F.col("fp")).alias("fingerprint"),
                      as_hex(F.col("edited_fp")).alias("edited_fingerprint"),
                      likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
                      likeness(F.col("fp"), F.coalesce("next_fp", "fp")).alias("near_next"))
