"""One query per operator over the whole of its table, with equal DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from haulmark.llm import langid
from haulmark.llm.chunked import rank_encode
from haulmark.llm.codec import encode_decode
from haulmark.llm.counts import token_counts
from haulmark.llm.divergence import source_divergence
from haulmark.llm.idfile import read_ids, write_ids
from haulmark.llm.labeller import extract
from haulmark.llm.leaks import find_leaks
from haulmark.llm.neardup import near_duplicates
from haulmark.llm.repeats import repeated_passages
from haulmark.llm.shards import minimax_shards
from haulmark.llm.simhash import edited_likeness
from haulmark.llm.vectorcodes import vector_codes
from haulmark.session import scratch_path

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run
    return register


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


NEAR_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS ws FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
         ELSE list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]))
         END AS sh FROM w),
u AS (SELECT doc_id, len(sh) AS n, unnest(sh) AS g FROM s),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, any_value(a.n) AS nx, any_value(b.n) AS ny, count(*) AS i
      FROM u a JOIN u b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM p WHERE 100 * i >= 85 * (nx + ny - i)),
b AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x, y FROM b UNION SELECT r.x, b.y FROM r JOIN b ON r.y = b.x),
m AS (SELECT x, min(y) AS y FROM r GROUP BY x)
SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, least(s.doc_id, coalesce(m.y, s.doc_id)) AS component_id,
       s.doc_id <= coalesce(m.y, s.doc_id) AS kept
FROM s LEFT JOIN m ON m.x = s.doc_id"""


@_query("op1_id_files")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    folder = scratch_path(spark, "ids")
    write_ids(_table(spark, sf, "documents"), folder, TOKENIZER, end_id=2)
    return read_ids(spark, folder, digest=True)


@_query("op2_minhash_groups", NEAR_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(_table(spark, sf, "documents"), shingle=3, percent=85)


@_query("op3_bpe_round_trip")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    coded = encode_decode(_table(spark, sf, "documents"), TOKENIZER)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op4_token_counts")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts(_table(spark, sf, "documents"), TOKENIZER)


@_query("op5_minimax_shards")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return minimax_shards(_table(spark, sf, "documents"), 8).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@_query("op7_simhash")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return edited_likeness(_table(spark, sf, "documents"))


@_query("op9_language_id")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = langid.predict(docs, langid.train(docs, ~langid.held_out()))
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@_query("op8_main_text")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return extract(_table(spark, sf, "pages"))


@_query("op10_benchmark_leaks")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    return find_leaks(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


@_query("op6_repeated_passages")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return repeated_passages(_table(spark, sf, "documents"))


DIVERGENCE_SQL = r"""
WITH d AS (SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
w AS (SELECT lang, source, r, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
v AS (SELECT lang, term, count(*) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
l AS (SELECT lang, count(*) AS v, sum(n) AS n FROM v GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT w.lang, w.source, w.term, count(*) AS n FROM w JOIN v ON w.lang = v.lang AND w.term = v.term GROUP BY ALL),
t AS (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL),
p AS (SELECT g.lang, g.source, v.term, coalesce(c.n, 0) AS n,
        1 + (1000000000 * CAST(coalesce(c.n, 0) + 5 AS HUGEINT)) // CAST(coalesce(t.n, 0) + 5 * l.v AS HUGEINT) AS p,
        1 + (1000000000 * CAST(v.n + 5 AS HUGEINT)) // CAST(l.n + 5 * l.v AS HUGEINT) AS q
      FROM g JOIN v ON v.lang = g.lang JOIN l ON l.lang = g.lang LEFT JOIN t ON t.lang = g.lang AND t.source = g.source
      LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = v.term),
f AS (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y
      ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
a AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, CAST(coalesce(f.value, 0) AS BIGINT) AS value
      FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
      LEFT JOIN f ON f.lang = x.lang AND f.source = x.source AND f.item = y.source
      UNION ALL SELECT lang, source, 'term', term, CAST(p - q AS BIGINT) FROM p WHERE n > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM a
QUALIFY part = 'pair' OR rank <= 50"""


@_query("op11_source_divergence", DIVERGENCE_SQL)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return source_divergence(_table(spark, sf, "documents"))


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """Rounds written out one after the other: every part against every entry of its codebook."""
    steps = [f"""
k AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT vec_id, p, q[p * (len(q) // {parts}) + 1 : (p + 1) * (len(q) // {parts})] AS x FROM k, range({parts}) r(p)),
b0 AS (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e, x AS y FROM s
       WHERE vec_id IN (SELECT vec_id FROM k ORDER BY vec_id LIMIT {entries}))"""]
    for n in range(rounds + 1):
        steps.append(f"""
d{n} AS (SELECT s.vec_id, s.p, min((list_sum(list_transform(list_zip(x, y), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e)) AS m
         FROM s JOIN b{n} ON b{n}.p = s.p GROUP BY ALL)""")
        if n < rounds:
            steps.append(f"""
u{n} AS (SELECT p, m[2] AS e, i, CAST(floor(sum(z) / count(*)) AS BIGINT) AS v FROM (SELECT s.p, m, unnest(x) AS z, unnest(range(1, len(x) + 1)) AS i
         FROM d{n} JOIN s ON s.vec_id = d{n}.vec_id AND s.p = d{n}.p) GROUP BY ALL),
n{n} AS (SELECT p, e, list(v ORDER BY i) AS y FROM u{n} GROUP BY ALL),
b{n + 1} AS (SELECT b{n}.p, b{n}.e, coalesce(n{n}.y, b{n}.y) AS y FROM b{n} LEFT JOIN n{n} ON n{n}.p = b{n}.p AND n{n}.e = b{n}.e)""")
    return "WITH" + ",".join(steps) + f""",
o AS (SELECT k.vec_id, k.label, c.code, c.error FROM k JOIN (SELECT vec_id, string_agg(lower(printf('%02x', m[2])), '' ORDER BY p) AS code,
      CAST(sum(m[1]) AS BIGINT) AS error FROM d{rounds} GROUP BY vec_id) c ON c.vec_id = k.vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(array_to_string(y, ','), ',' ORDER BY p, e)) FROM b{rounds}) AS codebooks_sha256 FROM o"""


@_query("op12_vector_codes", _codes_sql())
def op12(spark: SparkSession, sf: str) -> DataFrame:
    codes, books = vector_codes(_table(spark, sf, "embeddings"))
    return codes.select("vec_id", "code", "error", "label_error", F.lit(books.sha256() if books else None).cast("string").alias("codebooks_sha256"))


@_query("op13_chunked_bpe")
def op13(spark: SparkSession, sf: str) -> DataFrame:
    coded = rank_encode(_table(spark, sf, "documents"), RANKS)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
