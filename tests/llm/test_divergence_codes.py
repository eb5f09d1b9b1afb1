"""Source divergence, vector codes and chunked byte-level BPE against plain versions."""

import base64
import math
import re
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st
from pyspark.sql import Row, functions as F

from haulmark.llm import chunked, divergence as D, vectorcodes as V
from haulmark.llm.queries import RANKS

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def plain_divergence(rows, least, listed):
    """rows: (lang, source, text)."""
    docs = [(g or "", s or "", Counter(TERM.findall(lower(t or "")))) for g, s, t in rows]
    out = set()
    for lang in {g for g, _, _ in docs}:
        own = [(s, c) for g, s, c in docs if g == lang]
        df, total = Counter(), Counter()
        for _, c in own:
            df.update(c.keys())
            total.update(c)
        vocab = [t for t in df if df[t] >= least]
        groups = defaultdict(Counter)
        for s, c in own:
            groups[s].update({t: n for t, n in c.items() if df[t] >= least})

        def price(counts, t):
            return 1 + (10 ** 9 * (counts[t] + 5)) // (sum(counts.values()) + 5 * len(vocab))

        everything = Counter({t: total[t] for t in vocab})
        for s, c in groups.items():
            pairs = [(sum(abs(price(c, t) - price(o, t)) for t in vocab), x) for x, o in groups.items() if x != s]
            for k, (value, x) in enumerate(sorted(pairs, key=lambda p: (-p[0], p[1].encode()))):
                out.add((lang, s, "pair", x, value, k + 1))
            terms = [(price(c, t) - price(everything, t), t) for t in vocab if c[t]]
            best = sorted((p for p in terms if p[0] > 0), key=lambda p: (-p[0], p[1].encode()))
            for k, (value, t) in enumerate(best[:listed]):
                out.add((lang, s, "term", t, value, k + 1))
    return out


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_divergence_equals_plain(spark):
    rng = np.random.default_rng(5)
    vocab = [f"w{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["Ärger", "naïve", "東京", "x y"]
    rows = []
    for k in range(300):
        lang = ["de", "en", None][int(rng.integers(3))]
        source = f"s{min(int(rng.integers(30)), 20)}"
        at = (rng.random(int(rng.integers(0, 40))) ** 2 * len(vocab)).astype(int)
        rows.append((lang, source, " ".join(vocab[a].upper() if rng.random() < 0.2 else vocab[a] for a in at)))
    rows += [("en", None, None), ("en", "", "wa-wa 3wa_wa"), ("fr", "alone", "only here"), ("it", "a", "x"), ("it", "b", ""), rows[0], rows[0]]
    docs = spark.createDataFrame([Row(lang=g, source=s, text=t, term="clash", block=1, i=2, entries=3, whole=4) for g, s, t in rows]).repartition(5)
    got = rows_of(D.source_divergence(docs, least_docs=5, listed=7))
    assert len(got) == len(set(got))
    assert set(got) == plain_divergence(rows, 5, 7)
    assert ("it", "a", "pair", "b", 0, 1) in got and not any(r[0] == "fr" for r in got)


def test_divergence_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK", 4)
    monkeypatch.setattr(D, "BUNDLE", 2)
    rng = np.random.default_rng(6)
    rows = [("en", f"s{k % 7}", " ".join(f"t{'abcdefghijklmnopqrstuvwxyz'[int(x)]}" for x in rng.integers(0, 26, 30))) for k in range(60)]
    docs = spark.createDataFrame([Row(lang=g, source=s, text=t) for g, s, t in rows])
    assert set(rows_of(D.source_divergence(docs, least_docs=2))) == plain_divergence(rows, 2, 50)


def test_divergence_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string")
    assert D.source_divergence(docs).collect() == []


def test_long_texts_count_whole(spark):
    text = "ab " * 2_000_000
    docs = spark.createDataFrame([Row(lang="en", source="a", text=text), Row(lang="en", source="b", text="ab cd")])
    counts = {(r.source, r.term): r.n for r in D.term_counts(docs).collect() if r.term}
    assert counts == {("a", "ab"): 2_000_000, ("b", "ab"): 1, ("b", "cd"): 1}


@given(st.lists(st.integers(0, 400), unique=True), st.lists(st.integers(0, 400), unique=True), st.sampled_from([1, 3, 512]))
@settings(max_examples=150, deadline=None)
def test_gallop_finds_what_both_have(a, b, stride):
    a, b = np.sort(np.array(a, np.int64)), np.sort(np.array(b, np.int64))
    i, j = D.gallop(a, b, stride)
    assert a[i].tolist() == b[j].tolist() == np.intersect1d(a, b).tolist()


@given(st.integers(0, 10 ** 13), st.integers(10 ** 13 + 5, 8 * 10 ** 15))
def test_price_is_exact(count, total):
    assert int(D.price(count, total)) == 1 + 10 ** 9 * (count + 5) // total


# --- vector codes --------------------------------------------------------------

def plain_codes(rows, parts, entries, rounds):
    """rows: (vec_id, vector, label), ids distinct, one length."""
    kept = [(i, [math.floor(256 * x) for x in v], g) for i, v, g in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    split = lambda q: [q[p * width:(p + 1) * width] for p in range(parts)]
    books = [[split(q)[p] for _, q, _ in sorted(kept)[:entries]] for p in range(parts)]
    gap = lambda x, y: sum((a - b) ** 2 for a, b in zip(x, y))
    code = lambda q: [min((gap(x, y), e) for e, y in enumerate(books[p])) for p, x in enumerate(split(q))]
    for _ in range(rounds):
        chosen = [code(q) for _, q, _ in kept]
        new = [list(b) for b in books]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [split(q)[p] for (_, q, _), c in zip(kept, chosen) if c[p][1] == e]
                if own:
                    new[p][e] = [sum(x) // len(own) for x in zip(*own)]
        books = new
    out = {i: ("".join(f"{e:02x}" for _, e in code(q)), sum(d for d, _ in code(q))) for i, q, _ in kept}
    sums = Counter()
    for i, _, g in kept:
        sums[g] += out[i][1]
    return {(i, g, *out[i], sums[g]) for i, _, g in kept}, books


SCHEMA = "vec_id long, embedding array<float>, label int, q int, near string, code string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, g, 1, "x", "y") for i, v, g in rows], SCHEMA).repartition(4)


def test_codes_equal_plain(spark):
    rng = np.random.default_rng(7)
    rows = [(int(i), np.round(rng.normal(size=12) * rng.choice([0.05, 0.5]), 2).astype(np.float32).tolist(), [None, 1, 2][int(rng.integers(3))])
            for i in rng.permutation(400) - 50]
    rows += [(1000, None, 1), (1001, [0.5] * 11 + [None], 1), (1002, [float("nan")] + [0.1] * 11, 2), (-900, [float("inf")] * 12, None),
             (1003, [0.25] * 12, None), (1004, [0.25] * 12, None)]
    got, books = V.vector_codes(frame(spark, rows), parts=4, entries=16, rounds=2, pivots=3)
    want, plain = plain_codes(rows, 4, 16, 2)
    got = rows_of(got)
    assert len(got) == len(want) and set(got) == want
    assert [books.of(p).tolist() for p in range(4)] == plain


def test_codes_of_few_odd_and_repeated_vectors(spark):
    rows = [(5, [0.5, 0.25], 1), (5, [0.25, 0.25], 1), (5, [0.5, 0.25], None), (None, [0.5, 0.25], None), (7, [0.5], 2), (8, [], 2), (9, [0.5, 0.25, 0.1], 2)]
    got, books = V.vector_codes(frame(spark, rows), parts=2, entries=4)
    by_id = Counter((r.vec_id, r.label, r.code, r.error, r.label_error) for r in got.collect())
    # one entry per part: the least vector of id 5 begins it, two rounds move it to the floored mean of four, which is (111, 64)
    assert books.entries.tolist() == [[112, 64]]
    assert by_id == Counter({(5, 1, "0000", 256, 2560): 1, (5, 1, "0000", 2304, 2560): 1, (5, None, "0000", 256, 512): 1, (None, None, "0000", 256, 512): 1,
                             (7, 2, None, None, None): 1, (8, 2, None, None, None): 1, (9, 2, None, None, None): 1})


def test_codes_of_nothing(spark):
    got, books = V.vector_codes(frame(spark, []))
    assert got.collect() == [] and books is None
    got, books = V.vector_codes(frame(spark, [(None, [0.5] * 16, 1), (1, None, 1)]))
    assert [r.code for r in got.collect()] == [None] and books is None


def test_large_components_fail(spark):
    with pytest.raises(Exception, match="too large"):
        V.vector_codes(frame(spark, [(1, [2.0 ** 20] * 16, 1)]))[0].collect()


@given(st.integers(0, 2 ** 32 - 1))
@settings(max_examples=60, deadline=None)
def test_bounds_never_hide_the_nearest(seed):
    rng = np.random.default_rng(seed)
    size = int(rng.choice([2, 50, 2 ** 20]))
    entries = rng.integers(-size, size, (int(rng.integers(1, 70)), int(rng.integers(1, 9))))
    rows = np.vstack([rng.integers(-size, size, (200, entries.shape[1])), entries])
    books = V.Books(entries, 1)
    code, error = books.assign(rows, books.pivot_distances(rows))
    gaps = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
    assert code[:, 0].tolist() == gaps.argmin(axis=1).tolist()
    assert error[:, 0].tolist() == gaps.min(axis=1).tolist()


# --- chunked encoding ----------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    with open(RANKS, "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def check(spark, library, documents, texts, **sizes):
    rows = list(enumerate(texts)) + [(None, "no id"), (None, None), (3, "same id"), (3, "same id")]
    got = Counter((r.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in chunked.rank_encode(documents(rows), RANKS, **sizes).collect())
    want = Counter()
    for i, t in rows:
        ids = library.encode_ordinary(t or "")
        want[i, len(ids), np.array(ids, "<u4").tobytes(), (t or "").encode()] += 1
    assert got == want


EDGES = ["", None, " ", "   ", "a", "it's they're we'll I'd 's'", "x" * 500, " " * 500, " " * 499 + "x", "\n\n  \t word", "don''t" * 90,
         "abc 123 !? 東京の 😀😀 naïve café    <|endoftext|> end ", "'" * 200 + "re", ("word " * 7 + "\n" * 11) * 30,
         "a" * 90 + " " + "b" * 300 + " cc dd ee " * 50, "".join(chr(c) for c in range(1, 700))]


@pytest.mark.parametrize("sizes", [{}, {"chunk": 64, "overlap": 32}, {"chunk": 40, "overlap": 9}, {"chunk": 10, "overlap": 9}])
def test_chunks_encode_as_the_library(spark, library, documents, sizes):
    check(spark, library, documents, EDGES, **sizes)


def test_random_texts_in_chunks(spark, library, documents):
    rng = np.random.default_rng(8)
    alphabet = list("ab'rslet  \n\t.,;1é東") + ["  ", "'re", "'ll", " \n"]
    check(spark, library, documents, ["".join(rng.choice(alphabet, int(rng.integers(0, 400)))) for _ in range(400)], chunk=48, overlap=12)


def test_very_long_texts(spark, library, documents):
    check(spark, library, documents, ["lorem ipsum dolor's " * 60_000, "z" * 200_000, "x " * 50_000 + "y" * 80_000 + " x" * 50_000])


def test_no_text_at_all(spark, documents):
    assert chunked.rank_encode(documents([]), RANKS).collect() == []


def test_overlap_has_room_for_a_seam(documents):
    with pytest.raises(ValueError):
        chunked.rank_encode(documents([(1, "a")]), RANKS, chunk=8, overlap=8)


def test_queries_have_their_columns(spark):
    from haulmark.llm.queries import QUERIES
    sf = "/root/testdata/sf0.001"
    assert QUERIES["op11_source_divergence"](spark, sf).dtypes == [
        ("lang", "string"), ("source", "string"), ("part", "string"), ("item", "string"), ("value", "bigint"), ("rank", "int")]
    assert QUERIES["op12_vector_codes"](spark, sf).dtypes == [
        ("vec_id", "bigint"), ("code", "string"), ("error", "bigint"), ("label_error", "bigint"), ("codebooks_sha256", "string")]
    coded = QUERIES["op13_chunked_bpe"](spark, sf)
    assert coded.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.sha2("text", 256).alias("same"))
    assert coded.join(docs, "doc_id").where("decoded_sha256 = same").count() == docs.count()
