"""Near-duplicate groups, shards, fingerprints and languages against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from haulmark.llm import langid, shards as S, simhash as H
from haulmark.llm.components import components
from haulmark.llm.neardup import near_duplicates, set_keys, text_sets, without_duplicates

from test_words_hash import plain_words


def edited(words, edits, r):
    words = list(words)
    for _ in range(edits):
        k = r.randrange(len(words))
        kind = r.randrange(3)
        if kind == 0:
            words[k] = f"new{r.randrange(10 ** 9)}"
        elif kind == 1:
            words.insert(k, f"ins{r.randrange(10 ** 9)}")
        elif len(words) > 5:
            del words[k]
    return words


def fixture(seed=4):
    """Copies, near copies whose edits differ, near copies of near copies, short and odd texts."""
    r = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = [(0, None), (1, ""), (2, " \n"), (3, "single"), (4, "SINGLE"), (5, "two words"), (6, "Two  Words"), (7, "a b c"), (8, "c b a")]
    n = 20
    for size, copies in ((60, 45), (120, 30), (200, 12), (30, 10)):
        base = [r.choice(vocabulary) for _ in range(size)]
        for _ in range(copies):
            first = edited(base, r.choice([0, 0, 1, 2, 3, 4, 6]), r)
            rows.append((n, " ".join(first)))
            rows.append((n + 1, " ".join(edited(first, r.choice([0, 1, 2]), r)).upper()))
            n += 2
    rows += [(n + k, " ".join(r.choice(vocabulary) for _ in range(50))) for k in range(20)]
    order = list(range(len(rows)))
    r.shuffle(order)
    return [(rows[k][0] if rows[k][0] < 20 else 20 + order[k], rows[k][1]) for k in range(len(rows))]


def brute_groups(rows, size, percent):
    sets = {}
    for i, t in rows:
        w = plain_words(t)
        sets[i] = {tuple(w[k:k + size]) for k in range(max(1, len(w) - size + 1))} if w else set()
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("size,percent,seed", [(3, 85, 4), (5, 80, 8)])
def test_groups_equal_brute_force(documents, size, percent, seed):
    rows = fixture(seed)
    want = brute_groups(rows, size, percent)
    got = near_duplicates(documents(rows), shingle=size, percent=percent).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want and len(got) == len(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert len({c for _, c in want.values()}) < 0.7 * len(want)


def test_groups_of_odd_rows(documents):
    text = "one two three four five six"
    rows = [(5, text), (3, text), (5, text), (None, text), (None, None), (9, None), (8, "")]
    order = lambda x: (x[0], x[1])
    got = sorted(((r.doc_id or -1, r.n_shingles, r.component_id, r.kept) for r in near_duplicates(documents(rows), shingle=3, percent=85).collect()), key=order)
    assert got == [(-1, 0, None, True), (-1, 4, None, True), (3, 4, 3, True), (5, 4, 3, False), (5, 4, 3, False), (8, 0, 8, True), (9, 0, 9, True)]
    kept = without_duplicates(documents(rows), near_duplicates(documents(rows), shingle=3, percent=85))
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, -1, 3, 8, 9]
    assert near_duplicates(documents([])).count() == 0


def test_families_around_one_hub_are_not_paired_up(documents, monkeypatch):
    """Two families at a similarity of some 0.75 share buckets; links follow the number of members."""
    from haulmark.llm import neardup
    r = random.Random(3)
    base = [f"w{r.randrange(10 ** 6)}" for _ in range(300)]
    other = base[:262] + [f"v{k}" for k in range(38)]
    rows = [(k, " ".join(edited(base if k % 5 < 3 else other, 3, r))) for k in range(150)]
    seen = []
    whole = neardup.components
    monkeypatch.setattr(neardup, "components", lambda links, x, y: (seen.append(links.distinct().count()), whole(links, x, y))[1])
    got = {x.doc_id: x.component_id for x in near_duplicates(documents(rows), shingle=3, percent=85).collect()}
    assert got == {k: c for k, (_, c) in brute_groups(rows, 3, 85).items()}
    assert len(set(got.values())) == 2 and seen[0] < 8 * len(rows)


def test_set_keys_depend_on_the_set_alone():
    texts = pa.array(["a b c d e", None, "x y", "E F G H", "x  Y", "a b c d e", "e f g h"])
    key1, key2 = set_keys(*text_sets(texts, 3))
    for key in (key1, key2):
        assert key.dtype == np.int64 and key[0] == key[5] and key[2] == key[4] and key[3] == key[6] and len(set(key.tolist())) == 4


def test_repeated_ids_have_the_links_of_all_their_texts(documents):
    r = random.Random(9)
    base = [[f"{name}{r.randrange(300)}" for _ in range(80)] for name in "abcd"]
    a, b, c, d = (" ".join(w) for w in base)
    near = lambda k: " ".join(base[k][:-1] + ["other"])
    rows = [(1, a), (1, b), (1, b.upper()), (1, ""), (2, near(0)), (3, near(1)), (5, c), (4, near(2)), (4, near(3)), (6, d), (7, "alone here with no copy"), (None, a)]
    want = {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 7, None: None}
    for _ in range(2):
        found = near_duplicates(documents(rows), shingle=3, percent=85)
        got = found.collect()
        assert len(got) == len(rows) and all(x.component_id == want[x.doc_id] for x in got)
        assert all(x.kept == (x.doc_id == x.component_id) for x in got)
        kept = without_duplicates(documents(rows), found).collect()
        assert sorted(x.doc_id or 0 for x in kept) == [0, 1, 1, 1, 1, 4, 4, 7]
        r.shuffle(rows)


def test_likely_rows(spark, monkeypatch):
    from haulmark.llm import common
    ids = [-5, 0, 1, 63, 64, 10 ** 15, common.SLOTS, common.SLOTS + 7]
    rows = spark.createDataFrame([(i, "t") for i in [*ids, 2, 3, 10 ** 9]] + [(None, "x")], "doc_id long, text string")
    wanted = spark.createDataFrame([(i,) for i in ids], "doc_id long")
    assert sorted(r.doc_id for r in common.likely(rows, wanted).collect()) == sorted(ids)
    assert common.likely(rows, wanted.limit(0)).count() == 0
    monkeypatch.setattr(common, "SLOTS", 1)  # a full filter lets all through
    assert common.likely(rows, wanted).count() == 11


def test_components(spark):
    r = random.Random(2)
    links = [(k, k + 1) for k in range(100, 180)] + [(500, k) for k in range(501, 560)] + [(7, 7), (None, 3), (4, None), (9, 8), (9, 8), (8, 9)]
    links += [(r.randrange(1000, 1100), r.randrange(1000, 1100)) for _ in range(60)]
    root = {}

    def find(i):
        root.setdefault(i, i)
        while root[i] != i:
            i = root[i]
        return i
    for a, b in links:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    got = components(spark.createDataFrame(links, "a long, b long"))
    assert {(x.node, x.root) for x in got.collect()} == {(i, find(i)) for i in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def best_capacity(sizes, shards):
    ends = np.cumsum(sizes)
    low, high = max(max(sizes), -(-ends[-1] // shards)), ends[-1]
    while low < high:
        mid, at, used = (low + high) // 2, 0, 0
        while at < ends[-1] and used < shards:
            at = ends[np.searchsorted(ends, at + mid, "right") - 1]
            used += 1
        if at == ends[-1]:
            high = mid
        else:
            low = mid + 1
    return low


@pytest.mark.parametrize("slots", [4, S.SLOTS])
def test_shards_are_minimax(documents, monkeypatch, slots):
    monkeypatch.setattr(S, "SLOTS", slots)  # few slots: the summary has to be refined
    monkeypatch.setattr(S, "FINER", 4)
    r = random.Random(6)
    texts = ["copy" * 40] * 150 + [None] * 9 + [""] * 9 + ["z" * 3000] + ["".join(r.choice("abé") for _ in range(r.randint(1, 300))) for _ in range(250)]
    rows = list(enumerate(texts))
    r.shuffle(rows)
    got = {x.doc_id: x for x in S.minimax_shards(documents(rows), 8).collect()}
    data = {i: (t or "").encode() for i, t in rows}
    assert all(got[i].size == len(d) + 1 and got[i].text_crc32 == zlib.crc32(d) for i, d in data.items()) and len(got) == len(rows)
    groups, order = {}, {}
    for i, d in data.items():
        groups.setdefault(d, set()).add(got[i].shard)
        order[hashlib.md5(d).hexdigest()] = order.get(hashlib.md5(d).hexdigest(), 0) + len(d) + 1
    assert all(len(g) == 1 for g in groups.values())
    loads = [sum(x.size for x in got.values() if x.shard == s) for s in range(8)]
    assert max(loads) == best_capacity([order[k] for k in sorted(order)], 8)
    for s in range(8):
        assert sorted(x.slot for x in got.values() if x.shard == s) == list(range(sum(x.shard == s for x in got.values())))


def test_shards_of_few_rows(documents):
    assert S.minimax_shards(documents([])).count() == 0
    got = S.minimax_shards(documents([(1, "x"), (1, "x"), (None, None)]), 4).collect()
    assert len(got) == 3 and len({r.shard for r in got if r.text_crc32}) == 1


def test_fingerprints(spark, documents):
    texts = [None, "", "a", "A b  c", "a B c", "other text here " * 20, "日本 語"] + [f"word{k} word{k + 1} some more" for k in range(30)]
    rows = [(3 * k, t) for k, t in enumerate(texts)]
    r = random.Random(1)
    r.shuffle(rows)
    got = {x.doc_id: x for x in H.edited_likeness(documents(rows), buckets=5).collect()}
    ids = sorted(got, reverse=True)
    plain = {i: t or "" for i, t in rows}
    for k, i in enumerate(ids):
        text, after = plain[i], plain[ids[(k + 1) % len(ids)]]
        half = len(text) // 2
        change = text[:len(text) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), hashlib.sha256(change.encode()).hexdigest())
        a, b, c = (int(x, 16) for x in (got[i].fingerprint, got[i].edited_fingerprint, got[ids[(k + 1) % len(ids)]].fingerprint))
        assert got[i].near_edited == 1 - (a ^ b).bit_count() / 64 and got[i].near_next == 1 - (a ^ c).bit_count() / 64
    assert got[9].fingerprint == got[12].fingerprint != got[15].fingerprint and got[0].fingerprint == "0" * 16
    # votes bit by bit
    words = texts[5].split()
    pairs = spark.createDataFrame(list(zip(words, [*words[1:], None])), "a string, b string").select(F.xxhash64("a", "b").alias("h"))
    hashed = [r.h for r in pairs.collect()]
    votes = [sum(1 if (h >> b) & 1 else -1 for h in hashed) for b in range(64)]
    assert int(got[15].fingerprint, 16) == sum(1 << b for b in range(64) if votes[b] > 0)


def test_fingerprints_of_odd_rows(documents):
    assert H.edited_likeness(documents([])).count() == 0
    one = H.edited_likeness(documents([(4, "abcd")])).collect()
    assert len(one) == 1 and one[0].near_next == 1.0 and one[0].edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    got = H.edited_likeness(documents([(1, "x y"), (1, "x y"), (None, "z"), (None, None)]), buckets=3).collect()
    assert sorted(r.doc_id or -1 for r in got) == [-1, -1, 1, 1]


@pytest.mark.parametrize("radius,blocks", [(0, 1), (2, 4), (3, 6)])
def test_neighbours_within_radius(spark, radius, blocks):
    r = random.Random(radius)
    values = [r.getrandbits(64) for _ in range(120)]
    for v in values[:60]:
        for _ in range(2):
            for bit in r.sample(range(64), r.randint(0, 5)):
                v ^= 1 << bit
            values.append(v)
    signed = lambda v: v - (1 << 64) if v >> 63 else v
    frame = spark.createDataFrame([(signed(v),) for v in values + values[:5]] + [(None,)], "fingerprint long")
    got = {(x.query, x.found): x.distance for x in H.within_radius(frame, frame, radius, blocks).collect()}
    want = {(signed(a), signed(b)): (a ^ b).bit_count() for a in set(values) for b in set(values) if (a ^ b).bit_count() <= radius}
    assert got == want


def test_languages_on_held_out_rows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(docs, ~langid.held_out())
    got = langid.predict(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert len(got) > 200 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    assert all(0 <= r.score <= 1 for r in got)
    assert {zlib.crc32(str(r.doc_id).encode()) % 4 for r in got} == {2}


def test_languages_of_odd_rows(spark, documents):
    learned = documents([(k, "the cat and the dog " * 3) for k in range(8)]).union(documents([(k, "der hund und die katze " * 3) for k in range(8, 16)], "de"))
    model = langid.train(learned, F.lit(True))
    rows = [(1, None), (2, ""), (3, "123 !?"), (4, "the"), (4, "the"), (None, "und die"), (6, "the cat " * 50000)]
    got = sorted(((r.doc_id or -1), r.lang_pred, r.score) for r in langid.predict(documents(rows, None), model).collect())
    assert [(i, p) for i, p, _ in got] == [(-1, "de"), (1, "und"), (2, "und"), (3, "und"), (4, "en"), (4, "en"), (6, "en")]
    assert [s for _, p, s in got if p == "und"] == [0, 0, 0]
    kept = langid.accepted(documents(rows, None), model)
    assert kept.dtypes == documents(rows).dtypes and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 4, 4, 6]
    none = langid.train(documents(rows, None), F.lit(True))
    assert not none.languages and {r.lang_pred for r in langid.predict(documents(rows), none).collect()} == {"und"}
    assert langid.accepted(documents(rows), none).count() == 0 and langid.predict(documents([]), model).count() == 0


def test_scores_equal_plain_naive_bayes():
    import pyarrow as pa
    rng = np.random.default_rng(0)
    weights = np.log(rng.dirichlet(np.ones(langid.FEATURES), 3)).T.astype(np.float32)
    model = langid.Model(["a", "b", "c"], weights, np.log([0.5, 0.3, 0.2]))
    texts = pa.array(["", "x", "Grüße 日本", "a longer text of words"])
    best, share = langid.score_texts(texts, model)
    for k, text in enumerate(texts.to_pylist()):
        one = np.array(model.priors)
        for feature, row in langid.ngrams(pa.array([text])):
            assert len(feature) == max(0, len(text) - (len(text) - len(feature))) and set(row) <= {0}
            one = one + weights[feature].sum(axis=0, dtype=float)
        assert best[k] == one.argmax() and share[k] == pytest.approx(1 / np.exp(one - one.max()).sum(), rel=1e-4)
