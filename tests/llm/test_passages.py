"""Repeated passages, benchmark leaks and page texts against brute force; the stages of the pipeline."""

import random
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from haulmark.llm import labeller as L, leaks as K, repeats as R
from haulmark.llm.blocks import blocks_of
from haulmark.llm.neardup import near_duplicates

from test_groups import brute_groups, edited
from test_words_hash import plain_words


def corpus(seed=2):
    """(rows, ids that hold an exact shared passage of 50 words or more)."""
    r = random.Random(seed)
    fresh = lambda n: [f"v{r.randrange(10 ** 8)}" for _ in range(n)]
    passages = [fresh(60), fresh(50), fresh(300), fresh(49)]
    rows = [(0, None), (1, ""), (2, "short text")]
    n = 3
    for p in passages:
        for _ in range(9):
            rows.append((n, " ".join(fresh(r.randint(0, 120)) + p + fresh(r.randint(0, 120)))))
            n += 1
    rows += [(n + k, " ".join(fresh(200))) for k in range(20)]
    r.shuffle(rows)
    return rows


def exact_holders(rows, least=50):
    seen = {}
    for i, t in rows:
        w = plain_words(t)
        for k in range(len(w) - least + 1):
            seen.setdefault(tuple(w[k:k + least]), set()).add(i)
    return set().union(*(v for v in seen.values() if len(v) > 1))


def test_repeated_passages(documents):
    rows = corpus()
    found = R.repeated_passages(documents(rows)).collect()
    holders = {r.doc_id for r in found} | {r.other_id for r in found}
    assert holders == exact_holders(rows)
    texts = {i: plain_words(t) for i, t in rows}
    for r in found:
        a = texts[r.doc_id][r.first_word:r.first_word + r.n_words]
        b = texts[r.other_id][r.other_first_word:r.other_first_word + r.other_n_words]
        grams = [{tuple(x[k:k + 5]) for k in range(len(x) - 4)} for x in (a, b)]
        assert len(a) == r.n_words >= 50 and r.similarity == pytest.approx(len(grams[0] & grams[1]) / len(grams[0] | grams[1])) and r.similarity >= 0.8
    kept = R.without_repeats(documents(rows), documents(rows).sparkSession.createDataFrame(found))
    assert kept.dtypes == documents(rows).dtypes
    left = [(r.doc_id, r.text) for r in kept.collect()]
    assert not exact_holders(left)
    assert {i for i, _ in left} >= {i for i, t in rows if i not in holders} and all(dict(rows)[i] == t for i, t in left if i not in holders)


def test_the_least_of_linked_documents_keeps_a_passage(spark, documents):
    """Hubs with the largest ids: of members known only through them, all but the least are cut."""
    words = lambda name, n: [f"{name}{k}" for k in range(n)]
    star, chain, long = words("s", 60), words("c", 60), words("l", 100)
    rows = [(i, " ".join(words(f"o{i}x", 5) + p)) for i, p in [(5, star), (6, star), (9, star), (2, chain), (3, chain), (20, chain), (21, chain),
                                                             (30, long[:60]), (31, long[40:]), (40, long), (33, long[30:90]), (34, long[45:])]]
    pairs = [(5, 5, 60, 9, 5, 60), (6, 5, 60, 9, 5, 60),
             (3, 5, 60, 20, 5, 60), (20, 5, 60, 21, 5, 60), (2, 5, 60, 21, 5, 60),
             (30, 5, 60, 40, 5, 60), (31, 5, 60, 40, 45, 60), (33, 5, 60, 40, 35, 60), (34, 5, 55, 40, 50, 55)]
    found = spark.createDataFrame([(*p, 1.0) for p in pairs], "doc_id long, first_word int, n_words int, other_id long, other_first_word int, other_n_words int, similarity double")
    left = {r.doc_id: plain_words(r.text) for r in R.without_repeats(documents(rows), found).collect()}
    gone = {6: star, 9: star, 3: chain, 20: chain, 21: chain, 33: long[40:90], 34: long[45:], 40: long}
    for i, t in rows:
        assert left[i] == [w for w in t.split() if w not in gone.get(i, [])], i


def test_every_holder_meets_one_that_has_the_passage(documents):
    """Lines of a passage stand in earlier documents, each several times, and in a very long one, all in other surroundings."""
    r = random.Random(11)
    fresh = lambda n: [f"v{r.randrange(10 ** 8)}" for _ in range(n)]
    rows, giant = [], []
    for k in range(12):
        lines = [fresh(20) for _ in range(3)]
        passage = sum(lines, [])
        apart = sum((fresh(30) + line for line in lines), [])
        giant += apart + fresh(30)
        rows += [(k, " ".join(apart + fresh(30) + apart)), (100 + k, " ".join(apart + fresh(25) + apart)), (200 + k, " ".join(apart + fresh(20) + passage + fresh(9)))]
        rows += [(300 + 10 * k + j, " ".join(fresh(7) + passage + fresh(9))) for j in range(2)]
    rows.append((50, " ".join(giant)))
    found = R.repeated_passages(documents(rows)).collect()
    assert {x.doc_id for x in found} | {x.other_id for x in found} == exact_holders(rows)
    assert {(x.doc_id, x.other_id) for x in found} >= {(300 + 10 * k + j, 200 + k) for k in range(12) for j in range(2)}


def between_fillers(pairs, fillers, r):
    """Pairs of passages of 70 words, the second with a word changed, all whose runs of words stand in earlier and longer documents between other words; the rows of a pair are 1000 + 2 k and 1001 + 2 k."""
    fresh = lambda n: [f"v{r.randrange(10 ** 9)}" for _ in range(n)]
    both = [(p, p[:j] + fresh(1) + p[j + 1:]) for p, j in ((fresh(70), r.randint(20, 50)) for _ in range(pairs))]
    pieces = [x[a:a + 24] for pair in both for x in pair for a in range(0, len(x) - 15, 8)]
    rows = []
    for k in range(fillers):
        r.shuffle(pieces)
        rows.append((k, " ".join(sum((fresh(r.randint(10, 25)) + p for p in pieces), []))))
    return rows + [(1000 + 2 * k + j, " ".join(fresh(20) + x + fresh(20))) for k, pair in enumerate(both) for j, x in enumerate(pair)]


def test_edited_passages_whose_runs_lead_elsewhere(documents):
    """The first holder of every run, and the one that shares most, are other documents; the passage is found all the same."""
    rows = between_fillers(8, 50, random.Random(5))
    found = {tuple(sorted((x.doc_id, x.other_id))) for x in R.repeated_passages(documents(rows)).collect()}
    assert found == {(1000 + 2 * k, 1001 + 2 * k) for k in range(8)}


def test_first_tokens_of_stretches():
    r = np.random.default_rng(1)
    values, looked = r.integers(0, 40, 120).astype(np.uint64), r.random(111) < 0.3
    wanted = set()
    for s in np.flatnonzero(looked):
        least = sorted(set(values[s:s + 10].tolist()))[:3]
        wanted |= {int(p) for p in range(s, s + 10) if values[p] in least}
    assert set(np.flatnonzero(R._prefixes(values, looked, 10, 3)).tolist()) == wanted


def test_a_token_that_comes_again_and_again_is_one_place():
    """A line that stands 200 times in a document doesn't meet others 200 times; what known passages link differs inside and outside of them."""
    line = [f"l{k}" for k in range(60)]
    known = [{"first_word": 600, "n_words": 300, "other_id": 3, "links": 9, "first": False}, {"first_word": 700, "n_words": 100, "other_id": 4, "links": 1, "first": False}]
    batch = pa.RecordBatch.from_pylist([{"doc_id": 7, "text": " ".join(line * 200), "spans": list(range(12000 // R.SPAN + 1)), "known": known, "own": 2},
                                        {"doc_id": 8, "text": "short", "spans": [0], "known": None, "own": 0}])
    every = SimpleNamespace(value=np.full(1 << R.SLOT_BITS - 3, 255, np.uint8))
    rows = [x for b in R._places(50, 80, every)(iter([batch])) for x in b.to_pylist()]
    assert 0 < len(rows) <= 3 * 60 and {(x["g"], tuple(x["linked"])) for x in rows} == {(7, (7,)), (3, (3, 7)), (3, (3, 4, 7))}
    for x in rows:
        if x["linked"] != [7]:
            low, high = (600, 896) if 4 not in x["linked"] else (700, 796)
            assert low <= x["p"] <= x["q"] < high and (x["q"] - x["p"]) % 60 == 0
    assert max(x["q"] - x["p"] for x in rows) > 10000


def test_stretches_with_a_share_of_flags():
    r = np.random.default_rng(3)
    for _ in range(300):
        flags = r.random(r.integers(0, 60)) < r.choice([0.5, 0.8, 0.9])
        dense = any(flags[a:b].sum() >= 8 / 9 * (b - a) - 1e-9 for a in range(len(flags)) for b in range(a + 9, len(flags) + 1))
        assert R._sparse(flags, 9, 8 / 9) == (not dense)


def test_compared_stretches_equal_the_plain_definition():
    def plain(xs, ys, least, percent):
        share, out = 2 * percent / (100 + percent), []
        both = np.isin(xs, ys)
        for part, dense in ((R._longest, share), (R._covered, share), (R._covered, (1 + share) / 2), (R._covered, 1.0)):
            for a, b in part(both, least, dense):
                if any(a < c + n and c < b for c, n, *_ in out):
                    continue
                mine = set(xs[a:b].tolist())
                best = None
                for c, d in part(np.isin(ys, xs[a:b]), least, dense):
                    theirs = set(ys[c:d].tolist())
                    value = len(mine & theirs) / len(mine | theirs)
                    if best is None or value > best[4]:
                        best = (a, b - a, c, d - c, value)
                if best and 100 * best[4] >= percent - 1e-9 and best[1] >= least and best[3] >= least:
                    out.append(best)
        return out
    r = np.random.default_rng(4)
    found = 0
    for _ in range(300):
        base = r.integers(-2 ** 31, 2 ** 31, 90).astype(np.int32)
        side = lambda: np.concatenate([r.integers(0, 50, r.integers(0, 60)), np.where(r.random(90) < 0.05, 7, base)[r.integers(0, 30):], r.choice(base, r.integers(0, 20))]).astype(np.int32)
        xs, ys = side(), side()
        got = R.compare(xs, ys, 46, 80)
        assert got == plain(xs, ys, 46, 80)
        found += len(got)
    assert found > 50 and R.compare(xs, xs, 46, 80) == plain(xs, xs, 46, 80) and R.compare(xs[:45], xs[:45], 46, 80) == []


def test_edited_passages(documents):
    r = random.Random(3)
    base = [f"p{k}" for k in range(200)]
    rows = [(k, " ".join([f"a{k}x{j}" for j in range(30)] + (edited(base, 3, r) if k else base))) for k in range(8)]
    found = R.repeated_passages(documents(rows)).collect()
    assert {x.doc_id for x in found} | {x.other_id for x in found} == set(range(8))


def test_repeats_of_odd_rows(documents):
    text = " ".join(f"w{k}" for k in range(80))
    assert R.repeated_passages(documents([])).count() == 0
    found = R.repeated_passages(documents([(1, text), (1, text), (None, text), (2, text + " " + text), (3, None)])).collect()
    assert (2, 1) in {(x.doc_id, x.other_id) for x in found} <= {(1, 2), (2, 1)}
    assert R.repeated_passages(documents([(7, text + "\n" + text)])).count() == 0


def boilerplate_pairs(pairs, r, similar):
    """Pairs of passages of 80 words made of four lines that each stand alone in documents before; the second copy has words changed."""
    fresh = lambda n: [f"v{r.randrange(10 ** 9)}" for _ in range(n)]
    rows, n = [], 1000
    for k in range(pairs):
        lines = [fresh(20) for _ in range(4)]
        rows += [(4 * k + j, " ".join(fresh(40) + line + fresh(40))) for j, line in enumerate(lines)]
        passage = sum(lines, [])
        other = passage
        while True:
            other = edited(passage, similar, r)
            a, b = ({tuple(x[j:j + 5]) for j in range(len(x) - 4)} for x in (passage, other))
            if len(a & b) >= 0.8 * len(a | b):
                break
        rows += [(n, " ".join(fresh(25) + passage + fresh(25))), (n + 1, " ".join(fresh(30) + other + fresh(30)))]
        n += 2
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("changes", [1, 2, 3])
def test_recall_of_edited_passages_between_boilerplate(documents, changes):
    """Of passages with edits at a similarity of 0.8 to 0.95, 97 % at least are found."""
    pairs = 120
    rows = boilerplate_pairs(pairs, random.Random(20 + changes), changes)
    found = {(min(x.doc_id, x.other_id), max(x.doc_id, x.other_id)) for x in R.repeated_passages(documents(rows)).collect()}
    caught = sum((1000 + 2 * k, 1001 + 2 * k) in found for k in range(pairs))
    assert caught >= 0.97 * pairs
    assert all(a >= 1000 and b == a + 1 for a, b in found)


def test_rows_of_one_id_with_different_texts(spark, documents):
    """Each text of an id is searched, whatever the order of rows, and cut by its own passages."""
    p, q = ([f"{x}{k}" for k in range(60)] for x in "pq")
    own = lambda x, n=10: [f"{x}o{k}" for k in range(n)]
    rows = [(2, " ".join(own("a") + p)), (2, " ".join(own("b") + q)), (2, "short"), (2, "short"), (5, " ".join(p + own("c"))), (7, " ".join(q + own("d"))),
            (9, " ".join(own("e") + p)), (9, " ".join(p + own("f"))), (11, " ".join(own("g", 80))), (11, " ".join(own("h", 80)))]
    for order in (rows, rows[::-1]):
        found = R.repeated_passages(documents(order))
        got = {frozenset((x.doc_id, x.other_id)) for x in found.collect()}
        # pairs hold the holders of a passage together
        assert got - {frozenset((2, 7))} <= {frozenset(x) for x in ((2, 5), (2, 9), (5, 9))} and frozenset((2, 7)) in got and len(got) >= 3
        held = [(r.doc_id, r.text) for r in R.without_repeats(documents(order), found).collect()]
        # every text stays, a passage in one document only
        assert len(held) == len(rows) and {i for i, _ in held} == {2, 5, 7, 9, 11}
        assert len({i for i, t in held if "p30" in t.split()}) == 1 and len({i for i, t in held if "q30" in t.split()}) == 1
        assert sum(t == "short" for _, t in held) == 2 and sum(i == 11 for i, _ in held) == 2


def test_columns_with_names_of_ours(spark):
    text = " ".join(f"w{k}" for k in range(80))
    rows = [(k, text + f" own{k}", "en", "s", 5, "a", "b", "c", True, "d", 7) for k in range(3)] + [(9, "x" * 9, "en", "s", 9, "a", "b", "c", False, "d", 7)]
    docs = spark.createDataFrame(
        rows, "doc_id long, text string, lang string, source string, n_chars long, cuts string, row string, of string, `known text` boolean, id_ string, text_key long")
    kept = R.without_repeats(docs, R.repeated_passages(docs))
    assert kept.dtypes == docs.dtypes
    got = {r.doc_id: r for r in kept.collect()}
    assert got[0].text == text + " own0" and got[1].text == "own1" and got[1].n_chars == 4 and got[2]["known text"] is True and got[9].cuts == "a"
    for stage in (corpus_pipeline.language_id, corpus_pipeline.near_dedup, corpus_pipeline.substring_dedup):
        assert stage(spark, docs, "/root/testdata/sf0.001").dtypes == docs.dtypes


def test_a_very_long_text_and_many_copies(documents):
    long = " ".join(f"w{k % 9973}x{k // 9973}" for k in range(300_000))
    part = " ".join(long.split()[150_000:150_060])
    rows = [(1, long)] + [(10 + k, f"a{k} {part} b{k}") for k in range(200)]
    found = {(x.doc_id, x.other_id, x.n_words) for x in R.repeated_passages(documents(rows)).where("first").collect()}
    assert found == {(10 + k, 1, 60) for k in range(200)}


def test_nearest_smaller():
    r = random.Random(0)
    for _ in range(50):
        values = np.array(r.sample(range(1000), 30))
        group = np.sort(np.array([r.randrange(3) for _ in values]))
        want = [max((k for k in range(i) if values[k] < v and group[k] == group[i]), default=-1) for i, v in enumerate(values)]
        assert R._nearest_smaller(values, group).tolist() == want


def plain_alignment(a, b):
    h = np.zeros((len(a) + 1, len(b) + 1), int)
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (K.MATCH if a[i - 1] == b[j - 1] else K.MISMATCH), h[i - 1, j] + K.GAP, h[i, j - 1] + K.GAP)
    return h.max()


def test_alignment_equals_the_plain_algorithm():
    r = random.Random(0)
    for _ in range(200):
        a, b = (np.array([r.randrange(6) for _ in range(r.randint(1, n))], np.uint64) for n in (15, 25))
        score, first, last = K.align(a, b)
        assert score == plain_alignment(a, b) and (not score or plain_alignment(a, b[first:last + 1]) == score)


def leak_fixture():
    r = random.Random(5)
    fresh = lambda n: [f"v{r.randrange(300)}" for _ in range(n)]
    items = [(k, " ".join(fresh(n))) for k, n in enumerate([30, 45, 12, 60, 5, 2])] + [(6, None), (7, "  "), (None, "x y z"), (8, None)]
    rows, n = [(0, None), (1, "")], 2
    for k in range(5):
        words = items[k][1].split()
        for edits in (0, 0, len(words) // 10, len(words) // 6):
            rows.append((n, " ".join(fresh(r.randint(0, 80)) + edited(words, edits, r) + fresh(r.randint(0, 80)))))
            n += 1
    rows += [(n + k, " ".join(fresh(150))) for k in range(30)]
    return rows, items


@pytest.mark.parametrize("block", [20, K.ITEM_WORDS])
def test_leaks_equal_brute_force(spark, documents, monkeypatch, block):
    monkeypatch.setattr(K, "ITEM_WORDS", block)
    rows, items = leak_fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.score for r in K.find_leaks(documents(rows), benchmark).collect()}
    want = {}
    for i, t in rows:
        for k, s in items:
            a, b = plain_words(s), plain_words(t)
            if k is not None and a and b and len(a) > 3:
                names = {w: j for j, w in enumerate(set(a) | set(b))}
                share = plain_alignment([names[w] for w in a], [names[w] for w in b]) / (K.MATCH * len(a))
                if share >= 0.6:
                    want[(i, k)] = share
    assert set(want) <= set(got) and all(got[p] == pytest.approx(s) for p, s in want.items()) and len(want) >= 18
    clean = {i for i, _ in rows} - {i for i, _ in got}
    assert {r.doc_id for r in K.without_leaks(documents(rows), spark.createDataFrame([(i,) for i, _ in got], "doc_id long")).collect()} == clean


@pytest.mark.parametrize("hits", [40, K.HITS])
def test_leaks_with_many_words_replaced(spark, documents, monkeypatch, hits):
    """10 to 25 % of the words replaced, beside full copies, and one edited text copied many times, against alignment of every pair."""
    monkeypatch.setattr(K, "HITS", hits)
    r = random.Random(8)
    fresh = lambda n: [f"v{r.randrange(10 ** 6)}" for _ in range(n)]
    items = [(k, fresh(n)) for k, n in enumerate([38] * 6 + [18, 8, 60])]
    texts = [fresh(150) for _ in range(10)]
    for k, words in items:
        for share in (0, 0.1, 0.15, 0.2, 0.25):
            at = set(r.sample(range(len(words)), int(share * len(words))))
            copy = fresh(r.randint(0, 60)) + [fresh(1)[0] if j in at else w for j, w in enumerate(words)] + fresh(r.randint(0, 60))
            texts += [copy] * (30 if k == 3 and share == 0.2 else 1)
    rows = [(n, " ".join(t)) for n, t in enumerate(texts)]
    names = {w: j for j, w in enumerate({w for t in texts for w in t} | {w for _, t in items for w in t})}
    coded = lambda t: np.array([names[w] for w in t])
    want = {(n, k) for n, t in enumerate(texts) for k, words in items if K.align(coded(words), coded(t))[0] >= K.SCORE * K.MATCH * len(words)}
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items], "item_id long, text string")
    assert {(x.doc_id, x.item_id) for x in K.find_leaks(documents(rows), benchmark).collect()} == want and len(want) >= 70


def test_leaks_of_empty_tables(spark, documents):
    items = spark.createDataFrame([(1, "one two three four five")], "item_id long, text string")
    assert K.find_leaks(documents([]), items).count() == 0
    assert K.find_leaks(documents([(1, "x")]), items.limit(0)).count() == 0
    odd = K.find_leaks(documents([(None, "one two three four five"), (2, "ONE two three four five"), (2, "one two three four five")]), items).collect()
    assert sorted((r.doc_id or -1, r.score) for r in odd) == [(-1, 1.0), (2, 1.0), (2, 1.0)]


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu a</a><li><a href="/b">Menu b</a></ul></nav><!-- note --><div class="ad">Buy now.</div>
<article><h1>Head &amp; shoulders</h1><p><b>First</b>   line<br>goes&nbsp;on<p>Second &lt;one&gt;.</article><footer>&copy; us</footer>"""


def test_blocks():
    got = [(b.text, b.path[-1]) for b in blocks_of(PAGE)]
    assert got == [("T", "title"), ("Menu a", "li"), ("Menu b", "li"), ("Buy now.", "div.ad"), ("Head & shoulders", "h1"),
                   ("First line goes on", "p"), ("Second <one>.", "p"), ("© us", "footer")]
    assert blocks_of(None) == blocks_of("") == [] and [b.text for b in blocks_of("a < b <p")][:1] == ["a < b"]
    assert [b.text for b in blocks_of("</div></p>x<table><tr><td>1<td>2")] == ["x", "1", "2"]


def test_gradients():
    rng = np.random.default_rng(1)
    model = L.Labeller(1)
    model.w = {k: v.astype(np.float64) for k, v in model.w.items()}
    x, mask = L.padded([rng.normal(0, 1, (4, L.WIDTH)), rng.normal(0, 1, (2, L.WIDTH))])
    y = rng.integers(0, 2, mask.shape).astype(float)
    loss = lambda: -(np.log(np.where(y == 1, p := model.scores(x, mask), 1 - p)) * mask).sum() / mask.sum()  # noqa: E731,F841
    grad = model.gradients(x, mask, y)
    for name, values in model.w.items():
        at = tuple(rng.integers(0, s) for s in values.shape)
        kept = values[at]
        values[at] = kept + 1e-3
        up = loss()
        values[at] = kept - 1e-3
        down = loss()
        values[at] = kept
        assert grad[name][at] == pytest.approx((up - down) / 2e-3, abs=2e-4)


def test_main_texts_follow_the_markup(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = {r.page_id: r for r in L.extract(pages).collect()}
    same = 0
    for r in pages.collect():
        blocks = blocks_of(r.html)
        same += got[r.page_id].text == "\n".join(b.text for b, y in zip(blocks, L.weak_labels(blocks)) if y)
        assert got[r.page_id].n_chars == len(got[r.page_id].text) and got[r.page_id].url == r.url
    assert same >= 0.98 * len(got)


def test_pages_of_odd_rows(spark):
    model = L.fit([blocks_of(PAGE)] * 8, epochs=30)
    rows = [(1, "u", PAGE), (1, "u", PAGE), (None, None, None), (2, "v", ""), (3, "w", "<p>" + "x " * 200000)]
    got = sorted((r.page_id or -1, r.text, r.n_chars) for r in L.extract(spark.createDataFrame(rows, "page_id long, url string, html string"), model).collect())
    text = "Head & shoulders\nFirst line goes on\nSecond <one>."
    assert got[:4] == [(-1, "", 0), (1, text, len(text)), (1, text, len(text)), (2, "", 0)]
    assert L.extract(spark.createDataFrame([], "page_id long, url string, html string"), model).count() == 0


def test_stages(spark):
    """Each stage against what it must and must not drop, judged on its own input."""
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(folder + "/documents.parquet")
    items = [r.text for r in spark.read.parquet(folder + "/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        out = stage(spark, docs, folder)
        if name != "encoding":
            assert out.dtypes == docs.dtypes
        out = spark.createDataFrame(out.collect(), out.schema)
        rows = {r.doc_id: r for r in out.collect()}
        after = {i: r.text if name != "encoding" else r.decoded for i, r in rows.items()}
        if name == "language_id":
            assert set(after) == {i for i, t in before.items() if t and any(c.isalpha() for c in t)}
        elif name == "near_dedup":
            want = brute_groups(list(before.items()), 5, 80)
            assert set(after) == {i for i, (_, root) in want.items() if root == i}
        elif name == "substring_dedup":
            assert not exact_holders(list(after.items()))
            holders = exact_holders(list(before.items()))
            assert sum(before[i] != after.get(i) for i in before if i not in holders) <= 0.1 * len(before)
        elif name == "decontamination":
            assert set(before) - set(after) >= {i for i, t in before.items() if any(s in t for s in items)}
            assert not any(s in t for s in items for t in after.values())
        else:
            assert after == before and all(r.n_tokens == len(r.ids) for r in rows.values())
        docs = out


def test_pipeline_of_an_empty_table(spark, documents):
    docs = documents([])
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        assert docs.count() == 0


def test_sql_of_the_queries(spark):
    import duckdb
    from haulmark.llm.queries import QUERIES, SQL
    folder = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for table in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    for name, sql in SQL.items():
        got = sorted(map(tuple, QUERIES[name](spark, folder).collect()))
        assert got == sorted(con.execute(sql).fetchall())


def test_every_edited_passage_is_found(documents):
    """Pairs of passages with one word changed, wherever it is, that have nothing else in common: none is left to chance."""
    r = random.Random(6)
    fresh = lambda n: [f"v{r.randrange(10 ** 9)}" for _ in range(n)]
    rows = []
    for k in range(2000):
        p, j = fresh(50), r.randrange(20, 30)
        rows += [(2 * k, " ".join(fresh(20) + p + fresh(20))), (2 * k + 1, " ".join(fresh(30) + p[:j] + fresh(1) + p[j + 1:] + fresh(10)))]
    found = {(x.doc_id, x.other_id) for x in R.repeated_passages(documents(rows)).collect()}
    assert {tuple(sorted(x)) for x in found} == {(2 * k, 2 * k + 1) for k in range(2000)}


def test_a_passage_links_only_the_stretches_that_it_holds():
    """A token at the end of a known passage was chosen for stretches behind it too, which it doesn't link."""
    text = " ".join(f"w{k}" for k in range(300))
    known = [{"first_word": 0, "n_words": 90, "other_id": 3, "links": 9, "first": False}]
    batch = pa.RecordBatch.from_pylist([{"doc_id": 7, "text": text, "spans": list(range(20)), "known": known, "own": 2}])
    every = SimpleNamespace(value=np.full(1 << R.SLOT_BITS - 3, 255, np.uint8))
    rows = [x for b in R._places(50, 80, every)(iter([batch])) for x in b.to_pylist()]
    linked = {tuple(x["linked"]) for x in rows if x["p"] < 40}
    behind = [x for x in rows if 60 <= x["p"] < 86 and x["linked"] == [7]]
    assert (3, 7) in linked and behind and all(x["linked"] == [7] for x in rows if x["p"] >= 86)


def test_documents_with_common_pieces_are_not_all_compared(documents, monkeypatch):
    """Texts of words said over and over, in any order, and of a common passage after a common line, are no match beyond what is known: few pairs are compared."""
    r = random.Random(12)
    fresh = lambda n: [f"v{r.randrange(10 ** 9)}" for _ in range(n)]
    said, line, passage = fresh(30), fresh(13), fresh(60)
    rows = [(k, " ".join(sum(([w] * r.randint(20, 30) for w in r.sample(said, 7)), []))) for k in range(80)]
    rows += [(100 + k, " ".join(fresh(60) + (line if k % 4 == 0 else []) + passage + fresh(60))) for k in range(80)]
    compared, count = R._compared, []
    monkeypatch.setattr(R, "_compared", lambda pairs, *x: count.append(pairs.count()) or compared(pairs, *x))
    found = R.repeated_passages(documents(rows)).collect()
    assert {x.doc_id for x in found} | {x.other_id for x in found} >= exact_holders(rows)
    assert len(count) == 2 and count[1] <= 400, count


def test_numbers_of_tokens():
    r = np.random.default_rng(2)
    for wide in (50, 1 << 17, 1 << 31):
        tokens = r.integers(-wide, wide, 3000).astype(np.int32)
        got = R._numbers(tokens)
        assert got.max() < 2 * len(tokens) and np.array_equal(np.unique(got, return_index=True)[1].size, np.unique(tokens).size)
        assert all(len(set(tokens[got == n].tolist())) == 1 for n in np.unique(got)[:200])
