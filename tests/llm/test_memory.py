"""Workers stay, so what a task took goes back, and what it holds at once is small beside its texts."""

import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa

from haulmark.llm import common, langid, repeats as R


def test_memory_goes_back_before_and_after_the_batches(monkeypatch):
    seen = []
    monkeypatch.setattr(common, "give_back", lambda: seen.append("back"))
    batch = pa.RecordBatch.from_arrays([pa.array([1])], names=["x"])
    for b in common.each([batch, batch.slice(0, 0), batch]):
        seen.append(b.num_rows)
    assert seen == ["back", 1, 1, "back"]


def test_language_id_holds_little_at_once():
    model = langid.Model(["a", "b"], np.zeros((langid.FEATURES, 2), np.float32), np.zeros(2))
    texts = pa.array(["some words of a text " * 100] * 2000)
    row = pa.StructArray.from_arrays([pa.array(range(2000)), texts], names=["doc_id", "text"])
    batch = pa.RecordBatch.from_arrays([row, pa.array([True] * 2000)], names=["row", "letter"])
    tracemalloc.start()
    kept = list(langid._accept(SimpleNamespace(value=model), 0.5)(iter([batch.slice(1)])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sum(b.num_rows for b in kept) == 1999 and kept[0].column("row").field("doc_id")[0].as_py() == 1
    assert peak < 60 << 20, peak


def test_rows_are_chosen_by_id_without_python(documents):
    rows = common.id_text(documents([(i, f"t{i}") for i in (*range(-70, 70), common.SLOTS + 3, 1 << 62)] + [(None, "x")]))
    ids = rows.sparkSession.createDataFrame([(i,) for i in (-64, -1, 0, 3, 62, 63, 1 << 62, None)], "doc_id long")
    found = common.likely(rows, ids)
    assert sorted(r.doc_id for r in found.collect()) == [-64, -1, 0, 3, 62, 63, common.SLOTS + 3, 1 << 62]
    assert all(r.text == f"t{r.doc_id}" for r in found.collect())
    assert "InArrow" not in found._jdf.queryExecution().toString()
    assert common.likely(rows, ids.limit(0)).count() == 0


def test_batches_are_small_inside_only(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    sizes = lambda: {r.n for r in spark.range(0, 95, 1, 1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()}
    before = spark.conf.get(name, None)
    with common.batches_of(spark, 10):
        assert sizes() == {10, 5}
    assert spark.conf.get(name, None) == before and sizes() == {95}


def test_passages_are_looked_for_in_small_batches(documents, monkeypatch):
    monkeypatch.setattr(R, "ROWS", 4)
    seen = []
    flags = R._flags

    def spied(texts, keys_of):
        seen.append(max(r.n for r in texts.coalesce(1).mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in bs), "n long").collect()))
        return flags(texts, keys_of)
    monkeypatch.setattr(R, "_flags", spied)
    text = " ".join(f"w{k}" for k in range(60))
    assert {x.doc_id for x in R.repeated_passages(documents([(k, text) for k in range(30)])).collect()} == set(range(1, 30))
    assert seen and max(seen) <= 4


def test_flags_on_the_driver(documents):
    """All flags are 16 MB; the driver has them once, as bits."""
    text = " ".join(f"w{k}" for k in range(5000))
    texts = common.id_text(documents([(1, text), (2, "x " + text), (3, " ".join(f"z{k}" for k in range(3000)))]))
    tracemalloc.start()
    flags = R._flags(texts, R._run_keys(50))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    keys = np.concatenate([k[0] for k in R._keyed(pa.array([text, "x " + text]), 50)])
    unique, count = np.unique(keys, return_counts=True)
    slots = np.unique(unique[count > 1] >> np.uint64(64 - R.SLOT_BITS))
    assert np.array_equal(np.flatnonzero(np.unpackbits(flags)), slots)
    assert peak < 64 << 20, peak
