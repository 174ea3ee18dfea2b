"""Python workers outlive tasks: what they hold of earlier batches stays beside the executor's heap."""

import re
import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest

from paneloom.llm import common, near_dedup, toxicity


def _own_mb() -> float:
    found = re.findall(r"\nAnonymous:\s+(\d+)", Path("/proc/self/smaps_rollup").read_text())
    return sum(map(int, found)) / 1024


@pytest.mark.skipif(not common._trim(), reason="another C library")
def test_free_memory_goes_back():
    rows = [bytes(600) for _ in range(300_000)]
    last = rows[-1]  # what lies above the free memory
    del rows
    held = _own_mb()
    common.give_back()
    assert len(last) == 600
    assert _own_mb() < held - 100


def test_each_batch_gives_memory_back(monkeypatch):
    calls = []
    monkeypatch.setattr(common, "give_back", lambda: calls.append(1))
    batches = [
        pa.RecordBatch.from_arrays([pa.array([b"k"]), pa.array([f"one two {n}"])], names=["node", "text"])
        for n in range(3)
    ]
    texts = [b.select(["text"]) for b in batches]
    assert sum(b.num_rows for b in near_dedup._count(lambda h, c, _: (h, c))(iter(texts)))
    assert len(calls) == 3

    class Shared:
        value = near_dedup.Weights(3, np.zeros(0, np.uint64), np.zeros(0))

    assert len(list(near_dedup._signatures(Shared)(iter(batches)))) == 3
    assert len(calls) == 6


def test_training_rows_are_not_joined():
    """Counting the terms of the sample takes no second copy of it."""
    rows = [np.arange(n, n + 20_000, dtype=np.int32) % (1 << toxicity.BITS) for n in range(0, 10**6, 5000)]
    tracemalloc.start()
    toxicity.FactorizationMachine.fit(rows, np.zeros(len(rows)))
    _, peak = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert peak < sum(r.nbytes for r in rows)


def test_operators_leave_no_caches_to_each_other(spark):
    """A worker that scored texts holds no words, and the next operator drops what another has kept."""
    docs = spark.createDataFrame([(1, "some words here"), (2, "more words")], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.score_documents(docs, labels).count() == 2

    def held(batches):
        from paneloom.llm import common

        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([len(common.CACHES.get("slots", ()))])], names=["n"])

    left = docs.coalesce(1).mapInArrow(held, "n long").collect()
    assert left and not any(row.n for row in left)
    common.CACHES["other"] = {1: 1}
    try:
        toxicity.terms("word")
        assert list(common.lean(iter([1, 2]), "slots")) == [1, 2]
        assert toxicity._SLOTS and not common.CACHES["other"]
        assert list(common.lean(iter([]))) == [] and not toxicity._SLOTS
    finally:
        del common.CACHES["other"]


def test_slots_of_words():
    found = toxicity.terms("Shorter words, longer WORDS")
    assert len(found) == len({"shorter", "shor*", "short*", "shorte*", "words", "word*", "longer", "long*", "longe*"})
    assert list(found) == sorted(set(found))
    assert len(toxicity.terms("")) == len(toxicity.terms(None)) == len(toxicity.terms("...")) == 0
