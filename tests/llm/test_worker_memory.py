"""What a worker holds while a batch passes: parts of it, however many rows Spark puts into one."""

import gc
import tracemalloc
import weakref

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import types as T

from linkrank.llm import bpe, jaccard, langid
from linkrank.llm.text import stretches

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
TEXT = "the quick brown fox jumps over a lazy dog and more words follow here "
ROWS, REPEATS = 2_000, 150
MB = 1 << 20


class Value:
    def __init__(self, value):
        self.value = value


class Docs:
    """Stands for a table: returns the function that would run in the workers."""

    columns = ["text"]
    schema = T.StructType([])

    def select(self, *names):
        return self

    drop = select
    sparkSession = sparkContext = property(lambda self: self)
    broadcast = staticmethod(Value)

    def mapInArrow(self, run, schema):
        return run


def batch(rows: int) -> pa.RecordBatch:
    texts = [f"{k} {TEXT * REPEATS}" for k in range(rows)]
    ids, bodies = pa.array(range(rows), pa.int64()), pa.array(texts, pa.binary())
    columns = {"doc_id": ids, "key": ids, "node": ids, "a": ids, "b": ids, "text": pa.array(texts)}
    columns |= {"body": bodies, "text_a": bodies, "text_b": bodies}
    return pa.RecordBatch.from_pydict(columns)


def step(name: str):
    rule, levels = jaccard.Similarity(5, 80), np.zeros(1 << jaccard.SKETCH_BITS, np.uint16)
    if name == "identify":
        return langid.identify(Docs(), langid.fit({"en": [TEXT], "de": ["der schnelle braune Fuchs"]}))
    if name == "sets":
        return jaccard.document_sets(Docs(), rule)
    if name == "prefixes":
        return jaccard.class_prefixes(Docs(), levels, rule)
    if name == "orders":
        return jaccard.other_orders(Docs(), levels, rule)
    if name == "links":
        return jaccard._links(Docs(), rule)
    return bpe.bpe_ids(Docs(), RANKS, public_tokenizers.PATTERN)


@pytest.mark.parametrize("name", ["identify", "sets", "prefixes", "orders", "links", "tokens"])
def test_no_step_turns_a_whole_batch_into_values(name):
    run, whole = step(name), batch(ROWS)
    if name == "identify":
        whole = whole.select(["text"])
    size = ROWS * REPEATS * len(TEXT)
    if name != "sets":  # its sketch is made anew each time
        list(run(iter([whole.slice(0, 2)])))
    tracemalloc.start()
    try:
        rows = 0
        for out in run(iter([whole])):
            rows += sum(x is not None for x in out.column(0).to_pylist())
            assert out.nbytes <= 5 * MB  # the sketch, in one piece, is 4 MB
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == ROWS
    # The sketch and its blocks; numbers by character, some 50 bytes for each one of a part.
    limit = {"sets": 34, "identify": 16}.get(name, 10) * MB
    assert size > 18 * MB and peak < limit, (peak, limit)


@pytest.mark.parametrize("most", [1, 5, 1000])
def test_stretches_are_all_rows_in_turn(most):
    texts = ["", "a", None, "bb" * 4, "", "c" * 3, "dé", None]
    rows = pa.RecordBatch.from_pydict({"x": pa.array(texts), "y": pa.array([b"z", *[None] * 7])}).slice(1)
    for names in (["x"], ["x", "y"]):
        parts = list(stretches(rows, *names, most=most))
        assert [t for p in parts for t in p.column("x").to_pylist()] == texts[1:]
        sizes = [sum(len((t or "").encode()) for t in p.column("x").to_pylist()) for p in parts]
        assert all(s <= most or p.num_rows == 1 for s, p in zip(sizes, parts))
    assert list(stretches(rows.slice(0, 0), "x")) == []


def test_codec_serves_a_call_and_goes_with_it(monkeypatch):
    made = []

    class Seen(bpe.Codec):
        def __init__(self, *args):
            super().__init__(*args)
            made.append(weakref.ref(self))

    monkeypatch.setattr(bpe, "Codec", Seen)
    run = step("tokens")
    for _ in range(2):
        list(run(iter([batch(2)])))
    assert len(made) == 1 and made[0]() is not None
    del run
    gc.collect()
    assert made[0]() is None
