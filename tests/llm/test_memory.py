"""Memory that operators leave in Python workers."""

from __future__ import annotations

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import pytest

from meterlake.llm import shared, token_store


@pytest.fixture
def given_back(monkeypatch):
    """Owners whose tables were still held each time memory was handed back."""
    seen = []
    monkeypatch.setattr(shared, "_KEPT", {})
    monkeypatch.setattr(shared, "give_back", lambda: seen.append(sorted(k[0] for k in shared._KEPT)))
    return seen


def test_dropped_tables_are_handed_back(given_back):
    """The next operator gives the memory of another one's tables back, even if it keeps none itself."""
    table = shared.kept("encode", "a", lambda key: [key])
    del given_back[:]
    shared.forget("encode")
    assert shared.kept("encode", "a", lambda key: [key]) is table and given_back == []
    shared.forget(None)
    assert given_back == [[]]
    shared.forget(None)
    assert given_back == [[]]


def test_end_of_a_task_trims(spark, tmp_path):
    """A worker that only ran batches hands their memory back when its task ends."""
    mark = str(tmp_path / "trimmed")

    def run(batches):
        real = shared._malloc_trim

        def once():
            shared._malloc_trim = real
            with open(mark, "a") as f:
                f.write("x")
        shared._malloc_trim = once
        yield from batches
    rows = spark.range(10, numPartitions=1)
    assert shared.by_batch(rows, run, "id bigint").count() == 10
    assert open(mark).read() == "x"


def test_give_back_runs():
    shared.give_back()
    shared.trim()


def test_digest_does_not_copy_the_ids_of_a_batch():
    """Parts of a batch share its ids; reading one small part allocates little."""
    n = 1000
    ids = np.arange(n * n, dtype=np.int32)
    lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * n + 1, n, dtype=np.int32)), pa.array(ids))
    batch = pa.record_batch([pa.array(range(n)), lists, pa.array(range(n))], names=["doc_id", "ids", "row_id"])
    tracemalloc.start()
    got = list(token_store._digest_rows(batch.slice(at, 10) for at in range(0, n, 10)))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    crc = [x for b in got for x in b.column("ids_crc32").to_pylist()]
    assert crc == [zlib.crc32(ids[at:at + n].tobytes()) for at in range(0, n * n, n)]
    assert most < 1 << 20
