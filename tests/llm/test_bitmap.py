import tracemalloc

import numpy as np
import pyarrow as pa

from rankspark.llm import bitmap


def batches(values):
    for a in range(0, len(values), 1000):
        yield pa.RecordBatch.from_arrays([pa.array(values[a : a + 1000])], ["value"])


def test_map_of_a_task_with_all_pieces():
    """Few rows may come in one task, which then has every piece; their bits stay packed."""
    rng = np.random.default_rng(3)
    values = np.append(rng.integers(-(2**63), 2**63 - 1, 20_000), [-1, 0, -(2**63), 2**63 - 1])
    values = np.append(values, values[:500])
    out = np.zeros((1 << (bitmap.MAP_BITS - bitmap.PIECE_BITS), 1 << (bitmap.PIECE_BITS - 3)), np.uint8)
    want = np.unique(values.view(np.uint64) >> np.uint64(64 - bitmap.MAP_BITS)).astype(np.int64)
    assert len(list(bitmap._piece_task(batches(values[:1])))) == 1  # pyarrow imports what it needs
    tracemalloc.start()
    try:
        for row in bitmap._piece_task(batches(values)):
            out[row.column(0)[0].as_py()] = np.frombuffer(row.column(1)[0].as_py(), np.uint8)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert np.flatnonzero(np.unpackbits(out.ravel(), bitorder="little")).tolist() == want.tolist()
    assert bitmap.maps(out.tobytes(), values.view(np.uint64)).all()
    # the whole map has 32 MB
    assert most < 48 << 20
    assert list(bitmap._piece_task(batches(values[:0]))) == []


def test_few_values_take_a_small_map(spark):
    """Every worker holds the maps whole, 32 MB each: of few values they are folded."""
    rng = np.random.default_rng(5)
    values = np.append(rng.integers(-(2**63), 2**63 - 1, 5_000), [-1, 0, -(2**63), 2**63 - 1])
    table = spark.createDataFrame([(int(v),) for v in np.append(values, values[:50])], "value long")
    bits = bitmap.value_map(table, "value")
    assert bitmap.maps(bits, values.view(np.uint64)).all()
    assert len(bits) < 64 << 10
    others = rng.integers(-(2**63), 2**63 - 1, 50_000).view(np.uint64)
    assert bitmap.maps(bits, others).mean() < 1.2 / bitmap.SPARSE
    # what is set is what the values set
    n_bits = (8 * len(bits)).bit_length() - 1
    want = np.unique(values.view(np.uint64) >> np.uint64(64 - n_bits)).astype(np.int64)
    assert np.flatnonzero(np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little")).tolist() == want.tolist()
    assert not bitmap.maps(bitmap.value_map(table.limit(0), "value"), values.view(np.uint64)).any()


def test_places_of_a_task(monkeypatch):
    """Few places are held one by one and take little memory; many are put into the packed bits."""
    rng = np.random.default_rng(6)
    values = np.append(rng.integers(-(2**63), 2**63 - 1, 20_000), [-1, 0, -(2**63), 2**63 - 1])
    want = [(r.column(0)[0].as_py(), r.column(1)[0].as_py()) for r in bitmap._piece_task(batches(values))]
    tracemalloc.start()
    try:
        for _ in bitmap._piece_task(batches(values)):
            pass
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 8 << 20
    monkeypatch.setattr(bitmap, "MOST_PLACES", 7_000)
    assert [(r.column(0)[0].as_py(), r.column(1)[0].as_py()) for r in bitmap._piece_task(batches(values))] == want
