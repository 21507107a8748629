"""What a Python worker holds while it handles a batch, and what it keeps afterwards."""

from __future__ import annotations

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import common, minhash, substrings

N, WORDS = 4_000, 500


@pytest.fixture(scope="module")
def texts() -> list[str]:
    rng = np.random.default_rng(3)
    words = np.array([f"w{i:04d}" for i in range(5_000)])
    return [" ".join(words[rng.integers(0, len(words), WORDS)]) for _ in range(N)]


def batch_of(texts: list[str]) -> pa.RecordBatch:
    ids = pa.array(range(len(texts)), pa.int64())
    return pa.record_batch({"key": ids, "doc_id": ids, "text": pa.array(texts, pa.string())})


def peak_mb(results) -> float:
    """Of numpy and Python; what is yielded is dropped, as when it is sent on."""
    tracemalloc.start()
    try:
        for _ in results:
            pass
        return tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_worker_holds_little_beside_its_batch(texts):
    batch = batch_of(texts)  # 12 MB of text
    assert peak_mb(substrings._packed(iter([batch]))) < 80
    assert peak_mb(substrings._repeated_anchors(iter([batch.select(["key", "text"])]))) < 100


def test_freed_memory_is_handed_back_with_each_batch(texts, monkeypatch):
    calls = []
    monkeypatch.setattr(common, "hand_back", lambda: calls.append(1))
    batch = batch_of(texts[:10])
    assert sum(len(p) for p in common.pieces(iter([batch, batch, batch]), 2)) == 30
    assert len(calls) == 4  # what earlier tasks left, too


def test_sets_of_a_cell_come_piece_by_piece(texts, monkeypatch):
    sizes = []

    def seen(batches, column, *rest, **more):
        for piece in common.pieces(batches, column, *rest, most=1_000, **more):
            sizes.append(piece.num_rows)
            yield piece

    monkeypatch.setattr(minhash, "pieces", seen)
    shingles = list(minhash.shingle_sets([texts[0].encode()] * 6))
    rows = pa.record_batch(
        {
            "g": pa.array([1] * 6),
            "i": pa.array([0] * 6),
            "j": pa.array([0] * 6),
            "is_left": pa.array([True] + [False] * 5),
            "is_right": pa.array([False] + [True] * 5),
            "id": pa.array(range(6), pa.int64()),
            "component": pa.array(range(6), pa.int64()),
            "shingles": pa.array([s.tobytes() for s in shingles]),
        }
    )
    links = [row for b in minhash._cells(85)(iter([rows])) for row in b.to_pylist()]
    assert sizes == [1] * 6
    assert {link["a"] for link in links} == {1, 2, 3, 4, 5} and {link["b"] for link in links} == {0}


def test_texts_without_repeats_take_no_part_in_the_pieces_of_a_result():
    pack = substrings.zstandard.ZstdCompressor(write_content_size=True)
    rows = pa.record_batch(
        {
            "doc_id": pa.array([1, 2], pa.int64()),
            "n_words": pa.array([1, 21], pa.int64()),
            "digest": pa.array(["x", "y"]),
            "z": pa.array([None, pack.compress(b" ".join([b"w"] * 21))], pa.binary()),
            "spans": pa.array([None, [(1 << 32) | 1]], pa.list_(pa.int64())),
        }
    )
    assert [r["n_removed"] for b in substrings._result(iter([rows])) for r in b.to_pylist()] == [0, 20]
