import numpy as np
import pytest

from tests.llm.cases import documents, empty, odd_rows, prose, words
from tidemark.llm import mixing


def test_targets_share_the_excess_by_weight():
    got = mixing.targets([100, 10, 10, 0, 50])
    assert got == pytest.approx([161.25, 20, 20, 0, 53.75])
    assert sum(got) == pytest.approx(1.5 * 170)
    assert mixing.targets([]) == [] and mixing.targets([0, 0]) == [0.0, 0.0]


@pytest.mark.parametrize("n", [1, 2, 3, 17, 64, 1000])
def test_permutation_is_a_bijection(n):
    key = np.full(n, 99, np.uint64)
    got = mixing.permuted(np.arange(n), np.full(n, n), key)
    assert sorted(got) == list(range(n))
    assert [mixing._place_of(int(b), n, 99) for b in got] == list(range(n))


def test_every_row_is_mixed_and_sources_meet_their_targets(spark):
    rows = [(i, prose(i, 1 + i % 400), "en", f"s{min(i % 7, 3)}", 0) for i in range(300)]
    got = mixing.taken(documents(spark, rows), block_words=16).collect()
    assert len(got) == 300
    by = {}
    for r in got:
        assert r["size"] == len(words(rows[r["doc_id"]][1])) and 0 <= r["taken"] <= 2 * r["size"]
        s = by.setdefault(r["source"], [r["source_size"], r["target"], 0, 0])
        s[2] += r["taken"]
        s[3] += r["size"]
    for size, target, taken, total in by.values():
        assert size == total and abs(taken - target) <= 1
    again = mixing.taken(documents(spark, rows).repartition(7), block_words=16).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_blocks_hold_the_words_of_their_documents(spark):
    rows = [(i, " ".join(f"d{i}w{j}" for j in range(40 + i)), "en", "ab"[i % 2], 0) for i in range(12)]
    pieces = mixing.mix(documents(spark, rows), block_words=32, shards=3).where("taken > 0").collect()
    texts = {(r["shard"], r["slot"]): words(r["text"]) for r in mixing.blocks(documents(spark, rows), block_words=32, shards=3).collect()}
    size = {}
    for p in pieces:
        at = p["shard"], p["slot"]
        size[at] = size.get(at, 0) + p["taken"]
        own = words(rows[p["doc_id"]][1])[p["first"] : p["first"] + p["taken"]]
        assert " ".join(own) in " ".join(texts[at])
    assert {k: len(v) for k, v in texts.items()} == size
    assert {s for s, _ in size} == {0, 1, 2} and max(size.values()) == 32


def test_odd_rows(spark):
    got = mixing.taken(documents(spark)).collect()
    assert sorted((str(r["doc_id"]), r["size"]) for r in got) == sorted((str(i), len(words(t))) for i, t, *_ in odd_rows())
    assert all(r["taken"] == 0 for r in got if not r["size"])
    by_source = {r["source"]: (r["source_size"], r["target"]) for r in got}
    sizes = [by_source[s][0] for s in ("a", "b", "c", "ä", None)]
    assert [by_source[s][1] for s in ("a", "b", "c", "ä", None)] == pytest.approx(mixing.targets(sizes))


def test_empty_table(spark):
    assert mixing.taken(empty(spark)).collect() == []


def test_rows_alike_spread_over_the_bins(spark):
    """Null ids and repeated rows of one size are dealt like others, and reruns agree."""
    rows = [(None, prose(i % 700, 20), "en", "a", 0) for i in range(3000)] + [(5, prose(1, 20), "en", "a", 0)] * 3000
    docs = documents(spark, rows, extra=False)
    bins = mixing.mix(docs).groupBy("bin").count().collect()
    assert len(bins) > 50 and max(r["count"] for r in bins) < 400
    once, again = (sorted(map(str, mixing.taken(d).collect())) for d in (docs, docs.repartition(7)))
    assert once == again
    one, two = (sorted(map(str, mixing.blocks(d).collect())) for d in (docs, docs.repartition(5)))
    assert one == two
