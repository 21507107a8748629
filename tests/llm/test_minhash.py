import random

import numpy as np
import pytest

from tests.llm.cases import documents, empty, odd_rows, prose, words
from tidemark.llm import minhash
from tidemark.llm.common import forest

_LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text, n=5):
    w = words((text or "").translate(_LOWER))
    return frozenset(" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def brute(rows, percent=85):
    """(doc_id, size, component, kept) of each row, from all pairs."""
    sets = [shingles(r[1]) for r in rows]
    name = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = name[i], name[j]
                if a != b:
                    name = [min(a, b) if x in (a, b) else x for x in name]
    least = {}
    for n, r in zip(name, rows, strict=True):
        least[n] = min(filter(lambda x: x is not None, (least.get(n), r[0])), default=None)
    return sorted(((r[0], len(s), least[n], r[0] == least[n]) for r, s, n in zip(rows, sets, name, strict=True)), key=str)


def found(df):
    assert df.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    return sorted((tuple(r) for r in df.collect()), key=str)


def changed(rng, text, n):
    w = words(text)
    for _ in range(n):
        w[rng.randrange(len(w))] = f"changed{rng.random()}"
    return " ".join(w)


def test_groups_of_near_copies_against_brute_force(spark):
    rng = random.Random(3)
    texts = [changed(rng, prose(i % 12, rng.choice([6, 9, 40, 150, 400])), rng.choice([0, 0, 1, 1, 2, 3, 8])) for i in range(300)]
    texts += [prose(500 + i, n) for i, n in enumerate([1, 2, 3, 4, 5, 6] * 4)] + ["one two three", "One  two\tTHREE", "one two"]
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)] + odd_rows()
    assert found(minhash.near_duplicates(documents(spark, rows))) == brute(rows)


def test_large_group_in_several_cells(spark, monkeypatch):
    """Most of the group is linked over its centre, the rest only with each other or nothing."""
    monkeypatch.setattr(minhash, "CELL_BYTES", 40_000)
    rng = random.Random(5)
    base = prose(77, 150)
    rows = [(i, changed(rng, base, rng.choice([0, 1, 1, 2, 3, 4, 5, 9])), "en", "s", 0) for i in range(400)]
    other = changed(rng, base, 6)
    rows += [(1000 + i, changed(rng, other, 1), "en", "s", 0) for i in range(40)]
    assert found(minhash.near_duplicates(documents(spark, rows, extra=False))) == brute(rows)


def test_hot_copies_and_wordless_rows(spark):
    copy = prose(8, 60)
    rows = [(i, copy, "en", "s", 0) for i in range(500)] + [(i, " ", "en", "s", 0) for i in range(500, 800)] + [(None, copy, "en", "s", 0)] * 50
    got = found(minhash.near_duplicates(documents(spark, rows, extra=False)))
    assert got == sorted(((i, 56, 0, i == 0) if t == copy else (i, 0, i, True) for i, t, *_ in rows), key=str)


def test_exact_threshold(spark):
    """17 of 20 shingles in common, and 16 of 21."""
    w = [f"w{i}" for i in range(100)]
    a = w[:22]  # 18 shingles
    rows = [(1, " ".join(a)), (2, " ".join(a[:21] + ["x", "y"])), (3, " ".join(a[:20] + ["p", "q", "r"]))]
    rows = [(*r, "en", "s", 0) for r in rows]
    assert 100 * len(shingles(rows[0][1]) & shingles(rows[1][1])) == 85 * len(shingles(rows[0][1]) | shingles(rows[1][1]))
    assert found(minhash.near_duplicates(documents(spark, rows))) == brute(rows)


def test_other_parameters(spark):
    rng = random.Random(6)
    rows = [(i, changed(rng, prose(i % 5, 60), rng.choice([0, 1, 2])), "en", "s", 0) for i in range(60)]
    got = found(minhash.near_duplicates(documents(spark, rows), shingle=5, percent=90))
    assert got == brute(rows, 90)


def test_empty_table(spark):
    assert minhash.near_duplicates(empty(spark)).collect() == []


def hashes(rng, n):
    return np.unique(rng.integers(0, 2**64, n, dtype=np.uint64))


def test_registers_of_each_bucket():
    rng = np.random.default_rng(1)
    for n in (1, 3, 100, 5000):
        s = hashes(rng, n)
        got = minhash.sketch(s)
        for b in range(minhash.BUCKETS):
            own = [int(x) & (2**57 - 1) for x in s if int(x) >> 57 == b]
            if not own:
                assert got[b] == 0
                continue
            value = min(own) >> 4
            zeros = 53 - value.bit_length()
            assert got[b] == (zeros + 1) << 10 | ((value << zeros) >> 42) & 1023


@pytest.mark.parametrize("n", [6, 13, 60, 900, 20_000])
def test_linked_sets_share_bands_and_pass_the_estimate(n):
    rng = np.random.default_rng(n)
    missed = 0
    for _ in range(60):
        union = rng.permutation(hashes(rng, n))
        common = -(-85 * len(union) // 100)
        own = (len(union) - common) // 2
        a = np.sort(union[: len(union) - own])
        b = np.sort(np.concatenate([union[:common], union[len(union) - own :]])) if own else np.sort(union[:common])
        missed += not np.intersect1d(minhash.band_keys(minhash.sketch(a)), minhash.band_keys(minhash.sketch(b))).size
        possible = minhash._possible(minhash.sketch(a), len(a), minhash.sketch(b)[None], np.array([float(len(b))]), 85)
        assert possible.all()
    assert not missed


def test_chance_matches_are_expected():
    """Registers of unrelated sets agree as often as computed."""
    rng = np.random.default_rng(2)
    n, trials = 2000, 400
    equal = sum(int((minhash.sketch(hashes(rng, n)) == minhash.sketch(hashes(rng, n))).sum()) for _ in range(trials))
    want = minhash.chance_of_match(n) * minhash.BUCKETS * trials
    assert 0.5 * want < equal < 2 * want


def test_verified_links_are_a_forest():
    rng = np.random.default_rng(4)
    base = hashes(rng, 300)
    sets = [np.sort(np.concatenate([base[:290], hashes(rng, 5)])) for _ in range(30)] + [hashes(rng, 300) for _ in range(5)]
    items = [(i, i, s) for i, s in enumerate(sets)]
    links = minhash.verified(items, items)
    assert len(links) == 29 and {forest(iter(links))[i] for i in range(30)} == {0}
