import random

import numpy as np
import xxhash

from tests.llm.cases import documents, empty, odd_rows, prose, words
from tidemark.llm import common, simhash
from tidemark.llm.common import components

_LOWER = {c: c + 32 for c in range(65, 91)}


def slow_fingerprint(text):
    w = words((text or "").translate(_LOWER))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, prints, bits=3):
    name = list(range(len(ids)))
    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = name[i], name[j]
                name = [min(a, b) if x in (a, b) else x for x in name]
    least = {}
    for n, i in zip(name, ids, strict=True):
        least[n] = min(filter(lambda x: x is not None, (least.get(n), i)), default=None)
    return [least[n] for n in name]


def test_whole_documents_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for i in range(120):
        base = words(prose(i % 40, 150))
        for _ in range(rng.choice([0, 0, 1, 3])):
            base[rng.randrange(len(base))] = "Changed"
        rows.append((i, " ".join(base), "en", "s", 0))
    rows += odd_rows()
    got = simhash.near_duplicates(documents(spark, rows)).collect()
    prints = [slow_fingerprint(r[1]) for r in rows]
    want = zip([r[0] for r in rows], prints, slow_components([r[0] for r in rows], prints), strict=True)
    assert sorted(((r["doc_id"], r["fp"] % 2**64, r["component_id"]) for r in got), key=str) == sorted(want, key=str)


def test_links_against_brute_force(spark):
    rng = random.Random(9)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints):
        for n in (1, 2, 3, 4):
            q = p
            for b in rng.sample(range(64), n):
                q ^= 1 << b
            prints.add(q)
    signed = [p - 2**64 if p >= 2**63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    for bits in (0, 2, 3):
        got = {frozenset((r["a"], r["b"])) for r in simhash.links(df, bits).collect()}
        want = {frozenset((a, b)) for a in signed for b in signed if a < b and ((a ^ b) & (2**64 - 1)).bit_count() <= bits}
        assert got == want


def test_no_broadcast_by_a_size_taken_too_low(spark, monkeypatch, plan):
    made, real = {}, common.written

    def seen(df, name):
        made.setdefault(name, plan(df))
        return real(df, name)

    monkeypatch.setattr(common, "written", seen)
    found = simhash.near_duplicates(documents(spark))
    assert "SortMergeJoin [cell#" in made["links"] and "BroadcastHashJoin" not in made["links"]
    assert "SortMergeJoin [fp#" in plan(found) and "BroadcastHashJoin [fp#" not in plan(found)


def test_long_chain_is_one_component(spark):
    n = 300
    order = np.random.default_rng(1).permutation(n).tolist()
    links = spark.createDataFrame([(order[i], order[i + 1]) for i in range(n - 1)] + [(1000, 1001), (5, 5)], "x long, y long").repartition(20)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(1, n), 0), 1001: 1000}


def test_keep_one(spark):
    got = simhash.keep_one(documents(spark))
    assert got.columns == documents(spark).columns
    kept = sorted(str(r["doc_id"]) for r in got.select("doc_id").collect())
    assert kept == ["1", "10", "11", "4", "5", "8", "9", "None"] or set(kept) >= {"1", "4", "5", "8", "9", "10", "11"} and "6" not in kept


def test_empty_table(spark):
    assert simhash.near_duplicates(empty(spark)).collect() == []
    assert simhash.keep_one(empty(spark)).collect() == []


def test_keep_one_by_row(spark):
    one, two, three = (prose(s, 80) for s in (21, 22, 23))
    rows = [(1, one), (1, two), (2, two), (3, one), (7, three), (7, three), (7, three + " "), (8, three), (9, one), (9, prose(24, 80)), (None, two)]
    got = simhash.keep_one(documents(spark, [(i, t, "en", "s", 0) for i, t in rows])).collect()
    assert sorted((r["doc_id"], r["text"].strip()) for r in got) == sorted([(1, one), (1, two), (7, three), (9, prose(24, 80))])


def test_keep_one_against_brute_force_with_and_without_a_broadcast(spark, monkeypatch):
    rng = random.Random(17)
    rows = list(odd_rows())
    for i in range(120):
        base = prose(200 + i % 30, 60).split()
        if rng.random() < 0.4:
            base[rng.randrange(60)] = "Changed"
        rows.append((rng.choice([None, *range(40, 90)]), " ".join(base), "en", rng.choice("ab"), i % 2))
    rows += rng.sample(rows, 20)
    prints = [slow_fingerprint(r[1]) for r in rows]
    names = slow_components([r[0] for r in rows], prints)
    docs = documents(spark, rows, extra=False)
    hashes = {r["text"]: r["h"] for r in docs.selectExpr("text", "xxhash64(text) AS h").collect()}
    # Components by their fingerprints: those reached from one another.
    groups = []
    for p in set(prints):
        linked = [g for g in groups if any((p ^ q).bit_count() <= 3 for q in g)]
        groups = [g for g in groups if g not in linked] + [{p}.union(*linked)]
    want = []
    for g in groups:
        members = [(p - 2**64 if p >= 2**63 else p, hashes[r[1]], r[0], r[1]) for r, p, n in zip(rows, prints, names, strict=True) if p in g and r[0] == n]
        want.append(min(members, key=lambda m: m[:2])[2:])
    for limit in (1 << 20, 0):
        monkeypatch.setattr(simhash, "BROADCAST_BYTES", limit)
        got = simhash.keep_one(docs).collect()
        assert sorted(((r["doc_id"], r["text"]) for r in got), key=str) == sorted(want, key=str)
