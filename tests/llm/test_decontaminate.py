import random

import numpy as np

from tests.llm.cases import documents, empty, odd_rows, prose
from tidemark.llm import decontaminate as d

ITEMS = "item_id long, text string"


def slow_tiles(a, b, least):
    free_a, free_b, total = [True] * len(a), [True] * len(b), 0
    while True:
        longest, best = least - 1, []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and free_a[i + n] and free_b[j + n] and a[i + n] == b[j + n]:
                    n += 1
                if n > longest:
                    longest, best = n, [(i, j)]
                elif n == longest and n >= least:
                    best.append((i, j))
        if longest < least:
            return total
        for i, j in best:
            if all(free_a[i : i + longest]) and all(free_b[j : j + longest]):
                free_a[i : i + longest] = free_b[j : j + longest] = [False] * longest
                total += longest


def test_tiles_against_brute_force():
    rng = random.Random(3)
    for _ in range(500):
        a = [rng.randint(0, 2) for _ in range(rng.randint(1, 25))]
        b = [rng.randint(0, 2) for _ in range(rng.randint(1, 15))]
        assert sum(n for _, _, n in d.tile(np.array(a), np.array(b), 3)) == slow_tiles(a, b, 3)


def unique(prefix, n):
    return [f"{prefix}{i}" for i in range(n)]


def test_whole_reordered_and_partial_passages(spark):
    item = unique("q", 40)
    other = prose(1, 200)
    rows = [
        (1, f"{other} {' '.join(item)} {other}"),
        (2, f"{' '.join(item[20:])} {other} {' '.join(item[:20])}"),
        (3, f"{other} {' '.join(item[:20])} {other}"),  # half of it
        (4, " ".join(f"{w.upper()}," for w in item)),
        (5, " x ".join(item)),  # every word, but no run
        (6, other),
    ]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    items = spark.createDataFrame([(7, " ".join(item)), (8, "q0 q1"), (9, None), (None, "")], ITEMS).selectExpr("*", "1 AS doc_id")
    got = {(r["doc_id"], r["item_id"]): (r["coverage"], r["tiles"], r["longest"]) for r in d.find(docs, items).collect()}
    assert got == {(1, 7): (1.0, 1, 40), (2, 7): (1.0, 2, 20), (4, 7): (1.0, 1, 40)}
    kept = d.clean(docs, items)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()} == {3, 5, 6}


def test_a_full_filter_finds_the_same(spark):
    texts = [" ".join(unique(f"i{k}w", 12 + k)) for k in range(20)]
    docs = documents(spark, [(k, f"{prose(k, 30)} {texts[k]} {texts[(k * 7) % 20]}", "en", "s", 0) for k in range(20)])
    items = spark.createDataFrame(list(enumerate(texts)), ITEMS)
    whole = sorted(map(tuple, d.find(docs, items).collect()))
    assert whole == sorted(map(tuple, d.find(docs, items, filter_bits=64).collect())) and len(whole) == 38


def test_frequent_words_do_not_match_by_themselves(spark):
    docs = documents(spark, [(1, "same " * 5000, "en", "s", 0), (2, "same " * 30 + "other", "en", "s", 0)])
    items = spark.createDataFrame([(1, "same " * 20), (2, "same " * 6 + " ".join(unique("z", 30)))], ITEMS)
    assert {(r["doc_id"], r["item_id"]) for r in d.find(docs, items).collect()} == {(1, 1), (2, 1)}


def test_odd_rows(spark):
    items = spark.createDataFrame([(5, odd_rows()[4][1]), (5, odd_rows()[4][1])], ITEMS)
    got = sorted(str(r["doc_id"]) for r in d.find(documents(spark), items).collect())
    assert set(got) == {"5", "6", "7"} and got.count("6") == 4
    assert sorted(str(r["doc_id"]) for r in d.clean(documents(spark), items).collect()) == sorted(
        str(r[0]) for r in odd_rows() if r[0] not in (5, 6, 7)
    )
    assert d.find(empty(spark), items).collect() == [] and d.find(documents(spark), empty(spark, ITEMS)).collect() == []


def test_long_runs_and_short_items(spark):
    item, long = unique("q", 59), unique("r", 1000)
    other = prose(1, 200)
    rows = [
        (1, f"{other} {' '.join(item[:29])} {other}"),
        (2, f"{other} {' '.join(long[300:800])} {other}"),
        (3, f"{' '.join(long[:20])} {other} {' '.join(long[40:60])}"),  # no run is long enough
        (4, f"{other} S1, s2 s3! {other} t0 t1 t2 t3"),
        (5, "s1 s2 x s3 s2 s3 t0 t1 t2"),
    ]
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in rows])
    items = spark.createDataFrame([(1, " ".join(item)), (2, " ".join(long)), (3, "s1 s2 s3"), (4, "t0 t1 t2 t3")], ITEMS)
    got = {(r["doc_id"], r["item_id"]): (r["coverage"], r["tiles"], r["longest"]) for r in d.find(docs, items).collect()}
    assert got == {(1, 1): (29 / 59, 1, 29), (2, 2): (0.5, 1, 500), (4, 3): (1.0, 1, 3), (4, 4): (1.0, 1, 4)}
    assert sorted(r["doc_id"] for r in d.clean(docs, items).collect()) == [3, 5]


def test_a_repeated_item_is_compared_once(spark):
    item = " ".join(unique("q", 40))
    items = spark.createDataFrame([*((i, item) for i in range(500)), (None, item), (7, item), (900, "other words " * 10)], ITEMS)
    got = d.find(documents(spark, [(1, item, "en", "s", 0), (1, item, "en", "s", 0)]), items).collect()
    assert len(got) == 2 * 502 and sum(r["item_id"] == 7 for r in got) == 4 and sum(r["item_id"] is None for r in got) == 2
    assert d._items(items, 3).count() == 2


def test_clean_is_the_same_with_and_without_a_broadcast(spark, monkeypatch, plan):
    item = prose(50, 40)
    rows = [(i, item if i % 3 == 0 else prose(100 + i, 60), "en", "s", 0) for i in range(30)] + [(None, item, "en", "s", 0), (None, prose(7, 30), "en", "s", 0)]
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    docs = documents(spark, rows, extra=False)
    few = d.clean(docs, items)
    assert "Broadcast" in plan(few)
    monkeypatch.setattr(d, "BROADCAST_BYTES", 0)
    many = d.clean(docs, items)
    kept = [sorted(r["doc_id"] for r in kept.collect()) for kept in (few, many)]
    assert kept[0] == kept[1] == [i for i in range(30) if i % 3]


def test_pairs_against_brute_force(spark):
    rng = random.Random(11)
    words = unique("w", 12)
    items = [" ".join(rng.choice(words) for _ in range(rng.choice([2, 3, 4, 6, 9, 14, 40]))) for _ in range(40)]
    texts = []
    for _ in range(60):
        parts = [" ".join(rng.choice(words) for _ in range(8))]
        for item in rng.sample(items, 2):
            cut = item.split()
            start = rng.randrange(len(cut))
            parts += [" ".join(cut[start:]), " ".join(cut[:start])] if rng.random() < 0.5 else [item, "x"]
        texts.append(" ".join(parts))
    want = set()
    for i, text in enumerate(texts):
        for j, item in enumerate(items):
            a, b = ([int(w[1:]) if w != "x" else 99 for w in t.split()] for t in (text, item))
            if len(b) < 3:
                continue
            if len(b) < 5:
                if any(a[k : k + len(b)] == b for k in range(len(a))):
                    want.add((i, j))
            else:
                tiles = d.tile(np.array(a), np.array(b))
                if tiles and (sum(t[2] for t in tiles) >= 0.6 * len(b) or tiles[0][2] >= 25):
                    want.add((i, j))
    docs = documents(spark, [(i, t, "en", "s", 0) for i, t in enumerate(texts)])
    got = d.find(docs, spark.createDataFrame(list(enumerate(items)), ITEMS)).collect()
    assert {(r["doc_id"], r["item_id"]) for r in got} == want and len(got) == len(want)


def test_items_of_one_word_where_asked_for(spark):
    docs = documents(spark, [(1, "a Zebra!", "en", "s", 0), (2, "zebras x", "en", "s", 0)])
    items = spark.createDataFrame([(1, "zebra"), (2, "zebras x")], ITEMS)
    got = sorted((r["doc_id"], r["item_id"], r["coverage"]) for r in d.find(docs, items, shortest=1).collect())
    assert got == [(1, 1, 1.0), (2, 2, 1.0)]


def test_a_phrase_of_all_items_and_texts_makes_no_pairs(spark):
    phrase = "which of the following is the best answer here"
    items = spark.createDataFrame([(i, f"{phrase} {' '.join(unique(f'i{i}w', 40))}") for i in range(50)], ITEMS)
    docs = documents(spark, [(i, f"{phrase} {prose(i, 20)}", "en", "s", 0) for i in range(50)])
    table = d._items(items, 3)
    seeds = d._item_seeds(table, 5, 0.6, 25)
    near = d._near(docs, [5], d._filter(seeds, 1 << 16))
    assert near.count() == 50 and d._candidates(near.dropDuplicates(["key"]), seeds).count() == 0
