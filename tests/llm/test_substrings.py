import hashlib
import random

from tests.llm.cases import documents, empty, odd_rows, prose, words
from tidemark.llm import common, substrings
from tidemark.llm.substrings import WINDOW


def brute(rows):
    order = sorted({(r[0], r[1]) for r in rows}, key=lambda r: (r[0] is None, r[0] or 0))
    first, gone = {}, {}
    for i, t in order:
        w = words(t)
        for p in range(len(w) - WINDOW + 1):
            window = tuple(w[p : p + WINDOW])
            if first.setdefault(window, (i, t, p)) != (i, t, p):
                gone.setdefault((i, t), set()).update(range(p, p + WINDOW))
    out = []
    for r in rows:
        w, g = words(r[1]), gone.get((r[0], r[1]), set())
        kept = " ".join(x for i, x in enumerate(w) if i not in g)
        out.append((r[0], len(w), len(g), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.drop("kept_text").collect()), key=str)


def test_copies_passages_and_repeats(spark):
    rng = random.Random(6)
    passages = [prose(100 + k, 20 + 9 * k) for k in range(8)]
    rows = []
    for i in range(150):
        parts = [prose(i, rng.randint(0, 60))]
        for _ in range(rng.randint(0, 3)):
            p = words(rng.choice(passages))
            a = rng.randint(0, len(p) - 1)
            parts += [" ".join(p[a : a + rng.randint(15, 90)]), prose(1000 + i, rng.randint(0, 30))]
        rows.append((i, " \n".join(parts), "en", "s", 0))
    rows += [(200 + i, rows[i % 5][1], "en", "s", 0) for i in range(40)]
    got = substrings.remove_repeats(documents(spark, rows).repartition(9))
    assert rows_of(got) == brute(rows)
    for r in got.where("kept_text IS NOT NULL").collect():
        assert hashlib.sha256(r["kept_text"].encode()).hexdigest() == r["kept_sha256"]


def test_periodic_texts(spark):
    rows = [
        (1, "x " * 500, "", "", 0),
        (2, "x " * 19, "", "", 0),
        (3, "x " * 20, "", "", 0),
        (4, "a b c d e " * 30, "", "", 0),
        (5, "b c d e a " * 5, "", "", 0),
        (0, "y " + "x " * 25, "", "", 0),
    ]
    assert rows_of(substrings.remove_repeats(documents(spark, rows))) == brute(rows)


def test_order_is_by_id_not_by_place_in_the_table(spark):
    text = prose(1, 50)
    rows = [(9, text, "", "", 0), (-3, text, "", "", 0), (None, text, "", "", 0), (4, f"{text} {text}", "", "", 0)]
    assert rows_of(substrings.remove_repeats(documents(spark, rows))) == brute(rows)


def test_pieces_of_bounded_size_find_the_same(spark, monkeypatch):
    rows = [(i, prose(i % 7, 80) + " " + prose(500 + i, 30), "", "", 0) for i in range(60)]
    monkeypatch.setattr(common, "PIECE_BYTES", 500)
    assert rows_of(substrings.remove_repeats(documents(spark, rows))) == brute(rows)


def test_odd_rows(spark):
    assert rows_of(substrings.remove_repeats(documents(spark))) == brute(odd_rows())
    assert substrings.remove_repeats(empty(spark)).collect() == []


def test_rows_that_repeat_take_no_longer_than_copies(spark):
    """2,000 rows of one id and text against 2,000 copies with ids of their own."""
    import time

    text = " ".join([prose(31, 300), prose(32, 200), prose(31, 300)])

    def run(ids):
        start = time.perf_counter()
        rows = documents(spark, [(i, text, "en", "s", 0) for i in ids], extra=False)
        got = substrings.remove_repeats(rows).select("doc_id", "n_words", "n_removed").collect()
        return got, time.perf_counter() - start

    run(range(10))
    copies, own = run(range(2000))
    repeats, alike = run([7] * 2000)
    assert len(repeats) == 2000 and {tuple(r) for r in repeats} == {(7, 800, copies[0]["n_removed"] if copies[0]["doc_id"] == 0 else 300)}
    assert alike < 2 * own + 5
