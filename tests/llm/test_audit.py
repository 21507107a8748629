from itertools import permutations

from pyspark.sql import functions as F

from tests.llm.cases import documents, empty, odd_rows, prose, words
from tidemark.llm import audit

LABELS = "doc_id long, quality int, toxic int"


def brute(rows, labels):
    """Every order applied one filter after the other."""
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    docs = []
    for i, text, _, source, *_ in rows:
        text = text or ""
        w = words(text)
        ids = [r[0] for r in rows if (r[1] or "") == text and r[0] is not None]
        failed = {
            "A": len(w) < 200,
            "B": 100 * len(set(w)) < 50 * len(w),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 2 * len(text),
            "D": any(c in "#$%&*|" for c in text),
            "E": i is not None and any(j < i for j in ids),
        }
        docs.append((source or "", {f for f, bad in failed.items() if bad}, i in good, i in toxic))
    out, shapley = [], {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d for d in docs if d[0] == part]
            gone = []
            for step, f in enumerate(order, 1):
                here = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] = shapley.get((part, f), 0) + len(here)
                out.append(
                    (
                        part, "".join(order), step, len(left), len(here), sum(f in d[1] for d in gone),
                        sum(d[1] == {f} for d in docs if d[0] == part), sum(d[2] for d in here), sum(d[3] for d in here), f,
                    )
                )
                gone += here
    return sorted((*r[:-1], shapley[r[0], r[-1]]) for r in out)


def found(df):
    assert df.columns == ["part", "filter_order", "step", *audit.COUNTS]
    return sorted(tuple(r) for r in df.collect())


def rows_of(n):
    texts = [
        prose(1, 250), prose(2, 250) + " #", prose(3, 250).upper(), prose(4, 20), "same " * 300, "SAME # " * 150, prose(5, 199),
        " ".join(f"w{i}" for i in range(200)), " ".join(f"w{i}" for i in range(199)), "a b " * 100, "",
    ]
    return [(i, texts[i * i % len(texts)], "en", ["a", "b", None, "", "ä"][i % 5], 0) for i in range(n)]


def test_orders_against_brute_force(spark):
    rows = rows_of(90) + odd_rows()
    labels = [(i, i % 2, i % 3 % 2) for i in range(60)] + [(3, 1, 1), (3, None, 0), (None, 1, 1), (4, None, None), (500, 1, 1)]
    marks = spark.createDataFrame(labels, LABELS).withColumns({n: F.lit("x") for n in ("part", "mask", "text", "deal", "good")})
    assert found(audit.audit(documents(spark, rows), marks)) == brute(rows, labels)


def test_repeated_ids_and_texts(spark):
    """Copies under one id are no copies of each other; a part without the first copy has none."""
    text = prose(9, 250)
    rows = [(5, text, "en", "a", 0)] * 3 + [(5, text, "en", "b", 0), (7, text, "en", "b", 0), (None, text, "en", "c", 0), (7, text + " ", "en", "a", 0)]
    rows += [(5, prose(i, 210), "en", "a", 0) for i in range(20)] + [(None, prose(i, 210), "en", "a", 0) for i in range(20)]
    labels = [(5, 1, 0), (7, 0, 1)]
    assert found(audit.audit(documents(spark, rows), spark.createDataFrame(labels, LABELS))) == brute(rows, labels)


def test_empty_tables(spark):
    assert audit.audit(empty(spark), empty(spark, LABELS)).collect() == []
    rows = rows_of(12)
    assert found(audit.audit(documents(spark, rows), empty(spark, LABELS))) == brute(rows, [])


def test_many_parts(spark):
    rows = [(i, prose(i % 7, 210), "en", f"s{i % 300}", 0) for i in range(600)]
    got = found(audit.audit(documents(spark, rows), empty(spark, LABELS)))
    assert len(got) == 300 * 600 and got == brute(rows, [])


def test_the_product_is_the_first_failed_filter():
    orders, failed, steps = audit.removal_steps(5)
    for mask in range(32):
        for order, step in zip(orders.tolist(), steps[mask].tolist(), strict=True):
            assert step == next((s for s, f in enumerate(order) if failed[mask, f]), 5)
