"""The ledger of staged ids against a join with all staged events."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest

from shop import event, frame
from tidemark.operators.ingest import to_stored
from tidemark.plans import jobs, ledger
from tidemark.plans.ledger import IdLedger
from tidemark.sources import files, tables as t

FIRST = date(2024, 3, 1)


def days(n: int) -> date:
    return FIRST + timedelta(days=n)


def ids_frame(spark, rows):
    return spark.createDataFrame(rows, "event_id STRING, event_date DATE")


def stage(spark, path, rows, mode="overwrite"):
    ids_frame(spark, rows).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("event_date").parquet(path)


def looked_up(df) -> set[str]:
    return {r.event_id for r in df.collect()}


def test_thirty_dates_equal_the_anti_join(spark, folder, plan):
    """Repeats of any age are found; of the staged events nothing is read, of the ledger few buckets."""
    rng = random.Random(1)
    staged = [(f"e{n}", days(n % 30)) for n in range(3000)]
    stage(spark, f"{folder}/stg", staged)
    held = IdLedger(spark, f"{folder}/ledger", buckets=32)
    state = held.sync(f"{folder}/stg")
    assert len(state.dates) == 30
    repeats = {r[0] for r in rng.sample(staged, 3)}
    fresh = ids_frame(spark, [(f"new{n}", days(30)) for n in range(500)] + [(i, days(30)) for i in repeats])
    known = held.known(fresh, state, days(30))
    want = fresh.join(spark.read.parquet(f"{folder}/stg").select("event_id"), "event_id", "left_semi")
    assert looked_up(known) == looked_up(want) == repeats
    scans = plan(known)
    assert f"{folder}/stg" not in scans
    buckets = {p.split("bucket=")[1].split("/")[0] for p in known.inputFiles() if "bucket=" in p}
    assert 1 <= len(buckets) <= 6 < 32
    assert looked_up(held.known(fresh, state, FIRST)) == set()
    late = [i for i, d in staged if d >= days(20)][:5]
    some = ids_frame(spark, [(i, days(30)) for i in late])
    assert looked_up(held.known(some, state, days(20))) == set()
    assert looked_up(held.known(some, state, days(30), since=days(20))) == set(late)
    assert looked_up(held.known(fresh, state, days(30), since=days(30))) == set()


def test_filters_hold_every_id_and_few_others(spark):
    own = spark.range(20_000).selectExpr("concat('a', id) AS event_id", "CAST(id % 4 AS INT) AS bucket")
    filters = ledger.filters_of(own)
    hit = lambda ids: ids.join(filters, "bucket").filter(ledger.may_hold(filters["bits"])).count()
    assert hit(own) == 20_000
    others = spark.range(200_000).selectExpr("concat('b', id) AS event_id", "CAST(id % 4 AS INT) AS bucket")
    assert hit(others) <= 10
    sizes = {r.n for r in filters.selectExpr("size(bits) AS n").collect()}
    assert sizes == {5000 * ledger.BITS_PER_ID // 64}


def test_only_changed_dates_are_loaded_again(spark, folder):
    stg = f"{folder}/stg"
    stage(spark, stg, [(f"e{n}", days(n % 5)) for n in range(50)])
    held = IdLedger(spark, f"{folder}/ledger", buckets=4)
    first = held.sync(stg)
    assert held.sync(stg).version == first.version == 1
    stage(spark, stg, [("x", days(2)), ("y", days(7))])
    second = held.sync(stg)
    changed = {d for d, of in second.dates.items() if first.dates.get(d) != of}
    assert changed == {str(days(2)), str(days(7))}
    # What the date held before is forgotten.
    asked = ids_frame(spark, [("e2", days(9)), ("e3", days(9)), ("x", days(9)), ("y", days(9))])
    assert looked_up(held.known(asked, second, days(9))) == {"e3", "x", "y"}
    files.delete(spark, f"{stg}/event_date={days(3)}")
    third = held.sync(stg)
    assert looked_up(held.known(asked, third, days(9))) == {"x", "y"}
    assert held.sync(stg, before=days(1)).version == third.version


def test_fold_and_vacuum_change_nothing(spark, folder):
    stg = f"{folder}/stg"
    held = IdLedger(spark, f"{folder}/ledger", buckets=4)
    for n in range(6):
        stage(spark, stg, [(f"e{n}-{i}", days(n)) for i in range(5)], "append")
        held.sync(stg)
    asked = ids_frame(spark, [(f"e{n}-0", days(9)) for n in range(9)])
    before = looked_up(held.known(asked, held.state(), days(9)))
    state = held.fold(days(4))
    assert len({load for load, _ in state.dates.values()}) == 3
    held.vacuum()
    assert len(files.children(spark, f"{folder}/ledger/ids")) == 3
    assert before == {f"e{n}-0" for n in range(6)} == looked_up(held.known(asked, held.state(), days(9)))
    # A folded date that is staged again leaves its old ids behind.
    stage(spark, stg, [("other", days(1))])
    state = held.sync(stg)
    assert looked_up(held.known(asked, state, days(9))) == before - {"e1-0"}


def test_of_two_jobs_the_first_commits(spark, folder):
    stg = f"{folder}/stg"
    stage(spark, stg, [("a", days(0))])
    one, two = (IdLedger(spark, f"{folder}/ledger", buckets=4) for _ in range(2))
    old = two.state()
    one.sync(stg)
    state = two._commit(old, {})
    assert state.version == 1 and two.state().dates == one.state().dates != {}


def test_no_dates_and_no_ids(spark, folder):
    held = IdLedger(spark, f"{folder}/ledger")
    nothing = ids_frame(spark, [])
    assert held.sync(f"{folder}/missing").dates == {}
    assert looked_up(held.known(nothing, held.state(), days(1))) == set()
    stage(spark, f"{folder}/stg", [("a", days(0))])
    assert looked_up(held.known(nothing, held.sync(f"{folder}/stg"), days(1))) == set()


def install(spark, folder, rows) -> t.Tables:
    where = t.Tables(folder)
    raw = to_stored(frame(spark, rows).selectExpr("*", "CAST(NULL AS TIMESTAMP) AS kafka_timestamp"))
    raw.write.mode("append").partitionBy("event_date").parquet(where.path("raw_events"))
    return where


@pytest.mark.parametrize("dead_before_sync", [False, True])
def test_staging_keeps_known_ids_out(spark, folder, plan, dead_before_sync):
    """Also after a job that died between staging and the ledger."""
    noon = lambda d: datetime.combine(d, datetime.min.time()) + timedelta(hours=12)
    rows = [event(n, "click", noon(days(n % 30))) for n in range(90)]
    where = install(spark, folder, rows)
    path = where.path("stg_events")
    for start in (0, 10, 20):
        span = days(start), days(start + 9)
        jobs.replace_dates(jobs.new_events(spark, where, *span), path, "event_date", *span)
        if not dead_before_sync:
            jobs.id_ledger(spark, where).sync(path)
    repeated = [event(n, "click", noon(days(30))) for n in (0, 17, 44, 89)] + [event(500, "click", noon(days(30)))]
    install(spark, folder, repeated)
    fresh = jobs.new_events(spark, where, days(30), days(30))
    assert looked_up(fresh) == {"e500"}
    assert path not in plan(fresh)
    assert {d for d in jobs.id_ledger(spark, where).state().dates} == {str(days(n)) for n in range(30)}
