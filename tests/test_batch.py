"""Staging, marts, checks, jobs and reads on hand-made rows."""

from __future__ import annotations

from datetime import date, datetime, timedelta
from decimal import Decimal

import pytest

from shop import at, event, frame
from tidemark.operators import ingest
from tidemark.plans import jobs, marts, quality, reads, staging
from tidemark.schemas import PRODUCTS, USERS, ddl, require_columns
from tidemark.session import clear_shared, shared_dir
from tidemark.sources import files, tables as t


def stored(spark, rows):
    return ingest.to_stored(frame(spark, rows))


def table(spark, schema: str, *rows: dict):
    names = [f.name for f in ddl(schema)]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], ddl(schema))


# -- staging ---------------------------------------------------------------------


def test_is_on_sale(spark):
    rows = [
        {"product_id": "1", "discount_percent": Decimal(10), "tags": '["a", "b"]'},
        {"product_id": "2", "discount_percent": Decimal(0), "tags": "[]"},
        {"product_id": "3", "discount_percent": None, "tags": "no json"},
    ]
    got = staging.stg_products(table(spark, PRODUCTS, *rows)).orderBy("product_id").collect()
    assert [r.is_on_sale for r in got] == [True, False, False]
    assert [r.tags for r in got] == [["a", "b"], [], None]


def test_staged_users(spark):
    users = table(spark, USERS, {"user_id": "1", "country": " vn", "user_segment": "VIP "})
    (row,) = staging.stg_users(users).collect()
    assert (row.country, row.user_segment) == ("VN", "vip")


def test_staged_events(spark):
    rows = [
        event(1, "click", at(5)),
        event(1, "click", at(3)),
        event(2, "bogus", at()),
        event(3, "click", None),
        event(4, "click", at(), user_id=None),
    ]
    got = staging.stg_events(stored(spark, rows)).collect()
    assert [(r.event_id, r.timestamp) for r in got] == [("e1", at(3))]


def test_catalog_scans(spark):
    products = table(
        spark,
        PRODUCTS,
        {"product_id": "1", "is_available": True, "sale_price": None, "popularity_score": 0},
        {"product_id": "2", "is_available": True, "sale_price": Decimal("2.5"), "popularity_score": 7},
        {"product_id": "3", "is_available": False},
        {"product_id": "4", "is_available": None},
    )
    got = t.available_products(products).orderBy("product_id").collect()
    assert [(r.sale_price, r.popularity_score) for r in got] == [(0.0, 1), (2.5, 7)]
    users = table(spark, USERS, {"user_id": "1", "is_active": True}, {"user_id": "2"})
    assert [r.user_id for r in t.active_users(users).collect()] == ["1"]


def test_schema_check(spark):
    df = spark.createDataFrame([(1,)], "user_id INT")
    with pytest.raises(ValueError, match="user_id: expected string, found int"):
        require_columns(df, USERS, "users")


def test_shared_dir_is_the_one_of_the_cluster(spark):
    assert shared_dir(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


class Conf(dict):
    """Stands in for a session that has only settings."""

    @property
    def conf(self):
        return self


@pytest.mark.parametrize("master", ["local[2]", "spark://host:7077"])
def test_the_warehouse_is_shared_where_nothing_else_is_named(master):
    settings = {"spark.master": master, "spark.sql.warehouse.dir": "file:///nowhere/warehouse/"}
    assert shared_dir(Conf(settings), "x").startswith("file:///nowhere/warehouse/x-")


def test_work_folders_can_be_cleared(spark):
    folder = shared_dir(spark, "gone")
    spark.range(3).write.parquet(folder)
    clear_shared(spark)
    assert not files.exists(spark, folder)


# -- marts -----------------------------------------------------------------------


def test_daily_summary_counts_purchases_not_orders(spark):
    rows = [
        event(1, "purchase", at(), sale_price=10, quantity=2),
        event(2, "purchase", at(), sale_price=5, user_id="u2"),
        event(3, "click", at()),
    ]
    (row,) = marts.daily_summary(stored(spark, rows)).collect()
    assert (row.total_events, row.total_purchases, row.unique_users) == (3, 2, 2)
    assert (row.total_revenue, row.conversion_rate, row.avg_order_value) == (25.0, 2.0, 12.5)


def test_rates_without_clicks_are_zero(spark):
    (row,) = marts.daily_summary(stored(spark, [event(1, "page_view", at())])).collect()
    assert (row.conversion_rate, row.avg_order_value, row.total_revenue) == (0.0, 0.0, 0.0)


def test_product_performance_keeps_unknown_products(spark):
    rows = [event(1, "click", at()), event(2, "click", at(), product_id="p9")]
    products = table(spark, PRODUCTS, {"product_id": "p1", "product_name": "pen"})
    got = marts.product_performance(stored(spark, rows), products).orderBy("product_id").collect()
    assert [(r.product_id, r.product_name) for r in got] == [("p1", "pen"), ("p9", None)]


def test_segment_sessions_count_on_the_day_they_began(spark):
    late = datetime(2024, 3, 1, 23, 50)
    rows = [event(1, "click", late), event(2, "click", late + timedelta(minutes=20))]
    got = marts.user_segments(stored(spark, rows)).orderBy("date").collect()
    assert [(str(r.date), r.avg_session_duration) for r in got] == [
        ("2024-03-01", 1200.0),
        ("2024-03-02", 0.0),
    ]


def test_geo_uses_the_city_of_the_user(spark):
    users = table(spark, USERS, {"user_id": "u1", "city": "Hue"})
    rows = [
        event(1, "purchase", at(), sale_price=3),
        event(2, "click", at()),
        event(3, "click", at(), user_id="x"),
    ]
    got = marts.geo_revenue(stored(spark, rows), users).collect()
    assert {(r.city, r.event_count, r.purchase_count, r.revenue) for r in got} == {
        ("Hue", 2, 1, 3.0),
        (None, 1, 0, 0.0),
    }


def test_no_join_is_a_cross_join(spark, plan):
    events = stored(spark, [event(1, "click", at())])
    users = table(spark, USERS, {"user_id": "u1"})
    for df in (marts.geo_revenue(events, users), marts.user_segments(events)):
        assert "Cartesian" not in plan(df) and "NestedLoop" not in plan(df)


# -- checks ----------------------------------------------------------------------


def checks(df):
    return {(r.column_name, r.check_name): r.failures for r in df.collect()}


def test_row_checks_run_in_one_pass(spark, plan):
    df = spark.createDataFrame(
        [(None, -1.0, 0.5), ("a", 2.0, 1.5), ("b", None, None)], "k STRING, v DOUBLE, r DOUBLE"
    )
    result = quality.check_rows(
        df,
        "x",
        [
            quality.not_null("k"),
            quality.non_negative("v"),
            quality.valid_rate("r"),
            quality.accepted_values("k", ("a",)),
        ],
    )
    assert plan(result).count("Scan") == 1
    assert checks(result) == {
        ("k", "not_null"): 1,
        ("v", "non_negative"): 1,
        ("r", "valid_rate"): 1,
        ("k", "accepted_values"): 1,
    }


def test_unique_and_relationship(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), ("c",), (None,), (None,)], "k STRING")
    parent = spark.createDataFrame([("b",)], "id STRING")
    assert checks(quality.check_unique(df, "x", "k")) == {("k", "unique"): 1}
    got = checks(quality.check_relationship(df, "x", "k", parent, "id"))
    assert got == {("k", "relationship"): 3}
    empty = checks(quality.check_relationship(df.limit(0), "x", "k", parent, "id"))
    assert empty == {("k", "relationship"): 0}


def test_only_errors_stop_a_run(spark):
    df = spark.createDataFrame([(-1.0, None)], "v DOUBLE, k STRING")
    quality.enforce(quality.check_rows(df, "x", [quality.non_negative("v")]))
    with pytest.raises(quality.CheckFailed, match="x.k not_null: 1"):
        quality.enforce(quality.check_rows(df, "x", [quality.not_null("k")]))


# -- jobs ------------------------------------------------------------------------


def install(spark, folder, rows) -> t.Tables:
    where = t.Tables(folder)
    stored(spark, rows).write.partitionBy("event_date").parquet(where.path("raw_events"))
    users = table(spark, USERS, {"user_id": "u1", "city": "Hue"})
    users.write.parquet(where.path("users"))
    products = table(spark, PRODUCTS, {"product_id": "p1", "product_name": "pen"})
    products.write.parquet(where.path("products"))
    return where


def day(n: int, hour: float = 12) -> datetime:
    return datetime(2024, 3, 1) + timedelta(days=n - 1, hours=hour)


def append(spark, where, rows):
    raw = stored(spark, rows)
    raw.write.mode("append").partitionBy("event_date").parquet(where.path("raw_events"))


def daily(spark, where) -> dict:
    return {
        r.date.day: r.total_events
        for r in jobs.read_mart(spark, where, "mart_daily_summary").collect()
    }


def test_gate_stops_without_events(spark, folder):
    where = install(spark, folder, [event(1, "click", day(1))])
    with pytest.raises(jobs.NotReady):
        jobs.run_daily(spark, where, date(2024, 3, 5))


def test_daily_run_rebuilds_the_lookback_only(spark, folder):
    rows = [event(n, "click", day(n)) for n in range(1, 6)]
    where = install(spark, folder, rows)
    results = jobs.run_daily(spark, where, date(2024, 3, 4))
    assert daily(spark, where) == {2: 1, 3: 1}
    assert results.filter("severity = 'error' AND failures > 0").count() == 0
    append(spark, where, [event(20, "click", day(3, 1)), event(21, "click", day(2, 1))])
    jobs.run_daily(spark, where, date(2024, 3, 5))
    # Day 3 lies in the lookback of this run, day 2 does not.
    assert daily(spark, where) == {2: 1, 3: 2, 4: 1}
    before = daily(spark, where)
    jobs.run_daily(spark, where, date(2024, 3, 5))
    assert daily(spark, where) == before


def test_an_id_staged_before_does_not_come_back(spark, folder):
    rows = [event(1, "click", day(1)), event(2, "click", day(2)), event(3, "click", day(3))]
    where = install(spark, folder, rows)
    jobs.run_daily(spark, where, date(2024, 3, 3))
    append(
        spark, where, [event(1, "click", day(6)), event(7, "click", day(6)), event(8, "click", day(5))]
    )
    jobs.run_daily(spark, where, date(2024, 3, 7))
    assert daily(spark, where)[6] == 1


def test_a_date_without_rows_goes_from_every_table(spark, folder):
    rows = [event(n, "purchase", day(n), sale_price=2.0) for n in range(1, 5)]
    where = install(spark, folder, rows)
    jobs.run_daily(spark, where, date(2024, 3, 5), lookback_hours=96)
    assert daily(spark, where) == {1: 1, 2: 1, 3: 1, 4: 1}
    files.delete(spark, f"{where.path('raw_events')}/event_date=2024-03-03")
    jobs.run_daily(spark, where, date(2024, 3, 5), lookback_hours=96)
    for name in jobs.DAILY_MARTS:
        days = {r.date.day for r in jobs.read_mart(spark, where, name).select("date").collect()}
        assert days == {1, 2, 4}, name
    assert jobs.staged_events(spark, where).filter("event_date = '2024-03-03'").count() == 0


def test_dates_outside_the_lookback_stay(spark, folder):
    rows = [event(1, "click", datetime(2022, 6, 1, 9)), event(2, "click", day(1)), event(3, "click", day(2))]
    where = install(spark, folder, rows)
    jobs.run_daily(spark, where, date(2024, 3, 3), lookback_hours=24 * 1000)
    got = sorted(r.date for r in jobs.read_mart(spark, where, "mart_daily_summary").collect())
    assert got == [date(2022, 6, 1), date(2024, 3, 1), date(2024, 3, 2)]
    jobs.run_daily(spark, where, date(2024, 3, 3))
    assert sorted(r.date for r in jobs.read_mart(spark, where, "mart_daily_summary").collect()) == got


def test_daily_run_builds_and_checks_the_hourly_mart(spark, folder):
    where = install(spark, folder, [event(1, "click", day(1)), event(2, "click", day(2))])
    results = jobs.run_daily(spark, where, date(2024, 3, 3))
    hours = jobs.read_mart(spark, where, "mart_hourly_kpi")
    assert {r.hour_start for r in hours.collect()} == {day(1), day(2)}
    checked = {(r.table_name, r.check_name) for r in results.collect()}
    assert {("mart_hourly_kpi", c) for c in ("not_null", "unique", "non_negative")} <= checked
    assert ("stg_events", "relationship") in checked


@pytest.mark.parametrize("days", [2, 30])
def test_following_sessions_takes_one_plan(spark, days):
    """However long a user stays, nothing runs before the sessions are asked for."""
    start = day(3, 23.75)
    rows = [event(i, "click", start + timedelta(minutes=25 * i)) for i in range(days * 58)]
    events = stored(spark, rows)
    group = f"sessions-{days}"
    spark.sparkContext.setJobGroup(group, group)
    begun = jobs.sessions_begun(events, date(2024, 3, 3), date(2024, 3, 3))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    spark.sparkContext.setJobGroup("", "")
    assert [r.event_count for r in begun.collect()] == [len(rows)]


def test_sessions_over_many_midnights(spark, folder):
    """A session that began on a rebuilt day and goes on for days is found whole."""
    start = day(3, 23.75)
    steps = 3 * 24 * 4
    rows = [event(i, "click", start + timedelta(minutes=15 * i)) for i in range(steps)]
    rows.append(event(9999, "click", day(3, 5), user_id="u2"))
    events = stored(spark, rows)
    begun = jobs.sessions_begun(events, date(2024, 3, 3), date(2024, 3, 3))
    got = {(r.user_id, r.event_count) for r in begun.collect()}
    assert got == {("u1", steps), ("u2", 1)}
    # On later days the same session did not begin.
    later = jobs.sessions_begun(events, date(2024, 3, 4), date(2024, 3, 5))
    assert later.count() == 0


def test_hourly_run(spark, folder):
    rows = [event(1, "click", day(1, 1)), event(2, "click", day(2, 3)), event(3, "click", day(2, 4))]
    where = install(spark, folder, rows)
    got = jobs.run_hourly(spark, where, day(2, 5))
    assert sorted((r.hour_start, r.total_events) for r in got.collect()) == [
        (day(1, 1), 1),
        (day(2, 3), 1),
        (day(2, 4), 1),
    ]


def test_reads_only_the_dates_it_needs(spark, folder, plan):
    rows = [event(n, "click", day(n)) for n in range(1, 6)]
    where = install(spark, folder, rows)
    raw = t.read_raw_events(spark, where)
    text = plan(marts.daily_summary(jobs.between_dates(raw, date(2024, 3, 2), date(2024, 3, 3))))
    assert "PartitionFilters: [isnotnull(event_date" in text
    schema = text[text.index("ReadSchema") :].splitlines()[0]
    assert "search_keyword" not in schema and "user_id" in schema


def test_validity_reaches_the_files(spark, folder, plan):
    where = install(spark, folder, [event(1, "click", day(1))])
    text = plan(staging.stg_events(t.read_raw_events(spark, where)))
    pushed = text[text.index("PushedFilters") :].splitlines()[0]
    assert "IsNotNull(event_id)" in pushed and "In(event_type" in pushed


# -- reads -----------------------------------------------------------------------


def metric(name, minute, value, key="", member="", kind="1m"):
    return (at(minute), at(minute + 1), kind, name, value, key, member)


def metric_frame(spark, *rows):
    schema = (
        "window_start TIMESTAMP, window_end TIMESTAMP, window_type STRING, metric_name STRING, "
        "metric_value DOUBLE, dimension_key STRING, dimension_value STRING"
    )
    return spark.createDataFrame(list(rows), schema)


def test_snapshot_takes_the_newest_window(spark):
    df = metric_frame(
        spark,
        metric("click_1m", 1, 5.0),
        metric("click_1m", 3, 2.0),
        metric("click_1m", 2, 9.0),
        metric("revenue_1m", 1, None),
        metric("segment_distribution", 1, 4.0, "user_segment", "vip", "1h"),
    )
    got = {r.metric_name: r.metric_value for r in reads.kpi_snapshot(df).collect()}
    assert got == {"click_1m": 2.0, "revenue_1m": 0.0}


def test_boards_and_top(spark):
    counts = [("a", 1, 3.0), ("a", 2, 1.0), ("b", 1, 1.0), ("", 1, 9.0)]
    df = metric_frame(
        spark, *[metric("product_click_count", w, v, "sku", s, "1h") for s, w, v in counts]
    )
    got = reads.top_products(reads.leaderboards(df), "click").collect()
    assert [(r.product_id, r.score) for r in got] == [("b", 1.0), ("a", 1.0)]


def test_timeseries_needs_both_ends(spark):
    df = metric_frame(spark, *[metric("events_1m", i, float(i)) for i in range(5)])
    half = reads.timeseries(df, "1m", start=at(3).isoformat())
    assert half.count() == 5
    both = reads.timeseries(df, "1m", at(1).isoformat(), at(3).isoformat())
    assert [r.metric_value for r in both.collect()] == [3.0, 2.0, 1.0]
    assert reads.timeseries(df, "1h").count() == 0
    assert [r.metric_value for r in reads.timeseries(df, limit=1).collect()] == [4.0]


def test_kpi_cards_fall_back_to_clicks(spark):
    df = metric_frame(spark, metric("events_1m", 1, 0.0), metric("click_1m", 1, 7.9))
    (row,) = reads.kpi_cards(reads.kpi_snapshot(df)).collect()
    assert tuple(row) == (7, 0, 0, 0)


def test_live_chart_and_rolling_volume(spark):
    rows = [metric("click_1m", i, 1.0 + i) for i in range(40)] + [metric("purchase_1m", 39, 2.0)]
    df = metric_frame(spark, *rows)
    chart = {r.window_start: r for r in reads.live_chart(df, at(38), at(40)).collect()}
    assert (chart[at(39)].click_count, chart[at(39)].purchase_count) == (40.0, 2.0)
    assert (chart[at(38)].purchase_count, chart[at(38)].revenue) == (0.0, 0.0)
    rolling = reads.rolling_volume(df, 30).collect()
    assert min(r.window_start for r in rolling) == at(10) and len(rolling) == 30


def test_event_rate(spark):
    df = metric_frame(spark, metric("events_1m", 1, 100.0))
    assert reads.event_rate(df).first().events_per_sec == 1.7


def test_kpi_change(spark):
    df = metric_frame(
        spark, metric("x", 1, 4.0), metric("x", 2, 6.0), metric("x", 3, 0.0), metric("x", 4, 1.0)
    )
    got = [r.change_percent for r in reads.kpi_change(df).orderBy("window_start").collect()]
    assert got == [None, 50.0, -100.0, None]


def test_rank_change_counts_products_outside_the_board(spark):
    """A product that was third of three comes first, though the board shows one."""
    counts = [(0, "a", 5), (0, "b", 5), (0, "c", 1), (60, "c", 9), (60, "a", 2), (180, "a", 1)]
    df = metric_frame(
        spark,
        *[metric("product_purchase_count", w, float(n), "sku", s, "1h") for w, s, n in counts],
    )
    got = reads.rank_change(df, k=1).orderBy("window_start").collect()
    assert [(r.sku, r.rank, r.previous_rank, r.rank_change) for r in got] == [
        ("a", 1, None, None),
        ("c", 1, 3, 2),
        ("a", 1, None, None),
    ]


def test_week_over_week_with_missing_days(spark):
    rows = [(date(2024, 3, 1), 10, 1, 2.0, 1), (date(2024, 3, 8), 15, 1, 3.0, 1)]
    df = spark.createDataFrame(
        rows,
        "date DATE, total_events LONG, total_purchases LONG, total_revenue DOUBLE, unique_users LONG",
    )
    got = {r.date.day: r for r in reads.week_over_week(df).collect()}
    assert got[1].total_events_last_week is None
    assert (got[8].total_events_wow, got[8].total_revenue_wow) == (50.0, 50.0)


def test_revenue_by_hour_of_day(spark):
    rows = [
        event(1, "purchase", at(), sale_price=2),
        event(2, "purchase", at(24 * 60), sale_price=3),
        event(3, "click", at(60)),
    ]
    got = {r.hour_of_day: r.revenue for r in reads.revenue_by_hour_of_day(frame(spark, rows)).collect()}
    assert got == {10: 5.0, 11: 0.0}
