from __future__ import annotations

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shop import at, event, frame
from tidemark.functions.columns import ratio
from tidemark.operators import metrics as m
from tidemark.schemas import METRIC_COLUMNS


def values(df) -> dict:
    return {
        (r.window_start, r.metric_name, r.dimension_value): r.metric_value for r in df.collect()
    }


def some_events(n: int = 400, seed: int = 1) -> list[dict]:
    rng = random.Random(seed)
    kinds = ["click", "purchase", "add_to_cart", "product_view", "page_view"]
    return [
        event(
            i,
            rng.choice(kinds),
            at(rng.uniform(0, 150)),
            user_id=f"u{rng.randint(1, 9)}",
            sku=rng.choice(["s1", "s2", None]),
            category=rng.choice(["books", "toys", None]),
            user_segment=rng.choice(["vip", "casual", None]),
            sale_price=rng.choice([None, 1.5, 20.25]),
            quantity=rng.choice([None, 1, 3]),
            time_on_page_sec=rng.choice([None, 5, 90]),
        )
        for i in range(n)
    ]


def test_summary(spark):
    rows = [
        event(1, "purchase", at(), sale_price=2.5, quantity=2),
        event(2, "purchase", at(0.5), user_id="u2"),
        event(3, "click", at(0.9), user_id="u2"),
        event(4, "add_to_cart", at(1), sale_price=9),
    ]
    got = values(m.summary_1m(frame(spark, rows)))
    first = {k[1]: v for k, v in got.items() if k[0] == at()}
    assert first == {
        "events_1m": 3,
        "active_users_1m": 2,
        "revenue_1m": 5.0,
        "click_1m": 1,
        "cart_1m": 0,
        "purchase_1m": 2,
    }
    assert got[(at(1), "revenue_1m", "")] == 0.0


def test_summary_of_unpriced_purchases_is_zero(spark):
    got = values(m.summary_1m(frame(spark, [event(1, "purchase", at())])))
    assert got[(at(), "revenue_1m", "")] == 0.0


def test_category_revenue_counts_missing_as_zero(spark):
    rows = [
        event(1, "purchase", at(), sale_price=4, quantity=None),
        event(2, "purchase", at(), sale_price=4, quantity=2),
        event(3, "purchase", at(), sale_price=None, category=None),
        event(4, "click", at(), sale_price=4),
    ]
    got = values(m.revenue_by_category_1h(frame(spark, rows)))
    assert got == {
        (at(), "revenue_by_category", "books"): 8.0,
        (at(), "revenue_by_category", ""): 0.0,
    }


def test_ratio(spark):
    df = spark.createDataFrame([(1, 2), (3, 0), (0, 4), (3, 2)], "a LONG, b LONG")
    got = [r[0] for r in df.select(ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [0.5, 0.0, 0.0, 1.5]


@pytest.mark.parametrize("build", [m.rates_5m, m.time_on_page_5m])
def test_minutes_first_equals_sliding_window(spark, build, monkeypatch):
    """The two-step plan of a batch gives what a plain sliding window gives."""
    df = frame(spark, some_events())
    two_steps = values(build(df))

    def direct(events, keys, totals):
        grouped = events.groupBy(F.window("timestamp", "5 minutes", "1 minute"), *keys)
        return m._aggregate(grouped, totals)

    monkeypatch.setattr(m, "_sliding", direct)
    assert two_steps == values(build(df)) and two_steps


def test_rates_share_one_aggregate(spark):
    df = frame(spark, some_events())
    apart = {**values(m.conversion_rate_5m(df)), **values(m.add_to_cart_rate_5m(df))}
    assert apart == values(m.rates_5m(df))


def test_hourly_metrics_equal_the_single_ones(spark):
    df = frame(spark, some_events())
    single = [
        m.revenue_by_category_1h(df),
        m.product_counts_1h(df, "purchase"),
        m.product_counts_1h(df, "click"),
        m.breakdown_1h(df, "user_segment"),
        m.breakdown_1h(df, "country"),
    ]
    apart = {}
    for part in single:
        apart.update(values(part))
    assert apart == values(m.hourly_metrics(df, ("user_segment", "country")))


def test_shape(spark):
    df = frame(spark, some_events(50))
    for part in (m.summary_1m(df), m.rates_5m(df), m.hourly_metrics(df), m.all_metrics(df)):
        assert tuple(part.columns) == METRIC_COLUMNS
        assert part.filter("dimension_key IS NULL OR dimension_value IS NULL").count() == 0


def test_top_products_breaks_ties_by_sku(spark):
    rows = []
    for i, (sku, n) in enumerate([("c", 2), ("a", 2), ("b", 3), ("d", 1)]):
        rows += [event(10 * i + j, "purchase", at(j), sku=sku) for j in range(n)]
    top = m.top_products_1h(frame(spark, rows), k=3).orderBy("position").collect()
    assert [(r.dimension_value, r.metric_value) for r in top] == [("b", 3), ("a", 2), ("c", 2)]


def test_top_products_limits_each_task(spark, plan):
    text = plan(m.top_products_1h(frame(spark, some_events(20))))
    assert "WindowGroupLimit" in text and "Partial" in text


def test_hot_key_is_added_up_before_the_shuffle(spark, plan):
    """A third of all rows on one product: the shuffle sees one row per task and hour."""
    hot = spark.range(0, 30000, 1, 8).select(
        F.lit("purchase").alias("event_type"),
        F.lit(at()).cast("timestamp").alias("timestamp"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("sku"),
    )
    counted = m.product_counts_1h(hot)
    assert counted.filter("dimension_value = 'hot'").first().metric_value == 10000
    before = plan(counted)
    assert before.index("Exchange") < before.rindex("partial_count")


def test_windows_are_whole_hours(spark):
    rows = [event(1, "purchase", at(59.99)), event(2, "purchase", at(60))]
    got = m.product_counts_1h(frame(spark, rows)).collect()
    assert {r.window_end - r.window_start for r in got} == {timedelta(hours=1)}
    assert len(got) == 2
