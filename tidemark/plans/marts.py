"""Reporting marts over staged events.

All group by ``event_date``, the partition column of the stored events, so a
rebuild of a few dates reads only their folders. Rates and averages are 0.0
where nothing can be divided.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import count_type, ratio, revenue
from tidemark.operators.sessions import sessions


def daily_summary(events: DataFrame) -> DataFrame:
    totals = events.groupBy(F.col("event_date").alias("date")).agg(
        F.count("*").alias("total_events"),
        count_type("purchase").alias("total_purchases"),
        count_type("click").alias("clicks"),
        revenue().cast("double").alias("total_revenue"),
        F.count_distinct("user_id").alias("unique_users"),
    )
    return totals.select(
        "date",
        "total_events",
        "total_purchases",
        "total_revenue",
        "unique_users",
        ratio(F.col("total_purchases"), F.col("clicks")).alias("conversion_rate"),
        # Per purchase event: order ids are not unique and are not counted.
        ratio(F.col("total_revenue"), F.col("total_purchases")).alias("avg_order_value"),
    )


def product_performance(events: DataFrame, products: DataFrame) -> DataFrame:
    """Counts first, names after: the join sees one row per date and product."""
    totals = (
        events.filter(F.col("product_id").isNotNull())
        .groupBy(F.col("event_date").alias("date"), "product_id")
        .agg(
            count_type("product_view").alias("view_count"),
            count_type("click").alias("click_count"),
            count_type("add_to_cart").alias("cart_count"),
            count_type("purchase").alias("purchase_count"),
            revenue().cast("double").alias("revenue"),
        )
    )
    names = products.select("product_id", "product_name", F.col("category_name").alias("category"))
    return totals.join(names, "product_id", "left").select(
        "date",
        "product_id",
        "product_name",
        "category",
        "view_count",
        "click_count",
        "cart_count",
        "purchase_count",
        "revenue",
        ratio(F.col("purchase_count"), F.col("click_count")).alias("conversion_rate"),
    )


def user_segments(events: DataFrame, session_rows: DataFrame | None = None) -> DataFrame:
    """Segment totals per day, with the mean length of the sessions that began that day.

    ``session_rows`` lets a rebuild pass sessions that were found in a wider
    range of events than the dates being rebuilt.
    """
    if session_rows is None:
        session_rows = sessions(events, attribute="user_segment")
    totals = events.groupBy(F.col("event_date").alias("date"), "user_segment").agg(
        F.count_distinct("user_id").alias("user_count"),
        F.count("*").alias("event_count"),
        count_type("purchase").alias("purchase_count"),
        revenue().cast("double").alias("revenue"),
    )
    lengths = session_rows.groupBy(
        F.to_date("session_start").alias("session_date"),
        F.col("user_segment").alias("session_segment"),
    ).agg(F.sum("duration_us").alias("total_us"), F.count("*").alias("session_count"))
    same = (F.col("date") == F.col("session_date")) & F.col("user_segment").eqNullSafe(
        F.col("session_segment")
    )
    mean_seconds = F.col("total_us").cast("double") / (F.col("session_count") * 1000000.0)
    return totals.join(lengths, same, "left").select(
        "date",
        "user_segment",
        "user_count",
        "event_count",
        "purchase_count",
        "revenue",
        F.coalesce(mean_seconds, F.lit(0.0)).alias("avg_session_duration"),
    )


def funnel_analysis(events: DataFrame) -> DataFrame:
    totals = events.groupBy(
        F.col("event_date").alias("date"), F.col("category_name").alias("category")
    ).agg(
        count_type("page_view").alias("page_view_count"),
        count_type("product_view").alias("product_view_count"),
        count_type("click").alias("click_count"),
        count_type("add_to_cart").alias("add_to_cart_count"),
        count_type("purchase").alias("purchase_count"),
    )
    return totals.withColumns(
        {
            "view_to_click_rate": ratio(F.col("click_count"), F.col("product_view_count")),
            "click_to_cart_rate": ratio(F.col("add_to_cart_count"), F.col("click_count")),
            "cart_to_purchase_rate": ratio(F.col("purchase_count"), F.col("add_to_cart_count")),
        }
    )


def geo_revenue(events: DataFrame, users: DataFrame) -> DataFrame:
    """Users are added up first, so that a busy user is one row when cities join."""
    per_user = events.groupBy(F.col("event_date").alias("date"), "country", "user_id").agg(
        F.count("*").alias("n"),
        count_type("purchase").alias("purchases"),
        revenue().alias("amount"),
    )
    cities = users.select("user_id", "city")
    return (
        per_user.join(cities, "user_id", "left")
        .groupBy("date", "country", "city")
        .agg(
            F.sum("n").alias("event_count"),
            F.sum("purchases").alias("purchase_count"),
            F.sum("amount").cast("double").alias("revenue"),
        )
    )


def hourly_kpi(events: DataFrame) -> DataFrame:
    return (
        events.groupBy(F.window("timestamp", "1 hour"))
        .agg(
            F.count("*").alias("total_events"),
            count_type("purchase").alias("purchases"),
            revenue().cast("double").alias("revenue"),
            F.count_distinct("user_id").alias("active_users"),
        )
        .select(
            F.col("window.start").alias("hour_start"),
            "total_events",
            "purchases",
            "revenue",
            "active_users",
        )
    )
