"""Windowed KPIs. Every function takes events and returns metric rows.

All but ``summary_1m`` and ``top_products_1h`` accept a stream as well.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import count_type, is_type, line_total, ratio, revenue, salt
from tidemark.schemas import METRIC_COLUMNS, MONEY

MINUTE, FIVE_MINUTES, HOUR = "1 minute", "5 minutes", "1 hour"


def metric_row(
    window_type: str, name: str, value: Column, key: str = "", member: Column | None = None
) -> Column:
    """One metric as a struct in the shape of the stored table, without the window."""
    return F.struct(
        F.lit(window_type).alias("window_type"),
        F.lit(name).alias("metric_name"),
        value.cast("double").alias("metric_value"),
        F.lit(key).alias("dimension_key"),
        F.coalesce(member if member is not None else F.lit(""), F.lit("")).alias("dimension_value"),
    )


def to_metrics(grouped: DataFrame, *rows: Column) -> DataFrame:
    """Unpivot a windowed aggregate into metric rows, one per given struct."""
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.inline(F.array(*rows)),
    ).select(*METRIC_COLUMNS)


def event_types_1m(events: DataFrame) -> DataFrame:
    """Events of each type per minute."""
    grouped = events.groupBy(F.window("timestamp", MINUTE), "event_type").agg(F.count("*").alias("n"))
    row = metric_row("1m", "events_by_type_1m", F.col("n"), "event_type", F.col("event_type"))
    return to_metrics(grouped, row)


def active_users_5m(events: DataFrame) -> DataFrame:
    """Distinct users of five-minute windows that start every minute (batch).

    A user counts once a minute first, so only distinct pairs go to five windows.
    """
    minutes = events.select(F.window("timestamp", MINUTE).alias("minute"), "user_id").distinct()
    grouped = minutes.groupBy(F.window(F.col("minute.start"), FIVE_MINUTES, MINUTE)).agg(
        F.count_distinct("user_id").alias("users")
    )
    return to_metrics(grouped, metric_row("5m", "active_users_5m", F.col("users"), "users"))


def revenue_1d(events: DataFrame) -> DataFrame:
    """Revenue of each day."""
    grouped = events.groupBy(F.window("timestamp", "1 day")).agg(revenue().alias("revenue"))
    return to_metrics(grouped, metric_row("1d", "revenue_1d", F.col("revenue"), "revenue"))


def product_revenue_1h(events: DataFrame) -> DataFrame:
    """Revenue per product and hour."""
    grouped = (
        events.filter(is_type("purchase"))
        .groupBy(F.window("timestamp", HOUR), "sku")
        .agg(F.sum(line_total()).alias("revenue"))
    )
    row = metric_row("1h", "product_revenue", F.col("revenue"), "sku", F.col("sku"))
    return to_metrics(grouped, row)


def _minute_totals() -> dict[str, Column]:
    return {
        "events": F.count("*"),
        "revenue": revenue(),
        "clicks": count_type("click"),
        "carts": count_type("add_to_cart"),
        "purchases": count_type("purchase"),
    }


def _minute_rows() -> list[Column]:
    return [
        metric_row("1m", "events_1m", F.col("events"), "events"),
        metric_row("1m", "revenue_1m", F.col("revenue"), "revenue"),
        metric_row("1m", "click_1m", F.col("clicks"), "click"),
        metric_row("1m", "cart_1m", F.col("carts"), "add_to_cart"),
        metric_row("1m", "purchase_1m", F.col("purchases"), "purchase"),
    ]


def _users_row() -> Column:
    return metric_row("1m", "active_users_1m", F.col("users"), "users")


def _aggregate(grouped, totals: dict[str, Column]) -> DataFrame:
    return grouped.agg(*[value.alias(name) for name, value in totals.items()])


def summary_1m(events: DataFrame) -> DataFrame:
    """Six KPIs per minute in one aggregate (batch: the distinct count is exact)."""
    totals = {**_minute_totals(), "users": F.count_distinct("user_id")}
    per_minute = _aggregate(events.groupBy(F.window("timestamp", MINUTE)), totals)
    return to_metrics(per_minute, *_minute_rows(), _users_row())


def counts_1m(events: DataFrame) -> DataFrame:
    """The five minute KPIs a stream can aggregate directly."""
    per_minute = _aggregate(events.groupBy(F.window("timestamp", MINUTE)), _minute_totals())
    return to_metrics(per_minute, *_minute_rows())


def active_users_1m(events: DataFrame) -> DataFrame:
    """Distinct users per minute without a distinct aggregate.

    State is small rows per (minute, user), spread over all partitions, and goes
    away with the watermark. A stream has no map-side step for duplicates, so a
    busy user's events are first thinned out in several tasks.
    """
    seen = events.select(
        F.window("timestamp", MINUTE).alias("window"), "user_id", salt("event_id").alias("salt")
    )
    per_minute = (
        seen.dropDuplicates(["window", "user_id", "salt"])
        .dropDuplicates(["window", "user_id"])
        .groupBy("window")
        .agg(F.count("user_id").alias("users"))
    )
    return to_metrics(per_minute, _users_row())


def _sliding(events: DataFrame, keys: list[str], totals: dict[str, Column]) -> DataFrame:
    """Sums over 5-minute windows that start every minute.

    A batch first adds up each minute, then gives the few minute rows to their
    five windows; rows are not copied five times. A stream cannot chain two
    aggregates in update mode and takes the sliding window directly.
    """
    if events.isStreaming:
        return _aggregate(
            events.groupBy(F.window("timestamp", FIVE_MINUTES, MINUTE), *keys), totals
        )
    minutes = _aggregate(events.groupBy(F.window("timestamp", MINUTE).alias("minute"), *keys), totals)
    return _aggregate(
        minutes.groupBy(F.window(F.col("minute.start"), FIVE_MINUTES, MINUTE), *keys),
        {name: F.sum(name) for name in totals},
    )


def _conversion_row() -> Column:
    rate = ratio(F.col("purchases"), F.col("clicks"))
    return metric_row("5m", "conversion_rate", rate)


def _cart_row() -> Column:
    rate = ratio(F.col("carts"), F.col("views"))
    return metric_row("5m", "add_to_cart_rate", rate)


def conversion_rate_5m(events: DataFrame) -> DataFrame:
    totals = {"purchases": count_type("purchase"), "clicks": count_type("click")}
    return to_metrics(_sliding(events, [], totals), _conversion_row())


def add_to_cart_rate_5m(events: DataFrame) -> DataFrame:
    totals = {"carts": count_type("add_to_cart"), "views": count_type("product_view")}
    return to_metrics(_sliding(events, [], totals), _cart_row())


def rates_5m(events: DataFrame) -> DataFrame:
    """Both rates from one aggregate."""
    totals = {
        "purchases": count_type("purchase"),
        "clicks": count_type("click"),
        "carts": count_type("add_to_cart"),
        "views": count_type("product_view"),
    }
    return to_metrics(_sliding(events, [], totals), _conversion_row(), _cart_row())


def time_on_page_5m(events: DataFrame) -> DataFrame:
    """Average seconds on page per category, over views and clicks that have them."""
    browsing = events.filter(
        is_type("product_view", "click") & F.col("time_on_page_sec").isNotNull()
    )
    totals = {"seconds": F.sum("time_on_page_sec"), "pages": F.count("time_on_page_sec")}
    grouped = _sliding(browsing, ["category"], totals)
    average = F.col("seconds") / F.col("pages")
    return to_metrics(
        grouped, metric_row("5m", "avg_time_on_page", average, "category", F.col("category"))
    )


def revenue_by_category_1h(events: DataFrame) -> DataFrame:
    grouped = (
        events.filter(is_type("purchase"))
        .groupBy(F.window("timestamp", HOUR), "category")
        .agg(F.sum(line_total()).alias("revenue"))
    )
    return to_metrics(
        grouped,
        metric_row("1h", "revenue_by_category", F.col("revenue"), "category", F.col("category")),
    )


def _product_metric(event_type: str) -> str:
    return f"product_{event_type}_count"


def product_counts_1h(events: DataFrame, event_type: str = "purchase") -> DataFrame:
    grouped = (
        events.filter(is_type(event_type))
        .groupBy(F.window("timestamp", HOUR), "sku")
        .agg(F.count("*").alias("n"))
    )
    return to_metrics(
        grouped, metric_row("1h", _product_metric(event_type), F.col("n"), "sku", F.col("sku"))
    )


def _breakdown_metric(dimension: str) -> str:
    return f"{dimension.removeprefix('user_')}_distribution"


def breakdown_1h(events: DataFrame, dimension: str = "user_segment") -> DataFrame:
    """Events per value of a dimension: user_segment, country or device."""
    grouped = events.groupBy(F.window("timestamp", HOUR), dimension).agg(F.count("*").alias("n"))
    return to_metrics(
        grouped,
        metric_row("1h", _breakdown_metric(dimension), F.col("n"), dimension, F.col(dimension)),
    )


def hourly_totals(events: DataFrame, dimensions: tuple[str, ...] = ("user_segment",)) -> DataFrame:
    """The sums behind all hourly metrics, from one read, one parse and one shuffle.

    Each event becomes one small row per metric it counts towards; map-side
    partial sums shrink them before the shuffle.
    """
    one = F.lit(1).cast(MONEY)

    def entry(name: str, key: str, column: str, amount: Column) -> Column:
        return F.struct(
            F.lit(name).alias("metric_name"),
            F.lit(key).alias("dimension_key"),
            F.coalesce(F.col(column), F.lit("")).alias("dimension_value"),
            amount.cast("decimal(29,2)").alias("amount"),
        )

    always = [entry(_breakdown_metric(d), d, d, one) for d in dimensions]
    purchase = [
        entry("revenue_by_category", "category", "category", line_total()),
        entry(_product_metric("purchase"), "sku", "sku", one),
    ]
    click = [entry(_product_metric("click"), "sku", "sku", one)]
    entries = F.when(is_type("purchase"), F.array(*always, *purchase)).when(
        is_type("click"), F.array(*always, *click)
    )
    if always:
        entries = entries.otherwise(F.array(*always))
    return (
        events.select("timestamp", F.inline(entries))
        .groupBy(F.window("timestamp", HOUR), "metric_name", "dimension_key", "dimension_value")
        .agg(F.sum("amount").alias("amount"))
    )


def hourly_metrics(events: DataFrame, dimensions: tuple[str, ...] = ("user_segment",)) -> DataFrame:
    """All hourly metrics."""
    return hourly_totals(events, dimensions).select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        F.lit("1h").alias("window_type"),
        "metric_name",
        F.col("amount").cast("double").alias("metric_value"),
        "dimension_key",
        "dimension_value",
    )


def all_metrics(events: DataFrame, plain: DataFrame | None = None) -> DataFrame:
    """The whole metric table of a batch of events.

    ``plain`` are the same events before they were joined with dimensions; the
    metrics without one then spare the joins.
    """
    plain = events if plain is None else plain
    return (
        summary_1m(plain)
        .unionByName(rates_5m(plain))
        .unionByName(time_on_page_5m(events))
        .unionByName(hourly_metrics(events))
    )


def _ranked(counts: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("window_start").orderBy(F.desc("metric_value"), "dimension_value")
    # The limit reaches every map task (partial group limit), so one window never
    # gathers more than k rows per task.
    return counts.withColumn("position", F.row_number().over(order)).filter(F.col("position") <= k)


def top_products_1h(events: DataFrame, k: int = 10, event_type: str = "purchase") -> DataFrame:
    """The k best products of each hour (batch, or closed windows)."""
    return _ranked(product_counts_1h(events, event_type), k)
