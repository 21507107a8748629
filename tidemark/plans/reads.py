"""Read queries of the live dashboard and the reports.

Metric functions take the current metric rows (one per key); report functions
take a mart. Wherever several rows share the sort key, the other key columns
break the tie.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.columns import revenue
from tidemark.schemas import KPI_METRICS, LEADERBOARD_METRICS, METRIC_KEY


def _newest_first() -> list[Column]:
    rest = [c for c in METRIC_KEY if c != "window_start"]
    return [F.desc("window_start"), *[F.col(c) for c in rest]]


def kpi_snapshot(metrics: DataFrame) -> DataFrame:
    """The newest value of every KPI without a dimension; null counts as 0.0."""
    return (
        metrics.filter(F.col("metric_name").isin(*KPI_METRICS))
        .groupBy("metric_name")
        .agg(F.max_by("metric_value", "window_start").alias("metric_value"))
        .select("metric_name", F.coalesce("metric_value", F.lit(0.0)).alias("metric_value"))
    )


def leaderboards(metrics: DataFrame) -> DataFrame:
    """Score of each product: its count in the newest hour it was seen in."""
    board = F.coalesce(
        *[F.when(F.col("metric_name") == m, F.lit(b)) for m, b in LEADERBOARD_METRICS.items()]
    )
    return (
        metrics.filter(F.col("metric_name").isin(*LEADERBOARD_METRICS))
        .filter((F.col("dimension_key") == "sku") & (F.col("dimension_value") != ""))
        .groupBy(board.alias("leaderboard"), F.col("dimension_value").alias("member"))
        .agg(F.max_by("metric_value", "window_start").alias("score"))
    )


def top_products(boards: DataFrame, metric: str = "click", n: int = 10) -> DataFrame:
    """Best of a board; equal scores in descending order of the product."""
    return (
        boards.filter(F.col("leaderboard") == f"top:products:{metric}")
        .orderBy(F.desc("score"), F.desc("member"))
        .limit(n)
        .select(F.col("member").alias("product_id"), "score")
    )


def timeseries(
    metrics: DataFrame,
    window_type: str = "1m",
    start: str | None = None,
    end: str | None = None,
    limit: int = 100,
) -> DataFrame:
    """Newest rows of a window type. The range counts only when both ends are given.

    ``MetricTable.current(first, last)`` gives the rows of a range without
    reading the folders of other dates.
    """
    rows = metrics.filter(F.col("window_type") == window_type)
    if start and end:
        low, high = datetime.fromisoformat(start), datetime.fromisoformat(end)
        rows = rows.filter(F.col("window_start").between(F.lit(low), F.lit(high)))
    return (
        rows.orderBy(*_newest_first())
        .limit(limit)
        .select("window_start", "metric_name", "metric_value", "dimension_key", "dimension_value")
    )


def breakdown(metrics: DataFrame, dimension: str, limit: int = 100) -> DataFrame:
    return (
        metrics.filter(F.col("dimension_key") == dimension)
        .orderBy(*_newest_first())
        .limit(limit)
        .select("window_start", "metric_name", "metric_value", "dimension_value")
    )


def newest_report(mart: DataFrame, keys: list[str], limit: int) -> DataFrame:
    """The newest rows of a mart: daily (30), funnel (30) and products (100) reports."""
    return mart.orderBy(F.desc("date"), *keys).limit(limit)


def live_chart(
    metrics: DataFrame, start: datetime | None = None, end: datetime | None = None
) -> DataFrame:
    """One row per minute with click, purchase and revenue columns."""
    rows = metrics.filter(F.col("window_type") == "1m")
    if start is not None and end is not None:
        rows = rows.filter((F.col("window_start") >= F.lit(start)) & (F.col("window_start") < F.lit(end)))
    names = ["click_1m", "purchase_1m", "revenue_1m"]
    return (
        rows.filter(F.col("metric_name").isin(*names))
        .groupBy("window_start")
        .pivot("metric_name", names)
        .agg(F.max("metric_value"))
        .select(
            "window_start",
            *[
                F.coalesce(old, F.lit(0.0)).alias(new)
                for old, new in zip(names, ["click_count", "purchase_count", "revenue"])
            ],
        )
    )


def rolling_volume(metrics: DataFrame, minutes: int = 30) -> DataFrame:
    """Click, cart and purchase volume of the newest minutes, by the newest window."""
    names = {"click_1m": "click", "cart_1m": "add_to_cart", "purchase_1m": "purchase"}
    rows = metrics.filter(F.col("metric_name").isin(*names))
    newest = rows.agg(F.max("window_start")).scalar()
    recent = rows.filter(
        F.col("window_start") > newest - F.make_dt_interval(mins=F.lit(minutes))
    )
    return (
        recent.groupBy("window_start")
        .pivot("metric_name", list(names))
        .agg(F.max("metric_value"))
        .select(
            "window_start",
            *[F.coalesce(old, F.lit(0.0)).alias(new) for old, new in names.items()],
        )
    )


def event_rate(metrics: DataFrame) -> DataFrame:
    """Events per second of each minute, one decimal."""
    return metrics.filter(F.col("metric_name") == "events_1m").select(
        "window_start", F.round(F.floor("metric_value") / 60, 1).alias("events_per_sec")
    )


def kpi_cards(snapshot: DataFrame) -> DataFrame:
    """Whole numbers for the KPI cards; total events fall back to clicks."""

    def value(name: str) -> Column:
        return F.max(F.when(F.col("metric_name") == name, F.col("metric_value")))

    shown = snapshot.agg(
        value("events_1m").alias("events"),
        value("click_1m").alias("clicks"),
        value("active_users_1m").alias("users"),
        value("revenue_1m").alias("revenue"),
        value("purchase_1m").alias("purchases"),
    )

    def whole(*choices: Column) -> Column:
        return F.floor(F.coalesce(*choices, F.lit(0.0)))

    return shown.select(
        whole(F.nullif("events", F.lit(0.0)), F.col("clicks")).alias("total_events"),
        whole(F.col("users")).alias("active_users"),
        whole(F.col("revenue")).alias("revenue"),
        whole(F.col("purchases")).alias("purchases"),
    )


def kpi_now(metrics: DataFrame) -> DataFrame:
    """One row: users of the last five minutes, revenue of the day, conversion of five minutes."""
    newest = {
        "active_users_5m": "active_users",
        "revenue_1d": "revenue_today",
        "conversion_rate": "conversion_rate",
    }
    named = F.col("metric_name")
    return metrics.filter(named.isin(*newest)).agg(
        *[
            F.coalesce(
                F.max_by("metric_value", F.when(named == metric, F.col("window_start"))), F.lit(0.0)
            ).alias(shown)
            for metric, shown in newest.items()
        ]
    )


def daily_revenue_series(daily: DataFrame, days: int = 30) -> DataFrame:
    """Revenue in thousands per day of the daily report, oldest first."""
    return (
        newest_report(daily, [], days)
        .orderBy("date")
        .select(
            F.date_format("date", "MM-dd").alias("label"),
            (F.col("total_revenue") / 1000).alias("revenue_k"),
        )
    )


def kpi_change(metrics: DataFrame) -> DataFrame:
    """Percent change of each metric against the window just before.

    An equi-join on the window before, so all windows of a metric are compared
    at once; a window without one before it has no change.
    """
    keys = ["window_start", "window_type", "metric_name", "dimension_key", "dimension_value"]
    # Sliding windows start every minute, the others when the last one ends.
    step = F.when(F.col("window_type") == "5m", F.expr("INTERVAL 1 MINUTE")).otherwise(
        F.col("window_end") - F.col("window_start")
    )
    before = metrics.select(
        (F.col("window_start") + step).alias("window_start"),
        *keys[1:],
        F.col("metric_value").alias("previous_value"),
    )
    change = F.when(
        F.col("previous_value") != 0,
        (F.col("metric_value") - F.col("previous_value")) / F.abs("previous_value") * 100.0,
    )
    return metrics.join(before, keys, "left").select(
        *keys, "metric_value", "previous_value", change.alias("change_percent")
    )


def rank_change(product_counts: DataFrame, k: int = 10) -> DataFrame:
    """The k best products per hour and how their rank moved since the hour before.

    Products with equal counts share a rank. The earlier rank of a product that
    was not among the best then still counts: it is read from a histogram of the
    counts, so no hour's whole ranking is ever sorted in one place.
    """
    counts = product_counts.select(
        "window_start",
        F.col("dimension_value").alias("sku"),
        F.col("metric_value").alias("n"),
    )
    hour = Window.partitionBy("window_start")
    best = (
        counts.withColumn("position", F.row_number().over(hour.orderBy(F.desc("n"), "sku")))
        .filter(F.col("position") <= k)
        .withColumn("rank", F.rank().over(hour.orderBy(F.desc("n"))))
    )
    ahead = F.sum("products").over(
        hour.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        counts.groupBy("window_start", "n")
        .agg(F.count("*").alias("products"))
        .select(
            F.col("window_start").alias("earlier"),
            F.col("n").alias("earlier_n"),
            (F.coalesce(ahead, F.lit(0)) + 1).alias("previous_rank"),
        )
    )
    before = counts.select(
        F.col("window_start").alias("earlier"), "sku", F.col("n").alias("earlier_n")
    )
    return (
        best.withColumn("earlier", F.col("window_start") - F.make_dt_interval(hours=F.lit(1)))
        .join(before, ["earlier", "sku"], "left")
        .join(ranks, ["earlier", "earlier_n"], "left")
        .select(
            "window_start",
            "sku",
            F.col("n").alias("purchase_count"),
            "position",
            "rank",
            "previous_rank",
            (F.col("previous_rank") - F.col("rank")).alias("rank_change"),
        )
    )


def week_over_week(daily: DataFrame) -> DataFrame:
    """Daily KPIs beside those of the same day a week before; days may be missing."""
    compared = ["total_events", "total_purchases", "total_revenue", "unique_users"]
    before = daily.select(
        F.date_add("date", 7).alias("date"),
        *[F.col(c).alias(f"{c}_last_week") for c in compared],
    )

    def change(name: str) -> Column:
        old = F.col(f"{name}_last_week").cast("double")
        return F.when(old != 0, (F.col(name) - old) / old * 100.0).alias(f"{name}_wow")

    return daily.join(before, "date", "left").select(
        "date",
        *compared,
        *[f"{c}_last_week" for c in compared],
        *[change(c) for c in compared],
    )


def revenue_by_hour_of_day(events: DataFrame) -> DataFrame:
    return events.groupBy(F.hour("timestamp").alias("hour_of_day")).agg(
        revenue().cast("double").alias("revenue")
    )
