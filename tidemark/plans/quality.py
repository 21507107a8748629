"""Data checks. Results are rows; an error stops a run, a warning only reports."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import STAGING_EVENT_TYPES

ERROR, WARN = "error", "warn"


@dataclass(frozen=True)
class RowCheck:
    """Counts the rows for which ``bad`` holds."""

    column: str
    check: str
    bad: Column
    severity: str = ERROR


def not_null(column: str, severity: str = ERROR) -> RowCheck:
    return RowCheck(column, "not_null", F.col(column).isNull(), severity)


def accepted_values(column: str, values: tuple[str, ...], severity: str = ERROR) -> RowCheck:
    return RowCheck(column, "accepted_values", ~F.col(column).isin(*values), severity)


def non_negative(column: str, severity: str = WARN) -> RowCheck:
    return RowCheck(column, "non_negative", F.col(column) < 0, severity)


def valid_rate(column: str, severity: str = WARN) -> RowCheck:
    return RowCheck(column, "valid_rate", (F.col(column) < 0) | (F.col(column) > 1), severity)


def _result(table: str, column: str, check: str, severity: str, failures: Column) -> Column:
    return F.struct(
        F.lit(table).alias("table_name"),
        F.lit(column).alias("column_name"),
        F.lit(check).alias("check_name"),
        F.lit(severity).alias("severity"),
        F.coalesce(failures, F.lit(0)).cast("long").alias("failures"),
    )


def check_rows(df: DataFrame, table: str, checks: list[RowCheck]) -> DataFrame:
    """All row checks of a table in one pass."""
    counted = df.agg(*[F.count_if(c.bad).alias(f"c{i}") for i, c in enumerate(checks)])
    rows = [
        _result(table, c.column, c.check, c.severity, F.col(f"c{i}")) for i, c in enumerate(checks)
    ]
    return counted.select(F.inline(F.array(*rows)))


def check_unique(df: DataFrame, table: str, column: str, severity: str = ERROR) -> DataFrame:
    """Counts the values that occur more than once."""
    repeated = (
        df.filter(F.col(column).isNotNull()).groupBy(column).count().filter("count > 1")
    )
    result = _result(table, column, "unique", severity, F.col("n"))
    return repeated.agg(F.count("*").alias("n")).select(F.inline(F.array(result)))


def check_relationship(
    child: DataFrame,
    table: str,
    column: str,
    parent: DataFrame,
    parent_column: str,
    severity: str = ERROR,
) -> DataFrame:
    """Counts child rows whose key the parent lacks. Keys are counted before the join."""
    keys = child.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("key")).count()
    known = parent.select(F.col(parent_column).alias("key"))
    orphans = keys.join(known, "key", "left_anti").agg(F.sum("count").alias("n"))
    result = _result(table, column, "relationship", severity, F.col("n"))
    return orphans.select(F.inline(F.array(result)))


def combine(results: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, results)


class CheckFailed(RuntimeError):
    """A check of severity ``error`` found bad rows."""


def enforce(results: DataFrame) -> None:
    """Raise when an error-level check failed. The result has one row per check."""
    failed = results.filter((F.col("severity") == ERROR) & (F.col("failures") > 0)).collect()
    if failed:
        raise CheckFailed(
            "; ".join(f"{r.table_name}.{r.column_name} {r.check_name}: {r.failures}" for r in failed)
        )


def staging_checks(events: DataFrame, users: DataFrame, products: DataFrame) -> DataFrame:
    return combine(
        [
            check_rows(
                events,
                "stg_events",
                [
                    not_null("event_id"),
                    not_null("user_id"),
                    not_null("event_type"),
                    accepted_values("event_type", STAGING_EVENT_TYPES, WARN),
                ],
            ),
            check_rows(users, "stg_users", [not_null("user_id")]),
            check_unique(users, "stg_users", "user_id"),
            check_rows(products, "stg_products", [not_null("product_id")]),
            check_unique(products, "stg_products", "product_id"),
            check_relationship(events, "stg_events", "user_id", users, "user_id", WARN),
            check_relationship(events, "stg_events", "product_id", products, "product_id", WARN),
        ]
    )


def _mart_row_checks(mart: str) -> list[RowCheck]:
    return {
        "mart_daily_summary": [
            not_null("date"),
            non_negative("total_revenue"),
            valid_rate("conversion_rate"),
        ],
        "mart_product_performance": [
            not_null("product_id"),
            non_negative("revenue"),
            valid_rate("conversion_rate"),
        ],
        "mart_user_segments": [not_null("user_segment"), non_negative("revenue")],
        "mart_funnel_analysis": [
            not_null("category"),
            valid_rate("view_to_click_rate"),
            valid_rate("click_to_cart_rate"),
            valid_rate("cart_to_purchase_rate"),
        ],
        "mart_geo_revenue": [not_null("country"), non_negative("revenue")],
        "mart_hourly_kpi": [not_null("hour_start"), non_negative("revenue")],
    }[mart]


UNIQUE_IN_MART = {"mart_daily_summary": "date", "mart_hourly_kpi": "hour_start"}


def mart_checks(marts: dict[str, DataFrame]) -> DataFrame:
    results = []
    for name, df in marts.items():
        results.append(check_rows(df, name, _mart_row_checks(name)))
        if name in UNIQUE_IN_MART:
            results.append(check_unique(df, name, UNIQUE_IN_MART[name]))
    return combine(results)


def events_of_day(events: DataFrame, day: date) -> DataFrame:
    inside = (F.col("timestamp") >= F.lit(day)) & (
        F.col("timestamp") < F.lit(day + timedelta(days=1))
    )
    return events.filter((F.col("event_date") == F.lit(day)) & inside)


def day_has_events(events: DataFrame, day: date) -> DataFrame:
    """One row, ``ready``: are there events on ``day``?"""
    found = events_of_day(events, day).select(F.lit(1).alias("one")).limit(1)
    return found.agg((F.count("one") > 0).alias("ready"))
