"""Staging: cleaned events, users and products. No business logic here."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.operators.ingest import drop_repeats, is_valid


def stg_events(raw_events: DataFrame) -> DataFrame:
    """Valid events, one row per event id, typed and in snake case."""
    return drop_repeats(raw_events.filter(is_valid())).withColumn("search_keyword", F.lower("search_keyword"))


def stg_users(users: DataFrame) -> DataFrame:
    return users.withColumns(
        {
            "country": F.upper(F.trim("country")),
            "user_segment": F.lower(F.trim("user_segment")),
        }
    )


def stg_products(products: DataFrame) -> DataFrame:
    return products.withColumns(
        {
            "tags": F.from_json("tags", "array<string>"),
            "is_on_sale": F.coalesce(F.col("discount_percent") > 0, F.lit(False)),
        }
    )
