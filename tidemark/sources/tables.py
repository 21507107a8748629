"""Batch tables: stored events, users and products, with the two catalog scans."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import PRODUCTS, RAW_EVENTS, USERS, require_columns
from tidemark.streaming.event_store import EventStore


@dataclass(frozen=True)
class Tables:
    """Where the tables of one installation lie."""

    root: str

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def read_raw_events(spark: SparkSession, tables: Tables) -> DataFrame:
    """The stored events: of the event store where there is one, else of the folder the raw sink writes."""
    if EventStore.exists_at(spark, tables.path("event_store")):
        return require_columns(EventStore(spark, tables.path("event_store")).current(), RAW_EVENTS, "event_store")
    found = spark.read.schema(RAW_EVENTS).parquet(tables.path("raw_events"))
    return require_columns(found, RAW_EVENTS, "raw_events")


def read_users(spark: SparkSession, tables: Tables) -> DataFrame:
    return require_columns(spark.read.parquet(tables.path("users")), USERS, "users")


def read_products(spark: SparkSession, tables: Tables) -> DataFrame:
    return require_columns(spark.read.parquet(tables.path("products")), PRODUCTS, "products")


def active_users(users: DataFrame) -> DataFrame:
    return users.filter("is_active").select(
        F.col("user_id").cast("string").alias("user_id"),
        "username",
        "user_segment",
        "country",
        "city",
        "preferred_device",
        "os",
        "preferred_language",
        "is_active",
    )


def available_products(products: DataFrame) -> DataFrame:
    """Missing prices become 0.0; missing or zero popularity becomes 1."""
    popularity = F.col("popularity_score").cast("int")
    return products.filter("is_available").select(
        F.col("product_id").cast("string").alias("product_id"),
        "sku",
        "product_name",
        "brand",
        "category_name",
        "subcategory",
        F.coalesce(F.col("sale_price").cast("double"), F.lit(0.0)).alias("sale_price"),
        "currency",
        F.coalesce(F.nullif(popularity, F.lit(0)), F.lit(1)).alias("popularity_score"),
    )
