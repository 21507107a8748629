"""Schemas and fixed values shared by the streaming and the batch side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

# ---------------------------------------------------------------------------
# Names and codes that producers, stored tables and dashboards
# already use. They are data, not design.
# ---------------------------------------------------------------------------

VALID_EVENT_TYPES = (
    "page_view",
    "product_view",
    "search",
    "click",
    "add_to_cart",
    "remove_from_cart",
    "wishlist_add",
    "purchase",
    "review_submit",
)

# Event types the staging check accepts without a warning.
STAGING_EVENT_TYPES = (
    "click",
    "add_to_cart",
    "remove_from_cart",
    "purchase",
    "page_view",
    "search",
)

NULL_EVENT_ID = "Null Event ID"
NULL_USER_ID = "Null User ID"
INVALID_EVENT_TYPE = "Invalid Event Type"
NULL_TIMESTAMP = "Null Timestamp"

RAW_EVENTS_TOPIC = "raw-events"
METRICS_TOPIC = "aggregated-metrics"
DEAD_LETTER_TOPIC = "dead-letter-queue"

# Metrics without a dimension, i.e. the fields of the live KPI snapshot.
KPI_METRICS = (
    "events_1m",
    "active_users_1m",
    "revenue_1m",
    "click_1m",
    "cart_1m",
    "purchase_1m",
    "conversion_rate",
    "add_to_cart_rate",
)

# Metric name -> leaderboard it feeds.
LEADERBOARD_METRICS = {
    "product_purchase_count": "top:products:purchase",
    "product_click_count": "top:products:click",
    "product_revenue": "top:products:revenue",
}

SESSION_IDLE_SECONDS = 1800

# ---------------------------------------------------------------------------
# Schemas, as DDL
# ---------------------------------------------------------------------------

MONEY = "decimal(18,2)"

EVENT_JSON = """
    event_id STRING, event_type STRING, event_version STRING, session_id STRING,
    timestamp TIMESTAMP,
    user STRUCT<user_id: STRING, segment: STRING, country: STRING, city: STRING,
                device: STRING, os: STRING, language: STRING>,
    product STRUCT<product_id: STRING, sku: STRING, name: STRING, category: STRING,
                   subcategory: STRING, brand: STRING, sale_price: DOUBLE,
                   currency: STRING>,
    event_data STRUCT<quantity: INT, position_in_list: INT, time_on_page_sec: INT,
                      search_keyword: STRING, payment_method: STRING,
                      order_id: STRING, referrer: STRING>,
    metadata STRUCT<app_version: STRING, ip_address: STRING, user_agent: STRING,
                    screen_size: STRING>
"""

# Stored events: what the raw sink writes, partitioned by event_date.
RAW_EVENTS = f"""
    event_id STRING, event_type STRING, event_version STRING, timestamp TIMESTAMP,
    session_id STRING, user_id STRING, user_segment STRING, country STRING,
    device STRING, product_id STRING, category_name STRING, subcategory STRING,
    sale_price {MONEY}, currency STRING, quantity INT, referrer STRING,
    search_keyword STRING, position_in_list INT, time_on_page_sec INT,
    order_id STRING, ingested_at TIMESTAMP, event_date DATE
"""

USERS = """
    user_id STRING, username STRING, email STRING, full_name STRING, gender STRING,
    date_of_birth DATE, country STRING, city STRING, timezone STRING,
    preferred_device STRING, os STRING, preferred_language STRING,
    user_segment STRING, purchase_frequency STRING, price_sensitivity STRING,
    registered_at TIMESTAMP, is_active BOOLEAN, created_at TIMESTAMP
"""

PRODUCTS = f"""
    product_id STRING, sku STRING, product_name STRING, brand STRING,
    description STRING, image_url STRING, category_name STRING, subcategory STRING,
    tags STRING, original_price {MONEY}, sale_price {MONEY},
    discount_percent {MONEY}, stock_quantity INT, currency STRING,
    rating_avg {MONEY}, rating_count INT, is_available BOOLEAN,
    popularity_score INT, created_at TIMESTAMP, updated_at TIMESTAMP
"""

METRIC = """
    window_start TIMESTAMP, window_end TIMESTAMP, window_type STRING,
    metric_name STRING, metric_value DOUBLE, dimension_key STRING,
    dimension_value STRING
"""

METRIC_COLUMNS = (
    "window_start",
    "window_end",
    "window_type",
    "metric_name",
    "metric_value",
    "dimension_key",
    "dimension_value",
)

# A metric row is identified by these; the newest value wins.
METRIC_KEY = (
    "window_start",
    "window_type",
    "metric_name",
    "dimension_key",
    "dimension_value",
)


def ddl(schema: str) -> StructType:
    return StructType.fromDDL(schema)


def require_columns(df: DataFrame, schema: str, table: str) -> DataFrame:
    """Fail early, on the driver, when a table lacks a column or has another type."""
    found = {f.name: f.dataType.simpleString() for f in df.schema}
    problems = []
    for field in ddl(schema):
        want = field.dataType.simpleString()
        have = found.get(field.name)
        # Zoneless timestamps are accepted where zoned ones are declared.
        same = have == want or (want == "timestamp" and have == "timestamp_ntz")
        if not same:
            problems.append(f"{field.name}: expected {want}, found {have}")
    if problems:
        raise ValueError(f"table {table}: " + "; ".join(problems))
    return df.select(*[f.name for f in ddl(schema)])
