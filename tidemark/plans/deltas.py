"""Marts that are kept up by what is new, not rebuilt.

Each increment of staged events adds its sums, by mart, date and member, and the
users it saw there. The sums of all increments add up to the marts, and users are
counted from the keys they left, so a late event changes its date, and nothing is
read of the events that were there before. An increment that is written again
replaces itself. Mean session lengths do not add up, so the segment mart is not
among them; its counts are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import count_type, ratio, revenue
from tidemark.streaming.batch_table import BatchTable

QUERY = "increments"
_TYPES = {
    "events": None,
    "page_views": "page_view",
    "product_views": "product_view",
    "clicks": "click",
    "carts": "add_to_cart",
    "purchases": "purchase",
}
# Mart -> the SQL of its members, which have a row each.
_MEMBERS = {
    "summary": "''",
    "product": "product_id",
    "category": "category_name",
    "segment": "user_segment",
    "hour": "CAST(date_trunc('hour', timestamp) AS STRING)",
}
# Marts that count users.
_WITH_USERS = ("summary", "segment", "hour")
_KEY = ("date", "mart", "member")


class MartSums(BatchTable):
    schema = "date DATE, mart STRING, member STRING, " + ", ".join(f"{n} LONG" for n in _TYPES) + ", revenue DECIMAL(38,2)"

    def day(self) -> Column:
        return F.col("date")

    def merge(self, rows: DataFrame) -> DataFrame:
        sums = [F.sum(n).cast("long").alias(n) for n in _TYPES]
        last = [F.max(c).alias(c) for c in ("run", "batch_id")]
        return rows.groupBy(*_KEY).agg(*sums, F.sum("revenue").cast("decimal(38,2)").alias("revenue"), *last)


class MartUsers(BatchTable):
    schema = "date DATE, mart STRING, member STRING, user_id STRING"

    def day(self) -> Column:
        return F.col("date")

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_KEY, "user_id").agg(*[F.max(c).alias(c) for c in ("run", "batch_id")])


def _by_mart(events: DataFrame, marts) -> DataFrame:
    """Each event once for each mart, with its member there."""
    entries = F.array(*(F.struct(F.lit(m).alias("mart"), F.expr(_MEMBERS[m]).alias("member")) for m in marts))
    return events.select(F.col("event_date").alias("date"), "event_type", "sale_price", "quantity", "user_id", F.inline(entries))


def sums_of(events: DataFrame) -> DataFrame:
    counts = [(F.count("*") if kind is None else count_type(kind)).alias(n) for n, kind in _TYPES.items()]
    return _by_mart(events, _MEMBERS).groupBy(*_KEY).agg(*counts, revenue().cast("decimal(38,2)").alias("revenue"))


def users_of(events: DataFrame) -> DataFrame:
    return _by_mart(events, _WITH_USERS).select(*_KEY, "user_id").distinct()


class DeltaMarts:
    """The marts of one installation. Increments come one after the other, by number."""

    def __init__(self, spark: SparkSession, root: str):
        self.sums = MartSums(spark, f"{root}/sums")
        self.users = MartUsers(spark, f"{root}/users")

    def add(self, events: DataFrame, number: int) -> None:
        """Take in staged events that were in no increment before; the same number again replaces them."""
        self.sums.batch_writer(QUERY)(sums_of(events), number)
        self.users.batch_writer(QUERY)(users_of(events), number)

    def upkeep(self) -> None:
        """Fold the increments; while no reader is at work."""
        for table in (self.sums, self.users):
            table.compact()
            table.vacuum()

    def _of(self, mart: str, first, last) -> DataFrame:
        return self.sums.current(first, last).filter(F.col("mart") == mart)

    def _counted(self, mart: str, name: str, first, last) -> DataFrame:
        users = self.users.current(first, last).filter(F.col("mart") == mart)
        counts = users.groupBy("date", "member").agg(F.count("user_id").alias(name))
        sums = self._of(mart, first, last).alias("s")
        same = (F.col("s.date") == F.col("u.date")) & F.col("s.member").eqNullSafe(F.col("u.member"))
        return sums.join(counts.alias("u"), same, "left").select("s.*", F.coalesce(name, F.lit(0)).cast("long").alias(name))

    def daily_summary(self, first=None, last=None) -> DataFrame:
        total = F.col("revenue").cast("double")
        return self._counted("summary", "unique_users", first, last).select(
            "date",
            F.col("events").alias("total_events"),
            F.col("purchases").alias("total_purchases"),
            total.alias("total_revenue"),
            "unique_users",
            ratio(F.col("purchases"), F.col("clicks")).alias("conversion_rate"),
            ratio(total, F.col("purchases")).alias("avg_order_value"),
        )

    def product_performance(self, products: DataFrame, first=None, last=None) -> DataFrame:
        names = products.select("product_id", "product_name", F.col("category_name").alias("category"))
        sums = self._of("product", first, last).filter(F.col("member").isNotNull()).withColumnRenamed("member", "product_id")
        return sums.join(names, "product_id", "left").select(
            "date",
            "product_id",
            "product_name",
            "category",
            F.col("product_views").alias("view_count"),
            F.col("clicks").alias("click_count"),
            F.col("carts").alias("cart_count"),
            F.col("purchases").alias("purchase_count"),
            F.col("revenue").cast("double").alias("revenue"),
            ratio(F.col("purchases"), F.col("clicks")).alias("conversion_rate"),
        )

    def funnel_analysis(self, first=None, last=None) -> DataFrame:
        stages = {"page_views": "page_view_count", "product_views": "product_view_count", "clicks": "click_count", "carts": "add_to_cart_count", "purchases": "purchase_count"}
        return self._of("category", first, last).select(
            "date",
            F.col("member").alias("category"),
            *(F.col(n).alias(stage) for n, stage in stages.items()),
            ratio(F.col("clicks"), F.col("product_views")).alias("view_to_click_rate"),
            ratio(F.col("carts"), F.col("clicks")).alias("click_to_cart_rate"),
            ratio(F.col("purchases"), F.col("carts")).alias("cart_to_purchase_rate"),
        )

    def segment_counts(self, first=None, last=None) -> DataFrame:
        return self._counted("segment", "user_count", first, last).select(
            "date",
            F.col("member").alias("user_segment"),
            "user_count",
            F.col("events").alias("event_count"),
            F.col("purchases").alias("purchase_count"),
            F.col("revenue").cast("double").alias("revenue"),
        )

    def hourly_kpi(self, first=None, last=None) -> DataFrame:
        return self._counted("hour", "active_users", first, last).select(
            F.col("member").cast("timestamp").alias("hour_start"),
            F.col("events").alias("total_events"),
            "purchases",
            F.col("revenue").cast("double").alias("revenue"),
            "active_users",
        )
