"""The best products of an hour as a stream, with state of bounded size.

The state of an hour is a sketch of frequent items, not a counter for each
product. A sketch that tracks m items overestimates no item and underestimates
none by more than ``error_bound(m)`` of the hour's events; as long as an hour has
no more than m different products, the counts are exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators.metrics import HOUR
from tidemark.streaming import sinks
from tidemark.streaming.batch_table import BatchTable

TRACKED = 1000
K = 10
TOP = "window_start TIMESTAMP, sku STRING, purchase_count LONG, position INT"


def error_bound(tracked: int = TRACKED) -> float:
    """The largest error of a count, as a part of the hour's events.

    The sketch is a hash map of a power of two of which three quarters are used;
    its error is 3.5 divided by the size of the map.
    """
    return 3.5 / 2 ** (max(8, -(-tracked * 4 // 3)) - 1).bit_length()


def hourly_sketches(events: DataFrame, event_type: str = "purchase", tracked: int = TRACKED) -> DataFrame:
    """(window, items): a sketch of the products of each hour; of a stream, its state.

    Other events pass by inside the aggregate: a filter would be moved below the
    watermark, which only purchases would then advance.
    """
    counted = f"approx_top_k_accumulate(coalesce(sku, ''), {tracked}) FILTER (WHERE event_type = '{event_type}')"
    return events.groupBy(F.window("timestamp", HOUR)).agg(F.expr(counted).alias("items"))


def ranked(sketches: DataFrame, k: int = K, tracked: int = TRACKED) -> DataFrame:
    """The k best products of each hour; equal counts go by name.

    All tracked items are ranked, so that the order of equals does not depend on
    the sketch; an hour has at most ``tracked`` rows here.
    """
    items = sketches.select(F.col("window.start").alias("window_start"), F.explode(F.expr(f"approx_top_k_estimate(items, {tracked})")).alias("i"))
    place = Window.partitionBy("window_start").orderBy(F.desc("i.count"), "i.item")
    return (
        items.withColumn("position", F.row_number().over(place))
        .filter(F.col("position") <= k)
        .select("window_start", F.col("i.item").alias("sku"), F.col("i.count").alias("purchase_count"), "position")
    )


class TopProducts(BatchTable):
    """The boards of closed hours; each hour is written once."""

    schema = TOP

    def day(self):
        return F.to_date("window_start")

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows


def start_top_products(
    clean: DataFrame,
    table: TopProducts,
    checkpoint: str,
    trigger: sinks.Trigger = sinks.Trigger(),
    run: int = 0,
    k: int = K,
    tracked: int = TRACKED,
) -> StreamingQuery:
    """Write the board of each hour when the watermark has passed it."""
    write = table.batch_writer("top_products", run)
    sketches = hourly_sketches(clean, tracked=tracked)
    writer = sketches.writeStream.outputMode("append").foreachBatch(lambda batch, n: write(ranked(batch, k, tracked), n))
    return sinks._start(writer, "top_products", checkpoint, trigger)
