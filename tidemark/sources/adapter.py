"""Maps the supplied star-schema tables onto shop events, users and products.

The supplied ``events`` are not shop events, so the mapping is invented; the
oracle SQL repeats it. Dimension columns cost a join, so callers ask for them.
Table sizes decide between broadcast and shuffle; AQE splits hot join keys.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.joins import broadcast_if_small
from tidemark.schemas import MONEY
from tidemark.session import apply_settings, shared_dir
from tidemark.sources import files, streams

EVENTS = "event_id LONG, ts TIMESTAMP_NTZ, user_id LONG, event_type STRING, value DOUBLE, props STRING"
EVENT_COLUMNS = ("event_id", "ts", "user_id", "event_type", "value", "props")
MESSAGE = "value BINARY, timestamp TIMESTAMP"
_WIDTH = "spark.sql.shuffle.partitions"

_DEVICES = ("desktop", "mobile", "tablet")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _product_key() -> Column:
    return F.get_json_object("props", "$.k").cast("long")


def _event_type() -> Column:
    # Only views look into the JSON.
    kind = F.col("event_type")
    return (
        F.when(kind == "signup", "add_to_cart")
        .when((kind == "view") & (_product_key() % 2 == 0), "product_view")
        .when(kind == "view", "page_view")
        .otherwise(kind)
    )


def _map_events(raw: DataFrame, *more: str) -> DataFrame:
    """Event columns that need no dimension table, and others that are named."""
    typed = raw.withColumn("product_id", _product_key().cast("string")).withColumn(
        "event_type", _event_type()
    )
    kind, number = F.col("event_type"), F.col("event_id")
    return typed.select(
        F.col("event_id").cast("string").alias("event_id"),
        "event_type",
        F.lit("1.0").alias("event_version"),
        F.col("ts").alias("timestamp"),
        F.lit(None).cast("string").alias("session_id"),
        F.col("user_id").cast("string").alias("user_id"),
        "product_id",
        F.element_at(F.array(*map(F.lit, _DEVICES)), (F.pmod("user_id", F.lit(3)) + 1).cast("int")).alias("device"),
        F.col("value").cast(MONEY).alias("sale_price"),
        F.when(kind == "purchase", 1 + number % 5)
        .when(kind == "add_to_cart", 1 + number % 3)
        .otherwise(1)
        .cast("int")
        .alias("quantity"),
        F.when(kind.isin("product_view", "click"), 5 + number % 296)
        .cast("int")
        .alias("time_on_page_sec"),
        *more,
    )


def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as the users table."""
    places = _table(spark, sf_dir, "nation").join(
        _table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"), "left"
    )
    people = _table(spark, sf_dir, "customer").join(
        places, F.col("c_nationkey") == F.col("n_nationkey"), "left"
    )
    nothing = F.lit(None).cast("string")
    return people.select(
        F.col("c_custkey").cast("string").alias("user_id"),
        F.col("c_name").alias("username"),
        nothing.alias("email"),
        nothing.alias("full_name"),
        nothing.alias("gender"),
        F.lit(None).cast("date").alias("date_of_birth"),
        F.col("r_name").alias("country"),
        F.col("n_name").alias("city"),
        nothing.alias("timezone"),
        nothing.alias("preferred_device"),
        nothing.alias("os"),
        nothing.alias("preferred_language"),
        F.col("c_mktsegment").alias("user_segment"),
        nothing.alias("purchase_frequency"),
        nothing.alias("price_sensitivity"),
        F.lit(None).cast("timestamp").alias("registered_at"),
        (F.col("c_acctbal") >= 0).alias("is_active"),
        F.lit(None).cast("timestamp").alias("created_at"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the products table."""
    nothing = F.lit(None).cast("string")
    size = F.col("p_size")
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("product_id"),
        F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        nothing.alias("description"),
        nothing.alias("image_url"),
        F.col("p_type").alias("category_name"),
        nothing.alias("subcategory"),
        F.to_json(F.split("p_name", " ")).alias("tags"),
        F.col("p_retailprice").cast(MONEY).alias("original_price"),
        F.col("p_retailprice").cast(MONEY).alias("sale_price"),
        F.when(size % 5 != 0, size % 3 * 10).cast(MONEY).alias("discount_percent"),
        size.alias("stock_quantity"),
        nothing.alias("currency"),
        F.lit(None).cast(MONEY).alias("rating_avg"),
        F.lit(None).cast("int").alias("rating_count"),
        (size % 7 != 0).alias("is_available"),
        (size % 4).alias("popularity_score"),
        F.lit(None).cast("timestamp").alias("created_at"),
        F.lit(None).cast("timestamp").alias("updated_at"),
    )


def _add_dimensions(events: DataFrame, sf_dir: str, user: bool, product: bool) -> DataFrame:
    spark = events.sparkSession
    if user:
        columns = users(spark, sf_dir).select("user_id", "user_segment", "country", "city")
        customers = _table(spark, sf_dir, "customer")
        events = events.join(broadcast_if_small(columns, customers), "user_id", "left")
    if product:
        columns = products(spark, sf_dir).select(
            "product_id", "sku", F.col("category_name").alias("category"), "brand"
        )
        events = events.join(columns, "product_id", "left")
    for name in ("user_segment", "country", "city", "sku", "category", "brand"):
        if name not in events.columns:
            events = events.withColumn(name, F.lit(None).cast("string"))
    return events


def events(
    spark: SparkSession, sf_dir: str, user: bool = False, product: bool = False
) -> DataFrame:
    """Shop events before validation, flat."""
    apply_settings(spark)
    return _add_dimensions(_map_events(_table(spark, sf_dir, "events")), sf_dir, user, product)


def _payload(flat: DataFrame) -> DataFrame:
    """The flat events as the JSON messages a producer would have sent."""
    moment = F.concat(F.translate(F.col("timestamp").cast("string"), " ", "T"), F.lit("+00:00"))
    message = F.struct(
        "event_id",
        "event_type",
        "event_version",
        moment.alias("timestamp"),
        F.struct(
            "user_id", F.col("user_segment").alias("segment"), "country", "city", "device"
        ).alias("user"),
        F.struct("product_id", "sku", "category", "brand", "sale_price").alias("product"),
        F.struct("quantity", "time_on_page_sec").alias("event_data"),
    )
    return flat.select(
        F.to_json(message).cast("binary").alias("value"),
        F.col("timestamp").cast("timestamp").alias("timestamp"),
    )


def messages(
    spark: SparkSession, sf_dir: str, user: bool = False, product: bool = False
) -> DataFrame:
    return _payload(events(spark, sf_dir, user, product))


class Feed:
    """The supplied events as a producer would deliver them: pieces of time, one after the other.

    ``put`` writes the messages of a piece as ``files`` files, and a stream takes so
    many a micro-batch. So a piece is a batch at any size, windows close, state
    goes and batches follow each other. The producer joins what it knows of users
    and products once, before the first piece.
    ``late`` holds back every twentieth event of the first half for three pieces.
    ``sentinel`` adds one event of an unknown user long after the last.
    """

    PIECES = 6
    FILE_ROWS = 100_000

    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        user: bool = False,
        product: bool = False,
        late: bool = False,
        sentinel: bool = False,
    ):
        apply_settings(spark)
        self.spark = spark
        self.folder = shared_dir(spark, "feed")
        raw = _table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
        low, high, rows = raw.agg(F.min("ts"), F.max("ts"), F.count("*")).first()
        self.files = max(1, -(-rows // (self.PIECES * self.FILE_ROWS)))
        width = (high - low) / self.PIECES
        ends = [low + width * (i + 1) for i in range(self.PIECES - 1)]
        piece = F.lit(0)
        for end in ends:
            piece = piece + (F.col("ts") >= F.lit(end)).cast("int")
        if late:
            piece = piece + held_back(piece)
        known = lambda events: _add_dimensions(events, sf_dir, user, product)
        flat = known(_map_events(raw.withColumn("piece", piece), "piece"))
        produced = shared_dir(spark, "produced")
        flat.write.partitionBy("piece").parquet(produced)
        self.pieces = spark.read.schema(flat.schema).parquet(produced)
        # The sentinel is of no user and no product, so it needs no join.
        end = [(-1, high + timedelta(days=2), -1, "click", 0.0, "{}")]
        nobody = _add_dimensions(_map_events(spark.createDataFrame(end, EVENTS)), sf_dir, False, False)
        self.sentinel = nobody if sentinel else None

    def put(self, first: int = 0, last: int = PIECES - 1) -> None:
        for i in range(first, last + 1):
            self._deliver(self.pieces.filter(F.col("piece") == i).drop("piece"), self.files)
        if self.sentinel and last == self.PIECES - 1:
            self._deliver(self.sentinel, 1)

    def _deliver(self, events: DataFrame, count: int) -> None:
        """Messages as exactly ``count`` files. A task without rows writes none, so empty ones make up the number."""
        before = self._delivered()
        _payload(events.repartition(count)).write.mode("append").parquet(self.folder)
        for _ in range(before + count - self._delivered()):
            self.spark.createDataFrame([], MESSAGE).coalesce(1).write.mode("append").parquet(self.folder)

    def _delivered(self) -> int:
        return sum(name.startswith("part-") for name in files.children(self.spark, self.folder))

    def messages(self) -> DataFrame:
        return streams.read_events_stream(
            self.spark, "parquet", self.folder, maxFilesPerTrigger=str(self.files)
        )

    @contextmanager
    def state_width(self) -> Iterator[None]:
        """Streams started herein keep their state in as many stores as a batch has files, or the cluster cores.

        A stream's shuffle does not adapt to its batches, and every store costs a
        commit a batch, full or not. Fewer shuffle partitions than that stay as they are.
        """
        before = int(self.spark.conf.get(_WIDTH))
        self.spark.conf.set(_WIDTH, min(before, max(self.files, self.spark.sparkContext.defaultParallelism)))
        try:
            yield
        finally:
            self.spark.conf.set(_WIDTH, before)


def held_back(piece: Column) -> Column:
    """By how many pieces an event comes late."""
    return F.when((F.col("event_id") % 20 == 0) & (piece < Feed.PIECES // 2), 3).otherwise(0)


def delivered(spark: SparkSession, sf_dir: str, **feed: bool) -> Feed:
    """A feed that has put all of its pieces."""
    whole = Feed(spark, sf_dir, **feed)
    whole.put()
    return whole


def message_stream(spark: SparkSession, sf_dir: str, **feed: bool) -> DataFrame:
    """The messages as a stream of several micro-batches."""
    return delivered(spark, sf_dir, **feed).messages()
