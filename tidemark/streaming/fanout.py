"""All sinks from one read of the topic.

One query takes each micro-batch, parses it once, and hands it to writers that
overwrite what they wrote of the batch before: the event store, the dead letters,
the sums, the minute rollup, and the metrics. If the job dies between two of them, the batch is
taken again as a whole and every writer ends with the same rows.

No operator keeps state. What a batch adds to each minute and hour is written as
sums; sums of all batches add up to the value of a window, and a batch writes the
metrics of the windows it touched. So an event that comes late, however late, is
in its windows after the batch it came with; there is no watermark. Sums of a
batch and of all before it are the same rows in a replay, since a batch never
sees the sums of a later one.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.storagelevel import StorageLevel

from tidemark.functions.columns import count_type, is_type, line_total, ratio, revenue
from tidemark.operators import metrics as m
from tidemark.operators.ingest import PAYLOAD, flatten, is_valid, parse, validate
from tidemark.plans.rollups import MinuteRollup, rollup_minutes
from tidemark.schemas import METRIC_COLUMNS
from tidemark.sources import files
from tidemark.streaming import sinks
from tidemark.streaming.batch_table import BatchTable, adaptive
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable

QUERY = "fanout"
# After so many batches the sums are folded, so that a batch reads few folders.
COMPACT_EVERY = 50

_SUM_KEY = ("window_start", "window_type", "name", "dimension_key", "dimension_value")
_FIVE = range(5)


class Sums(BatchTable):
    """What the events of each window add up to, by name and dimension."""

    schema = "window_start TIMESTAMP, window_type STRING, name STRING, dimension_key STRING, dimension_value STRING, amount DECIMAL(38,2)"

    def day(self) -> Column:
        return F.to_date("window_start")

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*_SUM_KEY).agg(
            F.sum("amount").cast("decimal(38,2)").alias("amount"), F.max("run").alias("run"), F.max("batch_id").alias("batch_id")
        )


class MinuteUsers(BatchTable):
    """The users of each minute, once."""

    schema = "window_start TIMESTAMP, user_id STRING"

    def day(self) -> Column:
        return F.to_date("window_start")

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy("window_start", "user_id").agg(F.max("run").alias("run"), F.max("batch_id").alias("batch_id"))


class DeadLetters(BatchTable):
    """Dead letters with their reason and the message as it came."""

    schema = f"event_id STRING, event_type STRING, user_id STRING, timestamp TIMESTAMP, kafka_timestamp TIMESTAMP, error_reason STRING, {PAYLOAD} STRING"

    def day(self) -> Column:
        return F.to_date("kafka_timestamp")

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows


def sums_of(events: DataFrame) -> DataFrame:
    """The sums of some events: minutes as a whole, minutes by category, hours."""
    minute = F.window("timestamp", m.MINUTE)

    def entry(name: str, amount: Column, key: str = "", member: Column | None = None) -> Column:
        value = F.coalesce(member if member is not None else F.lit(""), F.lit(""))
        return F.struct(
            F.lit(name).alias("name"), F.lit(key).alias("dimension_key"), value.alias("dimension_value"), amount.cast("decimal(38,2)").alias("amount")
        )

    totals = {
        "events": F.count("*"),
        "revenue": revenue(),
        "clicks": count_type("click"),
        "carts": count_type("add_to_cart"),
        "purchases": count_type("purchase"),
        "views": count_type("product_view"),
    }
    minutes = events.groupBy(minute).agg(*[v.alias(k) for k, v in totals.items()])
    plain = minutes.select(F.col("window.start").alias("window_start"), F.lit("1m").alias("window_type"), F.inline(F.array(*(entry(k, F.col(k)) for k in totals))))
    browsing = events.filter(is_type("product_view", "click") & F.col("time_on_page_sec").isNotNull())
    pages = browsing.groupBy(minute, "category").agg(F.sum("time_on_page_sec").alias("page_seconds"), F.count("*").alias("pages"))
    by_category = pages.select(
        F.col("window.start").alias("window_start"),
        F.lit("1m").alias("window_type"),
        F.inline(F.array(*(entry(k, F.col(k), "category", F.col("category")) for k in ("page_seconds", "pages")))),
    )
    hours = m.hourly_totals(events).select(
        F.col("window.start").alias("window_start"),
        F.lit("1h").alias("window_type"),
        F.col("metric_name").alias("name"),
        "dimension_key",
        "dimension_value",
        F.col("amount").cast("decimal(38,2)").alias("amount"),
    )
    return plain.unionByName(by_category).unionByName(hours)


def minute_users_of(events: DataFrame) -> DataFrame:
    return events.select(F.window("timestamp", m.MINUTE)["start"].alias("window_start"), "user_id").distinct()


_WHOLE = ("events", "revenue", "clicks", "carts", "purchases", "views", "users")
_PAGES = ("page_seconds", "pages")


def _minute_of(moment: str) -> Column:
    return F.date_trunc("minute", moment)


def _windows_of(minute: Column) -> Column:
    """The windows a minute is part of: itself, five of five minutes, its hour."""

    def window(kind: str, start: Column) -> Column:
        return F.struct(F.lit(kind).alias("window_type"), start.alias("window_start"))

    slid = [window("5m", minute - F.expr(f"INTERVAL {i} MINUTE")) for i in _FIVE]
    return F.array(window("1m", minute), *slid, window("1h", F.date_trunc("hour", minute)))


def metrics_of(sums: DataFrame, users: DataFrame, touched: DataFrame) -> DataFrame:
    """The metrics of the windows that hold a touched minute.

    ``touched`` has the minutes as ``window_start``; ``sums`` and ``users`` at least
    those minutes, the four on either side, and the hours. Every sum goes to its
    windows, and one aggregate has all that a window's metrics are made of.
    """
    counted = users.groupBy("window_start").agg(F.count("user_id").cast("decimal(38,2)").alias("amount"))
    blank = F.lit("")
    rows = sums.select(*_SUM_KEY, "amount").unionByName(
        counted.select("window_start", F.lit("1m").alias("window_type"), F.lit("users").alias("name"), blank.alias("dimension_key"), blank.alias("dimension_value"), "amount")
    )
    hour = F.array(F.struct(F.lit("1h").alias("window_type"), F.col("window_start").alias("window_start")))
    targets = F.when(F.col("window_type") == "1h", hour).otherwise(F.filter(_windows_of(F.col("window_start")), lambda w: w["window_type"] != "1h"))
    placed = rows.select(targets.alias("targets"), "name", "dimension_key", "dimension_value", "amount").select(F.inline("targets"), "name", "dimension_key", "dimension_value", "amount")
    windows = touched.select(F.inline(_windows_of(F.col("window_start")))).distinct()
    # The name tells hourly metrics apart; the sums of a minute go together.
    hourly = F.when(F.col("window_type") == "1h", F.col("name")).otherwise(blank).alias("hourly")
    amount = lambda n: F.coalesce(F.sum(F.when(F.col("name") == n, F.col("amount"))), F.lit(0)).alias(n)
    grouped = (
        placed.join(windows, ["window_type", "window_start"], "left_semi")
        .groupBy("window_type", "window_start", hourly, "dimension_key", "dimension_value")
        .agg(F.sum("amount").alias("amount"), *(amount(n) for n in (*_WHOLE, *_PAGES)))
    )

    def metric(name: Column, value: Column, key: Column = blank, member: Column = blank) -> Column:
        return F.struct(name.alias("metric_name"), value.cast("double").alias("metric_value"), key.alias("dimension_key"), member.alias("dimension_value"))

    minute = [
        metric(F.lit(name), F.col(column), F.lit(key))
        for name, column, key in (
            ("events_1m", "events", "events"),
            ("revenue_1m", "revenue", "revenue"),
            ("click_1m", "clicks", "click"),
            ("cart_1m", "carts", "add_to_cart"),
            ("purchase_1m", "purchases", "purchase"),
            ("active_users_1m", "users", "users"),
        )
    ]
    whole = {n: F.col(n).cast("long") for n in (*_WHOLE, *_PAGES)}
    rates = [
        metric(F.lit("conversion_rate"), ratio(whole["purchases"], whole["clicks"])),
        metric(F.lit("add_to_cart_rate"), ratio(whole["carts"], whole["views"])),
    ]
    by_category = F.col("dimension_key") == "category"
    average = whole["page_seconds"] / F.nullif(whole["pages"], F.lit(0))
    kind = F.col("window_type")
    made = (
        F.when(kind == "1h", F.array(metric(F.col("hourly"), F.col("amount"), F.col("dimension_key"), F.col("dimension_value"))))
        .when((kind == "5m") & by_category, F.array(metric(F.lit("avg_time_on_page"), average, F.lit("category"), F.col("dimension_value"))))
        .when(kind == "5m", F.array(*rates))
        .when(~by_category, F.array(*minute))
    )
    width = F.when(kind == "1m", F.expr("INTERVAL 1 MINUTE")).when(kind == "5m", F.expr("INTERVAL 5 MINUTE")).otherwise(F.expr("INTERVAL 1 HOUR"))
    return grouped.select("window_type", "window_start", (F.col("window_start") + width).alias("window_end"), F.inline(made)).select(*METRIC_COLUMNS)


class FanOut:
    """The writers of one installation, called once a micro-batch."""

    def __init__(self, spark: SparkSession, layout, publish: tuple[str, str] | None = None, compact_every: int = COMPACT_EVERY):
        run = layout.run
        self.publish = publish
        self.compact_every = compact_every
        self.store = EventStore(spark, layout.event_store)
        self.dead = DeadLetters(spark, layout.dead_letter_store)
        self.sums = Sums(spark, layout.sums)
        self.users = MinuteUsers(spark, layout.minute_users)
        self.metrics = MetricTable(spark, layout.metrics)
        self.rollup = MinuteRollup(spark, layout.rollup)
        tables = {"store": self.store, "dead": self.dead, "sums": self.sums, "users": self.users, "rollup": self.rollup, "metrics": self.metrics}
        self.write = {name: table.batch_writer(QUERY, run) for name, table in tables.items()}

    def __call__(self, messages: DataFrame, batch_id: int) -> None:
        """Write what a batch of messages gives to every place.

        The parsed rows are kept until the last writer is through; what an
        executor loses of them is read and parsed again.
        """
        # Of the whole batch at once: the writers beside each other share the session.
        with adaptive(messages.sparkSession):
            self._take(messages, batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            # Nobody but this query reads the sums, so what they replace may go at once.
            for table in (self.sums, self.users):
                table.compact()
                table.vacuum()

    def _take(self, messages: DataFrame, batch_id: int) -> None:
        parsed = validate(flatten(parse(messages, payload=True, unknown=True)))
        rows = parsed.withColumn(PAYLOAD, F.when(F.col("error_reason").isNotNull(), F.col(PAYLOAD)))
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            clean, dead = rows.filter(is_valid()), rows.filter("error_reason IS NOT NULL")
            days = Observation()
            dated = clean.observe(days, F.collect_set(F.to_date("timestamp")).alias("days"))
            # The first write parses and keeps the rows; the others do not wait for each other.
            n = self.write["store"](dated, batch_id)
            beside = {"dead": dead, "sums": sums_of(clean), "users": minute_users_of(clean), "rollup": rollup_minutes(clean)}
            with ThreadPoolExecutor(len(beside)) as pool:
                for done in [pool.submit(self.write[name], out, batch_id) for name, out in beside.items()]:
                    done.result()
            touched = clean.select(_minute_of("timestamp").alias("window_start")).distinct()
            metrics = self._metrics(touched, days.get["days"]) if n else self.metrics._empty()
            self.write["metrics"](metrics, batch_id)
            if self.publish:
                self._send(metrics, dead, batch_id)
        finally:
            rows.unpersist()

    def _metrics(self, touched: DataFrame, days: list[date]) -> DataFrame:
        around = {d + timedelta(days=n) for d in days for n in (-1, 0, 1)}
        return metrics_of(self.sums.on_dates(around), self.users.on_dates(around), touched)

    def _send(self, metrics: DataFrame, dead: DataFrame, batch_id: int) -> None:
        kind, location = self.publish
        outgoing = {sinks.METRICS_TOPIC: sinks.encode_metrics(metrics), sinks.DEAD_LETTER_TOPIC: sinks.encode_dead_letters(dead)}
        for topic, encoded in outgoing.items():
            if kind == "kafka":
                encoded.write.format("kafka").option("kafka.bootstrap.servers", location).option("topic", topic).save()
            else:
                encoded.write.mode("overwrite").text(f"{location}/{topic}/batch_id={batch_id}")


def start_fanout(
    spark: SparkSession,
    messages: DataFrame,
    layout,
    trigger: sinks.Trigger = sinks.Trigger(),
    publish: tuple[str, str] | None = None,
    compact_every: int = COMPACT_EVERY,
) -> StreamingQuery:
    """One query that writes the event store, the dead letters and all metrics."""
    if publish and publish[0] not in ("kafka", "json"):
        raise ValueError(f"unknown message kind: {publish[0]}")
    each = FanOut(spark, layout, publish, compact_every)
    writer = messages.writeStream.outputMode("append").foreachBatch(each)
    return sinks._start(writer, QUERY, layout.checkpoint(QUERY), trigger)


def upkeep(spark: SparkSession, layout) -> None:
    """Pack the event store, the dead letters, the rollup and the metrics, and drop what is replaced; while no reader is at work."""
    kept = (
        EventStore(spark, layout.event_store),
        DeadLetters(spark, layout.dead_letter_store),
        MinuteRollup(spark, layout.rollup),
        MetricTable(spark, layout.metrics),
    )
    for table in kept:
        if files.exists(spark, table.root):
            table.compact()
            table.vacuum()
