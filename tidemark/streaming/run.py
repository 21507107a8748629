"""Starts the streaming queries of an installation."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tidemark.operators import metrics as m
from tidemark.operators.ingest import ALL_COLUMNS, ingest
from tidemark.streaming import sinks
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable

WATERMARK = os.environ.get("SPARK_WATERMARK", "5 minutes")

# Streaming metric queries and the columns they need beside the validated ones.
# Each reads the source once; hourly metrics of all dimensions share one query,
# as do the two rates.
METRIC_QUERIES = {
    "counts_1m": (m.counts_1m, ("sale_price", "quantity")),
    "active_users_1m": (m.active_users_1m, ()),
    "rates_5m": (m.rates_5m, ()),
    "time_on_page_5m": (m.time_on_page_5m, ("category", "time_on_page_sec")),
    "hourly": (
        m.hourly_metrics,
        ("user_segment", "category", "sku", "sale_price", "quantity"),
    ),
}


@dataclass(frozen=True)
class Layout:
    """Folders of a running installation. ``run`` goes up by one with new checkpoints."""

    root: str
    run: int = 0

    @property
    def raw_events(self) -> str:
        return f"{self.root}/raw_events"

    @property
    def unique_events(self) -> str:
        return f"{self.root}/unique_events"

    @property
    def dead_letters(self) -> str:
        return f"{self.root}/dead_letters"

    @property
    def event_store(self) -> str:
        return f"{self.root}/event_store"

    @property
    def dead_letter_store(self) -> str:
        return f"{self.root}/dead_letter_store"

    @property
    def sums(self) -> str:
        return f"{self.root}/sums"

    @property
    def minute_users(self) -> str:
        return f"{self.root}/minute_users"

    @property
    def rollup(self) -> str:
        return f"{self.root}/rollup"

    @property
    def metrics(self) -> str:
        return f"{self.root}/metrics"

    def checkpoint(self, query: str) -> str:
        return f"{self.root}/checkpoints/run={self.run}/{query}"


@dataclass
class Started:
    layout: Layout
    queries: list[StreamingQuery] = field(default_factory=list)

    def wait(self) -> None:
        """Until every query has ended; the first failure is raised."""
        for query in self.queries:
            query.awaitTermination()

    def stop(self) -> None:
        for query in self.queries:
            query.stop()


def clean_stream(
    messages: DataFrame,
    watermark: str = WATERMARK,
    columns: tuple[str, ...] = ALL_COLUMNS,
) -> tuple[DataFrame, DataFrame]:
    clean, dead = ingest(messages, columns)
    return clean.withWatermark("timestamp", watermark), dead


def start_all(
    spark: SparkSession,
    messages: DataFrame,
    layout: Layout,
    trigger: sinks.Trigger = sinks.Trigger(),
    watermark: str = WATERMARK,
    only: tuple[str, ...] | None = None,
    publish: tuple[str, str] | None = None,
) -> Started:
    """Start the raw, dead-letter and metric queries over one message stream.

    ``only`` restricts the run to some of them; the copy of the events without
    repeats, ``unique_events``, and the compacted store, ``event_store``, run only
    when named there. ``publish`` (kind, location) also sends metrics and dead
    letters out as messages. Each query reads the source on its own; see
    ``fanout`` for all sinks from one read.
    """
    clean, dead = clean_stream(messages, watermark)
    table = MetricTable(spark, layout.metrics)
    started = Started(layout)

    def wanted(name: str) -> bool:
        return only is None or name in only

    if wanted("raw_events"):
        started.queries.append(
            sinks.start_raw_events(
                clean, layout.raw_events, layout.checkpoint("raw_events"), trigger
            )
        )
    if only is not None and "unique_events" in only:
        started.queries.append(
            sinks.start_unique_events(
                clean, layout.unique_events, layout.checkpoint("unique_events"), trigger
            )
        )
    if only is not None and "event_store" in only:
        store = EventStore(spark, layout.event_store)
        started.queries.append(
            sinks.start_event_store(
                clean_stream(messages, watermark)[0], store, layout.checkpoint("event_store"), trigger, layout.run
            )
        )
    if wanted("dead_letters"):
        started.queries.append(
            sinks.start_dead_letters(
                dead, layout.dead_letters, layout.checkpoint("dead_letters"), trigger
            )
        )
        if publish:
            started.queries.append(
                sinks.start_dead_letter_messages(
                    dead, *publish, layout.checkpoint("out_dead_letters"), trigger
                )
            )
    for name, (build, columns) in METRIC_QUERIES.items():
        if not wanted(name):
            continue
        metrics = build(clean_stream(messages, watermark, columns)[0])
        started.queries.append(
            sinks.start_metrics(
                metrics, table, name, layout.checkpoint(name), trigger, layout.run
            )
        )
        if publish:
            started.queries.append(
                sinks.start_metric_messages(
                    metrics, *publish, name, layout.checkpoint(f"out_{name}"), trigger
                )
            )
    return started


def upkeep(spark: SparkSession, layout: Layout) -> int:
    """Fold finished metric batches into dated folders and drop what they replace.

    To be run now and then while no reader is at work, e.g. once a day; without
    it the number of batch folders grows with time.
    """
    table = MetricTable(spark, layout.metrics)
    version = table.compact()
    table.vacuum()
    return version


def run_forever(spark: SparkSession, messages: DataFrame, layout: Layout, **options) -> None:
    """Run until any query ends, then stop the others and raise what went wrong."""
    # Forget queries that ended before; they would end this wait at once.
    spark.streams.resetTerminated()
    started = start_all(spark, messages, layout, **options)
    try:
        spark.streams.awaitAnyTermination()
    finally:
        started.stop()
