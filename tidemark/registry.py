"""Every operator as a query over the supplied tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import ingest, metrics as m
from tidemark.operators.sessions import session_stream, sessions
from tidemark.plans import deltas, jobs, marts, quality, reads, rollups, staging
from tidemark.plans.ledger import IdLedger
from tidemark.session import shared_dir
from tidemark.sources import adapter, files, streams, tables as t
from tidemark.streaming import fanout, repair, run, sinks, state, top
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ONCE = sinks.Trigger(available_now=True)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# -- inputs -----------------------------------------------------------------


def clean(spark, sf, **dimensions) -> DataFrame:
    return ingest.route(adapter.events(spark, sf, **dimensions))[0]


def stored(spark, sf, **dimensions) -> DataFrame:
    return ingest.to_stored(clean(spark, sf, **dimensions))


def staged(spark, sf, **dimensions) -> DataFrame:
    raw = ingest.to_stored(adapter.events(spark, sf, **dimensions))
    return staging.stg_events(raw)


def with_date(events: DataFrame) -> DataFrame:
    return events.withColumn("event_date", F.to_date("timestamp"))


def staged_users(spark, sf) -> DataFrame:
    return staging.stg_users(adapter.users(spark, sf))


def staged_products(spark, sf) -> DataFrame:
    return staging.stg_products(adapter.products(spark, sf))


def plain_times(df: DataFrame) -> DataFrame:
    """Zoned times back to the zoneless type of the supplied tables."""
    zoned = [f.name for f in df.schema if f.dataType.simpleString() == "timestamp"]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned})


def finish(started: run.Started) -> None:
    started.wait()


# -- sources ----------------------------------------------------------------


@query
def a1_event_stream(spark, sf):
    """JSON lines in a folder, read as a stream."""
    source, out = shared_dir(spark, "a1-in"), shared_dir(spark, "a1-out")
    lines = adapter.messages(spark, sf).select(F.col("value").cast("string").alias("value"))
    lines.write.text(source)
    stream = ingest.flatten(ingest.parse(streams.read_events_stream(spark, "json", source)))
    started = (
        stream.select("event_id", "event_type", "user_id", "timestamp")
        .writeStream.option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/data", format="parquet")
    )
    started.awaitTermination()
    return plain_times(spark.read.parquet(f"{out}/data"))


@query
def a2_event_schema(spark, sf):
    parsed = ingest.parse(adapter.messages(spark, sf, user=True, product=True))
    return plain_times(
        parsed.select(
            "event_id",
            "timestamp",
            F.col("user.segment").alias("segment"),
            F.col("user.country").alias("country"),
            F.col("product.sku").alias("sku"),
            F.col("product.sale_price").alias("sale_price"),
            F.col("event_data.quantity").alias("quantity"),
        )
    )


@query
def a3_table_sources(spark, sf):
    """The three declared tables, written, read back and checked against their schema."""
    where = t.Tables(shared_dir(spark, "a3"))
    _write_tables(spark, sf, where)
    read = [
        ("raw_events", t.read_raw_events(spark, where)),
        ("users", t.read_users(spark, where)),
        ("products", t.read_products(spark, where)),
    ]
    columns = {
        "raw_events": ("event_id", "event_type", "user_id"),
        "users": ("user_id", "username", "user_segment"),
        "products": ("product_id", "sku", "category_name"),
    }
    rows = [
        df.select(F.lit(name).alias("table_name"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(columns[name])])
        for name, df in read
    ]
    return quality.combine(rows)


def _write_tables(spark, sf, where: t.Tables) -> None:
    events = stored(spark, sf, user=True, product=True)
    zoned = events.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    zoned.write.partitionBy("event_date").parquet(where.path("raw_events"))
    adapter.users(spark, sf).write.parquet(where.path("users"))
    adapter.products(spark, sf).write.parquet(where.path("products"))


@query
def a4_active_users(spark, sf):
    return t.active_users(adapter.users(spark, sf))


@query
def a5_available_products(spark, sf):
    return t.available_products(adapter.products(spark, sf))


# -- parsing, validation, routing --------------------------------------------


@query
def b1_parse_json(spark, sf):
    parsed = ingest.parse(adapter.messages(spark, sf))
    return plain_times(parsed.select("event_id", "event_type", "timestamp", "kafka_timestamp"))


@query
def b1_unknown_fields(spark, sf):
    """Every third message has fields that no schema names: they are read back from the event store."""
    number = F.get_json_object(F.col("value").cast("string"), "$.event_id").cast("long")
    more = F.concat(F.lit('{"campaign": {"id": '), (number % 5).cast("string"), F.lit(', "tags": ["t'), (number % 2).cast("string"), F.lit('"]}, '), F.expr("substr(CAST(value AS STRING), 2)"))
    text = F.when(number % 3 == 0, more).otherwise(F.col("value").cast("string"))
    messages = adapter.messages(spark, sf).select(text.cast("binary").alias("value"), "timestamp")
    parsed = ingest.flatten(ingest.parse(messages, unknown=True))
    store = EventStore(spark, shared_dir(spark, "unknown"))
    store.batch_writer("batch")(ingest.route(parsed)[0], 0)
    store.compact()
    return store.current().select(
        "event_id",
        "event_type",
        F.try_variant_get("extra", "$.campaign.id", "int").alias("campaign"),
        F.try_variant_get("extra", "$.campaign.tags[0]", "string").alias("tag"),
    )


@query
def b2_flatten(spark, sf):
    flat = ingest.flatten(ingest.parse(adapter.messages(spark, sf, user=True, product=True)))
    return plain_times(
        flat.select(
            "event_id",
            "event_type",
            "timestamp",
            "user_id",
            "user_segment",
            "country",
            "city",
            "product_id",
            "sku",
            "category",
            "brand",
            F.col("sale_price").cast("double").alias("sale_price"),
            "quantity",
            "time_on_page_sec",
        )
    )


@query
def b3_validate(spark, sf):
    return ingest.validate(adapter.events(spark, sf)).select("event_id", "error_reason")


@query
def b4_route(spark, sf):
    good, dead = ingest.ingest(adapter.messages(spark, sf))
    routed = [
        good.select("event_id", "event_type", F.lit("clean").alias("route")),
        dead.select("event_id", "event_type", F.lit("dead_letter").alias("route")),
    ]
    return routed[0].unionByName(routed[1])


@query
def b5_stored_form(spark, sf):
    return stored(spark, sf, user=True, product=True).select(
        "event_id",
        "event_type",
        "timestamp",
        "event_date",
        "user_id",
        "user_segment",
        "country",
        "product_id",
        "category_name",
        F.col("sale_price").cast("double").alias("sale_price"),
        "quantity",
        "position_in_list",
        "time_on_page_sec",
    )


@query
def b6_unpivot(spark, sf):
    return m.counts_1m(clean(spark, sf))


@query
def b7_metric_rows(spark, sf):
    return m.product_counts_1h(clean(spark, sf, product=True), "add_to_cart")


@query
def b8_safe_ratio(spark, sf):
    """Purchases per click of each product and day; many have no click."""
    grouped = with_date(clean(spark, sf)).groupBy("event_date", "product_id")
    return grouped.agg(
        m.ratio(m.count_type("purchase"), m.count_type("click")).alias("rate")
    )


@query
def b9_metric_messages(spark, sf):
    return sinks.encode_metrics(m.counts_1m(clean(spark, sf)))


@query
def b10_stg_events(spark, sf):
    return staged(spark, sf, user=True).select(
        "event_id", "event_type", "timestamp", "event_date", "user_id", "user_segment", "quantity"
    )


@query
def b11_stg_users(spark, sf):
    return staged_users(spark, sf).select("user_id", "username", "country", "city", "user_segment")


@query
def b12_stg_products(spark, sf):
    return staged_products(spark, sf).select(
        "product_id",
        "product_name",
        F.size("tags").alias("tag_count"),
        F.element_at("tags", 1).alias("first_tag"),
        "is_on_sale",
    )


# -- windowed metrics ---------------------------------------------------------


@query
def c1_summary_1m(spark, sf):
    return m.summary_1m(clean(spark, sf))


@query
def c2_conversion_rate_5m(spark, sf):
    return m.conversion_rate_5m(clean(spark, sf))


@query
def c3_add_to_cart_rate_5m(spark, sf):
    return m.add_to_cart_rate_5m(clean(spark, sf))


@query
def c23_rates_5m(spark, sf):
    return m.rates_5m(clean(spark, sf))


@query
def c4_time_on_page_5m(spark, sf):
    return m.time_on_page_5m(clean(spark, sf, product=True))


@query
def c5_revenue_by_category_1h(spark, sf):
    return m.revenue_by_category_1h(clean(spark, sf, product=True))


@query
def c6_product_purchases_1h(spark, sf):
    return m.product_counts_1h(clean(spark, sf, product=True), "purchase")


@query
def c7_segment_distribution_1h(spark, sf):
    return m.breakdown_1h(clean(spark, sf, user=True), "user_segment")


@query
def c8_top_products_1h(spark, sf):
    return m.top_products_1h(clean(spark, sf, product=True)).select(
        "window_start",
        F.col("dimension_value").alias("sku"),
        F.col("metric_value").alias("purchase_count"),
        "position",
    )


@query
def c_all_metrics(spark, sf):
    return m.all_metrics(clean(spark, sf, user=True, product=True), clean(spark, sf))


def _rollup(spark, sf) -> DataFrame:
    """Minutes with their sketches, stored and read again: what follows sees no events."""
    where = shared_dir(spark, "rollup")
    rollups.rollup_minutes(clean(spark, sf)).write.parquet(where)
    return spark.read.parquet(where)


def _within(estimate: str, exact: str):
    """Whether an estimated number of users is within three standard errors, and one user, of the exact one."""
    allowed = F.greatest(F.lit(1.0), 3 * rollups.RELATIVE_ERROR * F.col(exact))
    return F.abs(F.col(estimate) - F.col(exact)) <= allowed


@query
def c1_user_sketches(spark, sf):
    """Distinct users of five-minute windows from the sketches of minutes, against the exact count."""
    exact = m.active_users_5m(clean(spark, sf)).select("window_start", F.col("metric_value").alias("users"))
    slid = rollups.rolled_up(_rollup(spark, sf), "5 minutes", "1 minute").select("window_start", rollups.users_of().alias("estimate"))
    both = exact.join(slid, "window_start", "full")
    return both.select("window_start", "users", _within("estimate", "users").alias("within"))


@query
def m1_daily_from_minutes(spark, sf):
    """The daily mart from minutes alone; its users within the stated error of the exact ones."""
    exact = marts.daily_summary(staged(spark, sf)).select("date", F.col("unique_users").alias("exact"))
    days = rollups.daily_summary(_rollup(spark, sf)).join(exact, "date", "full")
    return days.withColumn("within", _within("unique_users", "exact")).drop("unique_users", "exact")


@query
def m6_hours_from_minutes(spark, sf):
    exact = marts.hourly_kpi(staged(spark, sf)).select("hour_start", F.col("active_users").alias("exact"))
    hours = rollups.hourly_kpi(_rollup(spark, sf)).join(exact, "hour_start", "full")
    return plain_times(hours.withColumn("within", _within("active_users", "exact")).drop("active_users", "exact"))


@query
def c8_top_products_stream(spark, sf):
    """The best products of each hour from a stream that holds a sketch for each hour; an event long after the last closes them."""
    out = shared_dir(spark, "top")
    feed = adapter.delivered(spark, sf, product=True, sentinel=True)
    events, _ = run.clean_stream(feed.messages(), "5 minutes")
    boards = top.TopProducts(spark, f"{out}/boards")
    with feed.state_width():
        started = top.start_top_products(events, boards, f"{out}/checkpoint", ONCE)
    started.awaitTermination()
    return plain_times(boards.current().select("window_start", "sku", "purchase_count", "position"))


# -- streaming ------------------------------------------------------------------


def _stream(spark, sf, *only: str, **feed) -> run.Layout:
    """Run some of the streaming queries over the supplied events, in several batches."""
    layout = run.Layout(shared_dir(spark, "stream"))
    _run_once(adapter.delivered(spark, sf, **feed), layout, only)
    return layout


def _run_once(feed: adapter.Feed, layout: run.Layout, only: tuple[str, ...] | None = None, messages: DataFrame | None = None) -> None:
    """Run streaming queries over what a feed has put and they have not taken yet."""
    messages = feed.messages() if messages is None else messages
    with feed.state_width():
        started = run.start_all(feed.spark, messages, layout, ONCE, only=only)
    finish(started)


def _streamed_metrics(spark, sf, *only: str, **feed) -> DataFrame:
    layout = _stream(spark, sf, *only, **feed)
    rows = MetricTable(spark, layout.metrics).current()
    return plain_times(rows.select(*m.METRIC_COLUMNS))


@query
def s1_watermarked_counts(spark, sf):
    """The minute KPIs of a watermarked stream, in update mode."""
    return _streamed_metrics(spark, sf, "counts_1m")


@query
def s2_sliding_stream(spark, sf):
    return _streamed_metrics(spark, sf, "rates_5m")


@query
def s2_tumbling_stream(spark, sf):
    return _streamed_metrics(spark, sf, "hourly", user=True, product=True)


@query
def s2_active_users_stream(spark, sf):
    return _streamed_metrics(spark, sf, "active_users_1m")


def _session_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "user_id",
        "session_start",
        "session_end",
        "event_count",
        (F.col("duration_us") / 1000000.0).cast("double").alias("duration_sec"),
    )


@query
def s3_sessions(spark, sf):
    return _session_columns(sessions(clean(spark, sf)))


@query
def s3_session_stream(spark, sf):
    """All sessions of the stream; an event long after the last closes them."""
    out = shared_dir(spark, "sessions")
    events, _ = run.clean_stream(adapter.message_stream(spark, sf, sentinel=True), "5 minutes")
    started = (
        session_stream(events)
        .writeStream.outputMode("append")
        .option("checkpointLocation", f"{out}/checkpoint")
        .trigger(availableNow=True)
        .start(f"{out}/data", format="parquet")
    )
    started.awaitTermination()
    return plain_times(_session_columns(spark.read.parquet(f"{out}/data")))


@query
def s4_output_modes(spark, sf):
    """Minute counts by type: closed windows once in append mode, beside the newest of update mode."""
    feed = adapter.delivered(spark, sf, sentinel=True)
    table = MetricTable(spark, shared_dir(spark, "modes"))
    started = []
    for mode in ("append", "update"):
        counts = m.event_types_1m(run.clean_stream(feed.messages(), "5 minutes", ())[0])
        checkpoint = f"{table.root}/checkpoint-{mode}"
        with feed.state_width():
            started.append(sinks.start_metrics(counts, table, mode, checkpoint, ONCE, mode=mode))
    for each in started:
        each.awaitTermination()
    stored = spark.read.parquet(f"{table.root}/updates")
    last = F.col("window_start") < F.lit(_end_of_events(spark, sf))
    rows = stored.filter((F.col("query") == "append") & last).withColumn("mode", F.lit("append"))
    newest = table.current().filter(last).withColumn("mode", F.lit("update"))
    columns = ("mode", "window_start", "dimension_value", "metric_value")
    return plain_times(rows.select(*columns).unionByName(newest.select(*columns)))


def _end_of_events(spark, sf) -> datetime:
    newest = spark.read.parquet(f"{sf}/events.parquet").agg(F.max("ts")).first()[0]
    return newest + timedelta(minutes=1)


@query
def s5_trigger(spark, sf):
    """A query that looks for new files every second, stopped once it has taken all of them."""
    out = shared_dir(spark, "trigger")
    stream, _ = run.clean_stream(adapter.message_stream(spark, sf))
    writer = stream.select("event_id", "event_type").writeStream.format("parquet")
    often = sinks.Trigger(every="1 second").apply(writer.option("path", f"{out}/data"))
    running = often.option("checkpointLocation", f"{out}/checkpoint").start()
    try:
        running.processAllAvailable()
    finally:
        running.stop()
    return spark.read.parquet(f"{out}/data")


@query
def s6_restart(spark, sf):
    """Stopped half-way, started again from its checkpoint, and once more without anything new."""
    layout = run.Layout(shared_dir(spark, "restart"))
    feed = adapter.Feed(spark, sf)
    half = feed.PIECES // 2
    for first, last in ((0, half - 1), (half, feed.PIECES - 1), (0, -1)):
        feed.put(first, last)
        _run_once(feed, layout, ("counts_1m",))
    rows = MetricTable(spark, layout.metrics).current()
    return plain_times(rows.select(*m.METRIC_COLUMNS))


@query
def s6_state_rows(spark, sf):
    """What the minute counts hold in state at the end: the minutes the watermark has not passed."""
    layout = _stream(spark, sf, "counts_1m", "raw_events")
    return state.all_state(spark, layout, ("counts_1m", "raw_events")).select("query", "operator", "rows")


@query
def s7_late_data(spark, sf):
    """Some events come days late: the minute counts leave them out."""
    return _streamed_metrics(spark, sf, "counts_1m", late=True)


@query
def s8_stream_dedup(spark, sf):
    """Every message arrives twice; each event is in the copy without repeats once."""
    layout = run.Layout(shared_dir(spark, "dedup"))
    feed = adapter.delivered(spark, sf)
    twice = feed.messages().unionByName(feed.messages())
    _run_once(feed, layout, ("unique_events",), twice)
    return plain_times(
        spark.read.parquet(layout.unique_events).select("event_id", "event_type", "timestamp")
    )


@query
def s9_all_streams(spark, sf):
    """All queries at once: what reached each place."""
    layout = run.Layout(shared_dir(spark, "all"))
    _run_once(adapter.delivered(spark, sf, user=True, product=True), layout)
    metrics = MetricTable(spark, layout.metrics).current()
    value = F.col("metric_value").alias("value")
    none = F.lit(None).cast("double").alias("value")
    places = [
        spark.read.parquet(layout.raw_events).select(F.lit("raw_events").alias("place"), F.col("event_id").alias("member"), none),
        spark.read.parquet(layout.dead_letters).select(F.lit("dead_letters").alias("place"), F.col("event_id").alias("member"), none),
        metrics.select(F.col("metric_name").alias("place"), F.col("dimension_value").alias("member"), value),
    ]
    return quality.combine(places)


def _fanned(spark, sf, **feed) -> run.Layout:
    layout = run.Layout(shared_dir(spark, "fanout"))
    messages = adapter.message_stream(spark, sf, user=True, product=True, **feed)
    fanout.start_fanout(spark, messages, layout, ONCE, compact_every=4).awaitTermination()
    return layout


@query
def s9_one_read(spark, sf):
    """All sinks from one query that parses each batch once: what reached each place."""
    layout = _fanned(spark, sf)
    metrics = MetricTable(spark, layout.metrics).current()
    none = F.lit(None).cast("double").alias("value")
    places = [
        EventStore(spark, layout.event_store).current().select(F.lit("raw_events").alias("place"), F.col("event_id").alias("member"), none),
        fanout.DeadLetters(spark, layout.dead_letter_store).current().select(F.lit("dead_letters").alias("place"), F.col("event_id").alias("member"), none),
        metrics.select(F.col("metric_name").alias("place"), F.col("dimension_value").alias("member"), F.col("metric_value").alias("value")),
    ]
    return quality.combine(places)


@query
def s7_late_in_sums(spark, sf):
    """Some events come days late: with sums in place of state, all metrics have them."""
    layout = _fanned(spark, sf, late=True)
    return plain_times(MetricTable(spark, layout.metrics).current().select(*m.METRIC_COLUMNS))


@query
def s7_repaired_windows(spark, sf):
    """Some events come days late and are left out; the windows they belong to are computed again."""
    layout = _stream(spark, sf, "counts_1m", "event_store", late=True)
    table = MetricTable(spark, layout.metrics)
    repair.repair_late(spark, EventStore(spark, layout.event_store), table, run.WATERMARK, layout.run)
    counts = ("events_1m", "revenue_1m", "click_1m", "cart_1m", "purchase_1m")
    return plain_times(table.current().filter(F.col("metric_name").isin(*counts)).select(*m.METRIC_COLUMNS))


# -- sinks ------------------------------------------------------------------------


@query
def d1_event_store(spark, sf):
    """The stored events after batches, replays and compactions in between, some of them late."""
    layout = run.Layout(shared_dir(spark, "store"))
    store = EventStore(spark, layout.event_store)
    feed = adapter.Feed(spark, sf, user=True, product=True, late=True)
    for i in range(0, feed.PIECES, 2):
        feed.put(i, i + 1)
        _run_once(feed, layout, ("event_store",))
        store.compact()
    store.vacuum()
    return _event_columns(store.current())


@query
def d1_raw_events(spark, sf):
    return _stored_events(spark, _stream(spark, sf, "raw_events", user=True, product=True))


@query
def d1_late_events(spark, sf):
    """Events that come days late are stored like any other."""
    late = _stream(spark, sf, "raw_events", user=True, product=True, late=True)
    return _stored_events(spark, late)


@query
def d1_late_daily_summary(spark, sf):
    """The daily mart over a store that took some events late."""
    layout = _stream(spark, sf, "raw_events", late=True)
    raw = spark.read.parquet(layout.raw_events)
    return marts.daily_summary(staging.stg_events(raw))


def _stored_events(spark, layout: run.Layout) -> DataFrame:
    return _event_columns(spark.read.parquet(layout.raw_events))


def _event_columns(stored: DataFrame) -> DataFrame:
    return plain_times(
        stored.select(
            "event_id",
            "event_type",
            "timestamp",
            "event_date",
            "user_id",
            "user_segment",
            "country",
            "product_id",
            "category_name",
            F.col("sale_price").cast("double").alias("sale_price"),
            "quantity",
            "time_on_page_sec",
        )
    )


@query
def d2_metric_upsert(spark, sf):
    """Half the value first, then the right one, a replay, and compactions in between.

    A batch that is still being written, wrong and half of it, is there all the time.
    """
    table = MetricTable(spark, shared_dir(spark, "upsert"))
    right = m.breakdown_1h(clean(spark, sf, user=True))
    write = table.batch_writer("segments")
    unfinished = f"{table.root}/updates/query=segments/run=0/batch_id=2"
    wrong = right.withColumn("metric_value", F.col("metric_value") * 9)
    wrong.withColumn("computed_at", F.current_timestamp()).write.parquet(unfinished)
    files.delete(spark, f"{unfinished}/_SUCCESS")
    write(right.withColumn("metric_value", F.col("metric_value") / 2), 0)
    table.compact()
    write(right, 1)
    write(right, 1)
    table.compact()
    table.vacuum()
    write(right, 1)
    write(right, 2)
    table.compact()
    return plain_times(table.current().select(*m.METRIC_COLUMNS))


@query
def d2_point_read(spark, sf):
    """The hours of one product, from a compacted table and a batch after it: few files are read."""
    table = MetricTable(spark, shared_dir(spark, "points"))
    write = table.batch_writer("hourly")
    metrics = m.hourly_metrics(clean(spark, sf, user=True, product=True))
    write(metrics.withColumn("metric_value", F.col("metric_value") * 2), 0)
    table.compact()
    write(metrics, 1)
    found = table.point("product_click_count", "sku", "SKU-7")
    return plain_times(found.select("window_start", "dimension_value", "metric_value"))


def _kept(spark, *metrics: DataFrame) -> MetricTable:
    """A metric table with these rows, as the dashboard's reads find it."""
    table = MetricTable(spark, shared_dir(spark, "metrics"))
    for number, rows in enumerate(metrics):
        table.batch_writer("batch")(rows, number)
    return table


@query
def d3_kpi_snapshot(spark, sf):
    events = clean(spark, sf)
    return reads.kpi_snapshot(_kept(spark, m.summary_1m(events), m.rates_5m(events)).current())


@query
def d4_leaderboards(spark, sf):
    return reads.leaderboards(_product_counts(spark, sf))


def _product_counts(spark, sf) -> DataFrame:
    events = clean(spark, sf, product=True)
    return _kept(spark, m.hourly_metrics(events, ()), m.product_revenue_1h(events)).current()


@query
def d5_metric_messages(spark, sf):
    """Published metric messages, newest per key decided by the reader."""
    out = shared_dir(spark, "messages")
    events, _ = run.clean_stream(adapter.message_stream(spark, sf))
    sinks.start_metric_messages(
        m.counts_1m(events), "json", f"{out}/data", "counts_1m", f"{out}/checkpoint", ONCE
    ).awaitTermination()
    return spark.read.text(f"{out}/data/counts_1m").select("value")


@query
def d6_dead_letters(spark, sf):
    layout = _stream(spark, sf, "dead_letters")
    return plain_times(
        spark.read.parquet(layout.dead_letters).select(
            "event_id", "event_type", "timestamp", "error_reason",
            F.get_json_object("message", "$.event_id").alias("sent_id"),
        )
    )


@query
def d6_dead_letter_messages(spark, sf):
    """Dead letters as messages: the reason, and the message as it came."""
    out = shared_dir(spark, "dead-messages")
    _, dead = run.clean_stream(adapter.message_stream(spark, sf))
    sinks.start_dead_letter_messages(
        dead, "json", f"{out}/data", f"{out}/checkpoint", ONCE
    ).awaitTermination()
    sent = spark.read.text(f"{out}/data/dead_letters")
    message = F.get_json_object("value", "$.message")
    return sent.select(
        F.get_json_object("value", "$.error_reason").alias("error_reason"),
        F.get_json_object(message, "$.event_id").alias("event_id"),
        F.get_json_object(message, "$.event_type").alias("event_type"),
    )


@query
def d7_batch_audit(spark, sf):
    """One line per non-empty batch: the lines of each query, and their rows."""
    layout = _stream(spark, sf, "counts_1m", "active_users_1m")
    audit = MetricTable(spark, layout.metrics).audit()
    return audit.groupBy("event", "query").agg(
        F.sum("metrics_count").alias("metrics_count"),
        F.count_distinct("batch_id").alias("batches"),
    )


@query
def d9_empty_batch(spark, sf):
    """Empty batches between others: neither rows nor audit lines come of them."""
    table = MetricTable(spark, shared_dir(spark, "empty"))
    write = table.batch_writer("segments")
    rows = m.breakdown_1h(clean(spark, sf, user=True))
    for number, batch in enumerate((rows.limit(0), rows, rows.limit(0))):
        write(batch, number)
    audit = table.audit().select("batch_id", "metrics_count")
    stored = spark.read.parquet(f"{table.root}/updates").groupBy("batch_id").count()
    return audit.join(stored.withColumnRenamed("count", "stored"), "batch_id", "full")


@query
def d8_inserted_rows(spark, sf):
    """The users table after loads that repeat and clash."""
    where = t.Tables(shared_dir(spark, "load"))
    users = adapter.users(spark, sf)
    sinks.insert_absent(users.filter("is_active"), where.path("users"), "user_id", "username")
    clash = users.withColumn("user_id", F.concat(F.lit("new-"), "user_id"))
    for rows in (users.unionByName(users), clash):
        sinks.insert_absent(rows, where.path("users"), "user_id", "username")
    return t.read_users(spark, where).select("user_id", "username", "user_segment")


@query
def d8_insert_absent(spark, sf):
    """Users come twice, half of them already stored; products clash on their sku."""
    where = t.Tables(shared_dir(spark, "load"))
    users, products = adapter.users(spark, sf), adapter.products(spark, sf)
    steps = [
        ("users", users.filter("is_active"), "user_id", "username"),
        ("users", users.unionByName(users), "user_id", "username"),
        ("products", products, "product_id", "sku"),
        (
            "products",
            products.withColumn("product_id", F.concat(F.lit("new-"), "product_id")),
            "product_id",
            "sku",
        ),
    ]
    done = []
    for step, (name, rows, key, unique) in enumerate(steps):
        inserted, skipped = sinks.insert_absent(rows, where.path(name), key, unique)
        done.append((step, name, inserted, skipped))
    return spark.createDataFrame(
        done, "step INT, table_name STRING, inserted LONG, skipped LONG"
    )


# -- marts ------------------------------------------------------------------------


@query
def m1_daily_summary(spark, sf):
    return marts.daily_summary(staged(spark, sf))


@query
def m2_product_performance(spark, sf):
    return marts.product_performance(staged(spark, sf), staged_products(spark, sf))


@query
def m3_user_segments(spark, sf):
    return marts.user_segments(staged(spark, sf, user=True))


@query
def m4_funnel_analysis(spark, sf):
    return marts.funnel_analysis(staged(spark, sf, product=True))


@query
def m5_geo_revenue(spark, sf):
    return marts.geo_revenue(staged(spark, sf, user=True), staged_users(spark, sf))


@query
def m6_hourly_kpi(spark, sf):
    return marts.hourly_kpi(staged(spark, sf))


# -- checks -----------------------------------------------------------------------


def _all_events(spark, sf) -> DataFrame:
    """Events before validation, so that the checks find something."""
    return ingest.to_stored(adapter.events(spark, sf))


@query
def q1_not_null(spark, sf):
    checks = [quality.not_null(c) for c in ("event_id", "user_id", "time_on_page_sec")]
    return quality.check_rows(_all_events(spark, sf), "raw_events", checks)


@query
def q2_unique(spark, sf):
    return quality.combine(
        [
            quality.check_unique(_all_events(spark, sf), "raw_events", "event_id"),
            quality.check_unique(_all_events(spark, sf), "raw_events", "user_id"),
        ]
    )


@query
def q3_accepted_values(spark, sf):
    checks = [
        quality.accepted_values("event_type", quality.STAGING_EVENT_TYPES, quality.WARN)
    ]
    return quality.check_rows(_all_events(spark, sf), "raw_events", checks)


@query
def q4_relationships(spark, sf):
    events = _all_events(spark, sf)
    shop = t.available_products(adapter.products(spark, sf))
    return quality.combine(
        [
            quality.check_relationship(events, "raw_events", "product_id", shop, "product_id"),
            quality.check_relationship(
                events, "raw_events", "user_id", t.active_users(adapter.users(spark, sf)), "user_id"
            ),
        ]
    )


@query
def q5_non_negative(spark, sf):
    accounts = spark.read.parquet(f"{sf}/customer.parquet")
    hours = marts.hourly_kpi(stored(spark, sf))
    return quality.combine(
        [
            quality.check_rows(hours, "mart_hourly_kpi", [quality.non_negative("revenue")]),
            quality.check_rows(accounts, "customer", [quality.non_negative("c_acctbal")]),
        ]
    )


@query
def q6_valid_rate(spark, sf):
    rates = m.conversion_rate_5m(clean(spark, sf))
    return quality.check_rows(rates, "conversion_rate", [quality.valid_rate("metric_value")])


@query
def q7_mart_checks(spark, sf):
    """All mart checks with their severity, over marts that are stored once."""
    where = t.Tables(shared_dir(spark, "marts"))
    return quality.mart_checks(
        {
            name: _stored_mart(spark, where, name, mart)
            for name, mart in _all_marts(spark, sf).items()
        }
    )


def _stored_mart(spark, where: t.Tables, name: str, mart: DataFrame) -> DataFrame:
    mart.write.parquet(where.path(name))
    return jobs.read_mart(spark, where, name)


def _all_marts(spark, sf) -> dict[str, DataFrame]:
    return (
        {
            "mart_daily_summary": m1_daily_summary(spark, sf),
            "mart_product_performance": m2_product_performance(spark, sf),
            "mart_user_segments": m3_user_segments(spark, sf),
            "mart_funnel_analysis": m4_funnel_analysis(spark, sf),
            "mart_geo_revenue": m5_geo_revenue(spark, sf),
            "mart_hourly_kpi": m6_hourly_kpi(spark, sf),
        }
    )


@query
def q8_data_ready(spark, sf):
    """The gate for the day before the first event, the first and the last day."""
    events = stored(spark, sf)
    first, last = events.agg(F.min("event_date"), F.max("event_date")).first()
    days = [first - timedelta(days=1), first, last]
    return quality.combine(
        [quality.day_has_events(events, d).withColumn("day", F.lit(d)) for d in days]
    )


# -- jobs -------------------------------------------------------------------------


def _dates(spark, where: t.Tables) -> tuple[date, date]:
    """The first and the last date with events."""
    return t.read_raw_events(spark, where).agg(F.min("event_date"), F.max("event_date")).first()


def _hours(first: date, until: date) -> int:
    """A lookback that reaches the first date."""
    return 24 * ((until - first).days + 1)


@query
def p1_daily_run(spark, sf):
    """The daily job with a lookback over all events: the daily mart it wrote."""
    where = _daily_run(spark, sf)
    return jobs.read_mart(spark, where, "mart_daily_summary")


def _daily_run(spark, sf) -> t.Tables:
    where = t.Tables(shared_dir(spark, "daily"))
    _write_tables(spark, sf, where)
    first, last = _dates(spark, where)
    jobs.run_daily(spark, where, last + timedelta(days=1), _hours(first, last))
    return where


@query
def p1_known_ids(spark, sf):
    """The last third of the dates, and a seventh of the earlier events again: what the ledger knows of them."""
    where = shared_dir(spark, "known")
    ids = with_date(clean(spark, sf)).select("event_id", "event_date")
    first, last = ids.agg(F.min("event_date"), F.max("event_date")).first()
    start = first + (last - first) * 2 // 3
    ids.filter(F.col("event_date") < F.lit(start)).write.partitionBy("event_date").parquet(f"{where}/stg_events")
    ledger = IdLedger(spark, f"{where}/id_ledger", buckets=16)
    state = ledger.sync(f"{where}/stg_events", start)
    again = F.col("event_id").cast("long") % 7 == 0
    fresh = ids.filter((F.col("event_date") >= F.lit(start)) | again).select("event_id")
    known = ledger.known(fresh, state, start).withColumn("known", F.lit(True))
    return fresh.join(known, "event_id", "left").select("event_id", F.coalesce("known", F.lit(False)).alias("known"))


@query
def p1_daily_marts(spark, sf):
    """All six marts of a daily run: rows, events, purchases and revenue by date."""
    where = _daily_run(spark, sf)
    names = {
        "mart_daily_summary": ("total_events", "total_purchases", "total_revenue"),
        "mart_product_performance": ("click_count", "purchase_count", "revenue"),
        "mart_user_segments": ("event_count", "purchase_count", "revenue"),
        "mart_funnel_analysis": ("click_count", "purchase_count", "add_to_cart_count"),
        "mart_geo_revenue": ("event_count", "purchase_count", "revenue"),
        "mart_hourly_kpi": ("total_events", "purchases", "revenue"),
    }
    return quality.combine(
        [
            jobs.read_mart(spark, where, name)
            .groupBy("date")
            .agg(
                F.count("*").alias("row_count"),
                F.sum(events).alias("events"),
                F.sum(purchases).alias("purchases"),
                F.round(F.sum(amount), 2).cast("double").alias("amount"),
            )
            .withColumn("mart", F.lit(name))
            for name, (events, purchases, amount) in names.items()
        ]
    )


@query
def p2_hourly_run(spark, sf):
    where = t.Tables(shared_dir(spark, "hourly"))
    _write_tables(spark, sf, where)
    first, last = _dates(spark, where)
    now = datetime.combine(last, datetime.max.time())
    return plain_times(jobs.run_hourly(spark, where, now, _hours(first, last)))


@query
def p3_incremental_rebuild(spark, sf):
    """Two daily runs; the second rebuilds days of the first and adds the rest."""
    where = t.Tables(shared_dir(spark, "rebuild"))
    _write_tables(spark, sf, where)
    first, last = _dates(spark, where)
    today = last + timedelta(days=1)
    jobs.run_daily(spark, where, today - timedelta(days=12), _hours(first, last))
    jobs.run_daily(spark, where, today, lookback_hours=24 * 14)
    return jobs.read_mart(spark, where, "mart_user_segments")


@query
def p3_delta_marts(spark, sf):
    """Marts of increments, one of them late and one written twice: totals of each mart and date."""
    events = staged(spark, sf, user=True, product=True)
    kept = deltas.DeltaMarts(spark, shared_dir(spark, "deltas"))
    part = F.when(F.col("event_id").cast("long") % 20 == 0, 2).otherwise((F.dayofmonth("timestamp") > 15).cast("int"))
    for number in (0, 1, 1, 2):
        kept.add(events.filter(part == number), number)
        if number == 0:
            kept.upkeep()
    names = {
        "mart_daily_summary": (kept.daily_summary(), "total_events", "total_purchases", "total_revenue"),
        "mart_product_performance": (kept.product_performance(staged_products(spark, sf)), "click_count", "purchase_count", "revenue"),
        "mart_funnel_analysis": (kept.funnel_analysis(), "click_count", "purchase_count", "add_to_cart_count"),
        "mart_hourly_kpi": (kept.hourly_kpi().withColumn("date", F.to_date("hour_start")), "total_events", "purchases", "revenue"),
    }
    return quality.combine(
        [
            mart.groupBy("date")
            .agg(
                F.count("*").alias("row_count"),
                F.sum(events).alias("events"),
                F.sum(purchases).alias("purchases"),
                F.round(F.sum(amount), 2).cast("double").alias("amount"),
            )
            .withColumn("mart", F.lit(name))
            for name, (mart, events, purchases, amount) in names.items()
        ]
    )


@query
def p3_delta_daily(spark, sf):
    """The daily mart of increments by event number: every date is in each of them."""
    events = staged(spark, sf)
    kept = deltas.DeltaMarts(spark, shared_dir(spark, "deltas"))
    for number in range(3):
        kept.add(events.filter(F.col("event_id").cast("long") % 3 == number), number)
    return kept.daily_summary()


@query
def p3_emptied_date(spark, sf):
    """A second run after all events of one date were withdrawn: the date goes from the marts."""
    where = t.Tables(shared_dir(spark, "emptied"))
    _write_tables(spark, sf, where)
    first, last = _dates(spark, where)
    for withdrawn in (None, last - timedelta(days=1)):
        if withdrawn:
            files.delete(spark, f"{where.path('raw_events')}/event_date={withdrawn}")
        jobs.run_daily(spark, where, last + timedelta(days=1), _hours(first, last))
    return jobs.read_mart(spark, where, "mart_daily_summary")


# -- reads ------------------------------------------------------------------------


@query
def r1_summary(spark, sf):
    return reads.kpi_snapshot(_kept(spark, m.summary_1m(clean(spark, sf))).current())


@query
def r2_timeseries(spark, sf):
    table = _kept(spark, m.summary_1m(clean(spark, sf)))
    return plain_times(reads.timeseries(table.current(), "1m"))


@query
def r2_timeseries_range(spark, sf):
    """Half a day; the table reads the folder of that date alone."""
    table = _kept(spark, m.hourly_metrics(clean(spark, sf, user=True, product=True)))
    day = date(2024, 1, 10)
    rows = table.current(day, day)
    return plain_times(
        reads.timeseries(rows, "1h", "2024-01-10T00:00:00", "2024-01-10T12:00:00", 200)
    )


@query
def r3_top_products(spark, sf):
    return reads.top_products(reads.leaderboards(_product_counts(spark, sf)), "click", 10)


@query
def r3_live_top_products(spark, sf):
    return reads.top_products(reads.leaderboards(_product_counts(spark, sf)), "purchase", 5)


@query
def r4_breakdown(spark, sf):
    events = clean(spark, sf, user=True, product=True)
    table = _kept(spark, m.hourly_metrics(events), m.time_on_page_5m(events))
    return plain_times(reads.breakdown(table.current(), "category"))


@query
def r5_daily_report(spark, sf):
    return reads.newest_report(_report(spark, m1_daily_summary(spark, sf)), [], 30)


def _report(spark, mart: DataFrame) -> DataFrame:
    """A mart as the reports find it: stored."""
    return _stored_mart(spark, t.Tables(shared_dir(spark, "report")), "mart", mart)


@query
def r6_funnel_report(spark, sf):
    return reads.newest_report(_report(spark, m4_funnel_analysis(spark, sf)), ["category"], 30)


@query
def r7_product_report(spark, sf):
    mart = _report(spark, m2_product_performance(spark, sf))
    return reads.newest_report(mart, ["product_id"], 100)


@query
def r8_live_chart(spark, sf):
    return plain_times(reads.live_chart(_kept(spark, m.counts_1m(clean(spark, sf))).current()))


@query
def r9_event_rate(spark, sf):
    return plain_times(reads.event_rate(_kept(spark, m.counts_1m(clean(spark, sf))).current()))


@query
def r9_event_types(spark, sf):
    """Events of each type per minute."""
    table = _kept(spark, m.event_types_1m(clean(spark, sf)))
    rows = table.current().select(
        "window_start", F.col("dimension_value").alias("event_type"), F.col("metric_value").alias("events")
    )
    return plain_times(rows)


@query
def r10_kpi_now(spark, sf):
    """Users of the last five minutes, revenue of the day, conversion of five minutes."""
    events = clean(spark, sf)
    parts = m.active_users_5m(events), m.revenue_1d(events), m.conversion_rate_5m(events)
    return reads.kpi_now(_kept(spark, *parts).current())


@query
def r3_top_products_by_revenue(spark, sf):
    return reads.top_products(reads.leaderboards(_product_counts(spark, sf)), "revenue", 10)


@query
def r10_kpi_cards(spark, sf):
    return reads.kpi_cards(r1_summary(spark, sf))


@query
def r11_daily_revenue(spark, sf):
    return reads.daily_revenue_series(_report(spark, m1_daily_summary(spark, sf)))


# -- comparisons --------------------------------------------------------------------


@query
def w1_kpi_change(spark, sf):
    return plain_times(reads.kpi_change(_kept(spark, m.counts_1m(clean(spark, sf))).current()))


@query
def w2_rank_change(spark, sf):
    table = _kept(spark, m.product_counts_1h(clean(spark, sf, product=True)))
    return plain_times(reads.rank_change(table.current()))


@query
def w3_week_over_week(spark, sf):
    return reads.week_over_week(_report(spark, m1_daily_summary(spark, sf)))


@query
def w4_country_breakdown(spark, sf):
    return m.breakdown_1h(clean(spark, sf, user=True), "country")


@query
def w4_device_breakdown(spark, sf):
    return m.breakdown_1h(clean(spark, sf), "device")


@query
def w5_rolling_volume(spark, sf):
    return plain_times(reads.rolling_volume(_kept(spark, m.counts_1m(clean(spark, sf))).current(), 30))


@query
def w6_revenue_by_hour(spark, sf):
    return reads.revenue_by_hour_of_day(clean(spark, sf))
