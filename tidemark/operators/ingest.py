"""From JSON messages to valid flat events, dead letters and the stored form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tidemark.schemas import (
    EVENT_JSON,
    INVALID_EVENT_TYPE,
    MONEY,
    NULL_EVENT_ID,
    NULL_TIMESTAMP,
    NULL_USER_ID,
    RAW_EVENTS,
    VALID_EVENT_TYPES,
    ddl,
)

# Flat column -> path in the parsed message.
FLAT_COLUMNS = {
    "event_id": "event_id",
    "event_type": "event_type",
    "event_version": "event_version",
    "timestamp": "timestamp",
    "session_id": "session_id",
    "user_id": "user.user_id",
    "user_segment": "user.segment",
    "country": "user.country",
    "city": "user.city",
    "device": "user.device",
    "os": "user.os",
    "language": "user.language",
    "product_id": "product.product_id",
    "sku": "product.sku",
    "product_name": "product.name",
    "category": "product.category",
    "subcategory": "product.subcategory",
    "brand": "product.brand",
    "sale_price": "product.sale_price",
    "currency": "product.currency",
    "quantity": "event_data.quantity",
    "position": "event_data.position_in_list",
    "time_on_page_sec": "event_data.time_on_page_sec",
    "search_keyword": "event_data.search_keyword",
    "payment_method": "event_data.payment_method",
    "order_id": "event_data.order_id",
    "referrer": "event_data.referrer",
    "app_version": "metadata.app_version",
    "kafka_timestamp": "kafka_timestamp",
}

ALL_COLUMNS = tuple(FLAT_COLUMNS)
# The message text beside a dead letter.
PAYLOAD = "message"
# The text of a message that has fields no schema names.
UNKNOWN = "unknown_fields"
# What the validation rules look at.
VALIDATED = ("event_id", "user_id", "event_type", "timestamp")

# Stored column -> flat column, where the names differ.
STORED_NAMES = {
    "category_name": "category",
    "position_in_list": "position",
    "ingested_at": "kafka_timestamp",
}

# Which of several rows with one id came first. Few columns, so that a query
# that needs few columns shuffles few.
_REPEAT_ORDER = ("timestamp", "ingested_at", "event_type", "user_id")


def _fields_for(columns: tuple[str, ...]) -> StructType:
    """The part of the message schema that some flat columns come from."""
    wanted: dict[str, set[str]] = {}
    for name in columns:
        head, _, leaf = FLAT_COLUMNS[name].partition(".")
        wanted.setdefault(head, set()).add(leaf)
    fields = []
    for field in ddl(EVENT_JSON):
        if field.name in wanted and isinstance(field.dataType, StructType):
            leaves = [f for f in field.dataType if f.name in wanted[field.name]]
            fields.append(StructField(field.name, StructType(leaves)))
        elif field.name in wanted:
            fields.append(field)
    return StructType(fields)


def has_unknown_fields(text: Column) -> Column:
    """Whether a message has a field that no schema names, at the top or in one of its parts."""
    schema = ddl(EVENT_JSON)
    parts = {f.name: f.dataType.names for f in schema if isinstance(f.dataType, StructType)}
    found = F.from_json(text, ", ".join(f"{name} MAP<STRING, STRING>" for name in parts))
    more = lambda keys, known: F.size(F.array_except(keys, F.array(*map(F.lit, known)))) > 0
    unknown = more(F.json_object_keys(text), schema.names)
    for name, known in parts.items():
        unknown = F.coalesce(unknown, F.lit(False)) | F.coalesce(more(F.map_keys(found[name]), known), F.lit(False))
    return unknown


def parse(
    messages: DataFrame, columns: tuple[str, ...] = ALL_COLUMNS, payload: bool = False, unknown: bool = False
) -> DataFrame:
    """Decode JSON. Text that is no JSON gives a row of nulls; ``payload`` keeps the text.

    ``unknown`` keeps the text of those messages that have fields no schema names.

    ``inline`` makes the parsed fields plain columns of a generator. A filter on
    them cannot be pushed below it, so each message is parsed once, not once per
    field a later filter looks at. Only the fields behind ``columns`` are decoded.
    """
    text = F.col("value").cast("string")
    decoded = F.from_json(text, _fields_for(columns))
    renamed = messages.select("value", F.col("timestamp").alias("kafka_timestamp"))
    kept = [text.alias(PAYLOAD)] if payload else []
    if unknown:
        kept.append(F.when(has_unknown_fields(text), text).alias(UNKNOWN))
    return renamed.select("kafka_timestamp", *kept, F.inline(F.array(decoded)))


def flatten(parsed: DataFrame, columns: tuple[str, ...] = ALL_COLUMNS) -> DataFrame:
    def column(name: str) -> Column:
        value = F.col(FLAT_COLUMNS[name])
        # A price that no decimal can hold counts as missing instead of failing the job.
        return (value.try_cast(MONEY) if name == "sale_price" else value).alias(name)

    kept = [c for c in (PAYLOAD, UNKNOWN) if c in parsed.columns]
    return parsed.select(*[column(name) for name in columns], *kept)


def is_valid() -> Column:
    """Passes every rule. A conjunction, so that file scans can skip by it."""
    return (
        F.col("event_id").isNotNull()
        & F.col("user_id").isNotNull()
        & F.col("event_type").isin(*VALID_EVENT_TYPES)
        & F.col("timestamp").isNotNull()
    )


def error_reason() -> Column:
    """The first rule an event breaks, or null."""
    known_type = F.coalesce(F.col("event_type").isin(*VALID_EVENT_TYPES), F.lit(False))
    return (
        F.when(F.col("event_id").isNull(), NULL_EVENT_ID)
        .when(F.col("user_id").isNull(), NULL_USER_ID)
        .when(~known_type, INVALID_EVENT_TYPE)
        .when(F.col("timestamp").isNull(), NULL_TIMESTAMP)
    )


def validate(flat: DataFrame) -> DataFrame:
    return flat.withColumn("error_reason", error_reason())


def route(flat: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Clean events, and dead letters with their reason."""
    return flat.filter(is_valid()), validate(flat).filter("error_reason IS NOT NULL")


def ingest(
    messages: DataFrame, columns: tuple[str, ...] = ALL_COLUMNS
) -> tuple[DataFrame, DataFrame]:
    """Parse, flatten and route; ``columns`` limits the work to what a query needs.

    Dead letters keep the message as it came, so that it can be read and sent
    again; clean events never carry it.
    """
    needed = tuple(c for c in ALL_COLUMNS if c in columns or c in VALIDATED)
    clean = route(flatten(parse(messages, needed), needed))[0]
    return clean, route(flatten(parse(messages, needed, payload=True), needed))[1]


def to_stored(clean: DataFrame, *more: str) -> DataFrame:
    """The columns of the stored events table, plus its partition date, and others that are named."""
    stored = []
    for field in ddl(RAW_EVENTS):
        if field.name == "event_date":
            value = F.to_date("timestamp")
        else:
            source = STORED_NAMES.get(field.name, field.name)
            value = F.col(source) if source in clean.columns else F.lit(None).cast(field.dataType)
        stored.append(value.alias(field.name))
    return clean.select(*stored, *more)


def drop_repeats(events: DataFrame) -> DataFrame:
    """Keep the earliest row of each event id, over any horizon (batch).

    The filter on the row number lets Spark cut every id down to one row per
    map task before the shuffle, so an id that repeats without end stays small.
    """
    order = [c for c in _REPEAT_ORDER if c in events.columns]
    first = F.row_number().over(Window.partitionBy("event_id").orderBy(*order))
    return events.withColumn("_copy", first).filter("_copy = 1").drop("_copy")
