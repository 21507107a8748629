"""Event streams. Every kind yields ``value BINARY, timestamp TIMESTAMP``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import RAW_EVENTS_TOPIC


def kafka_options(servers: str, topic: str = RAW_EVENTS_TOPIC, **extra: str) -> dict[str, str]:
    """Start at the newest offsets and go on when the broker has expired some."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        "failOnDataLoss": "false",
        **extra,
    }


def read_events_stream(
    spark: SparkSession, kind: str, location: str, **options: str
) -> DataFrame:
    """Open the raw event stream.

    ``kafka``: location is the broker list. ``json``: a folder of JSON lines.
    ``parquet``: a folder of files with ``value`` and ``timestamp``.
    Rate limits (``maxOffsetsPerTrigger``, ``maxFilesPerTrigger``) pass through.
    """
    reader = spark.readStream
    if kind == "kafka":
        raw = reader.format("kafka").options(**kafka_options(location, **options)).load()
        return raw.select("value", "timestamp")
    if kind == "json":
        lines = reader.options(**options).text(location)
        return lines.select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_modification_time").alias("timestamp"),
        )
    if kind == "parquet":
        schema = "value BINARY, timestamp TIMESTAMP"
        return reader.schema(schema).options(**options).parquet(location)
    raise ValueError(f"unknown stream kind: {kind}")
