"""What the streaming queries hold in their state, read from their checkpoints."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources import files

ROWS = "query STRING, operator STRING, store STRING, batch_id LONG, rows LONG"


def _stores(spark: SparkSession, checkpoint: str) -> list[tuple[int, str, str, int]]:
    """(operator id, operator, store, last batch) of a checkpoint; one entry for each stateful operator and store."""
    meta = spark.read.format("state-metadata").load(checkpoint)
    found = meta.select("operatorId", "operatorName", "stateStoreName", "maxBatchId").distinct().collect()
    return sorted(tuple(r) for r in found)


def has_state(spark: SparkSession, checkpoint: str) -> bool:
    return files.exists(spark, f"{checkpoint}/state")


def state_rows(spark: SparkSession, query: str, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Rows of state by operator and store, after the last batch or another one that is still kept."""
    counts = []
    for operator_id, operator, store, last in _stores(spark, checkpoint):
        reader = spark.read.format("statestore").option("operatorId", operator_id).option("storeName", store)
        at = last if batch_id is None else batch_id
        rows = reader.option("batchId", at).load(checkpoint)
        counts.append(
            rows.agg(F.count("*").alias("rows")).select(
                F.lit(query).alias("query"), F.lit(operator).alias("operator"), F.lit(store).alias("store"), F.lit(at).cast("long").alias("batch_id"), "rows"
            )
        )
    return reduce(DataFrame.unionByName, counts) if counts else spark.createDataFrame([], ROWS)


def all_state(spark: SparkSession, layout, queries: tuple[str, ...]) -> DataFrame:
    """The state of several queries of an installation; those without state have no rows."""
    held = [state_rows(spark, q, layout.checkpoint(q)) for q in queries if has_state(spark, layout.checkpoint(q))]
    return reduce(DataFrame.unionByName, held) if held else spark.createDataFrame([], ROWS)


def too_large(states: DataFrame, limits: dict[str, int]) -> DataFrame:
    """The stores that hold more rows than the query is allowed."""
    limit = F.lit(None).cast("long")
    for query, most in limits.items():
        limit = F.when(F.col("query") == query, F.lit(most)).otherwise(limit)
    return states.withColumn("limit", limit).filter(F.col("rows") > F.col("limit"))
