"""A store of raw events that is written batch by batch and kept in few files.

Each batch is a folder of its own until a compaction, so that a replayed batch
overwrites what it wrote before, and readers see an event once whatever happens.
A compaction packs the batches of a date into one folder. Folders of a date that
are still smaller than ``target_bytes`` are packed again with what is new; a
larger one is never rewritten. So each byte is rewritten a bounded number of
times, and a date has about a file for each ``target_bytes`` of events and few
more.

Events carry the run and the batch they came with, which tells in what order
they arrived (see ``repair``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ingest import UNKNOWN, to_stored
from tidemark.schemas import RAW_EVENTS
from tidemark.sources import files
from tidemark.streaming.batch_table import BatchTable

TARGET_BYTES = 512 << 20
# Beside the columns of the stored events: what hourly metrics are counted by,
# and the whole message where it has fields that no schema names.
_MORE = {"sku": "STRING", "extra": "VARIANT"}


class EventStore(BatchTable):
    schema = ", ".join([RAW_EVENTS.strip(), *(f"{name} {kind}" for name, kind in _MORE.items())])
    partition = "event_date"

    def __init__(self, spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES):
        super().__init__(spark, root)
        self.target_bytes = target_bytes

    @staticmethod
    def exists_at(spark: SparkSession, root: str) -> bool:
        return any(files.exists(spark, f"{root}/{part}") for part in ("state", "updates"))

    def day(self) -> Column:
        return F.col("event_date")

    def stamped(self, batch: DataFrame) -> DataFrame:
        """Clean flat events, or rows that have the stored form already."""
        if "category_name" not in batch.columns:
            sku = F.col("sku") if "sku" in batch.columns else F.lit(None).cast("string")
            extra = F.try_parse_json(F.col(UNKNOWN)) if UNKNOWN in batch.columns else F.lit(None).cast("variant")
            batch = to_stored(batch.select("*", sku.alias("_sku"), extra.alias("extra")), "_sku", "extra").withColumnRenamed("_sku", "sku")
        return batch.select(*self._columns)

    def merge(self, rows: DataFrame) -> DataFrame:
        return rows

    def _replaced(self, held: list[dict]) -> list[dict]:
        return [h for h in held if files.size(self.spark, self._base_folder(h)) < self.target_bytes]

    def _base_rows(self, rows: DataFrame) -> DataFrame:
        # A date's rows side by side; a large date becomes several files.
        return rows.hint("rebalance", self.partition)
