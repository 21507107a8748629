"""The metric table: streaming batches go in, the newest value per key comes out."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.schemas import METRIC, METRIC_COLUMNS, METRIC_KEY
from tidemark.streaming.batch_table import BatchTable


def newest_per_key(rows: DataFrame) -> DataFrame:
    """One row per metric key, from the latest run and batch.

    Run and batch make up one number, so the aggregate keeps only fixed-width
    values and stays a hash aggregate.
    """
    place = F.shiftleft(F.col("run").cast("long"), 40) + F.col("batch_id")
    rest = [c for c in rows.columns if c not in METRIC_KEY]
    newest = [F.max_by(c, "_place").alias(c) for c in rest]
    return rows.withColumn("_place", place).groupBy(*METRIC_KEY).agg(*newest)


# What point reads ask for; the compacted rows of a date are sorted by it.
_CLUSTER = ("metric_name", "dimension_key", "dimension_value")
_RANGES = "file STRING, window_date STRING, low STRUCT<n: STRING, k: STRING, v: STRING>, high STRUCT<n: STRING, k: STRING, v: STRING>"


class MetricTable(BatchTable):
    """Beside the compacted rows lies, for each of their files, the range of keys it holds:

        ranges/version=V/
    """

    schema = f"{METRIC}, computed_at TIMESTAMP"

    def day(self) -> Column:
        return F.to_date("window_start")

    def stamped(self, batch: DataFrame) -> DataFrame:
        return batch.select(*METRIC_COLUMNS, F.current_timestamp().alias("computed_at"))

    def merge(self, rows: DataFrame) -> DataFrame:
        return newest_per_key(rows)

    # -- point reads ----------------------------------------------------------

    def _base_rows(self, rows: DataFrame) -> DataFrame:
        order = [self.partition, *_CLUSTER, "window_start"]
        return rows.repartitionByRange(*order).sortWithinPartitions(*order)

    def _base_written(self, version: int) -> None:
        folder = self._path("base", f"version={version}")
        rows = self.spark.read.schema(f"{METRIC}, {self.partition} STRING").parquet(folder)
        key = F.struct(*(F.col(c).alias(a) for c, a in zip(_CLUSTER, "nkv", strict=True)))
        files_ = rows.groupBy(F.col("_metadata.file_path").alias("file"), F.col(self.partition).alias("window_date"))
        ranges = files_.agg(F.min(key).alias("low"), F.max(key).alias("high"))
        ranges.coalesce(1).write.mode("overwrite").json(self._path("ranges", f"version={version}"))

    def point(self, metric: str, dimension_key: str = "", dimension_value: str = "", first: date | None = None, last: date | None = None) -> DataFrame:
        """The windows of one metric and dimension value; of the compacted rows only the files that may hold it are read."""
        state = self._state()
        low, high = str(first or date.min), str(last or date.max)
        held = {(d["version"], d["window_date"]) for d in state["dates"] if low <= d["window_date"] <= high}
        found: list[str] = []
        wanted = F.struct(F.lit(metric).alias("n"), F.lit(dimension_key).alias("k"), F.lit(dimension_value).alias("v"))
        for version in sorted({v for v, _ in held}):
            ranges = self.spark.read.schema(_RANGES).json(self._path("ranges", f"version={version}"))
            inside = ranges.filter((F.col("low") <= wanted) & (wanted <= F.col("high")))
            found += [r["file"] for r in inside.collect() if (version, r["window_date"]) in held]
        base = self._folders(found)
        pending = self._pending(self._committed(state))
        parts = [p.select(*self._output) for p in (base, pending) if p is not None]
        if not parts:
            return self._empty()
        rows = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
        same = (F.col("metric_name") == metric) & (F.col("dimension_key") == dimension_key) & (F.col("dimension_value") == dimension_value)
        return self.merge(rows.filter(same & self.day().between(F.lit(low).cast("date"), F.lit(high).cast("date"))))
