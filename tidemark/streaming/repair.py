"""Windows that closed before all their events came, computed again.

A stateful query drops an event whose window ends behind the watermark. The event
store has it all the same, with the batch it came with; so the batches tell which
windows were closed when it arrived, and only these are computed again, from the
stored events of their dates. The rows go into the metric table with batch
numbers above any of the stream's in the same run, so they win there, and lose to
a later run, as rows of an older checkpoint do.
"""

from __future__ import annotations

from datetime import timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators import metrics as m
from tidemark.sources import files
from tidemark.streaming.event_store import EventStore
from tidemark.streaming.metric_table import MetricTable

QUERY = "repair"
# Batch numbers of repairs; a stream does not get here.
FIRST_REPAIR = 1 << 39
# Window type -> width in minutes. A window of five minutes starts every minute.
_WIDTHS = {"1m": 1, "5m": 5, "1h": 60}


def watermarks(stored: DataFrame, delay: str) -> DataFrame:
    """(run, batch_id, reached): how far the watermark can have been once the batch was through; a row for each batch.

    A query whose batches are larger or smaller than the store's has seen no more
    than the events up to the end of this one, so no window it had closed is missed.
    """
    newest = stored.groupBy("run", "batch_id").agg(F.max("timestamp").alias("newest"))
    # One row for each batch of the store.
    upto = Window.partitionBy("run").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    return newest.select("run", "batch_id", (F.max("newest").over(upto) - F.expr(f"INTERVAL {delay}")).alias("reached"))


def late_windows(stored: DataFrame, delay: str) -> DataFrame:
    """(window_type, window_start) of the windows that may have been closed when one of their events came."""
    # Minutes and batches first: an event of a busy minute is one row here.
    minutes = stored.groupBy("run", "batch_id", F.date_trunc("minute", "timestamp").alias("minute")).agg(F.count("*").alias("n"))
    late = minutes.join(watermarks(stored, delay), ["run", "batch_id"]).filter("minute < reached")
    starts = {
        "1m": F.array("minute"),
        "5m": F.array(*(F.expr(f"minute - INTERVAL {i} MINUTE") for i in range(5))),
        "1h": F.array(F.date_trunc("hour", "minute")),
    }
    closed = [
        late.select(F.lit(kind).alias("window_type"), "reached", F.explode(start).alias("window_start")).filter(
            F.col("window_start") + F.expr(f"INTERVAL {_WIDTHS[kind]} MINUTE") <= F.col("reached")
        )
        for kind, start in starts.items()
    ]
    return reduce(DataFrame.unionByName, closed).select("window_type", "window_start").distinct()


def repair_late(spark: SparkSession, store: EventStore, table: MetricTable, delay: str, run: int = 0) -> int:
    """Write the metrics of the windows that late events belong to; returns the number of rows.

    It may be run at any time and as often as one likes: a window is computed
    from all its stored events, and a repair that is repeated changes nothing.
    """
    stored = store.current()
    windows = late_windows(stored.select("run", "batch_id", "timestamp"), delay)
    days = [r["d"] for r in windows.select(F.to_date("window_start").alias("d")).distinct().collect()]
    if not days:
        return 0
    # Windows may reach into the next date.
    touched = sorted({d + timedelta(days=n) for d in days for n in (0, 1)})
    events = store.on_dates(set(touched)).withColumnRenamed("category_name", "category")
    again = m.all_metrics(events).join(windows, ["window_type", "window_start"], "left_semi")
    return table.batch_writer(QUERY, run)(again, _next(spark, table, run))


def _next(spark: SparkSession, table: MetricTable, run: int) -> int:
    """The number after the last repair, compacted or not."""
    state = table._state()
    done = [b["batch_id"] for b in state["batches"] if b["query"] == QUERY and b["run"] == run]
    place = f"{table.root}/updates/query={QUERY}/run={run}"
    done += [int(name.removeprefix("batch_id=")) for name in files.children(spark, place) if name.startswith("batch_id=")]
    return max(done, default=FIRST_REPAIR - 1) + 1
