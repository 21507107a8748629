"""Tables that streaming batches are written to, each batch once.

Layout below one root:

    updates/query=Q/run=R/batch_id=N/   what one micro-batch wrote
    base/version=V/<date>=D/            compacted rows
    state/version=V/                    which base folders are current for each date,
                                        and the last batch they contain
    audit/query=Q/run=R/batch_id=N/     one line per non-empty batch

A batch folder is overwritten when its batch is replayed, so a replay changes
nothing. A compaction becomes visible only with its state file; one that dies
half-way leaves folders nobody reads, and the next one overwrites them. Only
committed batch folders are read or compacted, so a batch that is being written
or replayed is never taken half.

``run`` counts the checkpoints of a query: batch ids restart with a new one.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidemark.schemas import ddl
from tidemark.sources import files

_STATE = """
    version INT,
    dates ARRAY<STRUCT<window_date: STRING, version: INT>>,
    batches ARRAY<STRUCT<query: STRING, run: INT, batch_id: LONG>>
"""
_ADAPTIVE = "spark.sql.adaptive.enabled"
_AUDIT = "event STRING, metrics_count LONG, query STRING, run INT, batch_id LONG"


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for what is written of a micro-batch.

    A stream turns it off in its session, since its own plan must not change from
    batch to batch; the writes of a finished batch may adapt to its size.
    """
    before = spark.conf.get(_ADAPTIVE)
    if before == "true":
        yield
        return
    spark.conf.set(_ADAPTIVE, "true")
    try:
        yield
    finally:
        spark.conf.set(_ADAPTIVE, before)


class BatchTable:
    """What its rows are, and how rows of several batches become one, is up to the subclass."""

    #: Columns of a row, as DDL.
    schema: str
    #: The partition column of the compacted rows.
    partition = "window_date"

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._columns = [f.name for f in ddl(self.schema)]
        self._output = [*self._columns, "run", "batch_id"]

    def day(self) -> Column:
        """The date a row belongs to."""
        raise NotImplementedError

    def merge(self, rows: DataFrame) -> DataFrame:
        """Rows of several batches, as readers see them; the columns stay, run and batch included."""
        raise NotImplementedError

    def _path(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    # -- writing ------------------------------------------------------------

    def stamped(self, batch: DataFrame) -> DataFrame:
        return batch.select(*self._columns)

    def batch_writer(self, query: str, run: int = 0) -> Callable[[DataFrame, int], int]:
        """A ``foreachBatch`` function that returns the number of rows. Errors fail the batch; Spark then retries it."""
        root = self.root

        def write(batch: DataFrame, batch_id: int) -> int:
            place = f"query={query}/run={run}/batch_id={batch_id}"
            target = f"{root}/updates/{place}"
            # Counted while it is written: the batch is computed once. As many
            # files as its bytes ask for.
            seen = Observation()
            counted = self.stamped(batch).observe(seen, F.count(F.lit(1)).alias("n"))
            spark = batch.sparkSession
            with adaptive(spark):
                counted.hint("rebalance").write.mode("overwrite").parquet(target)
            n = seen.get["n"]
            if not n:  # an empty batch leaves nothing behind
                files.delete(spark, target)
                files.delete(spark, f"{root}/audit/{place}")
                return 0
            files.write_text(spark, f"{root}/audit/{place}/line.json", json.dumps({"event": "refresh", "metrics_count": n}) + "\n")
            return n

        return write

    # -- reading ------------------------------------------------------------

    def _state(self) -> dict:
        """The newest committed compaction; its size grows with the calendar only."""
        versions = [
            int(name.split("=")[1])
            for name in files.children(self.spark, self._path("state"))
            if files.exists(self.spark, self._path("state", name, "_SUCCESS"))
        ]
        if not versions:
            return {"version": 0, "dates": [], "batches": []}
        newest = self._path("state", f"version={max(versions)}")
        return self.spark.read.schema(_STATE).json(newest).first().asDict(recursive=True)

    def _base(self, state: dict, dates: set[str] | None = None) -> DataFrame | None:
        wanted = [d for d in state["dates"] if dates is None or d["window_date"] in dates]
        return self._folders([self._base_folder(d) for d in wanted])

    def _base_folder(self, held: dict) -> str:
        return self._path("base", f"version={held['version']}", f"{self.partition}={held['window_date']}")

    def _folders(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        rows = self.spark.read.option("basePath", self._path("base"))
        return rows.schema(f"{self.schema}, run INT, batch_id LONG").parquet(*folders).select(*self._output)

    def _committed(self, state: dict) -> list[tuple[str, int, int, str]]:
        """Query, run, number and folder of each finished batch that is not compacted yet."""
        upto = {(b["query"], b["run"]): b["batch_id"] for b in state["batches"]}
        found = []
        for path in files.matching(self.spark, self._path("updates", "*", "*", "*", "_SUCCESS")):
            folder = path.rpartition("/")[0]
            query, run, batch = (part.partition("=")[2] for part in folder.split("/")[-3:])
            if int(batch) > upto.get((query, int(run)), -1):
                found.append((query, int(run), int(batch), folder))
        return found

    def _pending(self, committed: list[tuple[str, int, int, str]]) -> DataFrame | None:
        if not committed:
            return None
        rows = self.spark.read.option("basePath", self._path("updates"))
        stored = rows.schema(f"{self.schema}, query STRING, run INT, batch_id LONG")
        return stored.parquet(*[folder for *_, folder in committed])

    def _empty(self) -> DataFrame:
        fields = ddl(f"{self.schema}, run INT, batch_id LONG")
        return self.spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields])

    def _merged(self, state: dict, pending: DataFrame | None, dates: set[str] | None = None) -> DataFrame:
        base = self._base(state, dates)
        parts = [p for p in (base, pending) if p is not None]
        if not parts:
            return self._empty()
        rows = parts[0].select(*self._output)
        for part in parts[1:]:
            rows = rows.unionByName(part.select(*self._output))
        return self.merge(rows)

    def current(self, first: date | None = None, last: date | None = None) -> DataFrame:
        """The merged rows of all dates or of a range; a range reads only the base folders of its dates."""
        state = self._state()
        dates = None
        if first is not None or last is not None:
            low, high = str(first or date.min), str(last or date.max)
            dates = {d["window_date"] for d in state["dates"] if low <= d["window_date"] <= high}
        rows = self._merged(state, self._pending(self._committed(state)), dates).select(*self._output)
        if first is not None:
            rows = rows.filter(self.day() >= F.lit(first))
        if last is not None:
            rows = rows.filter(self.day() <= F.lit(last))
        return rows

    def on_dates(self, dates: set[date]) -> DataFrame:
        """The merged rows of some dates, which need not follow each other."""
        state = self._state()
        pending = self._pending(self._committed(state))
        if pending is not None:
            pending = pending.filter(self.day().isin(list(dates)))
        return self._merged(state, pending, {str(d) for d in dates})

    def audit(self) -> DataFrame:
        return self.spark.read.schema(_AUDIT).json(self._path("audit"))

    # -- upkeep -------------------------------------------------------------

    def _replaced(self, held: list[dict]) -> list[dict]:
        """Which base folders of a touched date a compaction takes in again."""
        return held

    def _base_rows(self, rows: DataFrame) -> DataFrame:
        """Rows as they are laid out in the base."""
        return rows

    def _base_written(self, version: int) -> None:
        """Called before the new base folders become current."""

    def compact(self) -> int:
        """Fold the pending batches into new base folders of the dates they touch.

        Returns the version now current. Batches that arrive meanwhile stay
        pending.
        """
        state = self._state()
        committed = self._committed(state)
        fixed = self._pending(committed)
        if fixed is None:
            return state["version"]
        upto = {(b["query"], b["run"]): b["batch_id"] for b in state["batches"]}
        for query, run, batch, _ in committed:
            upto[(query, run)] = max(batch, upto.get((query, run), -1))
        batches = [{"query": q, "run": r, "batch_id": n} for (q, r), n in sorted(upto.items())]
        dated = fixed.select(self.day().cast("string").alias("d")).distinct()
        touched = {row["d"] for row in dated.collect()}
        if not touched:
            return state["version"]
        version = state["version"] + 1
        taken = [h for d in sorted(touched) for h in self._replaced([x for x in state["dates"] if x["window_date"] == d])]
        again = self._folders([self._base_folder(h) for h in taken])
        rows = fixed.select(*self._output)
        merged = self.merge(rows if again is None else again.unionByName(rows))
        (
            self._base_rows(merged.select(*self._output).withColumn(self.partition, self.day()))
            .write.mode("overwrite")
            .partitionBy(self.partition)
            .parquet(self._path("base", f"version={version}"))
        )
        self._base_written(version)
        dates = [d for d in state["dates"] if d not in taken] + [{"window_date": d, "version": version} for d in touched]
        dates.sort(key=lambda d: (d["window_date"], d["version"]))
        (
            self.spark.createDataFrame([(version, dates, batches)], _STATE)
            .coalesce(1)
            .write.mode("overwrite")
            .json(self._path("state", f"version={version}"))
        )
        return version

    def vacuum(self) -> None:
        """Delete compacted batches and replaced base folders. Run it when nobody reads."""
        state = self._state()
        current = {(str(d["version"]), d["window_date"]) for d in state["dates"]}
        for folder in files.children(self.spark, self._path("base")):
            if not folder.startswith("version="):
                continue
            version = folder.split("=")[1]
            if int(version) > state["version"]:
                continue
            for day in files.children(self.spark, self._path("base", folder)):
                if day.startswith(f"{self.partition}=") and (version, day.split("=")[1]) not in current:
                    files.delete(self.spark, self._path("base", folder, day))
        for done in state["batches"]:
            place = ("updates", f"query={done['query']}", f"run={done['run']}")
            for folder in files.children(self.spark, self._path(*place)):
                number = folder.removeprefix("batch_id=")
                if number.isdigit() and int(number) <= done["batch_id"]:
                    files.delete(self.spark, self._path(*place, folder))
