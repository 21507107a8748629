"""Which event ids are staged already, without reading the staged events again.

Layout below one root:

    ids/load=L/bucket=B/      ids and their dates, dealt over buckets by a hash of the id
    filters/load=L/           a Bloom filter for each bucket that has ids
    state/version=V/          which load holds each date, and the files it was taken from

An id that may be known is first looked for in the filters of its bucket; only
the buckets where one was found are read, and there the ids themselves decide.
A load is one date, or the dates that were folded into one; it becomes visible
with the state file that names it. Each date is held with the names of the files
it was taken from, so that a date that was staged anew, or staged by a job that
died before it came here, is found and loaded again. The ledger can be deleted
at any time; the next job makes it anew.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from datetime import date
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import shared_dir
from tidemark.sources import files

# Of a new ledger. A bucket of a load is read by one task, and its filter is one row.
BUCKETS = 256
# Together a false find for each 170,000 ids that are looked up in a filter.
BITS_PER_ID = 32
HASHES = 8

_IDS = "event_id STRING, event_date DATE, bucket INT"
_FILTERS = "bucket INT, bits ARRAY<LONG>, load STRING"
_STATE = """
    version INT, buckets INT,
    dates ARRAY<STRUCT<event_date: STRING, load: STRING, source: STRING>>
"""


@dataclass
class State:
    version: int = 0
    buckets: int = BUCKETS
    #: date -> (load, names of the files it was taken from)
    dates: dict[str, tuple[str, str]] = field(default_factory=dict)

    def loads(self, before: str, since: str = "") -> set[str]:
        return {load for d, (load, _) in self.dates.items() if since <= d < before}


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("event_id"), F.lit(buckets)).cast("int")


def _places(n_bits: Column) -> list[Column]:
    """The bits of an id in a filter of so many, by double hashing; 31 bits of hash each, so that no product overflows."""
    mixed = F.xxhash64("event_id", F.lit("ledger"))
    start = F.shiftrightunsigned(mixed, 33)
    step = mixed.bitwiseAND(F.lit(0x7FFFFFFF)).bitwiseOR(F.lit(1))
    return [F.pmod(start + step * F.lit(i), n_bits) for i in range(HASHES)]


def may_hold(bits: Column) -> Column:
    """Whether a filter may hold the id; a conjunction that ends at the first bit that is not set."""
    n_bits = F.size(bits).cast("long") * 64
    tests = [
        F.getbit(F.get(bits, F.shiftrightunsigned(p, 6).cast("int")), p.bitwiseAND(F.lit(63)).cast("int")) == 1
        for p in _places(n_bits)
    ]
    return reduce(lambda a, b: a & b, tests)


def filters_of(ids: DataFrame) -> DataFrame:
    """(bucket, bits): a filter for each bucket of (event_id, bucket), its size by the number of its ids."""
    words = F.greatest(F.lit(1), F.ceil(F.count("*") * BITS_PER_ID / 64)).cast("long")
    # One row for each bucket.
    sizes = F.broadcast(ids.groupBy("bucket").agg(words.alias("words")))
    place = F.explode(F.array(*_places(F.col("words") * 64))).alias("place")
    set_bits = ids.join(sizes, "bucket").select("bucket", place).select(
        "bucket",
        F.shiftrightunsigned("place", 6).alias("word"),
        # Shifted by a column, which the function for literals does not take.
        F.expr("shiftleft(1L, CAST(place & 63 AS INT))").alias("bits"),
    )
    nothing = sizes.select("bucket", F.explode(F.sequence(F.lit(0).cast("long"), F.col("words") - 1)).alias("word"), F.lit(0).cast("long").alias("bits"))
    by_word = set_bits.union(nothing).groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))
    in_order = F.array_sort(F.collect_list(F.struct("word", "bits")))
    return by_word.groupBy("bucket").agg(F.transform(in_order, lambda w: w["bits"]).alias("bits"))


class IdLedger:
    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark = spark
        self.root = root.rstrip("/")
        self._buckets = buckets

    def _path(self, *parts: object) -> str:
        return "/".join([self.root, *map(str, parts)])

    def state(self) -> State:
        """The newest committed state; its size grows with the calendar only."""
        versions = [
            int(name.split("=")[1])
            for name in files.children(self.spark, self._path("state"))
            if files.exists(self.spark, self._path("state", name, "_SUCCESS"))
        ]
        if not versions:
            return State(buckets=self._buckets)
        row = self.spark.read.schema(_STATE).json(self._path("state", f"version={max(versions)}")).first()
        return State(row["version"], row["buckets"], {d["event_date"]: (d["load"], d["source"]) for d in row["dates"]})

    def _commit(self, before: State, dates: dict[str, tuple[str, str]]) -> State:
        """Make a new state current. Where another job was first, its state stays and this one serves this job alone."""
        state = State(before.version + 1, before.buckets, dates)
        listed = [{"event_date": d, "load": load, "source": source} for d, (load, source) in sorted(dates.items())]
        rows = self.spark.createDataFrame([(state.version, state.buckets, listed)], _STATE).coalesce(1)
        try:
            rows.write.mode("errorifexists").json(self._path("state", f"version={state.version}"))
        except AnalysisException as error:
            if error.getCondition() != "PATH_ALREADY_EXISTS":
                raise
        return state

    def _load(self, ids: DataFrame, state: State) -> str:
        """Write (event_id, event_date) as a load of its own."""
        load = uuid.uuid4().hex
        target = self._path("ids", f"load={load}")
        dealt = ids.select("event_id", "event_date", bucket_of(state.buckets).alias("bucket"))
        dealt.repartition("bucket").write.partitionBy("bucket").parquet(target)
        written = self.spark.read.schema(_IDS).parquet(target)
        filters_of(written).write.parquet(self._path("filters", f"load={load}"))
        return load

    def sync(self, staged: str, before: date | None = None) -> State:
        """Bring the dates of the staged events up to date, those before a date if one is given.

        Only folder names are compared; the ids of a date are read when it is
        new or its files have changed. Dates that are no longer staged go.
        """
        state = self.state()
        limit = str(before or date.max)
        found = {}
        for folder in files.children(self.spark, staged):
            day = folder.removeprefix("event_date=")
            if folder.startswith("event_date=") and day < limit:
                names = [n for n in files.children(self.spark, f"{staged}/{folder}") if n.startswith("part-")]
                found[day] = f"{len(names)} {min(names, default='')} {max(names, default='')}"
        dates = {d: held for d, held in state.dates.items() if d >= limit or d in found}
        stale = sorted(d for d, names in found.items() if dates.get(d, ("", ""))[1] != names)
        if not stale and len(dates) == len(state.dates):
            return state
        if stale:
            rows = self.spark.read.schema("event_id STRING, event_date DATE").option("basePath", staged)
            load = self._load(rows.parquet(*[f"{staged}/event_date={d}" for d in stale]), state)
            dates |= {d: (load, found[d]) for d in stale}
        return self._commit(state, dates)

    def _valid(self, state: State, wanted: set[str], before: str, since: str) -> Column:
        """Rows of the loads that still hold their date."""
        by_load = {load: [d for d, (of, _) in state.dates.items() if of == load and since <= d < before] for load in wanted}
        clauses = [(F.col("load") == load) & F.col("event_date").isin([date.fromisoformat(d) for d in days]) for load, days in sorted(by_load.items())]
        return reduce(lambda a, b: a | b, clauses, F.lit(False))

    def known(self, fresh: DataFrame, state: State, before: date, since: date | None = None) -> DataFrame:
        """(event_id): the fresh ids that were staged on a date before ``before``.

        The filters meet the fresh ids in a join on the bucket whose condition
        looks at the bits. What they find is written and names the buckets to
        read, at most all buckets of all loads.
        """
        low, high = str(since or date.min), str(before)
        loads = state.loads(high, low)
        if not loads:
            return fresh.select("event_id").limit(0)
        folders = [self._path("filters", f"load={load}") for load in sorted(loads)]
        filters = self.spark.read.schema(_FILTERS).option("basePath", self._path("filters")).parquet(*folders)
        ids = fresh.select("event_id", bucket_of(state.buckets).alias("id_bucket"))
        hits = ids.join(filters, (F.col("id_bucket") == F.col("bucket")) & may_hold(F.col("bits"))).select("event_id", "bucket", "load")
        path = shared_dir(self.spark, "ledger-hits")
        hits.write.parquet(path)
        hits = self.spark.read.schema("event_id STRING, bucket INT, load STRING").parquet(path)
        places = hits.select("load", "bucket").distinct().collect()
        if not places:
            return hits.select("event_id")
        root = self._path("ids")
        stored = (
            self.spark.read.schema(f"{_IDS}, load STRING")
            .option("basePath", root)
            .parquet(*[f"{root}/load={p['load']}/bucket={p['bucket']}" for p in places])
            .filter(self._valid(state, loads, high, low))
        )
        return hits.select("event_id").distinct().join(stored.select("event_id"), "event_id", "left_semi")

    def fold(self, before: date) -> State:
        """Make one load of all dates before a date, so that a lookup meets one filter a bucket for them."""
        state = self.state()
        high = str(before)
        loads = state.loads(high)
        if len(loads) < 2:
            return state
        root = self._path("ids")
        stored = (
            self.spark.read.schema(f"{_IDS}, load STRING")
            .option("basePath", root)
            .parquet(*[f"{root}/load={load}" for load in sorted(loads)])
            .filter(self._valid(state, loads, high, ""))
        )
        load = self._load(stored, state)
        return self._commit(state, {d: (load if d < high else of, names) for d, (of, names) in state.dates.items()})

    def vacuum(self) -> None:
        """Delete loads no date needs and older states. Run it when no job is at work."""
        state = self.state()
        needed = {f"load={load}" for load, _ in state.dates.values()}
        for kind in ("ids", "filters"):
            for folder in files.children(self.spark, self._path(kind)):
                if folder.startswith("load=") and folder not in needed:
                    files.delete(self.spark, self._path(kind, folder))
        for folder in files.children(self.spark, self._path("state")):
            if folder.startswith("version=") and int(folder.split("=")[1]) < state.version:
                files.delete(self.spark, self._path("state", folder))
