"""Daily and hourly batch jobs."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.ingest import is_valid
from tidemark.operators.sessions import sessions
from tidemark.plans import marts, quality, staging
from tidemark.plans.ledger import IdLedger
from tidemark.schemas import RAW_EVENTS, SESSION_IDLE_SECONDS
from tidemark.sources import files
from tidemark.sources.tables import Tables, read_products, read_raw_events, read_users

LOOKBACK_HOURS = 24
DAILY_MARTS = (
    "mart_daily_summary",
    "mart_product_performance",
    "mart_user_segments",
    "mart_funnel_analysis",
    "mart_geo_revenue",
    "mart_hourly_kpi",
)
# Marts written at the same time, so that one's last tasks do not idle the cluster.
MARTS_AT_ONCE = 4


class NotReady(RuntimeError):
    """The day before has no events yet."""


def between_dates(events: DataFrame, first: date, last: date | None) -> DataFrame:
    kept = events.filter(F.col("event_date") >= F.lit(first))
    return kept if last is None else kept.filter(F.col("event_date") <= F.lit(last))


def replace_dates(
    rows: DataFrame,
    path: str,
    partition: str = "date",
    first: date | None = None,
    last: date | None = None,
) -> None:
    """Overwrite the partitions that occur in ``rows``; of the given dates the others go.

    Every write gives its files new names, so a partition whose files are the
    same as before had no rows this time.
    """
    spark = rows.sparkSession

    def stored() -> dict[str, list[str]]:
        low, high = f"{partition}={first}", f"{partition}={last}"
        found = [p for p in files.children(spark, path) if first and low <= p <= high]
        return {p: files.children(spark, f"{path}/{p}") for p in found}

    before = stored()
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(partition)
        .parquet(path)
    )
    for folder, names in stored().items():
        if before.get(folder) == names:
            files.delete(spark, f"{path}/{folder}")


def one_file_per_date(mart: DataFrame) -> DataFrame:
    """Gather each date's rows before a write; AQE splits a date that is large."""
    return mart.hint("rebalance", "date")


def sessions_begun(events: DataFrame, first: date, last: date) -> DataFrame:
    """Sessions that began on the given dates, whole.

    Whether a session begins on a date depends on the half hour before it, so
    one earlier day suffices. A session may go on after the last date; later
    events are read only of the users who have one open then.
    """

    def begun(seen: DataFrame) -> DataFrame:
        return sessions(seen, attribute="user_segment").filter(
            F.to_date("session_start").between(F.lit(first), F.lit(last))
        )

    columns = ("user_id", "timestamp", "event_date", "user_segment")
    inside = between_dates(events, first - timedelta(days=1), last).select(*columns)
    midnight = F.lit(datetime.combine(last + timedelta(days=1), datetime.min.time()))
    limit = midnight - F.make_dt_interval(secs=F.lit(SESSION_IDLE_SECONDS))
    still_open = begun(inside).filter(F.col("session_end") > limit).select("user_id").distinct()
    later = events.filter(F.col("event_date") > F.lit(last)).select(*columns)
    return begun(inside.unionByName(later.join(still_open, "user_id", "left_semi")))


def new_events(
    spark: SparkSession,
    tables: Tables,
    first: date,
    last: date,
    repeats_since: date | None = None,
) -> DataFrame:
    """Staged form of the raw events of some dates.

    An id that was staged on an earlier date does not come back. The ledger of
    staged ids tells; of the earlier dates nothing is read but the buckets of
    the ledger that may hold one of the ids. Where ids are known not to repeat
    after some days, ``repeats_since`` spares looking at what is older.
    """
    raw = between_dates(read_raw_events(spark, tables), first, last)
    fresh = staging.stg_events(raw)
    if not files.exists(spark, tables.path("stg_events")):
        return fresh
    ledger = id_ledger(spark, tables)
    state = ledger.sync(tables.path("stg_events"), first)
    ids = raw.filter(is_valid()).select("event_id")
    return fresh.join(ledger.known(ids, state, first, repeats_since), "event_id", "left_anti")


def id_ledger(spark: SparkSession, tables: Tables) -> IdLedger:
    return IdLedger(spark, tables.path("id_ledger"))


def staged_events(spark: SparkSession, tables: Tables) -> DataFrame:
    return spark.read.schema(RAW_EVENTS).parquet(tables.path("stg_events"))


def touched_dates(upto: datetime, lookback_hours: int) -> tuple[date, date]:
    """First and last date of the lookback that ends at ``upto`` (exclusive)."""
    last = (upto - timedelta(microseconds=1)).date()
    return (upto - timedelta(hours=lookback_hours)).date(), last


def build_daily_marts(
    spark: SparkSession, tables: Tables, first: date, last: date
) -> dict[str, DataFrame]:
    """Marts of some dates, as plans. Distinct counts need whole dates."""
    everything = staged_events(spark, tables)
    events = between_dates(everything, first, last)
    users = staging.stg_users(read_users(spark, tables))
    products = staging.stg_products(read_products(spark, tables))
    return {
        "mart_daily_summary": marts.daily_summary(events),
        "mart_product_performance": marts.product_performance(events, products),
        "mart_user_segments": marts.user_segments(events, sessions_begun(everything, first, last)),
        "mart_funnel_analysis": marts.funnel_analysis(events),
        "mart_geo_revenue": marts.geo_revenue(events, users),
        "mart_hourly_kpi": dated_hours(events),
    }


def dated_hours(events: DataFrame) -> DataFrame:
    return marts.hourly_kpi(events).withColumn("date", F.to_date("hour_start"))


def read_mart(spark: SparkSession, tables: Tables, name: str) -> DataFrame:
    return spark.read.parquet(tables.path(name))


def run_daily(
    spark: SparkSession,
    tables: Tables,
    today: date,
    lookback_hours: int = LOOKBACK_HOURS,
    repeats_since: date | None = None,
) -> DataFrame:
    """Gate, staging, daily marts, checks. Returns the check results.

    Covers the day before ``today`` and the lookback before that day.
    """
    yesterday = today - timedelta(days=1)
    if quality.events_of_day(read_raw_events(spark, tables), yesterday).isEmpty():
        raise NotReady(f"no events on {yesterday}")
    midnight = datetime.combine(yesterday, datetime.min.time())
    first, last = touched_dates(midnight, lookback_hours)[0], yesterday
    # Staged once because every mart reads it: removing repeated ids shuffles
    # whole events. One more day on each side holds the ends of sessions that
    # cross midnight.
    around = first - timedelta(days=1), today
    staged = new_events(spark, tables, *around, repeats_since)
    replace_dates(staged, tables.path("stg_events"), "event_date", *around)
    id_ledger(spark, tables).sync(tables.path("stg_events"))
    built = build_daily_marts(spark, tables, first, last)
    with ThreadPoolExecutor(MARTS_AT_ONCE) as pool:
        for write in [
            pool.submit(
                replace_dates, one_file_per_date(mart), tables.path(name), "date", first, last
            )
            for name, mart in built.items()
        ]:
            write.result()
    results = quality.combine(
        [
            quality.staging_checks(
                between_dates(staged_events(spark, tables), first, last),
                staging.stg_users(read_users(spark, tables)),
                staging.stg_products(read_products(spark, tables)),
            ),
            quality.mart_checks(
                {
                    n: read_mart(spark, tables, n).filter(
                        F.col("date").between(F.lit(first), F.lit(last))
                    )
                    for n in DAILY_MARTS
                }
            ),
        ]
    )
    checked = results.coalesce(1).withColumn("run_date", F.lit(today))
    replace_dates(checked, tables.path("check_results"), "run_date")
    done = spark.read.parquet(tables.path("check_results")).filter(F.col("run_date") == F.lit(today))
    quality.enforce(done)
    return done


def run_hourly(
    spark: SparkSession,
    tables: Tables,
    now: datetime,
    lookback_hours: int = LOOKBACK_HOURS,
    repeats_since: date | None = None,
) -> DataFrame:
    """Rebuild the hourly mart on the dates the lookback touches, and check it."""
    first, last = touched_dates(now, lookback_hours)
    dated = dated_hours(new_events(spark, tables, first, last, repeats_since))
    path = tables.path("mart_hourly_kpi")
    replace_dates(one_file_per_date(dated), path, "date", first, last)
    rebuilt = read_mart(spark, tables, "mart_hourly_kpi").filter(
        F.col("date").between(F.lit(first), F.lit(last))
    )
    quality.enforce(quality.mart_checks({"mart_hourly_kpi": rebuilt}))
    return read_mart(spark, tables, "mart_hourly_kpi").drop("date")
