"""Bronze and Silver by event time, with Spark's own file sink, watermark and state store.

Bronze is a partitioned Parquet folder that the file sink writes; its log makes
every batch visible whole or not at all, keeps all files, and is what the
next stream follows, so a reader that starts late or was down misses nothing.
Silver drops log rows that are delivered again within the watermark. Their
state is bounded by the watermark; rows behind it are dropped by the operator,
which counts them (``dropped_late``), and come in with reconciliation.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..functions.rules import clock, observed
from ..operators.bronze import to_bronze
from ..operators.route import quarantine, valid
from ..plans.reconcile import validated
from ..schemas import BRONZE
from ..sources.tables import Table
from .state import state_store

POSITION = ["kafka_partition", "kafka_offset"]


def bronze_files(log: DataFrame, path: str, checkpoint: str, *, config: Config = Config(), now: datetime | Column | None = None, once: bool = False) -> StreamingQuery:
    """The log as Bronze files by arrival date."""
    writer = to_bronze(log, now).writeStream.queryName("bronze_files").format("parquet").partitionBy("ingest_date").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=config.trigger)
    return writer.start(path)


class FileBronze:
    """Bronze files as reconciliation reads them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def read(self, since: str | None = None) -> DataFrame:
        rows = self.spark.read.schema(BRONZE).parquet(self.path)
        return rows if since is None else rows.filter(F.col("ingest_date") >= F.lit(since).cast("date"))

    def stream(self, max_files: int = 1000) -> DataFrame:
        return self.spark.readStream.schema(BRONZE).option("maxFilesPerTrigger", max_files).parquet(self.path)


def event_time(config: Config, now: datetime | Column | None) -> Column:
    """A reading's time; the log's where it has none or lies beyond the clock skew, so that a bad clock moves no watermark."""
    at = F.col("reading_timestamp")
    return F.when(at <= clock(now) + F.make_interval(hours=F.lit(config.max_clock_skew_hours)), at).otherwise(F.col("kafka_timestamp"))


def deduplicated(bronze: DataFrame, *, config: Config = Config(), now: datetime | Column | None = None) -> DataFrame:
    """A stream of Bronze rows without those seen before within the watermark: the same position, log time and payload."""
    timed = bronze.withColumn("event_time", event_time(config, now)).withColumn("_payload", F.xxhash64("raw_payload")).withWatermark("event_time", f"{config.watermark_hours} hours")
    return timed.dropDuplicatesWithinWatermark([*POSITION, "kafka_timestamp", "_payload"]).drop("_payload")


def silver_events(
    bronze: DataFrame,
    silver: Table,
    quarantined: Table,
    dims: Callable[[], tuple[DataFrame, DataFrame]],
    checkpoint: str,
    *,
    config: Config = Config(),
    now: datetime | Column | None = None,
    once: bool = False,
) -> StreamingQuery:
    """A stream of Bronze rows into Silver and quarantine; ``dims`` is asked anew for every batch.

    Positions seen are kept in RocksDB, on disk, as a batch's own do not leave before the next one.
    """

    def each(df: DataFrame, n: int) -> None:
        if silver.applied(("events", n)):
            return
        rows = observed(validated(df.drop("event_time"), *dims(), config=config, now=now)).persist()
        try:
            quarantined.insert_absent(quarantine(rows, now, ("kafka_timestamp",)), batch=("events", n))
            silver.upsert(valid(rows), ("events", n))
        finally:
            rows.unpersist()

    writer = deduplicated(bronze, config=config, now=now).writeStream.queryName("silver_events").option("checkpointLocation", checkpoint).foreachBatch(each)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=config.trigger)
    with state_store(bronze.sparkSession):
        return writer.start()


def state_of(query: StreamingQuery) -> dict[str, int]:
    """What the query's recent batches say of its state: rows held now and at most, rows dropped as late, and as seen before."""
    states = [p["stateOperators"][0] for p in query.recentProgress if p["stateOperators"]]
    held = [s["numRowsTotal"] for s in states]
    return {
        "rows": held[-1] if held else 0,
        "most_rows": max(held, default=0),
        "dropped_late": sum(s["numRowsDroppedByWatermark"] for s in states),
        "dropped_twice": sum(int(s["customMetrics"].get("numDroppedDuplicateRows", 0)) for s in states),
    }
