"""Bronze and Silver as streams.

Bronze appends decoded log rows. Silver follows Bronze's commits and, batch by
batch, enriches and judges the rows they added and feeds two tables: an upsert of
valid rows and an append of quarantined ones. Directories of writes that were
never committed are not seen. The upsert needs no stream state, so late rows are
never dropped; the watermark only tells how many rows of a batch are late, which
``report`` gets. Tables record the batches they hold, so a
batch replayed after a failure is skipped.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import Config
from ..functions.rules import clock, observed
from ..operators.bronze import to_bronze
from ..operators.route import quarantine, valid
from ..plans.reconcile import validated
from ..sources.tables import Table


def _start(stream: DataFrame, name: str, checkpoint: str, each: Callable[[DataFrame, int], None], config: Config, once: bool) -> StreamingQuery:
    writer = stream.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(each)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime=config.trigger)
    return writer.start()


def bronze_stream(log: DataFrame, table: Table, checkpoint: str, *, config: Config = Config(), now: datetime | Column | None = None, once: bool = False) -> StreamingQuery:
    return _start(to_bronze(log, now), "bronze", checkpoint, lambda df, n: table.append(df, ("bronze", n)), config, once)


def commits(table: Table, max_commits: int = 1) -> DataFrame:
    """A table's log as a stream of (version), ``max_commits`` a micro-batch.

    The stream only tells that there are commits up to a version: it lists names, so a
    commit counts whatever its file held when it was listed, and the batch reads all
    versions since its last one by number (``unread``).
    """
    log = table.spark.readStream.format("binaryFile").schema("path string, modificationTime timestamp, length long, content binary").option("pathGlobFilter", "*.json").option("maxFilesPerTrigger", max_commits).load(f"{table.path}/log")
    return log.select(F.regexp_extract("path", r"(\d+)\.json$", 1).cast("long").alias("version"))


def unread(table: Table, done: int | None, newest: int) -> tuple[DataFrame, int]:
    """The rows that versions behind ``done`` up to ``newest`` appended, and the version that is read then.

    A reader that has read nothing and finds the first commits collected takes the whole table as
    it is; one that has read before fails if a commit that it needs is gone.
    """
    held = table._numbers("log")
    wanted = range((done or 0) + 1, newest + 1)
    gone = sorted(set(wanted) - set(held))
    if not gone:
        return table.added(list(wanted)), newest
    if done is not None:
        raise RuntimeError(f"the table no longer keeps version {gone[0]}, which its reader has not read")
    state = table.manifest()
    return table.read(state["version"]), state["version"]


#: Where Silver's commits keep the greatest event time seen, in microseconds.
MARK = "silver.watermark"
#: Where they keep the last version of Bronze that they hold.
DONE = "bronze.version"


def lateness(rows: DataFrame, before: int | None, config: Config, now: datetime | Column | None) -> DataFrame:
    """One row (seen, late): the batch's greatest sane event time, and its rows more than the watermark's hours behind ``before``.

    Times beyond the clock skew move nothing, so one bad clock cannot make all that follows late.
    """
    at = F.col("reading_timestamp")
    sane = F.when(at <= clock(now) + F.make_interval(hours=F.lit(config.max_clock_skew_hours)), F.unix_micros(at))
    limit = F.lit(None).cast("long") if before is None else F.lit(before - config.watermark_hours * 3_600_000_000)
    return rows.agg(F.max(sane).alias("seen"), F.count_if(F.unix_micros(at) < limit).alias("late"))


def silver_stream(
    bronze: Table,
    silver: Table,
    quarantined: Table,
    dims: Callable[[], tuple[DataFrame, DataFrame]],
    checkpoint: str,
    *,
    config: Config = Config(),
    now: datetime | Column | None = None,
    once: bool = False,
    max_commits: int = 1,
    report: Callable[[dict], None] = lambda _: None,
) -> StreamingQuery:
    """``dims`` gives the meter and area dimensions; it is asked anew for every batch.

    A batch takes Bronze's versions by number, from the last one that Silver holds to the
    newest that the stream has listed, so none is skipped. Silver registers with Bronze,
    which keeps what it has not read, however long it is down; a gap stops the stream. Quarantine
    is written before Silver, whose commit says that the batch is done. Every batch moves the watermark that Silver's commits carry; ``report`` gets the
    batch's number, its rows later than the watermark, and the watermark.
    """

    # one name for each table that follows Bronze
    reader = hashlib.md5(silver.path.encode()).hexdigest()
    bronze.register(reader, silver.manifest()["batches"].get(DONE, 0))

    def each(df: DataFrame, n: int) -> None:
        if silver.applied(("silver", n)):
            return
        done = silver.manifest()["batches"].get(DONE)
        newest = max((r.version for r in df.collect()), default=0)  # ``max_commits`` numbers
        if newest <= (done or 0):
            return
        news, upto = unread(bronze, done, newest)
        rows = observed(validated(news, *dims(), config=config, now=now)).persist()
        try:
            before = silver.manifest()["batches"].get(MARK)
            found = lateness(rows, before, config, now).first()
            mark = max(x for x in (before, found.seen, -(1 << 62)) if x is not None)
            quarantined.append(quarantine(rows, now), ("silver", n))
            silver.upsert(valid(rows), ("silver", n), marks={MARK: mark, DONE: upto})
            bronze.register(reader, upto)
            report({"batch": n, "late": found.late, "watermark": mark})
        finally:
            rows.unpersist()

    return _start(commits(bronze, max_commits), "silver", checkpoint, each, config, once)
