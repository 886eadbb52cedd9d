"""Latest-wins dedup, the valid/quarantine split, projections and late rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.rules import clock
from ..schemas import QUARANTINE_COLUMNS, SILVER_COLUMNS

KEY = ("meter_id", "reading_timestamp")
ORDER = ("ingest_timestamp", "kafka_offset", "kafka_partition")


def latest(df: DataFrame, keys: tuple[str, ...] = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """One row a key: that of the greatest order columns, nulls least.

    An aggregate with map-side combine, so a key with very many redeliveries
    costs its tasks one row each.
    """
    top = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), F.struct(*order)).alias("r"))
    return top.select("r.*")


def valid(df: DataFrame) -> DataFrame:
    return df.filter("is_valid").select(*SILVER_COLUMNS)


def quarantine(df: DataFrame, now: datetime | Column | None = None, also: tuple[str, ...] = ()) -> DataFrame:
    """Rows that break a rule; ``also`` names further columns to keep."""
    return df.filter("not is_valid").select(*QUARANTINE_COLUMNS, *also).withColumn("quarantined_at", clock(now))


def recent(df: DataFrame, days: int, today: Column | None = None) -> DataFrame:
    """Rows of the last ``days`` dates and today, by the partition column, so files are pruned."""
    return df.filter(F.col("ingest_date") >= F.date_sub(today if today is not None else F.current_date(), days))


def with_lateness(
    df: DataFrame, hours: int, *, by: str = "reading_timestamp", order: tuple[str, str] = ("kafka_partition", "kafka_offset"), now: datetime | Column | None = None, skew_hours: int = 1, stretch: int = 1_000_000
) -> DataFrame:
    """``df`` with is_late: over ``hours`` behind the greatest event time that arrived before in its partition.

    Rows beyond the clock skew do not move the watermark, so one bad clock
    cannot make all that follows late. A partition is cut into stretches of
    offsets: their greatest times are small enough to run over, and each stretch
    is ordered by itself, so no task holds a partition's history.
    """
    log, offset = order
    sane = F.when(F.col(by) <= clock(now) + F.make_interval(hours=F.lit(skew_hours)), F.col(by))
    rows = df.withColumn("_sane", sane).withColumn("_stretch", F.expr(f"{offset} div {stretch}"))
    upto = rows.groupBy(log, "_stretch").agg(F.max("_sane").alias("_top"))
    upto = upto.withColumn("_before", F.expr(f"max(_top) over (partition by {log} order by _stretch rows between unbounded preceding and 1 preceding)"))
    upto = upto.select(F.col(log).alias("_log"), F.col("_stretch").alias("_at"), "_before")
    inside = F.expr(f"max(_sane) over (partition by {log}, _stretch order by {offset} rows between unbounded preceding and 1 preceding)")
    seen = rows.withColumn("_inside", inside).join(upto, F.col(log).eqNullSafe(F.col("_log")) & F.col("_stretch").eqNullSafe(F.col("_at")))
    late = F.col(by) < F.greatest("_inside", "_before") - F.make_interval(hours=F.lit(hours))
    return seen.withColumn("is_late", F.coalesce(late, F.lit(False))).select(*df.columns, "is_late")
