"""Nightly reconciliation of the last days' Bronze rows into Silver and quarantine."""

from __future__ import annotations

import sys
from datetime import UTC, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.rules import with_quarantine_reasons
from ..operators.enrich import enrich
from ..operators.merge import insert_absent, merge_latest
from ..operators.route import quarantine, recent, valid
from ..session import in_utc
from ..sources.tables import BY_POSITION, BY_READING, Table


def validated(bronze: DataFrame, dim_meter: DataFrame, dim_dma: DataFrame, *, config: Config = Config(), now: datetime | Column | None = None) -> DataFrame:
    """Bronze rows enriched and judged: what stream and batch share."""
    return with_quarantine_reasons(enrich(bronze, dim_meter, dim_dma), max_plausible_liters=config.max_plausible_liters, max_clock_skew_hours=config.max_clock_skew_hours, now=now)


def reconciled(bronze: DataFrame, silver: DataFrame, quarantined: DataFrame, dim_meter: DataFrame, dim_dma: DataFrame, *, config: Config = Config(), now: datetime, today: str) -> tuple[DataFrame, DataFrame]:
    """Silver and quarantine as they are after a run, as plans."""
    config.guard()
    rows = validated(recent(bronze, config.lookback_days, F.lit(today).cast("date")), dim_meter, dim_dma, config=config, now=now)
    bad = quarantine(rows, now)
    return merge_latest(silver, valid(rows)), quarantined.unionByName(insert_absent(quarantined, bad))


def _first_day(now: datetime, config: Config) -> str:
    """The first date partition that a run reads."""
    return str((now.astimezone(UTC) - timedelta(days=config.lookback_days)).date())


def run(spark: SparkSession, config: Config, *, bronze: Table, silver: Table, quarantined: Table, dim_meter: DataFrame, dim_dma: DataFrame, now: datetime) -> None:
    """One run over tables. The clock is fixed, so both merges judge rows alike, and a second run changes nothing.

    A quarantine table with kafka_timestamp tells all log rows apart; one without it,
    those that differ in position, arrival or payload.
    """
    config.guard()
    in_utc(spark)
    rows = validated(recent(bronze.read(since=_first_day(now, config)), config.lookback_days, F.lit(now).cast("date")), dim_meter, dim_dma, config=config, now=now)
    silver.upsert(valid(rows))
    quarantined.insert_absent(quarantine(rows, now, ("kafka_timestamp",)))


def main(argv: list[str]) -> None:
    """``reconcile --catalog C``: the run over the catalog's tables, named by Spark conf ``aquilith.path``."""
    from ..schemas import BRONZE
    from ..session import build

    config = Config.from_args(argv).guard()
    spark = build()
    root = f"{spark.conf.get('aquilith.path')}/{config.catalog}"
    dims = {d: spark.read.parquet(f"{root}/reference/{d}") for d in ("dim_meter", "dim_dma")}
    empty = validated(spark.createDataFrame([], BRONZE), dims["dim_meter"], dims["dim_dma"], config=config)
    now = datetime.now().astimezone()
    run(
        spark,
        config,
        bronze=Table(spark, f"{root}/bronze/meter_telemetry", BRONZE),
        silver=Table(spark, f"{root}/silver/meter_readings", valid(empty).schema, parts=BY_READING, merge_on_read=True),
        quarantined=Table(spark, f"{root}/quarantine/silver_meter_readings_quarantine", quarantine(empty).schema, parts=BY_POSITION),
        now=now,
        **dims,
    )


if __name__ == "__main__":
    main(sys.argv[1:])
