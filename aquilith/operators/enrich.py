"""Dimension joins and derived columns: one function for stream and batch."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.units import to_liters

_METER = {"customer_id": "ref_customer_id", "dma_id": "ref_meter_dma_id", "meter_type": "ref_meter_type", "meter_size_mm": "ref_meter_size_mm", "expected_unit": "ref_meter_expected_unit", "install_date": "ref_meter_install_date", "status": "ref_meter_status"}
_DMA = {"dma_id": "ref_dma_id", "dma_name": "ref_dma_name", "region": "ref_dma_region", "utc_offset_minutes": "ref_dma_utc_offset_minutes"}


def current(dim: DataFrame, key: str) -> DataFrame:
    """The current revisions; of several for a key, the one that started last.

    Nothing keeps a dimension from holding two current rows for a key, which
    would double facts in a join.
    """
    rest = [c for c in dim.columns if c != key]
    newest = dim.filter("is_current").groupBy(key).agg(F.max_by(F.struct(*rest), F.struct("effective_start_date", *[c for c in rest if c.endswith("_sk")])).alias("r"))
    return newest.select(key, "r.*").select(*dim.columns)


def as_of(dim: DataFrame, key: str, day: date | str) -> DataFrame:
    """The revisions in effect on a day."""
    d = F.lit(day).cast("date")
    return dim.filter((F.col("effective_start_date") <= d) & (F.col("effective_end_date").isNull() | (d < F.col("effective_end_date"))))


def meter_columns(dim_meter: DataFrame) -> DataFrame:
    return dim_meter.select("meter_id", *[F.col(a).alias(b) for a, b in _METER.items()])


def dma_columns(dim_dma: DataFrame) -> DataFrame:
    return dim_dma.select(*[F.col(a).alias(b) for a, b in _DMA.items()])


def local_time(ts: Column, offset_minutes: Column) -> Column:
    """Wall-clock time at an offset; an unknown one counts as UTC. Sessions run in UTC."""
    return ts + F.make_interval(mins=F.coalesce(offset_minutes, F.lit(0)))


def enrich(bronze: DataFrame, dim_meter: DataFrame, dim_dma: DataFrame) -> DataFrame:
    """Bronze rows with their meter's and area's current attributes, liters and local time.

    The area is the one that the reading names, not the meter master's. Which
    side is broadcast is left to the planner, which knows the dimensions' sizes:
    a meter dimension of hundreds of millions of rows joins by shuffle.
    """
    joined = bronze.join(meter_columns(current(dim_meter, "meter_id")), "meter_id", "left")
    areas = dma_columns(current(dim_dma, "dma_id"))
    joined = joined.join(areas, joined["dma_id"] == areas["ref_dma_id"], "left")
    return joined.withColumn("reading_value_liters", to_liters(F.col("reading_value"), F.col("unit"))).withColumn(
        "reading_local_timestamp", local_time(F.col("reading_timestamp"), F.col("ref_dma_utc_offset_minutes"))
    )


def enrich_as_of(bronze: DataFrame, dim_meter: DataFrame) -> DataFrame:
    """Bronze rows with the meter revision in effect at the reading's time: an equi key with a range."""
    m = dim_meter.select(F.col("meter_id").alias("_meter"), "effective_start_date", "effective_end_date", *[F.col(a).alias(b) for a, b in _METER.items()])
    day = F.to_date(bronze["reading_timestamp"])
    in_effect = (bronze["meter_id"] == m["_meter"]) & (day >= m["effective_start_date"]) & (m["effective_end_date"].isNull() | (day < m["effective_end_date"]))
    return bronze.join(m, in_effect, "left").drop("_meter")


def with_customer(silver: DataFrame, dim_customer: DataFrame) -> DataFrame:
    """Silver rows with their customer's current type, status and billing cycle."""
    c = current(dim_customer, "customer_id").select(F.col("customer_id").alias("ref_customer_id"), "customer_type", "account_status", "billing_cycle")
    return silver.join(c, "ref_customer_id", "left")
