"""Deterministic synthetic telemetry, as DataFrame plans."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Fixed values of the workload: results must show its shape.
#: Share of flow by hour of day.
HOURLY = [0.2, 0.15, 0.1, 0.1, 0.15, 0.3, 0.8, 1.6, 1.3, 0.9, 0.7, 0.6, 0.6, 0.6, 0.6, 0.7, 0.9, 1.3, 1.7, 1.4, 1.0, 0.7, 0.4, 0.25]
#: Type, cumulative share of meters, flow relative to a residential one.
TYPES = [("RESIDENTIAL", 0.85, 1.0), ("COMMERCIAL", 0.97, 4.0), ("INDUSTRIAL", 1.0, 12.0)]
FIRMWARE = ["2.4.1", "2.4.2", "2.5.0", "2.5.1"]
SIZES = [15, 15, 15, 20, 25, 40]
AREAS, MINUTES, BASE_LITERS, SPREAD, DROPOUT = 20, 15, 3.0, 0.25, 0.02
LEAK_HOURS, LEAK_CHANCE, LEAK_LITERS = (2, 4), 0.01, (8.0, 20.0)
BATTERY_CHANCE, SIGNAL, LAG = 0.03, (40, 100), (1, 45)


def unit(seed: int, *keys: Column | str) -> Column:
    """A number in [0, 1) from a seed and columns, by 48 bits of a digest that other engines have too."""
    text = F.concat_ws(":", F.lit(str(seed)), *[(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("long") / F.lit(float(1 << 48))


def _whole(draw: Column, low: int, high: int) -> Column:
    """A whole number from low to high, both included."""
    return (F.lit(low) + F.floor(draw * (high - low + 1))).cast("int")


def _one_of(values: list, draw: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _whole(draw, 1, len(values)))


def meters(spark: SparkSession, count: int, seed: int = 42, today: str = "2024-01-01") -> DataFrame:
    """Meter master rows; equal seeds give equal rows."""
    i = F.col("id")
    draw = lambda what: unit(seed, i, F.lit(what))
    kind = F.lit(TYPES[-1][0])
    for name, upto, _ in reversed(TYPES[:-1]):
        kind = F.when(draw("kind") < upto, name).otherwise(kind)
    return spark.range(count).select(
        F.format_string("MTR-%08d", i).alias("meter_id"),
        F.format_string("DMA-%03d", _whole(draw("dma"), 1, AREAS)).alias("dma_id"),
        F.format_string("CUST-%08d", _whole(draw("customer"), 1, max(1, count))).alias("customer_id"),
        kind.alias("meter_type"),
        F.date_sub(F.lit(today).cast("date"), _whole(draw("age"), 30, 365 * 12)).alias("install_date"),
        F.round(29.0 + 1.5 * draw("latitude"), 6).alias("latitude"),
        F.round(-98.5 + 1.5 * draw("longitude"), 6).alias("longitude"),
        _one_of(FIRMWARE, draw("firmware")).alias("firmware_version"),
        _one_of(SIZES, draw("size")).alias("meter_size_mm"),
    )


def leaking(master: DataFrame, rate: float, seed: int = 42) -> DataFrame:
    """meter_id of max(1, rate of all) meters, those of least hash."""
    n = master.count()
    return master.select("meter_id").orderBy(F.xxhash64(F.lit(seed), "meter_id"), "meter_id").limit(max(1, int(n * rate))) if n else master.select("meter_id")


def readings(master: DataFrame, start: datetime, end: datetime, *, leaks: DataFrame | None = None, leak_rate: float = LEAK_CHANCE, dropout: float = DROPOUT, seed: int = 42) -> DataFrame:
    """Event rows on a 15-minute grid of [start, end): a register that never falls, numbered without gaps.

    A dropped reading is missing, not zero: numbering goes on. A leak starts
    with some night reading of a meter in ``leaks`` and stays. flow_rate is the
    interval's volume a minute; the battery loses a percent now and then, to 1.
    """
    if start.tzinfo is None or end.tzinfo is None:
        raise ValueError("times need a zone")
    steps = int((end - start).total_seconds() // (60 * MINUTES))
    at = F.timestamp_micros(F.unix_micros(F.lit(start)) + F.col("_step").cast("long") * F.lit(MINUTES * 60_000_000))
    grid = master.withColumn("_step", F.explode(F.sequence(F.lit(0), F.lit(max(steps - 1, 0))))).withColumn("reading_timestamp", at)
    if steps <= 0:
        grid = grid.limit(0)
    draw = lambda what: unit(seed, "meter_id", F.unix_micros("reading_timestamp"), F.lit(what))
    grid = grid.filter(draw("drop") >= dropout)
    if leaks is not None:
        grid = grid.join(leaks.withColumn("_can_leak", F.lit(True)), "meter_id", "left")
    else:
        grid = grid.withColumn("_can_leak", F.lit(False))
    so_far = Window.partitionBy("meter_id").orderBy("reading_timestamp").rowsBetween(Window.unboundedPreceding, 0)
    hour = F.hour("reading_timestamp")
    trigger = F.coalesce("_can_leak", F.lit(False)) & hour.between(*LEAK_HOURS) & (draw("leak") < leak_rate)
    normal = F.sqrt(-2 * F.log(draw("a") + 1e-12)) * F.cos(6.283185307179586 * draw("b"))
    factor = F.element_at(F.create_map(*[F.lit(x) for name, _, times in TYPES for x in (name, times)]), F.col("meter_type"))
    base = F.greatest(F.lit(0.0), BASE_LITERS * factor * F.element_at(F.array(*map(F.lit, HOURLY)), hour + 1) * (1 + SPREAD * normal))
    leak = F.when(F.max(trigger.cast("int")).over(so_far) == 1, LEAK_LITERS[0] + (LEAK_LITERS[1] - LEAK_LITERS[0]) * draw("size")).otherwise(0.0)
    flowing = grid.withColumn("_volume", base + leak).withColumn("sequence_no", F.row_number().over(so_far).cast("long"))
    drained = F.sum((draw("battery") < BATTERY_CHANCE).cast("int")).over(so_far)
    return flowing.select(
        "meter_id",
        "reading_timestamp",
        (F.col("reading_timestamp") + F.make_interval(secs=_whole(draw("lag"), *LAG).cast("decimal(18,6)"))).alias("ingest_timestamp"),
        F.round(F.sum(F.round("_volume", 6)).over(so_far), 3).alias("reading_value"),
        F.lit("LITERS").alias("unit"),
        F.round(F.col("_volume") / MINUTES, 4).alias("flow_rate"),
        F.greatest(F.lit(1), (100 - drained).cast("int")).alias("battery_pct"),
        _whole(draw("signal"), *SIGNAL).alias("signal_quality"),
        "dma_id",
        "firmware_version",
        "sequence_no",
    )
