"""Validation rules: every violated code of a row, in a fixed order.

A rule holds only where its condition is true; false or null gives its code.
Rules are data: a code and a condition over the enriched row's columns.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import UNITS

#: Metrics only: they never route a row.
SOFT = {name: f"{name} is null or {name} between 0 and 100" for name in ("battery_pct", "signal_quality")}


def clock(now: datetime | Column | None) -> Column:
    """A fixed time, or the statement's own."""
    return F.current_timestamp() if now is None else now if isinstance(now, Column) else F.lit(now)


def hard_rules(*, max_plausible_liters: float, max_clock_skew_hours: int, now: Column) -> list[tuple[str, Column]]:
    c = F.col
    value, ts = c("reading_value"), c("reading_timestamp")

    def unless_null(*guards: Column, then: Column) -> Column:
        out = then
        for g in guards:
            out = g.isNull() | out
        return out

    return [
        ("bronze_parse_error", c("parse_error").isNull()),
        ("missing_meter_id", c("meter_id").isNotNull()),
        ("missing_reading_timestamp", ts.isNotNull()),
        ("missing_reading_value", value.isNotNull()),
        ("invalid_unit", c("unit").isin(*UNITS)),
        ("negative_reading", unless_null(value, then=value >= 0)),
        # compared as reported, before any conversion
        ("implausible_reading_magnitude", unless_null(value, then=value <= max_plausible_liters)),
        ("reading_timestamp_in_future", unless_null(ts, then=ts <= now + F.make_interval(hours=F.lit(max_clock_skew_hours)))),
        ("unknown_meter_id", c("ref_meter_status").isNotNull()),
        ("meter_not_active", unless_null(c("ref_meter_status"), then=c("ref_meter_status") == "ACTIVE")),
        ("reading_before_install", unless_null(ts, c("ref_meter_install_date"), then=F.to_date(ts) >= c("ref_meter_install_date"))),
        ("unit_mismatch", unless_null(c("unit"), c("ref_meter_expected_unit"), then=c("unit") == c("ref_meter_expected_unit"))),
        ("unknown_dma_id", c("ref_dma_id").isNotNull()),
    ]


def with_quarantine_reasons(
    enriched: DataFrame, *, max_plausible_liters: float = 1e9, max_clock_skew_hours: int = 1, now: datetime | Column | None = None
) -> DataFrame:
    """``enriched`` with quarantine_reasons (array of codes) and is_valid; no row is lost."""
    rules = hard_rules(max_plausible_liters=max_plausible_liters, max_clock_skew_hours=max_clock_skew_hours, now=clock(now))
    codes = F.array(*[F.when(F.coalesce(ok, F.lit(False)), F.lit(None)).otherwise(F.lit(code)) for code, ok in rules])
    return enriched.withColumn("quarantine_reasons", F.array_compact(codes)).withColumn("is_valid", F.size("quarantine_reasons") == 0)


def soft_metrics(df: DataFrame) -> DataFrame:
    """(rule, passed, failed) of each soft rule over all rows, in one pass."""
    counts = df.agg(*[F.count_if(F.expr(cond)).alias(name) for name, cond in SOFT.items()], F.count("*").alias("n"))
    pairs = ", ".join(f"'{name}_in_range', {name}, n - {name}" for name in SOFT)
    return counts.selectExpr(f"stack({len(SOFT)}, {pairs}) as (rule, passed, failed)")


def observed(df: DataFrame, name: str = "soft") -> DataFrame:
    """``df`` with the soft rules as observed metrics of any query over it, streaming too."""
    return df.observe(name, *[F.count_if(F.expr(cond)).alias(rule) for rule, cond in SOFT.items()], F.count(F.lit(1)).alias("rows"))
