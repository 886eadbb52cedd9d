"""Consumption shared out by time.

A register's rise belongs to the whole time since the reading before, which may
lie hours or months back after a dropout. Each interval (previous, this] is cut
at the bounds of the periods it touches, and the rise is shared by overlap, in
whole millionths of a liter: a bound gets what has flowed up to it, rounded
down, so that an interval's pieces always add up to its rise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.ordered import with_previous

#: Months, days and hours of a period.
UNITS = {"hour": (0, 0, 1), "day": (0, 1, 0), "month": (1, 0, 0), "quarter": (3, 0, 0)}

#: What a mart tells of a period, from its whole numbers.
MEASURES = ("micros / 1e6D as liters", "covered / 1e6D as seconds", "n_intervals", "n_cut", "micros", "covered")


def intervals(silver: DataFrame, *columns: str) -> DataFrame:
    """(meter_id, since, until, micros, *columns): the rise since the reading before, in millionths of a liter.

    A fall counts 0; a meter's first reading ends no interval. ``columns`` are the later reading's.
    """
    rows = with_previous(silver.select("meter_id", "reading_timestamp", "reading_value_liters", *columns), "meter_id", "reading_timestamp", ("reading_timestamp", "reading_value_liters"))
    rise = F.greatest(F.col("reading_value_liters") - F.col("previous.reading_value_liters"), F.lit(0.0))
    return rows.filter("previous is not null").select(
        "meter_id", F.col("previous.reading_timestamp").alias("since"), F.col("reading_timestamp").alias("until"), F.floor(rise * 1e6 + 0.5).cast("long").alias("micros"), *columns
    )


def pieces(rows: DataFrame, unit: str | Column) -> DataFrame:
    """Intervals cut at the bounds of their ``unit`` (a name, or a column of names): period, part (millionths of a liter), covered (microseconds), is_cut."""
    unit = F.lit(unit) if isinstance(unit, str) else unit
    months, days, hours = (F.coalesce(*[F.when(unit == name, F.lit(size[i])) for name, size in UNITS.items()]) for i in range(3))
    step = F.make_interval(months=months, days=days, hours=hours)
    trunc = F.coalesce(*[F.when(unit == name, F.date_trunc(name, "since")) for name in UNITS])
    cut = rows.withColumn("_step", step).withColumn("period", F.explode(F.sequence(trunc, F.col("until"), F.col("_step"))))
    start, end = F.greatest("period", "since"), F.least(F.col("period") + F.col("_step"), F.col("until"))
    cut = cut.withColumn("_from", F.unix_micros(start) - F.unix_micros("since")).withColumn("_to", F.unix_micros(end) - F.unix_micros("since")).filter("_to > _from")
    cut = cut.withColumn("_all", F.unix_micros("until") - F.unix_micros("since"))
    flowed = lambda x: F.expr(f"(cast(micros as decimal(19,0)) * cast({x} as decimal(19,0))) div cast(_all as decimal(19,0))")
    return cut.withColumn("part", flowed("_to") - flowed("_from")).withColumn("covered", F.col("_to") - F.col("_from")).withColumn("is_cut", F.col("covered") < F.col("_all")).drop("_step", "_from", "_to", "_all")


def summed(cut: DataFrame, *by: str) -> DataFrame:
    """(by, period, liters, seconds, n_intervals, n_cut, micros, covered) of pieces.

    How much, over how much time, from how many intervals, how many of which other periods
    share; the last two are liters and seconds in whole millionths.
    """
    sums = cut.groupBy(*by, "period").agg(F.sum("part").alias("micros"), F.sum("covered").alias("covered"), F.count("*").alias("n_intervals"), F.count_if("is_cut").alias("n_cut"))
    return sums.selectExpr(*by, "period", *MEASURES)


def consumption(silver: DataFrame, unit: str) -> DataFrame:
    """Liters by meter and period."""
    return summed(pieces(intervals(silver), unit), "meter_id")


def metered(silver: DataFrame) -> DataFrame:
    """(dma_id, day, metered_liters), the areas' share of every day."""
    days = summed(pieces(intervals(silver, "dma_id"), "day"), "dma_id")
    return days.select("dma_id", F.to_date("period").alias("day"), F.col("liters").alias("metered_liters"))


def billing_unit() -> Column:
    return F.when(F.col("billing_cycle") == "MONTHLY", "month").otherwise("quarter")


def billing(silver_with_customer: DataFrame) -> DataFrame:
    """Liters by customer and billing period; an interval over its bound is shared by both periods."""
    cut = pieces(intervals(silver_with_customer, "ref_customer_id", "customer_type", "billing_cycle"), billing_unit())
    return summed(cut, "ref_customer_id", "customer_type")
