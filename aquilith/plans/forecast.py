"""Demand by hour: one least-squares fit a meter, from sums that merge.

Hourly liters are fitted by a level, the day's first two and the week's first
harmonics. A fit needs only the sums of products of these terms, and of them with the
liters, so one aggregation with map-side combine holds for any number of hours and
meters; the equations of many meters are then solved at once, in the tasks that hold the sums.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Periods in hours of the pairs of terms.
PERIODS = (24.0, 12.0, 168.0)
N = 1 + 2 * len(PERIODS)
#: Added to the equations' diagonal, a share of the hours, so that meters with few hours have a fit.
RIDGE = 1e-6


def terms(period: Column) -> list[Column]:
    hours = F.unix_timestamp(period) / 3600.0
    return [F.lit(1.0), *(f(2 * math.pi / p * hours) for p in PERIODS for f in (F.sin, F.cos))]


def sums(hourly: DataFrame) -> DataFrame:
    """(meter_id, n, xx, xy, yy): what a fit needs of (meter_id, period, liters)."""
    rows = hourly.select("meter_id", F.col("liters").alias("y"), *[t.alias(f"x{i}") for i, t in enumerate(terms(F.col("period")))])
    products = [F.sum(F.col(f"x{i}") * F.col(f"x{j}")) for i in range(N) for j in range(i, N)]
    return rows.groupBy("meter_id").agg(F.count("*").alias("n"), F.array(*products).alias("xx"), F.array(*[F.sum(F.col(f"x{i}") * F.col("y")) for i in range(N)]).alias("xy"), F.sum(F.col("y") * F.col("y")).alias("yy"))


def merged(*parts: DataFrame) -> DataFrame:
    """Sums of several ranges of time as one."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    added = lambda c, k: F.array(*[F.sum(F.col(c)[i]) for i in range(k)]).alias(c)
    return whole.groupBy("meter_id").agg(F.sum("n").alias("n"), added("xx", N * (N + 1) // 2), added("xy", N), F.sum("yy").alias("yy"))


def _solved(batches):
    upper = np.triu_indices(N)
    for b in batches:
        if not b.num_rows:
            continue
        xx, xy = (b.column(i).flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1) for i in (2, 3))
        a = np.zeros((b.num_rows, N, N))
        a[:, upper[0], upper[1]] = xx
        a[:, upper[1], upper[0]] = xx
        a += np.eye(N) * (RIDGE * np.maximum(a[:, :1, :1], 1))
        w = np.linalg.solve(a, xy[:, :, None])[:, :, 0]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(w.tolist(), pa.list_(pa.float64()))], ["meter_id", "n_hours", "weights"])


def fit(gathered: DataFrame) -> DataFrame:
    """(meter_id, n_hours, weights) from ``sums``."""
    return gathered.select("meter_id", "n", "xx", "xy").mapInArrow(_solved, "meter_id string, n_hours long, weights array<double>")


def predicted(models: DataFrame, hours: DataFrame) -> DataFrame:
    """``hours`` (meter_id, period, ...) with ``forecast``, never below 0; null for meters without a fit."""
    value = sum((F.col("weights")[i] * t for i, t in enumerate(terms(F.col("period")))), F.lit(0.0))
    return hours.join(models.select("meter_id", "weights"), "meter_id", "left").withColumn("forecast", F.greatest(value, F.lit(0.0))).drop("weights")


def backtest(hourly: DataFrame, cut: Column) -> DataFrame:
    """(meter_id, n, error, baseline_error): mean absolute errors over the hours from ``cut`` on, of a fit on those before and of the value a week earlier.

    Scored are hours whose meter has a fit and a value 168 hours before, ahead of the cut.
    """
    before, after = hourly.filter(F.col("period") < cut), hourly.filter((F.col("period") >= cut) & (F.col("period") < cut + F.expr("interval 7 days")))
    earlier = before.select("meter_id", (F.col("period") + F.expr("interval 7 days")).alias("period"), F.col("liters").alias("baseline"))
    scored = predicted(fit(sums(before)), after).join(earlier, ["meter_id", "period"]).filter("forecast is not null")
    return scored.groupBy("meter_id").agg(F.count("*").alias("n"), F.avg(F.abs(F.col("liters") - F.col("forecast"))).alias("error"), F.avg(F.abs(F.col("liters") - F.col("baseline"))).alias("baseline_error"))
