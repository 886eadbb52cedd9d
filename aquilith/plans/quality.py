"""What readings look like over time: sketches by day and area that merge.

A day's and area's rows leave counts (of rows and of each rule's violations), a KLL sketch of
every measure and an HLL sketch of the meters. Any range of days or areas is a merge of
these, without a look at the rows; two ranges are compared by how far their
measures' distributions lie apart.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MEASURES = ("reading_value_liters", "flow_rate", "battery_pct", "signal_quality")
#: Size of the KLL sketches: at 200 the rank error is under 1.65 % with 99 % confidence.
K = 200
#: Ranks whose quantiles stand for a distribution when two are compared.
RANKS = tuple(i / 100 for i in range(1, 100))


def daily(judged: DataFrame, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """(day, area, n_rows, n_valid, reasons, meters, <measure>): one row a day of arrival and area."""
    rows = judged.withColumn("day", F.col("ingest_date")).withColumn("area", F.coalesce("dma_id", F.lit("")))
    sketches = [F.expr(f"kll_sketch_agg_double(cast({m} as double), {K})").alias(m) for m in measures]
    base = rows.groupBy("day", "area").agg(F.count("*").alias("n_rows"), F.count_if("is_valid").alias("n_valid"), F.hll_sketch_agg("meter_id").alias("meters"), *sketches)
    told = rows.select("day", "area", F.explode("quarantine_reasons").alias("reason")).groupBy("day", "area", "reason").agg(F.count("*").alias("n"))
    reasons = told.groupBy("day", "area").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("reason", "n")))).alias("reasons"))  # a few reasons a group
    return base.join(reasons, ["day", "area"], "left")


def merged(days: DataFrame, *by: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """The rows of ``daily`` merged by columns of theirs, or all into one."""
    sketches = [F.expr(f"kll_merge_agg_double({m}, {K})").alias(m) for m in measures]
    return days.groupBy(*by).agg(F.sum("n_rows").alias("n_rows"), F.sum("n_valid").alias("n_valid"), F.hll_union_agg("meters").alias("meters"), *sketches)


def reasons(days: DataFrame, *by: str) -> DataFrame:
    """(by, reason, n_rows) over merged days."""
    return days.select(*by, F.explode("reasons").alias("reason", "n")).groupBy(*by, "reason").agg(F.sum("n").alias("n_rows"))


def profile(found: DataFrame, *by: str, measures: tuple[str, ...] = MEASURES, ranks: tuple[float, ...] = (0.05, 0.5, 0.95)) -> DataFrame:
    """(by, measure, n, meters, quantiles) of merged rows; a measure without values has none."""
    each = [F.struct(F.lit(m).alias("measure"), F.col(m).alias("sketch")) for m in measures]
    rows = found.select(*by, F.hll_sketch_estimate("meters").alias("n_meters"), F.explode(F.array(*each)).alias("m")).select(*by, "n_meters", "m.*")
    counted = rows.withColumn("n", F.expr("kll_sketch_get_n_double(sketch)"))
    asked = ", ".join(f"cast({r} as double)" for r in ranks)
    return counted.withColumn("quantiles", F.expr(f"case when n > 0 then kll_sketch_get_quantile_double(sketch, array({asked})) end")).drop("sketch")


def drift(before: DataFrame, after: DataFrame, *by: str, measures: tuple[str, ...] = MEASURES) -> DataFrame:
    """(by, measure, distance): the greatest difference between the shares of two merged ranges' values up to any point, from 0 to 1.

    The shares are counted among each range's 99 percentiles, at all of them, so a distance
    is right to about a hundredth and the sketches' rank error.
    """
    a = before.select(*by, *[F.col(m).alias(f"a_{m}") for m in measures])
    b = after.select(*by, *[F.col(m).alias(f"b_{m}") for m in measures])
    met = a.join(b, list(by)) if by else a.join(F.broadcast(b), F.lit(True))  # one row on either side
    each = [F.struct(F.lit(m).alias("measure"), F.col(f"a_{m}").alias("a"), F.col(f"b_{m}").alias("b")) for m in measures]
    rows = met.select(*by, F.explode(F.array(*each)).alias("m")).select(*by, "m.*").filter("kll_sketch_get_n_double(a) > 0 and kll_sketch_get_n_double(b) > 0")
    asked = ", ".join(f"cast({r} as double)" for r in RANKS)
    points = rows.select(*by, "measure", *[F.expr(f"kll_sketch_get_quantile_double({s}, array({asked}))").alias(f"q{s}") for s in "ab"])
    upto = lambda q, p: F.size(F.filter(q, lambda x: x <= p))
    apart = F.transform(F.concat("qa", "qb"), lambda p: F.abs(upto("qa", p) - upto("qb", p)))
    return points.select(*by, "measure", (F.array_max(apart) / (len(RANKS) + 1)).alias("distance"))
