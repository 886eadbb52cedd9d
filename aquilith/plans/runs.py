"""Sequence numbers as runs that merge, in whatever order readings arrive.

What has been seen of a meter's numbers is a set of disjoint runs (low, high) with
the rows they came from. Runs of two batches merge into the runs of both, so the
set is kept from batch to batch without the readings; gaps, duplicates and numbers
that were filled in later follow from it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Numbers of a stretch, within which a batch's rows are ordered.
STRETCH = 65_536


def runs_of(rows: DataFrame, key: str = "meter_id", number: str = "sequence_no") -> DataFrame:
    """(key, low, high, n_rows) of a batch's rows; rows without key or number have no place.

    Numbers are ordered within stretches, so a meter that holds a third of all rows is
    spread over its stretches; their runs then merge.
    """
    each = rows.select(F.col(key).alias("key"), F.col(number).cast("long").alias("number")).dropna().groupBy("key", "number").agg(F.count("*").alias("n_rows"))
    stretch = Window.partitionBy("key", F.expr(f"floor(number / {STRETCH})")).orderBy("number")
    islands = each.withColumn("island", F.col("number") - F.row_number().over(stretch)).withColumn("stretch", F.expr(f"floor(number / {STRETCH})"))
    found = islands.groupBy("key", "stretch", "island").agg(F.min("number").alias("low"), F.max("number").alias("high"), F.sum("n_rows").alias("n_rows"))
    return merged(found.select("key", "low", "high", "n_rows"))


def merged(*runs: DataFrame) -> DataFrame:
    """The runs of all of them: those that overlap or touch become one."""
    every = reduce(DataFrame.unionByName, runs)
    by_low = Window.partitionBy("key").orderBy("low", "high")
    reach = F.max("high").over(by_low.rowsBetween(Window.unboundedPreceding, -1))
    starts = F.when(reach.isNull() | (F.col("low") > reach + 1), 1).otherwise(0)
    numbered = every.withColumn("start", starts).withColumn("run", F.sum("start").over(by_low.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy("key", "run").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n_rows").alias("n_rows")).drop("run")


def gaps(runs: DataFrame) -> DataFrame:
    """(key, after, before, missing): numbers that have not come between two that have."""
    following = F.lead("low").over(Window.partitionBy("key").orderBy("low"))
    return runs.withColumn("before", following).filter("before is not null").select("key", F.col("high").alias("after"), "before", (F.col("before") - F.col("high") - 1).alias("missing"))


def totals(runs: DataFrame) -> DataFrame:
    """(key, n_rows, n_numbers, n_duplicates, low, high) by meter."""
    sums = runs.groupBy("key").agg(F.sum("n_rows").alias("n_rows"), F.sum(F.col("high") - F.col("low") + 1).alias("n_numbers"), F.min("low").alias("low"), F.max("high").alias("high"))
    return sums.withColumn("n_duplicates", F.col("n_rows") - F.col("n_numbers"))


class NumberRuns:
    """Runs kept in a folder, a batch a subfolder, which a replay replaces."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def add(self, rows: DataFrame, n: int, key: str = "meter_id", number: str = "sequence_no") -> None:
        runs_of(rows, key, number).write.mode("overwrite").parquet(f"{self.path}/batch={n}")

    def read(self) -> DataFrame:
        return merged(self.spark.read.parquet(self.path).drop("batch"))

    def filled(self, n: int) -> DataFrame:
        """(key, numbers): how many numbers batch ``n`` filled in below the greatest that batches before it had seen."""
        every = self.spark.read.parquet(self.path)
        before, own = merged(every.filter(F.col("batch") < n).drop("batch")), every.filter(F.col("batch") == n).drop("batch")
        top = totals(before).select("key", F.col("high").alias("top"), F.col("n_numbers").alias("known"))
        both = merged(before, own).join(top, "key").withColumn("high", F.least("high", "top")).filter("low <= high")
        now = both.groupBy("key").agg(F.sum(F.col("high") - F.col("low") + 1).alias("now"), F.max("known").alias("known"))
        return now.select("key", (F.col("now") - F.col("known")).alias("numbers")).filter("numbers > 0")
