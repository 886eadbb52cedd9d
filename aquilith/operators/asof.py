"""The revision in effect at a fact's time, by one sorted scan.

Revisions may overlap, start on one day or have no end. ``disjoint`` makes of a
key's revisions stretches in which one holds: of those in effect the one that started
last. The stretches' beginnings and the facts are then put in one order of key and
time, and the last beginning is carried to the facts behind it: no fact meets more than one
revision, and none is multiplied. A key's facts are cut by time, so that a meter with a
third of all rows is many tasks; what holds at a cut is carried there by the same
scan over one row a cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def disjoint(revisions: DataFrame, key: str, *, start: str = "effective_start_date", end: str = "effective_end_date", order: str | None = None) -> DataFrame:
    """(key, at, revision): from ``at`` on ``revision`` holds, a struct of all columns, or none where it is null.

    Of revisions in effect together the one with the latest start holds, ties by ``order``
    (a column), then by all columns. One that ends before it starts is never in effect.
    """
    columns = revisions.columns
    rows = revisions.filter(F.col(key).isNotNull() & F.col(start).isNotNull() & (F.col(end).isNull() | (F.col(start) < F.col(end))))
    rows = rows.select(F.col(key).alias("_key"), F.col(start).alias("_start"), F.col(end).alias("_end"), F.struct(*columns).alias("revision"), (F.col(order) if order else F.lit(0)).alias("_order"))
    points = rows.select("_key", F.explode(F.array_compact(F.array("_start", "_end"))).alias("at")).distinct()
    # a dimension's revisions of one key are few; each point meets those of its own key
    met = points.join(rows, (points["_key"] == rows["_key"]) & (F.col("at") >= F.col("_start")) & (F.col("_end").isNull() | (F.col("at") < F.col("_end"))), "left")
    top = F.max(F.when(F.col("revision").isNotNull(), F.struct("_start", "_order", "revision")))["revision"]
    return met.groupBy(points["_key"].alias("key"), "at").agg(top.alias("revision"))


def as_of(facts: DataFrame, revisions: DataFrame, key: str, at: Column, *, stretch: str = "month", **how) -> DataFrame:
    """``facts`` with ``revision``, the struct of the revision of their key that holds at the date ``at``, or null.

    Facts without key or date have none; every fact comes back once.
    """
    begins = disjoint(revisions, key, **how).select("key", "at", F.struct(F.col("revision")).alias("holds"))
    rows = facts.select(F.struct(*facts.columns).alias("fact"), F.col(key).alias("key"), at.cast("date").alias("at"))
    timed, untimed = rows.filter("key is not null and at is not null"), rows.filter("key is null or at is null")
    cut = lambda df: df.withColumn("cut", F.trunc("at", stretch))
    # what holds where a cut begins: cuts and beginnings in one order, cuts ahead of beginnings of their own day
    cuts = cut(timed).select("key", F.col("cut").alias("at")).distinct().withColumn("holds", F.lit(None).cast(begins.schema["holds"].dataType)).withColumn("is_cut", F.lit(True))
    in_order = Window.partitionBy("key").orderBy("at", F.desc("is_cut")).rowsBetween(Window.unboundedPreceding, 0)
    carried = cuts.unionByName(begins.withColumn("is_cut", F.lit(False))).withColumn("carried", F.last("holds", True).over(in_order)).filter("is_cut")
    entering = carried.select("key", F.col("at").alias("cut"), F.col("carried").alias("holds")).withColumn("rank", F.lit(0))
    # within a cut: what was carried in, then beginnings, then facts of the same day
    none = F.lit(None).cast(timed.schema["fact"].dataType)
    marks = entering.withColumn("at", F.col("cut")).unionByName(cut(begins).withColumn("rank", F.lit(1))).withColumn("fact", none)
    both = marks.unionByName(cut(timed).withColumn("holds", F.lit(None).cast(begins.schema["holds"].dataType)).withColumn("rank", F.lit(2)))
    inside = Window.partitionBy("key", "cut").orderBy("at", "rank").rowsBetween(Window.unboundedPreceding, 0)
    told = both.withColumn("found", F.last("holds", True).over(inside)).filter("rank = 2").select("fact", F.col("found.revision").alias("revision"))
    whole = told.unionByName(untimed.select("fact", F.lit(None).cast(told.schema["revision"].dataType).alias("revision")))
    return whole.select("fact.*", "revision")
