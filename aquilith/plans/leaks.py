"""When a leak began and when it ended, from the nights' least flows.

A meter's least flow of a night should reach zero. The cumulative sum of what it
stays above ``target`` by, started anew whenever it falls to zero, rises night by
night while water runs: S = C - min(0, C so far), with C the plain running sum, so
it is two window functions. A stretch of nights with S above 0 that rises over
``alarm`` is a leak. It began with the stretch's first night, and has ended where S
was greatest, if there are nights behind that. One quiet night does not hide it, and a leak that was mended ends.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def nightly(rows: DataFrame) -> DataFrame:
    """(meter_id, night, flow, n_rows): the least flow from 02:00 to 04:00 of every night with readings."""
    night = rows.filter(F.hour("reading_timestamp").between(2, 3) & F.col("flow_rate").isNotNull() & F.col("meter_id").isNotNull())
    return night.groupBy("meter_id", F.to_date("reading_timestamp").alias("night")).agg(F.min("flow_rate").alias("flow"), F.count("*").alias("n_rows"))


def leaks(rows: DataFrame, *, target: float = 0.5, alarm: float = 3.0) -> DataFrame:
    """(meter_id, onset, alarmed, ended, nights, excess) of every leak; ``ended`` is null while it runs.

    Nights without readings say nothing. A meter's nights are ordered in one task: one row a night.
    """
    by_night = Window.partitionBy("meter_id").orderBy("night")
    upto = by_night.rowsBetween(Window.unboundedPreceding, 0)
    summed = nightly(rows).withColumn("c", F.sum(F.col("flow") - target).over(upto))
    scored = summed.withColumn("s", F.col("c") - F.least(F.lit(0.0), F.min("c").over(upto)))
    final = F.max("night").over(Window.partitionBy("meter_id")).alias("final")
    stretched = scored.select("*", final).withColumn("stretch", F.count_if(F.col("s") <= 0).over(upto)).filter("s > 0")
    # the stretch's greatest S so far, so that its nights up to the top can be counted on the way
    inside = Window.partitionBy("meter_id", "stretch").orderBy("night").rowsBetween(Window.unboundedPreceding, 0)
    numbered = stretched.withColumn("nights", F.count("*").over(inside))
    found = numbered.groupBy("meter_id", "stretch").agg(
        F.min("night").alias("onset"), F.min(F.when(F.col("s") > alarm, F.col("night"))).alias("alarmed"), F.max(F.struct("s", "night", "nights")).alias("top"), F.max("final").alias("final")
    )
    ended = F.when(F.col("top.night") < F.col("final"), F.col("top.night"))
    return found.filter("alarmed is not null").select("meter_id", "onset", "alarmed", ended.alias("ended"), F.col("top.nights").alias("nights"), F.col("top.s").alias("excess"))
