"""Neighbours of rows in time, without a task that holds a key's whole history."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def with_previous(df: DataFrame, key: str, order: str, columns: tuple[str, ...], *, stretch: str = "day") -> DataFrame:
    """``df`` with ``previous``, a struct of the columns of the key's row before; null for its first.

    A key's rows are ordered within stretches of time only; a stretch's first row
    takes the last of the stretch before that has any, found among one row a
    stretch. So a meter that holds a third of all rows is spread over its days.
    """
    rows = df.withColumn("_stretch", F.date_trunc(stretch, order))
    inside = F.lag(F.struct(*columns)).over(Window.partitionBy(key, "_stretch").orderBy(order))
    ends = rows.groupBy(key, "_stretch").agg(F.max_by(F.struct(*columns), order).alias("_end"))
    before = F.lag("_end").over(Window.partitionBy(key).orderBy("_stretch"))
    ends = ends.select(F.col(key).alias("_key"), F.col("_stretch").alias("_at"), before.alias("_before"))
    met = rows.withColumn("_inside", inside).join(ends, (F.col(key) == F.col("_key")) & (F.col("_stretch") == F.col("_at")))
    return met.select(*df.columns, F.coalesce("_inside", "_before").alias("previous"))
