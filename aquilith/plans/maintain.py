"""Marts kept up to date from changed rows.

A reading that arrives, or replaces one, changes two intervals: the one it ends
and the one that begins with it. So a batch touches the days of its readings and,
for each meter, the days with readings next to these. Only those rows of Silver
are read, before and after the batch; intervals that differ are retracted and
added again, as rows with a sign. Marts are sums of such rows, in whole numbers, so a
mart kept through any order of batches equals the one made anew.

A batch writes its signed rows under its number, which a replay replaces, and
then Silver, whose commit says that the batch is done. ``snapshot`` sums what has
gathered, so that readers need not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merge import newest
from ..sources.tables import BY_READING, Table
from . import apportion

ATTRIBUTES = ("dma_id", "ref_customer_id", "customer_type", "billing_cycle")
#: Marts: what they are grouped by, and their periods.
MARTS: dict[str, tuple[tuple[str, ...], str | None]] = {
    "hourly": (("meter_id",), "hour"),
    "areas": (("dma_id",), "day"),
    "billing": (("ref_customer_id", "customer_type"), None),
}


class MaintainedMarts:
    """Silver, with its customers' columns, and the marts that follow it, below one folder."""

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, *, parts: tuple[str, ...] = BY_READING):
        self.spark, self.path = spark, path.rstrip("/")
        self.silver = Table(spark, f"{self.path}/silver", schema, parts=parts, merge_on_read=True)
        self._days = T.StructType([T.StructField("meter_id", T.StringType()), T.StructField("day", T.DateType()), T.StructField("batch", T.LongType())])

    def _written(self, name: str, schema: T.StructType, where: Column) -> DataFrame:
        """What batches have written under a name; nothing before the first."""
        folder = self.silver._path(f"{self.path}/{name}")
        if not self.silver._fs.exists(folder):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/{name}").filter(where)

    def near(self, touched: DataFrame, n: int) -> DataFrame:
        """(meter_id, day): the touched days, and the days with readings that are next to them."""
        days = self._written("days", self._days, F.col("batch") < n).select("meter_id", "day")
        known = days.join(touched.select("meter_id").distinct(), "meter_id", "left_semi").select("*", F.lit(True).alias("old"), F.lit(False).alias("new"))
        both = known.unionByName(touched.select("meter_id", "day", F.lit(False).alias("old"), F.lit(True).alias("new"))).groupBy("meter_id", "day").agg(F.max("old").alias("old"), F.max("new").alias("new"))
        by_day = Window.partitionBy("meter_id").orderBy("day")
        old = F.when(F.col("old"), F.col("day"))
        before = F.last(old, True).over(by_day.rowsBetween(Window.unboundedPreceding, -1))
        after = F.first(old, True).over(by_day.rowsBetween(1, Window.unboundedFollowing))
        met = both.select("meter_id", "new", F.array("day", before, after).alias("days")).filter("new")
        return met.select("meter_id", F.explode(F.array_compact("days")).alias("day")).distinct()

    def held(self, near: DataFrame) -> DataFrame:
        """Silver's rows of these meters and days; only the partitions that can hold them are read."""
        names = self.silver._part(near.select("meter_id", F.col("day").cast("timestamp").alias("reading_timestamp"))).select("_part").distinct().collect()
        rows = self.silver.read(parts=sorted(r[0] for r in names))
        at = near.select(F.col("meter_id").alias("_meter"), F.col("day").alias("_day"))
        return rows.join(at, (F.col("meter_id") == F.col("_meter")) & (F.to_date("reading_timestamp") == F.col("_day")), "left_semi")

    @staticmethod
    def changed(before: DataFrame, after: DataFrame) -> DataFrame:
        """Intervals with a sign: 1 for those to add, -1 for those to retract.

        Days left out between two that are read make intervals that do not exist; they
        lie between rows that no batch row is next to, so they are on both sides alike and cancel.
        """
        signed = [apportion.intervals(rows, *ATTRIBUTES).withColumn("sign", F.lit(sign)) for rows, sign in ((after, 1), (before, -1))]
        both = signed[0].unionByName(signed[1])
        return both.groupBy(*[c for c in both.columns if c != "sign"]).agg(F.sum("sign").alias("sign")).filter("sign <> 0")

    def apply(self, rows: DataFrame, n: int) -> None:
        """Takes in a batch of valid rows with their customers' columns; a batch that was applied is skipped."""
        if self.silver.applied(("marts", n)):
            return
        rows = newest(rows).persist()
        near = None
        try:
            touched = rows.select("meter_id", F.to_date("reading_timestamp").alias("day")).distinct()
            near = self.near(touched, n).persist()
            before = self.held(near)
            after = newest(before.unionByName(rows.select(*before.columns)))
            signed = f"{self.path}/signed/batch={n}"
            self.changed(before, after).write.mode("overwrite").parquet(signed)
            for name in MARTS:
                self._parts(self.spark.read.parquet(signed), name).write.mode("overwrite").parquet(f"{self.path}/{name}/batch={n}")
            touched.write.mode("overwrite").parquet(f"{self.path}/days/batch={n}")
            self.silver.upsert(rows, ("marts", n))
        finally:
            rows.unpersist()
            if near is not None:
                near.unpersist()

    @staticmethod
    def _parts(signed: DataFrame, name: str) -> DataFrame:
        by, unit = MARTS[name]
        cut = apportion.pieces(signed, unit if unit is not None else apportion.billing_unit())
        times = lambda c: F.sum(F.col(c) * F.col("sign"))
        return cut.withColumn("is_cut", F.col("is_cut").cast("long")).groupBy(*by, "period").agg(times("part").alias("part"), times("covered").alias("covered"), F.sum("sign").alias("n"), times("is_cut").alias("n_cut"))

    def _gathered(self, name: str) -> DataFrame:
        """The mart's whole numbers: the last snapshot and what came after it."""
        fields = [T.StructField(c, T.StringType()) for c in MARTS[name][0]] + [T.StructField("period", T.TimestampType())] + [T.StructField(c, T.LongType()) for c in ("part", "covered", "n", "n_cut")]
        upto, folder = -1, None
        if self.silver._fs.exists(self.silver._path(f"{self.silver.path}/marts/{name}.json")):
            state = self.silver._load(f"marts/{name}.json")
            upto, folder = state["upto"], state["folder"]
        rows = self._written(name, T.StructType([*fields, T.StructField("batch", T.LongType())]), F.col("batch") > upto).drop("batch")
        if folder:
            rows = rows.unionByName(self.spark.read.schema(T.StructType(fields)).parquet(folder))
        return rows.groupBy(*MARTS[name][0], "period").agg(*[F.sum(c).alias(c) for c in ("part", "covered", "n", "n_cut")]).filter("n <> 0")

    def read(self, name: str) -> DataFrame:
        """The mart, as ``apportion.summed`` gives it."""
        rows = self._gathered(name)
        rows = rows.withColumnsRenamed({"part": "micros", "n": "n_intervals"})
        return rows.selectExpr(*MARTS[name][0], "period", *apportion.MEASURES)

    def snapshot(self, name: str) -> None:
        """Sums the mart into one folder; later reads start from it."""
        upto = self.silver.manifest()["batches"].get("marts", -1)
        folder = f"{self.path}/snapshots/{name}-{uuid.uuid4().hex}"
        self._gathered(name).write.parquet(folder)
        self.silver._create(f"marts/{name}.json", {"upto": upto, "folder": folder}, replace=True)
