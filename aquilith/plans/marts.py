"""Marts over Silver: consumption, areas, customers, dashboards and features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..operators.enrich import current


def total(name: str) -> Column:
    """A sum of doubles that does not depend on the order of rows: added as decimals of nine places."""
    return F.sum(F.col(name).cast("decimal(38,9)")).cast("double")


def by_meter() -> WindowSpec:
    return Window.partitionBy("meter_id").orderBy("reading_timestamp")


def reason_histogram(judged: DataFrame) -> DataFrame:
    return judged.select(F.explode("quarantine_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n_rows"))


def sequence_gaps(rows: DataFrame) -> DataFrame:
    """(meter_id, sequence_no, gap): numbers skipped before a reading; -1 marks a number repeated."""
    w = Window.partitionBy("meter_id").orderBy("sequence_no", "kafka_offset")
    return rows.select("meter_id", "sequence_no", "kafka_offset", (F.col("sequence_no") - F.lag("sequence_no").over(w) - 1).alias("gap")).filter("gap <> 0")


def deltas(silver: DataFrame) -> DataFrame:
    """Silver rows with used_liters, the register's rise since the meter's previous reading; a fall counts 0.

    Rows that have them come back as they are, so several marts can share one pass.
    """
    if "used_liters" in silver.columns:
        return silver
    rise = F.col("reading_value_liters") - F.lag("reading_value_liters").over(by_meter())
    return silver.withColumn("delta_liters", rise).withColumn("used_liters", F.greatest(F.coalesce(rise, F.lit(0.0)), F.lit(0.0)))


def consumption(silver: DataFrame, unit: str) -> DataFrame:
    """Liters by meter and hour, day, month or quarter."""
    return deltas(silver).groupBy("meter_id", F.date_trunc(unit, "reading_timestamp").alias("period")).agg(total("used_liters").alias("liters"), F.count("*").alias("n_readings"))


def daily_usage(silver: DataFrame, limit: float) -> DataFrame:
    return consumption(silver, "day").withColumn("is_anomaly", F.col("liters") > limit)


def area_balance(silver: DataFrame, dim_dma: DataFrame, supply: DataFrame) -> DataFrame:
    """By area and day: supplied (given) against metered liters, the loss share, and whether it exceeds the target.

    Areas that the dimension lacks stay, without name and target.
    """
    metered = deltas(silver).groupBy("dma_id", F.to_date("reading_timestamp").alias("day")).agg(total("used_liters").alias("metered_liters"))
    return balance(metered, dim_dma, supply)


def balance(metered: DataFrame, dim_dma: DataFrame, supply: DataFrame) -> DataFrame:
    """``area_balance`` of given metered liters by area and day."""
    joined = supply.join(metered, ["dma_id", "day"], "left").withColumn("metered_liters", F.coalesce("metered_liters", F.lit(0.0)))
    joined = joined.join(current(dim_dma, "dma_id").select("dma_id", "dma_name", "target_nrw_pct"), "dma_id", "left")
    nrw = F.when(F.col("supplied_liters") > 0, 100 * (F.col("supplied_liters") - F.col("metered_liters")) / F.col("supplied_liters"))
    return joined.withColumn("nrw_pct", nrw).withColumn("over_target", F.col("nrw_pct") > F.col("target_nrw_pct"))


def customer_usage(silver_with_customer: DataFrame) -> DataFrame:
    """Liters by customer and billing period (month or quarter, as the customer's cycle says)."""
    period = F.when(F.col("billing_cycle") == "MONTHLY", F.trunc("reading_timestamp", "month")).otherwise(F.trunc("reading_timestamp", "quarter"))
    return deltas(silver_with_customer).groupBy("ref_customer_id", "customer_type", period.alias("period")).agg(total("used_liters").alias("liters"), F.countDistinct("meter_id").alias("n_meters"))


def operations(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    """By day: liters, peak meter-hour, anomalies."""
    h = hourly.groupBy(F.to_date("period").alias("day")).agg(F.max("liters").alias("peak_hour_liters"))
    d = daily.groupBy(F.to_date("period").alias("day")).agg(total("liters").alias("liters"), F.count_if("is_anomaly").alias("n_anomalies"))
    return h.join(d, "day")


def executive(areas: DataFrame, customers: DataFrame) -> DataFrame:
    """Totals over areas and customers, one row a customer type."""
    a = areas.agg(total("supplied_liters").alias("supplied_liters"), F.count_if("over_target").alias("n_over_target"))
    c = customers.groupBy("customer_type").agg(total("liters").alias("liters"), F.countDistinct("ref_customer_id").alias("n_customers"))
    return c.crossJoin(F.broadcast(a))  # one row on the right


def night_flow(rows: DataFrame, least: float = 0.5) -> DataFrame:
    """Meters whose flow from 02:00 to 04:00 never falls under ``least``: a leak's signature."""
    night = rows.filter(F.hour("reading_timestamp").between(2, 3) & F.col("flow_rate").isNotNull())
    return night.groupBy("meter_id").agg(F.avg("flow_rate").alias("avg_flow"), F.min("flow_rate").alias("min_flow"), F.count("*").alias("n_rows")).withColumn("is_leak", F.col("min_flow") >= least)


def features(silver: DataFrame) -> DataFrame:
    """Rolling and lagged features of every reading."""
    last4 = by_meter().rowsBetween(-3, 0)
    seconds = Window.partitionBy("meter_id").orderBy(F.col("reading_timestamp").cast("long")).rangeBetween(-86_400, 0)
    return deltas(silver).select(
        "meter_id",
        "reading_timestamp",
        F.avg("used_liters").over(last4).alias("avg_last4"),
        F.max("used_liters").over(last4).alias("max_last4"),
        F.count("*").over(seconds).alias("n_last_day"),
        F.lag("used_liters", 2).over(by_meter()).alias("lag2"),
    )


def sessions(rows: DataFrame, gap: str = "30 minutes") -> DataFrame:
    """(meter_id, started, ended, n_rows): runs of a meter's readings with less than ``gap`` between them; of streams with a watermark too."""
    timed = rows.filter("meter_id is not null and reading_timestamp is not null")
    window = timed.groupBy("meter_id", F.session_window("reading_timestamp", gap).alias("w")).agg(F.max("reading_timestamp").alias("ended"), F.count("*").alias("n_rows"))
    return window.select("meter_id", F.col("w.start").alias("started"), "ended", "n_rows")


def anomalies(silver: DataFrame, threshold: float = 3.0, last: int = 12) -> DataFrame:
    """(meter_id, reading_timestamp, used_liters, score): readings over ``threshold`` times the greatest use among the meter's ``last`` before."""
    before = by_meter().rowsBetween(-last, -1)
    top = F.max("used_liters").over(before)
    scored = deltas(silver).select("meter_id", "reading_timestamp", "used_liters", F.when(top > 0, F.col("used_liters") / top).alias("score"))
    return scored.filter(F.col("score") > threshold)
