"""Test tables mapped onto the telemetry domain, with defects planted by id.

The expressions are SQL that Spark and DuckDB both read, so oracles use them
too; e, u and c are an event's, user's and customer's number, a the attempt
(1: a redelivery).
"""

from __future__ import annotations

from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The fixed clock of all queries.
NOW = datetime(2024, 1, 25, tzinfo=UTC)

EXPRESSIONS = {
    "meter_id": "CASE WHEN e % 97 = 0 THEN NULL ELSE CAST(u AS {s}) END",
    "reading_value": "CASE WHEN e % 23 = 0 THEN NULL WHEN e % 29 = 0 THEN CAST(1000000000000 AS DOUBLE) WHEN e % 17 = 0 THEN -v ELSE v END",
    "unit": "CASE WHEN e % 31 = 0 THEN 'FURLONGS' WHEN e % 37 = 0 THEN NULL WHEN e % 19 = 0 THEN 'GALLONS' WHEN u % 3 = 0 THEN 'LITERS' WHEN u % 3 = 1 THEN 'GALLONS' ELSE 'CUBIC_METERS' END",
    "parse_error": "CASE WHEN e % 101 = 0 THEN 'avro_deserialization_failed' END",
    "dma_id": "CASE WHEN e % 41 = 0 THEN '99' ELSE CAST(u % 25 AS {s}) END",
    "kafka_offset": "CASE WHEN a = 1 THEN e + 1000000 ELSE e END",
    "kafka_partition": "CAST(e % 4 AS INT)",
    "battery_pct": "CAST(e % 120 AS INT)",
    "signal_quality": "CAST(e % 110 - 5 AS INT)",
    "flow_rate": "CASE WHEN e % 7 = 0 THEN NULL ELSE CAST(e % 50 AS DOUBLE) / 8 END",
    "firmware_version": "CASE WHEN e % 2 = 0 THEN '1.0.0' ELSE '1.1.0' END",
    "sequence_no": "e",
}
LAG_SECONDS = "CAST(e % 45 + 1 + CASE WHEN a = 1 AND e % 26 <> 0 THEN 60 ELSE 0 END AS INT)"


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as Bronze rows: every event, and a redelivery of each thirteenth."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("e"), F.col("ts").cast("timestamp").alias("t"), F.col("user_id").alias("u"), F.col("value").alias("w"))
    tried = events.select("*", F.explode(F.expr("if(e % 13 = 0, array(0, 1), array(0))")).alias("a")).withColumn("v", F.col("w") + F.col("a"))
    rows = tried.select(
        "e",
        "u",
        *[F.expr(x.format(s="string")).alias(n) for n, x in EXPRESSIONS.items()],
        F.expr("if(e % 89 = 0, null, t)").alias("reading_timestamp"),
        F.expr(f"t + make_interval(0, 0, 0, 0, 0, 0, {LAG_SECONDS})").alias("ingest_timestamp"),
    )
    return rows.select(
        *"meter_id reading_timestamp ingest_timestamp reading_value unit flow_rate battery_pct signal_quality dma_id firmware_version sequence_no".split(),
        F.expr("cast(concat('p', e) as binary)").alias("raw_payload"),
        "parse_error",
        "kafka_partition",
        "kafka_offset",
        F.col("ingest_timestamp").alias("kafka_timestamp"),
        F.to_date("ingest_timestamp").alias("ingest_date"),
    )


def dim_meter(spark: SparkSession, sf_dir: str, history: bool = False) -> DataFrame:
    """``customer`` as meters; with ``history``, revisions superseded on 2024-01-12 before them."""
    c = spark.read.parquet(f"{sf_dir}/customer.parquet").filter("c_custkey % 20 <> 5")
    now = c.selectExpr(
        "c_custkey as meter_sk",
        "cast(c_custkey as string) as meter_id",
        "concat('C', c_custkey) as customer_id",
        "cast(c_custkey % 25 as string) as dma_id",
        "case when c_custkey % 2 = 0 then 'ULTRASONIC' else 'MECHANICAL' end as meter_type",
        "cast(15 + 5 * (c_custkey % 3) as int) as meter_size_mm",
        "case c_custkey % 3 when 0 then 'LITERS' when 1 then 'GALLONS' else 'CUBIC_METERS' end as expected_unit",
        "case when c_custkey % 7 = 0 then date'2024-01-10' else date'2020-01-01' end as install_date",
        "case when c_custkey % 11 = 0 then 'DECOMMISSIONED' else 'ACTIVE' end as status",
        "case when c_custkey % 4 = 0 then date'2024-01-12' else date'2020-01-01' end as effective_start_date",
        "cast(null as date) as effective_end_date",
        "true as is_current",
    )
    if not history:
        return now
    before = now.filter("meter_sk % 4 = 0").selectExpr(
        "-meter_sk as meter_sk", "meter_id", "customer_id", "dma_id", "'MECHANICAL' as meter_type", "10 as meter_size_mm", "expected_unit", "install_date",
        "'ACTIVE' as status", "date'2020-01-01' as effective_start_date", "date'2024-01-12' as effective_end_date", "false as is_current",
    )
    return now.unionByName(before)


def dim_dma(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    return n.selectExpr(
        "cast(n_nationkey as bigint) as dma_sk",
        "cast(n_nationkey as string) as dma_id",
        "n_name as dma_name",
        "concat('R', n_regionkey) as region",
        "concat('Z', n_nationkey % 4) as supply_zone",
        "cast(100 + n_nationkey as int) as connected_meter_count",
        "cast(5 + n_nationkey % 10 as double) as target_nrw_pct",
        "cast(-300 + 60 * (n_nationkey % 3) as int) as utc_offset_minutes",
        "date'2020-01-01' as effective_start_date",
        "cast(null as date) as effective_end_date",
        "true as is_current",
    )


def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = spark.read.parquet(f"{sf_dir}/customer.parquet")
    return c.selectExpr(
        "c_custkey as customer_sk",
        "concat('C', c_custkey) as customer_id",
        "c_name as account_number",
        "c_mktsegment as customer_type",
        "cast(c_nationkey as string) as service_dma_id",
        "case when c_acctbal < 0 then 'ARREARS' else 'OPEN' end as account_status",
        "case when c_custkey % 2 = 0 then 'MONTHLY' else 'QUARTERLY' end as billing_cycle",
        "date'2020-01-01' as effective_start_date",
        "cast(null as date) as effective_end_date",
        "true as is_current",
    )
