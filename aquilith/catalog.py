"""Tables' definitions, reference seeds and views, for any catalog that Spark has."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .schemas import BRONZE, DIM_CUSTOMER, DIM_DMA, DIM_METER, UNITS


@dataclass(frozen=True)
class Definition:
    schema: T.StructType
    comment: str
    quality: str
    partition: str | None = None


DEFINITIONS = {
    "bronze.meter_telemetry": Definition(BRONZE, "Decoded log rows with their payloads, append only", "bronze", "ingest_date"),
    "reference.dim_meter": Definition(DIM_METER, "Meters, a row a revision", "reference"),
    "reference.dim_dma": Definition(DIM_DMA, "Areas, a row a revision", "reference"),
    "reference.dim_customer": Definition(DIM_CUSTOMER, "Customers, a row a revision", "reference"),
}


def _quoted(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def ddl(name: str, definition: Definition, *, location: str | None = None, using: str = "parquet") -> str:
    """CREATE TABLE with column comments and properties; names are schema.table."""
    columns = []
    for f in definition.schema.fields:
        note = f" COMMENT {_quoted(f.metadata['comment'])}" if f.metadata.get("comment") else ""
        columns.append(f"{f.name} {f.dataType.simpleString()}{note}")
    parts = [f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(columns)}) USING {using}"]
    if definition.partition:
        parts.append(f"PARTITIONED BY ({definition.partition})")
    if location:
        parts.append(f"LOCATION {_quoted(location)}")
    parts.append(f"COMMENT {_quoted(definition.comment)}")
    parts.append(f"TBLPROPERTIES ('quality' = {_quoted(definition.quality)}, 'changes' = 'true')")
    return " ".join(parts)


def create(spark: SparkSession, names: list[str] | None = None, *, prefix: str = "", location: str | None = None) -> list[str]:
    """Creates the tables that are not there, in schemas ``prefix`` + schema; gives their names."""
    out = []
    for name in names or list(DEFINITIONS):
        space, table = name.split(".")
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {prefix}{space}" + (f" LOCATION {_quoted(f'{location}/{space}')}" if location else ""))
        spark.sql(ddl(f"{prefix}{name}", DEFINITIONS[name], location=f"{location}/{space}/{table}" if location else None))
        out.append(f"{prefix}{name}")
    return out


def seeds(spark: SparkSession, meters: int = 30, areas: int = 8) -> dict[str, DataFrame]:
    """Reference rows by rule: a customer a meter, areas in turn, some meters retired, and superseded revisions too.

    Every seventh meter was MECHANICAL until 2023; its first revision is not current.
    """
    i = F.col("id")
    started, changed = F.lit("2021-01-01").cast("date"), F.lit("2023-01-01").cast("date")
    area = F.format_string("A-%02d", i % areas + 1)
    base = spark.range(1, meters + 1)
    meter = base.select(
        i.alias("meter_sk"), F.format_string("M-%04d", i).alias("meter_id"), F.format_string("C-%04d", i).alias("customer_id"), area.alias("dma_id"),
        F.when(i % 2 == 0, "ULTRASONIC").otherwise("AMR").alias("meter_type"), (15 + 5 * (i % 4)).cast("int").alias("meter_size_mm"),
        F.element_at(F.array(*map(F.lit, UNITS)), (i % 3 + 1).cast("int")).alias("expected_unit"), started.alias("install_date"),
        F.when(i % 13 == 0, "DECOMMISSIONED").otherwise("ACTIVE").alias("status"), F.when(i % 7 == 0, changed).otherwise(started).alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"), F.lit(True).alias("is_current"),
    )
    older = meter.filter("meter_sk % 7 = 0").withColumns(
        {"meter_sk": F.col("meter_sk") + 10_000, "meter_type": F.lit("MECHANICAL"), "effective_start_date": started, "effective_end_date": changed, "is_current": F.lit(False)}
    )
    dma = spark.range(1, areas + 1).select(
        i.alias("dma_sk"), F.format_string("A-%02d", i).alias("dma_id"), F.format_string("Area %d", i).alias("dma_name"), F.element_at(F.array(*map(F.lit, ["North", "South", "Coast"])), (i % 3 + 1).cast("int")).alias("region"),
        F.format_string("Z%d", i % 4).alias("supply_zone"), (1000 * i).cast("int").alias("connected_meter_count"), (8 + i % 5).cast("double").alias("target_nrw_pct"),
        (-300 + 60 * (i % 3)).cast("int").alias("utc_offset_minutes"), started.alias("effective_start_date"), F.lit(None).cast("date").alias("effective_end_date"), F.lit(True).alias("is_current"),
    )
    customer = base.select(
        i.alias("customer_sk"), F.format_string("C-%04d", i).alias("customer_id"), F.format_string("ACC%06d", 7 * i).alias("account_number"),
        F.element_at(F.array(*map(F.lit, ["RESIDENTIAL", "COMMERCIAL", "INDUSTRIAL"])), (i % 3 + 1).cast("int")).alias("customer_type"), area.alias("service_dma_id"), F.lit("OPEN").alias("account_status"),
        F.when(i % 2 == 0, "MONTHLY").otherwise("QUARTERLY").alias("billing_cycle"), started.alias("effective_start_date"), F.lit(None).cast("date").alias("effective_end_date"), F.lit(True).alias("is_current"),
    )
    return {"reference.dim_meter": meter.unionByName(older), "reference.dim_dma": dma, "reference.dim_customer": customer}


def load_seeds(spark: SparkSession, *, prefix: str = "", location: str | None = None) -> list[str]:
    """Creates the reference tables and replaces their rows by the seeds; running it again changes nothing."""
    rows = seeds(spark)
    names = create(spark, list(rows), prefix=prefix, location=location)
    for name, df in zip(names, rows.values(), strict=True):
        views(spark, {"_seed_rows": df})
        spark.sql(f"INSERT OVERWRITE {name} SELECT {', '.join(df.columns)} FROM _seed_rows")
    spark.catalog.dropTempView("_seed_rows")
    return names


def views(spark: SparkSession, frames: dict[str, DataFrame]) -> None:
    """Registers temporary views, replacing those of the same names."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


@contextmanager
def pool(spark: SparkSession, name: str) -> Iterator[None]:
    """Runs what is inside in a scheduler pool, so that workloads (bi, adhoc, executive) do not starve each other."""
    context = spark.sparkContext
    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", name)
    try:
        yield
    finally:
        context.setLocalProperty("spark.scheduler.pool", before)
