"""The event log: Kafka where its connector is installed, else a replay directory of the same shape."""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Config
from ..functions.avro import encoded
from ..schemas import LOG


def sasl_config(connection: str) -> str:
    """JAAS login line for a connection string used as the password."""
    quoted = connection.replace("\\", "\\\\").replace('"', '\\"')
    return f'org.apache.kafka.common.security.plain.PlainLoginModule required username="$ConnectionString" password="{quoted}";'


def kafka_options(*, servers: str | None = None, topic: str | None = None, group: str | None = None, connection: str | None = None, config: Config | None = None) -> dict[str, str]:
    """Reader options; what is not given comes from the settings."""
    config = config or Config()
    options = {
        "kafka.bootstrap.servers": servers or f"{config.namespace}:9093",
        "subscribe": topic or config.topic,
        "kafka.group.id": group or config.consumer_group,
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": str(config.max_offsets_per_trigger),
        "failOnDataLoss": "true",
    }
    if connection:
        options |= {"kafka.security.protocol": "SASL_SSL", "kafka.sasl.mechanism": "PLAIN", "kafka.sasl.jaas.config": sasl_config(connection)}
    return options


def kafka_stream(spark: SparkSession, **how) -> DataFrame:
    """Needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**kafka_options(**how)).load()


def replay_stream(spark: SparkSession, path: str, max_files: int = 1) -> DataFrame:
    """Log rows from Parquet files, oldest first, ``max_files`` a micro-batch."""
    return spark.readStream.schema(LOG).option("maxFilesPerTrigger", max_files).parquet(path)


def as_log(events: DataFrame) -> DataFrame:
    """Event rows (with kafka_partition and kafka_offset) as log rows, keyed by meter."""
    return events.select(
        F.col("meter_id").cast("binary").alias("key"),
        encoded().alias("value"),
        F.col("kafka_partition").alias("partition"),
        F.col("kafka_offset").alias("offset"),
        F.col("ingest_timestamp").alias("timestamp"),
    )


def produce(events: DataFrame, path: str, files: int = 1) -> None:
    """Writes event rows (with kafka_partition and kafka_offset) as log rows, keyed by meter and in order."""
    as_log(events).repartition(files, "key").sortWithinPartitions("key", "offset").write.mode("append").parquet(path)


#: Log partitions that keys are dealt to.
PARTITIONS = 32


def batched(events: DataFrame, batch_rows: int) -> DataFrame:
    """Event rows with kafka_partition, kafka_offset and batch: a meter's events keep their order, partition and batches.

    A batch holds one meter's events, at most ``batch_rows``. Offsets count the
    meter's own events behind a range that its hash names, so no partition is
    ordered as a whole.
    """
    place = F.expr(f"cast(pmod(xxhash64(meter_id), {PARTITIONS}) as int)")
    at = F.expr("row_number() over (partition by meter_id order by reading_timestamp, sequence_no) - 1")
    numbered = events.withColumn("kafka_partition", place).withColumn("_at", at)
    offset = F.expr("shiftleft(pmod(shiftright(xxhash64(meter_id), 8), 1L << 31), 31) + _at")
    return numbered.withColumn("kafka_offset", offset).withColumn("batch", (F.col("_at") / batch_rows).cast("long")).drop("_at")


def publish(events: DataFrame, to: str, *, servers: str | None = None, events_per_second: float | None = None, batch_rows: int = 500) -> int:
    """Writes event rows to the log ``to`` as keyed batches and says how many events that were.

    With ``events_per_second`` they go in slices of about ten seconds' events, in
    order of time, each no sooner than the rate allows.
    """
    rows = batched(events, batch_rows).persist()
    try:
        count = rows.count()
        slices = max(1, -(-count // max(1, int(10 * events_per_second)))) if events_per_second else 1
        cuts = rows.select(F.unix_micros("reading_timestamp").alias("t")).approxQuantile("t", [i / slices for i in range(1, slices)], 0.001) if slices > 1 else []
        began, sent, micros = time.monotonic(), 0, F.unix_micros("reading_timestamp")
        cuts = sorted(set(cuts))
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            part = rows
            if low is not None:
                part = part.filter(micros >= low)
            if high is not None:
                part = part.filter(micros < high)
            if servers:
                log = part.select(F.col("meter_id").alias("key"), encoded().alias("value"))
                log.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", to).save()
            else:
                produce(part, to)
            if events_per_second:
                sent += part.count()
                time.sleep(max(0.0, began + sent / events_per_second - time.monotonic()))
        return count
    finally:
        rows.unpersist()
