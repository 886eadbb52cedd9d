"""Table shapes; both the streaming and the batch path project by these lists."""

from __future__ import annotations

from pyspark.sql import types as T

_KINDS = {"string": T.StringType(), "long": T.LongType(), "int": T.IntegerType(), "double": T.DoubleType(), "timestamp": T.TimestampType(), "date": T.DateType(), "boolean": T.BooleanType(), "binary": T.BinaryType()}


def struct(spec: str, comments: dict[str, str] | None = None) -> T.StructType:
    """A schema from "name type, name type"; comments go to the fields' metadata."""
    fields = []
    for part in spec.split(","):
        name, kind = part.split()
        fields.append(T.StructField(name, _KINDS[kind], True, {"comment": comments[name]} if comments and name in comments else None))
    return T.StructType(fields)


UNITS = ("LITERS", "GALLONS", "CUBIC_METERS")

EVENT = struct(
    "meter_id string, reading_timestamp timestamp, ingest_timestamp timestamp, reading_value double, unit string, flow_rate double,"
    "battery_pct int, signal_quality int, dma_id string, firmware_version string, sequence_no long",
    {"reading_value": "cumulative register, in the row's unit", "sequence_no": "counts a meter's readings"},
)
LOG = struct("key binary, value binary, partition int, offset long, timestamp timestamp")
BRONZE = T.StructType(
    [*EVENT.fields, *struct("raw_payload binary, parse_error string, kafka_partition int, kafka_offset long, kafka_timestamp timestamp, ingest_date date, ingested_at timestamp").fields]
)
DIM_METER = struct(
    "meter_sk long, meter_id string, customer_id string, dma_id string, meter_type string, meter_size_mm int, expected_unit string, install_date date,"
    "status string, effective_start_date date, effective_end_date date, is_current boolean"
)
DIM_DMA = struct(
    "dma_sk long, dma_id string, dma_name string, region string, supply_zone string, connected_meter_count int, target_nrw_pct double,"
    "utc_offset_minutes int, effective_start_date date, effective_end_date date, is_current boolean"
)
DIM_CUSTOMER = struct(
    "customer_sk long, customer_id string, account_number string, customer_type string, service_dma_id string, account_status string,"
    "billing_cycle string, effective_start_date date, effective_end_date date, is_current boolean",
    {"account_number": "pii"},
)
SILVER_COLUMNS = (
    "meter_id reading_timestamp ingest_timestamp reading_value unit reading_value_liters reading_local_timestamp flow_rate battery_pct signal_quality "
    "dma_id ref_customer_id ref_meter_dma_id ref_meter_type ref_meter_size_mm ref_dma_name ref_dma_region firmware_version sequence_no "
    "kafka_partition kafka_offset ingest_date"
).split()
QUARANTINE_COLUMNS = "meter_id reading_timestamp ingest_timestamp reading_value unit dma_id raw_payload quarantine_reasons kafka_partition kafka_offset ingest_date".split()
