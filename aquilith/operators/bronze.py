"""Raw log rows to Bronze rows: decoded, with the payload kept as it came."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.avro import decoded
from ..functions.rules import clock
from ..schemas import BRONZE, EVENT

#: Fixed value: what parse_error holds of a payload that cannot be read.
PARSE_ERROR = "avro_deserialization_failed"
#: Bronze's names of what the log says about a row.
_SOURCE = {"raw_payload": "value", "kafka_partition": "partition", "kafka_offset": "offset", "kafka_timestamp": "timestamp"}


def _derived(event: Column, at: Column) -> dict[str, Column]:
    """The columns that neither the event nor the log has."""
    arrived = event["ingest_timestamp"]
    return {
        "parse_error": F.when(event.isNull(), PARSE_ERROR),
        "ingest_date": F.to_date(F.ifnull(arrived, at)),
        "ingested_at": at,
    }


def to_bronze(log: DataFrame, now: datetime | Column | None = None) -> DataFrame:
    """Log rows (value, partition, offset, timestamp) as ``BRONZE`` rows.

    A payload that cannot be decoded gives null fields and a parse_error; the
    partition date falls back to the processing date.
    """
    # decoded below the projection, so that the payload is decoded once
    read = log.select(*_SOURCE.values(), decoded(F.col("value")).alias("event"))
    event = F.col("event")
    held = {f.name: event[f.name] for f in EVENT.fields}
    held |= {name: F.col(c) for name, c in _SOURCE.items()}
    held |= _derived(event, clock(now))
    return read.select(*[held[f.name].cast(f.dataType).alias(f.name) for f in BRONZE.fields])
