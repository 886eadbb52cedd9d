"""Rule by rule: one valid row, one field changed, the exact codes in order."""

from datetime import UTC, date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aquilith.config import Config
from aquilith.functions.rules import with_quarantine_reasons
from aquilith.functions.units import to_liters
from aquilith.schemas import struct

NOW = datetime(2024, 6, 1, tzinfo=UTC)
SCHEMA = struct(
    "meter_id string, reading_timestamp timestamp, reading_value double, unit string, parse_error string, battery_pct int, signal_quality int,"
    "ref_meter_status string, ref_meter_expected_unit string, ref_meter_install_date date, ref_dma_id string"
)
GOOD = dict(meter_id="7", reading_timestamp=NOW - timedelta(days=1), reading_value=12.5, unit="LITERS", parse_error=None, battery_pct=50, signal_quality=60, ref_meter_status="ACTIVE", ref_meter_expected_unit="LITERS", ref_meter_install_date=date(2022, 2, 3), ref_dma_id="A")
ALL_BAD = dict(meter_id=None, parse_error="x", reading_value=None, unit="PINTS", reading_timestamp=NOW + timedelta(hours=2), ref_meter_status=None, ref_dma_id=None, ref_meter_install_date=date(2030, 1, 1))
CASES = [
    ({}, []),
    ({"parse_error": "bad"}, ["bronze_parse_error"]),
    ({"meter_id": None}, ["missing_meter_id"]),
    ({"reading_timestamp": None}, ["missing_reading_timestamp"]),
    ({"reading_value": None}, ["missing_reading_value"]),
    ({"unit": None}, ["invalid_unit"]),
    ({"unit": "PINTS"}, ["invalid_unit", "unit_mismatch"]),
    ({"reading_value": -0.5}, ["negative_reading"]),
    ({"reading_value": -0.0}, []),
    ({"reading_value": 0.0}, []),
    ({"reading_value": 1e9}, []),
    ({"reading_value": 1.1e9}, ["implausible_reading_magnitude"]),
    ({"reading_value": float("nan")}, ["implausible_reading_magnitude"]),
    ({"reading_value": float("inf")}, ["implausible_reading_magnitude"]),
    ({"reading_value": float("-inf")}, ["negative_reading"]),
    ({"reading_timestamp": NOW + timedelta(hours=1)}, []),
    ({"reading_timestamp": NOW + timedelta(hours=1, seconds=1)}, ["reading_timestamp_in_future"]),
    ({"ref_meter_status": None}, ["unknown_meter_id"]),
    ({"ref_meter_status": "DECOMMISSIONED"}, ["meter_not_active"]),
    ({"reading_timestamp": datetime(2022, 2, 3, tzinfo=UTC)}, []),
    ({"reading_timestamp": datetime(2022, 2, 2, 23, tzinfo=UTC)}, ["reading_before_install"]),
    ({"ref_meter_expected_unit": "GALLONS"}, ["unit_mismatch"]),
    ({"ref_dma_id": None}, ["unknown_dma_id"]),
    ({"battery_pct": 150, "signal_quality": -5}, []),
    (ALL_BAD, ["bronze_parse_error", "missing_meter_id", "missing_reading_value", "invalid_unit", "reading_timestamp_in_future", "unknown_meter_id", "reading_before_install", "unit_mismatch", "unknown_dma_id"]),
]


def test_rules(spark):
    rows = [tuple((GOOD | change)[f.name] for f in SCHEMA) for change, _ in CASES]
    numbered = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], struct("i int," + ",".join(f"{f.name} {f.dataType.simpleString().replace('bigint', 'long')}" for f in SCHEMA)))
    got = {r.i: (r.quarantine_reasons, r.is_valid) for r in with_quarantine_reasons(numbered, now=NOW).collect()}
    for i, (change, codes) in enumerate(CASES):
        assert got[i] == (codes, not codes), change


def test_units(spark):
    rows = spark.createDataFrame([(10.0, "LITERS"), (10.0, "GALLONS"), (2.0, "CUBIC_METERS"), (1.0, "PINTS"), (1.0, None), (None, "LITERS")], "v double, u string")
    assert [r[0] for r in rows.select(to_liters(F.col("v"), F.col("u"))).collect()] == [10.0, 37.85411784, 2000.0, None, None, None]


def test_config(spark):
    c = Config.from_args(["--catalog", "dev"])
    assert (c.catalog, c.lookback_days, c.watermark_hours, c.max_clock_skew_hours, c.max_plausible_liters) == ("dev", 3, 24, 1, 1e9)
    assert c.guard() is c
    with pytest.raises(SystemExit):
        Config.from_args([])
    with pytest.raises(ValueError, match="must exceed"):
        Config(lookback_days=1, watermark_hours=24).guard()
    assert Config.from_json('{"silver.watermark_hours": "48", "other": 1}').watermark_hours == 48
    spark.conf.set("aquilith.silver.max_clock_skew_hours", "2")
    assert Config.from_conf(spark).max_clock_skew_hours == 2
    spark.conf.unset("aquilith.silver.max_clock_skew_hours")
