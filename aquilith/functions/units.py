"""Volume units."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Liters in one of each unit.
LITERS_PER = {"LITERS": 1.0, "GALLONS": 3.785411784, "CUBIC_METERS": 1000.0}


def to_liters(value: Column, unit: Column) -> Column:
    """The value in liters; null where the unit is unknown or null."""
    factor = F.lit(None).cast("double")
    for name, liters in LITERS_PER.items():
        factor = F.when(unit == name, F.lit(liters)).otherwise(factor)
    return value * factor
