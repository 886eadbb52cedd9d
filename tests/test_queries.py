"""Every query against its oracle in DuckDB."""

import math
from pathlib import Path

import duckdb
import pytest

from aquilith.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for p in Path(SF).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def normal(rows, order):
    def value(v):
        if isinstance(v, float):
            return ("nan" if math.isnan(v) else round(v + 0.0, 4))
        return v

    return sorted((tuple(value(r[i]) for i in order) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_equals_oracle(spark, duck, name):
    got = QUERIES[name](spark, SF)
    expected = duck.sql(ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(expected.columns)
    names = sorted(got.columns)
    rows = got.collect()
    assert normal(rows, [got.columns.index(n) for n in names]) == normal(expected.fetchall(), [expected.columns.index(n) for n in names])
    assert rows


def test_counts_of_the_fixture(spark):
    histogram = {r.reason: r.n_rows for r in QUERIES["q08_reason_histogram"](spark, SF).collect()}
    assert histogram == {
        "bronze_parse_error": 11, "missing_meter_id": 12, "missing_reading_timestamp": 13, "missing_reading_value": 48, "invalid_unit": 65,
        "negative_reading": 58, "implausible_reading_magnitude": 35, "reading_timestamp_in_future": 189, "unknown_meter_id": 78, "meter_not_active": 131,
        "reading_before_install": 87, "unit_mismatch": 62, "unknown_dma_id": 27,
    }
    assert QUERIES["q09_silver_projection"](spark, SF).count() == 444
    assert QUERIES["q01_bronze_project"](spark, SF).count() == 1077


def test_synthetic_invariants(spark):
    rows = QUERIES["q29_synth_invariants"](spark, SF).collect()
    assert len(rows) == 40 and all(r.monotone and r.gapless for r in rows)
    assert 40 * 96 * 0.9 < sum(r.n for r in rows) < 40 * 96
