"""Events numbered up to beyond a million, where redelivered rows have log positions of other rows."""

import shutil

import duckdb
import pytest
from test_queries import normal

from aquilith.queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """Small tables, with a copy of every event whose number is a million higher."""
    out = tmp_path_factory.mktemp("positions")
    for name in ("customer", "nation"):
        shutil.copy(f"{SF}/{name}.parquet", out)
    duckdb.sql(f"COPY (SELECT * REPLACE (event_id + 1000000 * k AS event_id, user_id + 7 * k AS user_id) FROM '{SF}/events.parquet', range(2) AS t(k)) TO '{out}/events.parquet'")
    return str(out)


@pytest.mark.parametrize("name", ["q14_merge_quarantine", "q15_reconcile_e2e", "q44_event_time_state"])
def test_rows_that_share_a_position_all_stay(spark, folder, name):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for table in ("events", "customer", "nation"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    got, expected = QUERIES[name](spark, folder), con.sql(ORACLE_SQL[name])
    names = sorted(got.columns)
    rows = got.collect()
    assert normal(rows, [got.columns.index(n) for n in names]) == normal(expected.fetchall(), [expected.columns.index(n) for n in names])
    positions = [(r.kafka_offset, getattr(r, "kind", "quarantine")) for r in rows]
    assert len(positions) > len(set(positions))
