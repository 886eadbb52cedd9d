"""Consumption shared out by time, and marts that follow changed rows."""

import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from aquilith.operators.enrich import with_customer
from aquilith.operators.ordered import with_previous
from aquilith.operators.route import latest, valid
from aquilith.plans import apportion, maintain
from aquilith.plans.reconcile import validated
from aquilith.sources import fixtures

SF = "/root/testdata/sf0.001"
AT = datetime(2024, 1, 1, tzinfo=UTC)
SCHEMA = "meter_id string, reading_timestamp timestamp, reading_value_liters double"


def rows_of(df):
    return sorted(map(str, df.select(sorted(df.columns)).collect()))


def test_a_dropout_is_shared_by_its_hours(spark):
    rows = [("a", AT, 0.0), ("a", AT + timedelta(minutes=30), 3.0), ("a", AT + timedelta(hours=4), 73.0), ("a", AT + timedelta(hours=5), 10.0), ("b", AT, 5.0)]
    got = {r.period.hour: (r.liters, r.seconds, r.n_intervals, r.n_cut) for r in apportion.consumption(spark.createDataFrame(rows, SCHEMA), "hour").collect()}
    assert got == {0: (13.0, 3600.0, 2, 1), 1: (20.0, 3600.0, 1, 1), 2: (20.0, 3600.0, 1, 1), 3: (20.0, 3600.0, 1, 1), 4: (0.0, 3600.0, 1, 0)}


@pytest.mark.parametrize("unit", ["hour", "day", "month", "quarter"])
def test_pieces_add_up_to_every_rise(spark, unit):
    rng = random.Random(8)
    rows, value = [], 0.0
    for i in range(200):
        value += rng.random() * rng.choice([0.000_001, 1, 1e6])
        rows.append((f"m{i % 3}", AT + timedelta(microseconds=rng.randrange(10**6), minutes=i * rng.choice([1, 30, 3000])), value))
    table = spark.createDataFrame(rows, SCHEMA).dropDuplicates(["meter_id", "reading_timestamp"])
    spans = apportion.intervals(table)
    whole = {r.meter_id: (r.m, r.t) for r in spans.groupBy("meter_id").agg(F.sum("micros").alias("m"), F.sum(F.unix_micros("until") - F.unix_micros("since")).alias("t")).collect()}
    cut = apportion.pieces(spans, unit)
    assert whole == {r.meter_id: (r.m, r.t) for r in cut.groupBy("meter_id").agg(F.sum("part").alias("m"), F.sum("covered").alias("t")).collect()}
    assert cut.filter(f"part < 0 or covered <= 0 or period <> date_trunc('{unit}', period)").count() == 0


def test_the_row_before_is_found_across_stretches(spark):
    rng = random.Random(2)
    rows = list({(f"m{rng.randrange(4)}", AT + timedelta(hours=rng.randrange(3000)), 0.0) for _ in range(300)})
    expected = {}
    for m in {r[0] for r in rows}:
        times = sorted(r[1] for r in rows if r[0] == m)
        expected |= {(m, t.replace(tzinfo=None)): p and p.replace(tzinfo=None) for p, t in zip([None, *times], times, strict=False)}
    got = with_previous(spark.createDataFrame(rows, SCHEMA), "meter_id", "reading_timestamp", ("reading_timestamp",))
    assert {(r.meter_id, r.reading_timestamp): r.previous and r.previous[0] for r in got.collect()} == expected


@pytest.fixture(scope="module")
def good(spark):
    rows = validated(fixtures.bronze(spark, SF), fixtures.dim_meter(spark, SF), fixtures.dim_dma(spark, SF), now=fixtures.NOW)
    return with_customer(valid(rows), fixtures.dim_customer(spark, SF)).persist()


def test_batches_in_any_order_give_the_marts_of_a_full_run(spark, good, tmp_path, monkeypatch):
    kept = maintain.MaintainedMarts(spark, f"file://{tmp_path}/m", good.schema, parts=maintain.BY_READING[:1])
    batch = F.pmod(F.xxhash64("kafka_offset", F.lit(7)), F.lit(3))
    for n in (0, 1):
        kept.apply(good.filter(batch == n), n)
    kept.snapshot("hourly")
    read = []
    monkeypatch.setattr(kept.silver, "_held", lambda state, parts, plain=kept.silver._held: read.append(parts) or plain(state, parts))
    few = good.filter(batch == 2).filter(F.to_date("reading_timestamp") == "2024-01-10")
    kept.apply(few, 2)
    kept.apply(few, 2)  # a replay changes nothing
    near = kept.near(few.select("meter_id", F.to_date("reading_timestamp").alias("day")).distinct(), 2)
    assert few.count() and read[0] == sorted({str(r.day) for r in near.collect()} & set(read[0])) and len(read[0]) < len(kept.silver.manifest()["partitions"])
    monkeypatch.undo()
    kept.apply(good.filter(batch == 2), 3)  # the few come again, with the others
    silver = latest(good).persist()
    expected = {
        "hourly": apportion.consumption(silver, "hour"),
        "areas": apportion.summed(apportion.pieces(apportion.intervals(silver, "dma_id"), "day"), "dma_id"),
        "billing": apportion.billing(silver),
    }
    for name, df in expected.items():
        assert rows_of(kept.read(name)) == rows_of(df)
        kept.snapshot(name)
        assert rows_of(kept.read(name)) == rows_of(df)


def test_a_crash_before_silver_is_made_good_by_the_replay(spark, good, tmp_path, monkeypatch):
    kept = maintain.MaintainedMarts(spark, f"file://{tmp_path}/m", good.schema, parts=maintain.BY_READING[:1])
    kept.apply(good.filter("kafka_offset % 2 = 0"), 0)
    rest = good.filter("kafka_offset % 2 = 1")
    with monkeypatch.context() as m:
        m.setattr(kept.silver, "upsert", lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            kept.apply(rest, 1)
    kept.apply(rest, 1)
    assert rows_of(kept.read("hourly")) == rows_of(apportion.consumption(latest(good), "hour"))
