"""Codec, tables, merges, streams and synthetic data."""

from datetime import UTC, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aquilith.functions.avro import FIELDS, decode, encode
from aquilith.operators.bronze import to_bronze
from aquilith.operators.merge import insert_absent, merge_latest
from aquilith.operators.route import latest, quarantine, valid, with_lateness
from aquilith.plans.reconcile import run, validated
from aquilith.config import Config
from aquilith.schemas import BRONZE, EVENT, LOG
from aquilith.sources import fixtures, synthetic
from aquilith.sources.log import kafka_options, sasl_config
from aquilith.sources.tables import Table, read_jsonl, write_jsonl

SF = "/root/testdata/sf0.001"
RECORD = dict(meter_id="é1", reading_timestamp="2024-01-02 03:04:05.678", ingest_timestamp="2024-01-02 03:04:06", reading_value=-1.5, unit="GALLONS", flow_rate=None, battery_pct=3, signal_quality=None, dma_id="A", firmware_version="", sequence_no=-(1 << 40))


def test_codec():
    data = encode(RECORD)
    values = dict(zip([n for n, _ in FIELDS], decode(data), strict=True))
    assert values == RECORD | {"reading_timestamp": 1704164645678, "ingest_timestamp": 1704164646000}
    assert decode(data + b"newer fields") == decode(data)
    assert all(decode(data[:n]) is None for n in range(len(data)))
    assert decode(None) is None and decode(b"\x02\xff" + data[3:]) is None
    assert encode(RECORD | {"unit": "PINTS"}) is None


@settings(max_examples=200, deadline=None)
@given(st.binary(max_size=60))
def test_decoder_never_raises(data):
    decode(data)


def _values(arrow, i):
    row = arrow[i].as_py()
    return tuple(row[n] for n, _ in FIELDS) if row["ok"] else None


_GOOD = encode(RECORD)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.none(), st.binary(max_size=70), st.tuples(st.integers(0, len(_GOOD)), st.integers(0, 255)).map(lambda x: _GOOD[: x[0]] + bytes([x[1]]) + _GOOD[x[0] + 1 :]), st.just(_GOOD)), max_size=6))
def test_batches_decode_as_records_do(payloads):
    import math

    import pyarrow as pa

    from aquilith.functions.avro import _decode

    got = _decode(pa.array(payloads, pa.binary()))
    same = lambda a, b: a == b or (isinstance(a, float) and isinstance(b, float) and math.isnan(a) and math.isnan(b))
    for i, p in enumerate(payloads):
        a, b = _values(got, i), decode(p)
        assert (a is None) == (b is None) and (a is None or all(map(same, a, b))), (p, a, b)


_TEXTS = st.one_of(st.none(), st.text(max_size=5))
_LONGS = st.integers(-(1 << 62), (1 << 62) - 1)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(_TEXTS, st.sampled_from(["LITERS", "PINTS", None]), _LONGS, st.one_of(st.none(), st.floats(allow_nan=False)), st.one_of(st.none(), st.integers(-(1 << 31), (1 << 31) - 1)), st.one_of(st.none(), st.datetimes(datetime(1900, 1, 1), datetime(2200, 1, 1)))), max_size=5))
def test_batches_encode_as_records_do(rows):
    import pyarrow as pa

    from aquilith.functions.avro import _encode

    records = [dict(meter_id=t, reading_timestamp=at, ingest_timestamp=at, reading_value=f, unit=u, flow_rate=f, battery_pct=i, signal_quality=i, dma_id="ä", firmware_version="", sequence_no=n) for t, u, n, f, i, at in rows]
    kinds = {"string": pa.string(), "millis": pa.timestamp("us", tz="UTC"), "double": pa.float64(), "enum": pa.string(), "int": pa.int32(), "long": pa.int64()}
    got = _encode(*[pa.array([r[n] for r in records], kinds[k.rstrip("?")]) for n, k in FIELDS])
    assert got.to_pylist() == list(map(encode, records))


def test_bronze_keeps_what_it_cannot_read(spark):
    at = datetime(2024, 1, 3, tzinfo=UTC)
    log = spark.createDataFrame([(b"k", encode(RECORD), 1, 5, at), (b"k", b"junk", 2, 6, at), (None, None, 2, 7, at)], LOG)
    good, bad, none = to_bronze(log, at).orderBy("kafka_offset").collect()
    assert (good.meter_id, good.parse_error, str(good.ingest_date), good.battery_pct) == ("é1", None, "2024-01-02", 3)
    assert (bad.meter_id, bad.parse_error, str(bad.ingest_date), bytes(bad.raw_payload)) == (None, "avro_deserialization_failed", "2024-01-03", b"junk")
    assert none.parse_error and none.raw_payload is None
    assert to_bronze(log, at).columns == BRONZE.fieldNames()


@pytest.fixture(scope="module")
def judged(spark):
    rows = validated(fixtures.bronze(spark, SF), fixtures.dim_meter(spark, SF), fixtures.dim_dma(spark, SF), now=fixtures.NOW)
    return rows.persist()


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_split_is_total_and_disjoint(judged):
    assert valid(judged).count() + quarantine(judged, fixtures.NOW).count() == judged.count()


def test_dedup_is_idempotent_and_order_free(judged):
    once = latest(valid(judged))
    assert rows_of(latest(once)) == rows_of(once) == rows_of(latest(valid(judged).repartition(7)))


def test_upsert_in_batches_equals_one_merge(spark, judged, tmp_path):
    good = valid(judged)
    table = Table(spark, f"file://{tmp_path}/silver", good.schema, keep=3)
    for n in (2, 0, 1):
        table.upsert(good.filter(f"kafka_offset % 3 = {n}"), ("s", {2: 0, 0: 1, 1: 2}[n]))
    assert rows_of(table.read().select(good.columns)) == rows_of(latest(good))
    v = table.manifest()["version"]
    table.upsert(good.limit(5), ("s", 1))  # a batch replayed
    assert table.manifest()["version"] == v
    table.upsert(good)
    assert rows_of(table.read().select(good.columns)) == rows_of(latest(good)) and table.changes(v).count() == 0
    assert table.read(v - 1).count() < table.read(v).count() == 444
    table.append(good.limit(0))
    assert len(table.versions()) == 3
    with pytest.raises(ValueError, match="no version"):
        table.read(1)


def test_redelivery_under_another_date_leaves_one_row(spark, judged, tmp_path):
    good = valid(judged)
    one = good.limit(1).persist()
    table = Table(spark, f"file://{tmp_path}/t", good.schema)
    table.upsert(one)
    later = one.withColumn("ingest_timestamp", F.expr("ingest_timestamp + interval 3 days")).withColumn("ingest_date", F.date_add("ingest_date", 3))
    table.upsert(later)
    assert rows_of(table.read().select(good.columns)) == rows_of(later)
    table.upsert(one)
    assert rows_of(table.read().select(good.columns)) == rows_of(later)


def test_a_crash_before_the_manifest_leaves_the_old_version(spark, judged, tmp_path, monkeypatch):
    good = valid(judged)
    table = Table(spark, f"file://{tmp_path}/t", good.schema)
    table.append(good.limit(3))
    monkeypatch.setattr(table, "_commit", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        table.append(good)
    assert Table(spark, f"file://{tmp_path}/t", good.schema).read().count() == 3


def test_reconciliation_twice_is_once(spark, judged, tmp_path):
    bronze_rows = fixtures.bronze(spark, SF).withColumn("ingested_at", F.lit(fixtures.NOW)).select(*BRONZE.fieldNames())
    bronze = Table(spark, f"file://{tmp_path}/b", BRONZE)
    bronze.append(bronze_rows)
    silver, bad = Table(spark, f"file://{tmp_path}/s", valid(judged).schema), Table(spark, f"file://{tmp_path}/q", quarantine(judged, fixtures.NOW).schema)
    how = dict(bronze=bronze, silver=silver, quarantined=bad, dim_meter=fixtures.dim_meter(spark, SF), dim_dma=fixtures.dim_dma(spark, SF), now=fixtures.NOW)
    run(spark, Config(lookback_days=30), **how)
    first = rows_of(silver.read()), rows_of(bad.read())
    run(spark, Config(lookback_days=30), **how)
    assert (rows_of(silver.read()), rows_of(bad.read())) == first and len(first[0]) == 444
    with pytest.raises(ValueError, match="must exceed"):
        run(None, Config(lookback_days=1), **how)


def test_merges_with_null_keys(spark):
    t = spark.createDataFrame([("a", 1, 1, 1, 0)], "meter_id string, reading_timestamp int, ingest_timestamp int, kafka_offset int, kafka_partition int")
    s = spark.createDataFrame([("a", 1, 1, 1, 1), ("a", 1, 1, 2, 0), (None, 1, 5, 3, 0)], t.schema)
    assert {tuple(r) for r in merge_latest(t, s).collect()} == {("a", 1, 1, 2, 0), (None, 1, 5, 3, 0)}
    held = spark.createDataFrame([(None, 100)], "kafka_partition int, kafka_offset int")
    more = spark.createDataFrame([(None, 100), (1, 100), (1, 100), (0, 100)], held.schema)
    assert {tuple(r) for r in insert_absent(held, more).collect()} == {(1, 100), (0, 100)}


def test_a_bad_clock_does_not_poison_the_watermark(spark):
    at = lambda d: datetime(2024, 1, d, tzinfo=UTC)
    df = spark.createDataFrame([(0, 1, at(10)), (0, 2, datetime(2099, 1, 1, tzinfo=UTC)), (0, 3, at(10)), (0, 4, at(8))], "kafka_partition int, kafka_offset int, reading_timestamp timestamp")
    assert [r.is_late for r in with_lateness(df, 24, now=at(11)).orderBy("kafka_offset").collect()] == [False, False, False, True]


def test_jsonl_and_log_options(spark, tmp_path):
    start, end = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 1, 6, tzinfo=UTC)
    rows = synthetic.readings(synthetic.meters(spark, 3), start, end, dropout=0).select(*EVENT.fieldNames())
    write_jsonl(rows, f"{tmp_path}/r")
    millis = rows.withColumn("ingest_timestamp", F.timestamp_millis(F.unix_millis("ingest_timestamp")))
    assert rows_of(read_jsonl(spark, f"{tmp_path}/r", EVENT).select(*EVENT.fieldNames())) == rows_of(millis)
    o = kafka_options(servers="h:9093", topic="t", connection='a"b')
    assert o["startingOffsets"] == "earliest" and o["maxOffsetsPerTrigger"] == "2000000" and '\\"' in sasl_config('a"b')


def test_synthetic(spark):
    m = synthetic.meters(spark, 200)
    assert m.select("meter_id").distinct().count() == 200 and rows_of(m) == rows_of(synthetic.meters(spark, 200))
    start, end = datetime(2024, 1, 1, tzinfo=UTC), datetime(2024, 1, 2, tzinfo=UTC)
    few = synthetic.meters(spark, 20)
    leaks = synthetic.leaking(few, 0.2)
    assert leaks.count() == 4 and synthetic.leaking(few, 0.0).count() == 1
    night = lambda df: df.filter("hour(reading_timestamp) in (3, 4)").join(leaks, "meter_id").agg(F.avg("flow_rate")).first()[0]
    assert night(synthetic.readings(few, start, end, leaks=leaks, leak_rate=1.0)) > 5 / 15 + night(synthetic.readings(few, start, end))
    assert 0 < synthetic.readings(few, start, end).count() < 20 * 96 == synthetic.readings(few, start, end, dropout=0).count()
    with pytest.raises(ValueError, match="zone"):
        synthetic.readings(few, datetime(2024, 1, 1), end)
