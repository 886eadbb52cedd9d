"""Event time and arbitrary state: counts of late rows, bounded state, restarts, readings out of order."""

import random
from datetime import UTC, datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from aquilith.operators.route import quarantine, valid
from aquilith.plans import marts
from aquilith.plans.reconcile import validated
from aquilith.sources import fixtures
from aquilith.sources.log import produce, replay_stream
from aquilith.sources.tables import Table
from aquilith.streaming import events
from aquilith.streaming.state import HOUR, Alerts, Sessions, alert_stream, session_stream, state_store

SF = "/root/testdata/sf0.001"
START = datetime(2024, 1, 1, tzinfo=UTC)


def test_state_is_bounded_and_late_rows_are_counted(spark, tmp_path):
    rows = fixtures.bronze(spark, SF).filter("parse_error is null and meter_id is not null and reading_value is not null and unit in ('LITERS', 'GALLONS', 'CUBIC_METERS') and reading_timestamp is not null").persist()
    days = [r[0] for r in rows.select("ingest_date").distinct().orderBy("ingest_date").collect()]
    for n in range(0, len(days), 3):
        own = rows.filter(F.col("ingest_date").isin(days[n : n + 3]))
        produce(own.unionByName(own.filter("kafka_offset % 4 = 0")), f"file://{tmp_path}/log")
    produce(rows.filter(F.col("ingest_date") == days[0]), f"file://{tmp_path}/log")  # three weeks late
    bronze = events.FileBronze(spark, f"{tmp_path}/bronze")
    events.bronze_files(replay_stream(spark, f"file://{tmp_path}/log"), bronze.path, f"{tmp_path}/cb", now=fixtures.NOW, once=True).awaitTermination()
    seen = []
    stream = events.deduplicated(bronze.stream(max_files=4), now=fixtures.NOW)
    query = stream.writeStream.option("checkpointLocation", f"{tmp_path}/cs").foreachBatch(lambda df, n: seen.extend(df.select(*events.POSITION).collect())).trigger(availableNow=True).start()
    query.awaitTermination()
    state = events.state_of(query)
    first, held = rows.filter(F.col("ingest_date") == days[0]).count(), rows.count()
    assert len(seen) == len(set(seen)) == held
    assert state["dropped_late"] >= first and state["dropped_twice"] > 0
    assert state["most_rows"] < held / 2 and state["rows"] < held / 3
    assert bronze.read().count() == held + first + rows.filter("kafka_offset % 4 = 0").count()
    assert bronze.read(since=str(days[-1])).select("ingest_date").distinct().count() == 1


def replay(spark, folder, parts, stream, schema):
    """The stream's output over files of rows, restarted behind each."""
    with state_store(spark):
        for part in parts:
            spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{folder}/in")
            read = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/in")
            sink = stream(read).writeStream.format("parquet").outputMode("append").option("checkpointLocation", f"{folder}/c")
            sink.trigger(availableNow=True).start(f"{folder}/out").awaitTermination()
    return spark.read.parquet(f"{folder}/out").filter("meter_id <> 'beat'").collect()


@pytest.mark.parametrize("seed", range(2))
def test_sessions_and_alerts_of_shuffled_batches(spark, tmp_path, seed):
    """Readings out of order within the watermark, a restart after every file; the same as the batch functions."""
    rng = random.Random(seed)
    rows, now = [], {m: START for m in "abc"}
    for _ in range(240):
        m = rng.choice("abc")
        now[m] += timedelta(minutes=rng.choice([5, 20, 40, 200]))
        rows.append((m, now[m], float(rng.randrange(10_000))))
    rows.sort(key=lambda r: r[1])
    parts = [rows[n : n + 80] for n in range(0, 240, 80)]
    for part in parts:
        rng.shuffle(part)
    beat = ("beat", START + timedelta(days=90), 0.0)
    parts.append([beat])
    schema = "meter_id string, reading_timestamp timestamp, reading_value_liters double"
    whole = spark.createDataFrame(rows, schema)
    text = lambda rows: sorted(map(str, rows))
    got = replay(spark, f"{tmp_path}/s", parts, lambda s: session_stream(s, HOUR // 2, late="1 hour"), schema)
    batch = marts.sessions(whole, "30 minutes")
    assert text(r[:2] + (r.ended, r.n_rows) for r in got) == text((r.meter_id, r.started, r.ended, r.n_rows) for r in batch.collect())
    told = replay(spark, f"{tmp_path}/a", parts, lambda s: alert_stream(s, threshold=1.2, last=5, silence_micros=3 * HOUR), schema)
    spikes = marts.anomalies(whole, 1.2, 5)
    assert text((r.meter_id, r.reading_timestamp, round(r.score, 9)) for r in told if r.kind == "spike") == text((r.meter_id, r.reading_timestamp, round(r.score, 9)) for r in spikes.collect())
    after = {m: sorted(r[1] for r in rows if r[0] == m) for m in "abc"}
    silent = [(m, t) for m, times in after.items() for t, u in zip(times, [*times[1:], None], strict=True) if u is None or u - t >= timedelta(hours=3)]
    assert text((r.meter_id, r.reading_timestamp) for r in told if r.kind == "silent") == text((m, t.replace(tzinfo=None)) for m, t in silent)


class Handle:
    """A stand-in for a meter's state that counts its timers."""

    def __init__(self):
        self.timers, self.held = [], {}

    def getListState(self, name, schema):  # noqa: N802
        return Held(self.held, name)

    getValueState = getListState  # noqa: N815

    def registerTimer(self, at):  # noqa: N802
        self.timers.append(at)


class Held:
    def __init__(self, held, name):
        self.held, self.name = held, name

    def exists(self):
        return self.name in self.held

    def get(self):
        return self.held[self.name]

    def put(self, rows):
        self.held[self.name] = rows

    update = put

    def appendList(self, rows):  # noqa: N802
        self.held[self.name] = [*self.held.get(self.name, []), *rows]

    def clear(self):
        self.held.pop(self.name, None)


class Mark:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):  # noqa: N802
        return self.ms


@pytest.mark.parametrize("processor", [Sessions(HOUR), Alerts(1.5, 3, 1000 * HOUR)])
def test_one_timer_waits_however_many_readings(processor):
    handle = Handle()
    processor.init(handle)
    times = [2 * HOUR * n for n in range(1, 101)]
    list(processor.handleInputRows(("m",), iter([pd.DataFrame({"micros": times, "liters": [1.0] * 100})]), Mark(0)))
    assert len(handle.timers) == 1 and handle.timers[0] <= (times[0] + HOUR) // 1000
    at, told = times[49] // 1000, list(processor.handleExpiredTimer(("m",), Mark(times[49] // 1000), None))
    assert len(handle.timers) == 2 and at < handle.timers[1] <= (times[50] + HOUR) // 1000
    assert not isinstance(processor, Sessions) or len(told[0]) == 49


def test_positions_seen_are_held_on_disk(spark, tmp_path):
    rows = fixtures.bronze(spark, SF).limit(50)
    produce(rows, f"file://{tmp_path}/log")
    dims = lambda: (fixtures.dim_meter(spark, SF), fixtures.dim_dma(spark, SF))
    bronze = events.FileBronze(spark, f"{tmp_path}/bronze")
    events.bronze_files(replay_stream(spark, f"file://{tmp_path}/log"), bronze.path, f"{tmp_path}/cb", now=fixtures.NOW, once=True).awaitTermination()
    judged = validated(bronze.read(), *dims(), now=fixtures.NOW)
    silver = Table(spark, f"file://{tmp_path}/s", valid(judged).schema)
    bad = Table(spark, f"file://{tmp_path}/q", quarantine(judged, fixtures.NOW, ("kafka_timestamp",)).schema)
    query = events.silver_events(bronze.stream(), silver, bad, dims, f"{tmp_path}/cs", now=fixtures.NOW, once=True)
    query.awaitTermination()
    states = [s for p in query.recentProgress for s in p["stateOperators"]]
    assert states and all(any("rocksdb" in m for m in s["customMetrics"]) for s in states)
