"""Number runs, leak onset, the as-of scan, demand forecasts and sketches against plainer ways."""

import random
from collections import Counter, defaultdict
from datetime import UTC, date, datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from aquilith.operators import asof
from aquilith.plans import forecast, leaks, quality, runs
from aquilith.plans.reconcile import validated
from aquilith.sources import fixtures

SF = "/root/testdata/sf0.001"
AT = datetime(2024, 1, 1, tzinfo=UTC)


@pytest.mark.parametrize("seed", range(2))
def test_runs_of_shuffled_batches(spark, tmp_path, seed, monkeypatch):
    monkeypatch.setattr(runs, "STRETCH", 16)
    rng = random.Random(seed)
    rows = [(m, n) for m in "ab" for n in range(-20, 150) if rng.random() < 0.7] + [("a", 5), ("a", 5), (None, 3), ("b", None), ("c", 1 << 40)]
    rng.shuffle(rows)
    kept, seen = runs.NumberRuns(spark, f"{tmp_path}/r"), defaultdict(Counter)
    for n in range(3):
        part = rows[n::3]
        top = {m: max(c) for m, c in seen.items()}
        known = {m: set(c) for m, c in seen.items()}
        for m, x in part:
            if m is not None and x is not None:
                seen[m][x] += 1
        kept.add(spark.createDataFrame(part, "meter_id string, sequence_no long"), n)
        kept.add(spark.createDataFrame(part, "meter_id string, sequence_no long"), n)  # a replay
        filled = {m: len({x for x in c if x < top[m]} - known[m]) for m, c in seen.items() if m in top}
        if n:
            assert {r.key: r.numbers for r in kept.filled(n).collect()} == {m: k for m, k in filled.items() if k}
    found = kept.read()
    expected = set()
    for m, c in seen.items():
        xs = sorted(c)
        expected |= {(m, a, b, b - a - 1) for a, b in zip(xs, xs[1:], strict=False) if b > a + 1}
    assert {tuple(r) for r in runs.gaps(found).collect()} == expected
    assert {r.key: (r.n_rows, r.n_numbers, r.n_duplicates) for r in runs.totals(found).collect()} == {m: (sum(c.values()), len(c), sum(c.values()) - len(c)) for m, c in seen.items()}


def test_injected_leaks_are_found_at_their_night(spark):
    rng = random.Random(3)
    rows, truth = [], {}
    for k in range(40):
        start, length = rng.randrange(20, 60), rng.randrange(8, 25)
        if k % 2:
            truth[f"m{k}"] = (start, start + length)
        for night in range(100):
            leak = 1.2 if k % 2 and start <= night < start + length else 0.0
            for hour in (1, 2, 3, 12):
                quiet = rng.random() * 0.3 if hour in (2, 3) else 5.0
                rows.append((f"m{k}", AT + timedelta(days=night, hours=hour, minutes=rng.randrange(60)), quiet + leak))
    found = {r.meter_id: r for r in leaks.leaks(spark.createDataFrame(rows, "meter_id string, reading_timestamp timestamp, flow_rate double")).collect()}
    assert set(found) == set(truth)
    for m, (start, end) in truth.items():
        assert (found[m].onset, found[m].ended) == (AT.date() + timedelta(days=start), AT.date() + timedelta(days=end - 1))
        assert found[m].onset < found[m].alarmed <= found[m].ended and found[m].nights == end - start


def test_a_leak_runs_on_and_a_quiet_night_does_not_hide_it(spark):
    night = lambda n, flow: ("a", AT + timedelta(days=n, hours=2), flow)
    rows = [night(n, 0.0) for n in range(5)] + [night(n, 0.0 if n == 9 else 2.0) for n in range(5, 14)]
    (r,) = leaks.leaks(spark.createDataFrame(rows, "meter_id string, reading_timestamp timestamp, flow_rate double")).collect()
    assert (r.onset, r.ended, r.nights, r.excess) == (date(2024, 1, 6), None, 9, 8 * 1.5 - 0.5)


@pytest.mark.parametrize("stretch", ["month", "week"])
def test_as_of_equals_looking_at_every_revision(spark, stretch):
    rng = random.Random(5)
    day = lambda n: date(2024, 1, 1) + timedelta(days=n)
    revisions, n = [], 0
    for k in range(12):
        for _ in range(rng.randrange(0, 6)):
            a = rng.randrange(0, 90)
            revisions.append((f"k{k}", n, day(a), rng.choice([None, day(a + rng.randrange(-3, 30))])))
            n += 1
    revisions += [(None, 900, day(0), None), ("k1", 901, None, None)]
    facts = [(i, rng.choice([None, *(f"k{k}" for k in range(14))]), rng.choice([None, *map(day, range(-5, 110))])) for i in range(600)] + [(0, "k1", day(50))] * 3
    expected = Counter()
    for i, k, d in facts:
        held = [(s, sk) for key, sk, s, e in revisions if k is not None and d is not None and key == k and s is not None and s <= d and (e is None or d < e)]
        expected[i, k, d, max(held)[1] if held else None] += 1
    got = asof.as_of(
        spark.createDataFrame(facts, "i int, key string, at date").repartition(4),
        spark.createDataFrame(revisions, "key string, sk int, effective_start_date date, effective_end_date date"),
        "key", F.col("at"), stretch=stretch, order="sk",
    )
    assert Counter((r.i, r.key, r["at"], r.revision and r.revision.sk) for r in got.collect()) == expected


def test_fits_equal_numpy_and_beat_the_last_week(spark):
    rng = np.random.default_rng(2)
    rows = []
    for m in range(6):
        for h in range(24 * 35):
            t = AT + timedelta(hours=h)
            level = 50 + 20 * np.sin(2 * np.pi * h / 24 + m) + 8 * np.cos(2 * np.pi * h / 168)
            rows.append((f"m{m}", t, float(level + 6 * rng.normal())))
    hourly = spark.createDataFrame(rows, "meter_id string, period timestamp, liters double").repartition(3)
    parts = [forecast.sums(hourly.filter(f"period {c} '2024-01-20'")) for c in ("<", ">=")]
    models = {r.meter_id: np.array(r.weights) for r in forecast.fit(forecast.merged(*parts)).collect()}
    for m in range(6):
        own = [(t.timestamp() / 3600, y) for k, t, y in rows if k == f"m{m}"]
        hours, y = np.array(own).T
        x = np.column_stack([np.ones_like(hours), *(f(2 * np.pi / p * hours) for p in forecast.PERIODS for f in (np.sin, np.cos))])
        assert np.allclose(models[f"m{m}"], np.linalg.lstsq(x, y, rcond=None)[0], atol=1e-3)
    scored = forecast.backtest(hourly, F.lit(AT + timedelta(days=28))).collect()
    assert len(scored) == 6 and all(r.n == 168 and r.error < r.baseline_error for r in scored)
    one = spark.createDataFrame(rows[:2], "meter_id string, period timestamp, liters double")
    assert forecast.fit(forecast.sums(one)).count() == 1  # too few hours for a plain solution


@pytest.fixture(scope="module")
def days(spark):
    judged = validated(fixtures.bronze(spark, "/root/testdata/sf0.01"), fixtures.dim_meter(spark, SF), fixtures.dim_dma(spark, SF), now=fixtures.NOW).persist()
    return judged, quality.daily(judged).persist()


def test_merged_sketches_keep_their_rank_error(days):
    judged, sketched = days
    (row,) = quality.merged(sketched).collect()
    found = quality.profile(quality.merged(sketched), ranks=(0.1, 0.5, 0.9)).collect()
    for r in found:
        exact = np.sort([x[0] for x in judged.select(r.measure).dropna().collect()])
        assert r.n == len(exact)
        for q, rank in zip(r.quantiles, (0.1, 0.5, 0.9), strict=True):
            low, high = np.searchsorted(exact, q, "left") / len(exact), np.searchsorted(exact, q, "right") / len(exact)
            assert low - 0.0165 <= rank <= high + 0.0165
    meters = judged.select("meter_id").dropna().distinct().count()
    assert row.n_rows == judged.count() and row.n_valid == judged.filter("is_valid").count()
    assert abs(found[0].n_meters - meters) < 0.1 * meters
    direct = {r.reason: r.n for r in judged.select(F.explode("quarantine_reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n")).collect()}
    assert {r.reason: r.n_rows for r in quality.reasons(sketched).collect()} == direct


def test_drift_tells_shifted_days(spark, days):
    judged, sketched = days
    early, late = (quality.merged(sketched.filter(f"day {c} '2024-01-15'")) for c in ("<", ">="))
    assert all(r.distance < 0.1 for r in quality.drift(early, late).collect())
    moved = quality.merged(quality.daily(judged.withColumn("flow_rate", F.col("flow_rate") + 3)))
    told = {r.measure: r.distance for r in quality.drift(early, moved).collect()}
    assert told["flow_rate"] > 0.4 and told["battery_pct"] < 0.1
