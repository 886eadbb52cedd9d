import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from aquilith.llm.mixing import mix, mixed


def water(sizes, weights, cap):
    """Targets by sharing the excess again until no target is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    left, target, total = set(order), {}, float(sum(sizes.values()))
    while left:
        rest, all_w = total - sum(target.values()), sum(w[s] for s in left)
        over = {s for s in left if rest * w[s] / all_w >= cap * sizes[s]}
        if not over:
            target.update({s: rest * w[s] / all_w for s in left})
            break
        target.update({s: cap * sizes[s] for s in over})
        left -= over
    return target


def corpus(seed, n=600):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        source = "hot" if rng.random() < 0.36 else rng.choice(["a", "b", "é", "zz", None, "tiny"] if rng.random() < 0.9 else ["tiny2"])
        rows.append((i, " ".join(["w"] * rng.choice([0, 3, 10, 50, 400])), "en", source))
    return rows


def check(rows, got):
    sizes, taken = defaultdict(int), defaultdict(int)
    for _, t, _, s in rows:
        sizes[s] += len(t.split())
    expected = water(dict(sizes), (1, 2, 3), 3)
    by = {r.doc_id: r for r in got}
    for i, t, _, s in rows:
        r = by[i]
        assert (r.size, r.source_size) == (len(t.split()), sizes[s])
        assert r.target == pytest.approx(expected[s])
        assert r.taken <= 3 * r.size and (not r.size or r.taken % r.size == 0)
        whole = int(expected[s] / sizes[s] + 1e-9) if sizes[s] else 0
        assert whole * r.size <= r.taken <= (whole + 1) * r.size
        taken[s] += r.taken
    for s in sizes:
        assert abs(taken[s] - expected[s]) <= 200, s  # half of the longest document


@pytest.mark.parametrize("seed", [1, 2])
def test_targets_and_takes(documents, seed):
    rows = corpus(seed)
    docs = documents(rows).repartition(5)
    got = mix(docs).collect()
    check(rows, got)
    assert sorted(map(tuple, mix(docs.coalesce(1)).collect())) == sorted(map(tuple, got))
    out = mixed(docs)
    assert out.columns == docs.columns
    counts = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    assert {r.doc_id: r.size * counts.get(r.doc_id, 0) for r in got} == {r.doc_id: r.taken for r in got}


def test_inclusion_follows_the_odds(documents):
    """Over seeds, documents of a source are taken as often as its share says."""
    rows = [(i, "w " * 10, "en", "ab"[i % 2]) for i in range(80)]
    docs = documents(rows).cache()
    hits = defaultdict(int)
    for seed in range(12):
        for r in mix(docs, weights=(1, 3), seed=seed).collect():
            hits["ab"[r.doc_id % 2]] += r.taken / r.size
    assert hits["a"] == pytest.approx(12 * 20, abs=12) and hits["b"] == pytest.approx(12 * 60, abs=12)


def test_nulls_repeats_and_empty_tables(spark, documents):
    docs = documents([(1, None, "en", None), (None, "a b", "en", None), (2, "c d e", "en", "s"), (2, "c d e", "en", "s"), (3, "", "en", "zero")])
    docs = docs.withColumn("size", F.lit("x")).withColumn("end", F.lit(1)).withColumn("q", F.lit(0)).withColumn("row", F.lit(3))
    got = mix(docs).collect()
    assert len(got) == 5 and all(r.taken == 0 for r in got if not r.size)
    assert sorted(r.taken for r in got if r.doc_id == 2) == [0, 3]  # of a target of 2
    assert mix(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).columns == docs.columns


def test_plan_runs_no_python(documents):
    plan = mix(documents(corpus(1, 30)))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_copies_are_numbered(documents):
    docs = documents([(i, "one two three four " * (i + 1), "en", "abc"[i % 3]) for i in range(30)])
    got = mixed(docs, copy_col="copy")
    assert got.columns == [*docs.columns, "copy"]
    by = {}
    for r in got.collect():
        by.setdefault(r.doc_id, []).append(r["copy"])
    assert all(sorted(c) == list(range(1, len(c) + 1)) for c in by.values()) and max(map(len, by.values())) > 1
    assert sorted(map(tuple, got.drop("copy").collect())) == sorted(map(tuple, mixed(docs).collect()))


def chances(sizes, rest):
    """Inclusion by size: in proportion to bit lengths, the certain ones set aside until none is above 1."""
    certain = set()
    while True:
        left = rest - sum(sizes[i] for i in certain)
        pull = sum(n * n.bit_length() for i, n in enumerate(sizes) if i not in certain)
        out = [1.0 if i in certain else n.bit_length() * left / pull for i, n in enumerate(sizes)]
        over = {i for i, p in enumerate(out) if i not in certain and p >= 1}
        if not over:
            return out
        certain |= over


def test_inclusion_differs_by_document(documents):
    """Over seeds and sources alike, each size is included as often as its chance says."""
    sizes, alike = [1, 3, 12, 60, 300] * 12, [f"a{k:02d}" for k in range(24)]
    rows = [(1000 * k + i, "w " * n, "en", s) for k, s in enumerate(alike) for i, n in enumerate(sizes)]
    rows += [(100_000 + i, "w " * 100, "en", f"b{i % 24:02d}") for i in range(24 * 20)]
    docs = documents(rows).cache()
    hits, seeds = defaultdict(int), 2
    for seed in range(seeds):
        got = mix(docs, weights=(1,), seed=seed).collect()
        target = next(r.target for r in got if r.doc_id == 0)
        taken = defaultdict(int)
        for r in got:
            if r.doc_id < 100_000:
                hits[r.size] += r.taken > 0
                taken[r.doc_id // 1000] += r.taken
        assert all(abs(n - target) <= 150 for n in taken.values())
    expected = dict(zip(sizes, chances(sizes, target), strict=True))
    assert 0 < expected[1] < expected[12] < expected[300] <= 1
    for n, p in expected.items():
        assert hits[n] / (12 * 24 * seeds) == pytest.approx(p, abs=0.06), n


def test_certain_documents_are_always_taken(documents):
    sizes = [1] * 30 + [1000] * 3
    docs = documents([(i, "w " * n, "en", "a") for i, n in enumerate(sizes)] + [(900, "w " * 3028, "en", "b")]).cache()
    for seed in range(2):
        got = mix(docs, weights=(1985, 2000), seed=seed).collect()
        target = next(r.target for r in got if r.doc_id == 0)
        assert target < sum(sizes) and chances(sizes, target)[-1] == 1 or target > sum(sizes)
        assert all(r.taken >= 1000 for r in got if r.size == 1000)


@pytest.mark.parametrize("parts", [1, 6])
def test_repeated_rows_are_taken_one_by_one(documents, parts):
    rows = [(7, "w " * 10, "en", "a")] * 100 + [(8, "v " * 1000, "en", "b")] + [(9, "u", "en", "b")] * 3
    docs = documents(rows).repartition(parts)
    got = mix(docs, weights=(2, 3)).collect()
    target = next(r.target for r in got if r.doc_id == 7)
    assert len(got) == len(rows) and 0 < target < 1000 and target % 10
    assert abs(sum(r.taken for r in got if r.doc_id == 7) - target) <= 5
    assert {r.taken for r in got if r.doc_id == 7} == {0, 10}
    assert mixed(docs, weights=(2, 3)).filter("doc_id = 7").count() * 10 == sum(r.taken for r in got if r.doc_id == 7)


def test_long_texts(documents):
    rows = [(i, "word " * (100_000 if i == 3 else 50), "en", "ab"[i % 2]) for i in range(30)]
    got = {r.doc_id: r for r in mix(documents(rows)).collect()}
    assert got[3]["size"] == 100_000 and all(0 <= r.taken <= 3 * r["size"] for r in got.values())
