"""Ranked search against scoring every document for every item."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest

from aquilith.llm import retrieval
from aquilith.llm.queries import ORACLE_SQL, QUERIES
from aquilith.llm.retrieval import search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def of(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    counted = [(i, Counter(of(t)), len(of(t))) for i, t in docs]
    n, total = sum(x[2] > 0 for x in counted), sum(x[2] for x in counted)
    df = Counter(t for x in counted for t in x[1])
    out = []
    for item, text in items:
        scores = []
        for i, tf, size in counted:
            m = 75 + 25 * size * n // max(total, 1)
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * tf[t] // (1000 * tf[t] + 12 * m)) for t in of(text) if tf[t])
            scores += [(-s, i is None, i or 0, i)] * (s > 0)
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=repr)


def run(spark, docs, items, k, **how):
    d = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, block string, term int")
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id int, text string, rank string")
    return sorted(map(tuple, search(d.repartition(3), q, k=k, **how).collect()), key=repr)


def corpus(rng, n):
    words = [f"w{i}" for i in range(60)] + ["é", "日本", "Straße", "x1"]
    odds = [1 / (i + 1) for i in range(len(words))]
    docs = [(rng.randrange(10**6), " ".join(rng.choices(words, odds, k=rng.randrange(0, 40)))) for _ in range(n)]
    return docs + [(7000 + i, docs[0][1]) for i in range(n // 3)]


def test_terms():
    assert terms("Ab-c É_ü\x7f9 日本, x\n".encode()) == ["ab".encode(), b"c", "É".encode(), "ü".encode(), b"9", "日本".encode(), b"x"]
    assert terms(None) == terms(b"") == terms(b" .,!") == []


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("block", [7, 64, 16_384])
def test_equals_brute_force(spark, seed, block):
    rng = random.Random(seed)
    docs = corpus(rng, 150)
    items = [(i, " ".join(rng.choices([w for _, t in docs[:20] for w in t.split()] + ["nowhere"], k=rng.randrange(1, 25)))) for i in range(12)]
    assert run(spark, docs, items, 5, block=block) == brute(docs, items, 5)


def test_nulls_repeats_long_texts_groups_and_empty_tables(spark):
    docs = [(1, None), (2, ""), (None, "alpha beta"), (None, "alpha beta"), (3, "alpha"), (3, "alpha"), (4, "alpha beta " * 50_000), (5, "gamma. ALPHA"), (6, "...")]
    items = [(1, "alpha"), (1, "alpha"), (2, None), (3, ""), (None, "beta beta gamma"), (4, "delta")]
    assert run(spark, docs, items, 3) == brute(docs, items, 3)
    assert run(spark, docs, items, 20, item_bytes=4) == brute(docs, items, 20)
    assert run(spark, [], items, 3) == run(spark, docs, [], 3) == []
    with pytest.raises(ValueError):
        run(spark, docs, items, 3, block=1 << 17)


def test_threshold_is_the_greatest():
    rng = random.Random(5)
    for _ in range(300):
        most = [rng.randrange(1, 40) for _ in range(rng.randrange(1, 9))]
        bound = rng.randrange(0, sum(most) + 1)
        t = retrieval._threshold(bound, most)
        reach = lambda t: sum(min(t - 1, m) for m in most)
        assert t >= 1 and reach(t) <= max(bound, 1) - 1 < max(reach(t + 1), 1 + reach(t))


def test_whole_query_equals_sql(spark):
    folder = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    expected = con.sql(ORACLE_SQL["op11_lexical_search"])
    got = QUERIES["op11_lexical_search"](spark, folder)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect())) == sorted(expected.fetchall())
