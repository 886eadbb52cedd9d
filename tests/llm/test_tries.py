"""The prefix trie against one built in plain Python, and against SQL on whole tables."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import duckdb
import pytest

from aquilith.llm.queries import ORACLE_SQL, QUERIES
from aquilith.llm.tries import prefix_trie

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows, family=20, openings=4):
    own = defaultdict(list)
    for c, n, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            own[c].append((n is not None, n or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest(), role, text))
    own = {c: [x[3:] for x in sorted(t)] for c, t in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % openings
        base = (abs(c) - abs(c) % family) * (1 if c >= 0 else -1)
        path = own.get(base, [])[:h] + turns[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids = defaultdict(list)
    for p in members:
        if p:
            kids[p[:-1]].append(p)
    leaves, saved = {}, {}
    for p in sorted(members, key=len, reverse=True):
        leaves[p] = sum(leaves[q] for q in kids[p]) if kids[p] else 1
        saved[p] = sum(saved[q] for q in kids[p]) + (len(members[p]) - 1) * (len(WORD.findall(p[-1][1])) if p else 0)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else None, len(m), len(kids[p]), leaves[p], saved[p], hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest())
        for p, m in members.items()
    )


def run(spark, rows, **how):
    table = spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn int, role string, text string, key int, base string").repartition(3)
    return sorted(map(tuple, prefix_trie(table, **how).collect()))


def conversations(rng, n, low=0):
    rows = []
    for c in range(low, low + n):
        rows += [(c, t, rng.choice(["user", "assistant", None]), " ".join(rng.choices(["a", "b", None or "c  d"], k=rng.randrange(3)))) for t in range(rng.randrange(6))]
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    rows = conversations(rng, 90, rng.choice([0, -45, 1000]))
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, family=7, openings=2) == brute(rows, 7, 2)


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [
        (0, 1, "user", "base one"), (0, 2, "user", "base two"), (0, None, None, None), (0, 3, "user", "x " * 50_000),
        (1, 0, "user", "same"), (1, 0, "user", "same"), (1, 0, "assistant", "tie"), (None, 0, "user", "lost"),
        *[(40 + i, 0, "user", "of one turn") for i in range(20)], *[(2, t, "user", f"turn {t % 3}") for t in range(2000)],
        (65, 0, "user", "no base"), (-3, 0, "user", "below"), (-3, 1, "user", "zero"), (-20, 0, "user", "base"), (-21, 0, "u", "v"), (-21, 4, "u", "w"),
    ]
    assert run(spark, rows) == brute(rows)


def test_empty_tables_have_no_node(spark):
    assert run(spark, []) == run(spark, [(None, 0, "user", "text")]) == []
    with pytest.raises(ValueError):
        run(spark, [], openings=0)


def test_a_hot_conversation(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(3000) for t in range(2)] + [(c, 2, "user", str(c)) for c in range(0, 3000, 3)]
    assert run(spark, rows) == brute(rows)


def test_whole_query_equals_sql(spark):
    folder = "/root/testdata/sf0.1"
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    expected = con.sql(ORACLE_SQL["op12_prefix_trie"])
    got = QUERIES["op12_prefix_trie"](spark, folder)
    assert got.columns == expected.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(expected.fetchall(), key=repr)
