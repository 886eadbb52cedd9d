import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from aquilith.llm.partenum import PartEnum, jaccard_components, one_of_each


def brute(rows, n, threshold):
    sets = {}
    for i, t in rows:
        w = [x.decode() for x in t.encode().lower().split()] if t else []
        sets[i] = {tuple(w[j : j + n]) for j in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x in ids:
        for y in ids:
            a, b = sets[x], sets[y]
            if x < y and a and b and 100 * len(a & b) >= threshold * len(a | b):
                p, q = sorted((find(x), find(y)))
                root[q] = p
    return {(i, len(sets[i]), find(i)) for i in ids}


def corpus(seed, bases, copies):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [rng.choice(vocabulary) for _ in range(40)]
    rows, at = [], 0
    for b in range(bases):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 12, 25, 60, 150, 400]))]
        if b % 3 == 0:
            words += passage
        for _ in range(rng.randrange(1, copies)):
            own = list(words)
            for _ in range(rng.randrange(0, 4) * max(1, len(own) // 100)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            rows.append((at, " ".join(own)))
            at += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize(("n", "threshold", "seed"), [(3, 90, 1), (5, 80, 2), (1, 60, 3)])
def test_components_equal_brute_force(documents, n, threshold, seed):
    rows = corpus(seed, 40, 12)
    rows += [(10_000, None), (10_001, " \n"), (10_002, "One two"), (10_003, "one two"), (10_004, "ONE TWO")]
    got = {tuple(r) for r in jaccard_components(documents(rows), shingle=n, threshold=threshold).collect()}
    assert got == brute(rows, n, threshold)
    assert any(c != i for i, _, c in got)


def test_chain_through_copies_that_do_not_link_directly(documents):
    words = [f"x{i}" for i in range(300)]
    rows = []
    for i in range(40):  # every copy links to the base only
        own = list(words)
        for j in range(3):
            own[7 + 7 * i % 290 - j * 2 - i // 20] = f"y{i}_{j}"
        rows.append((100 + i, " ".join(own)))
    rows.append((999, " ".join(words)))
    got = {tuple(r) for r in jaccard_components(documents(rows), shingle=3, threshold=90).collect()}
    assert got == brute(rows, 3, 90)


def test_nulls_repeats_and_empty_tables(spark, documents):
    docs = documents([(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (None, None), (2, ""), (None, "q r s")])
    docs = docs.withColumn("id", F.lit("clash")).withColumn("key", F.lit(1)).withColumn("component_id", F.lit(1))
    got = sorted((tuple(r) for r in jaccard_components(docs).collect()), key=str)
    assert got == sorted([(1, 2, 1), (1, 2, 1), (None, 2, 1), (None, 0, None), (2, 0, 2), (None, 1, None)], key=str)
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in kept.collect()) == sorted(
        [("1", "a b c d e f"), ("None", "a b c d e f"), ("None", "None"), ("2", ""), ("None", "q r s")]
    )
    assert jaccard_components(docs.limit(0)).count() == 0
    assert one_of_each(docs.limit(0)).count() == 0


def test_long_text(documents):
    text = " ".join(f"t{i % 9973}" for i in range(60_000))
    got = {tuple(r)[2] for r in jaccard_components(documents([(5, text), (4, text + " end")])).collect()}
    assert got == {4}


def test_sketches_bound_the_difference(spark):
    import numpy as np

    from aquilith.llm.partenum import _far_apart, sketch, wide_sketch

    rng = np.random.default_rng(1)
    rows = []
    for n in (1, 5, 60, 64, 65, 130, 700):
        for d in (0, 1, 3, n // 8, n):
            base = rng.integers(0, 1 << 60, n + d, dtype=np.uint64)
            a, b = np.unique(base[:n]), np.unique(base[d:])
            differ = len(np.setxor1d(a, b))
            assert sum(int(x).bit_count() for x in (sketch(a) ^ sketch(b)).view(np.uint64)) <= differ
            both = len(np.intersect1d(a, b))
            rows.append((wide_sketch(a).tolist(), len(a), wide_sketch(b).tolist(), len(b), 100 * both >= 80 * (len(a) + len(b) - both)))
    df = spark.createDataFrame(rows, "aw array<long>, an int, bw array<long>, bn int, link boolean")
    df = df.selectExpr("named_struct('wide', aw, 'size', an) as a", "named_struct('wide', bw, 'size', bn) as b", "link")
    got = df.selectExpr("link", f"{_far_apart(80)} as far").collect()
    assert not any(r.link and r.far for r in got) and sum(r.far for r in got) >= 5


def test_spread_signatures_change_nothing(documents):
    rows = corpus(7, 20, 12)
    rows += [(9000 + i, rows[0][1]) for i in range(5)]
    docs = documents(rows).repartition(3)
    got = {tuple(r) for r in jaccard_components(docs, hot=1).collect()}
    assert got == brute(rows, 5, 80) and any(c != i for i, _, c in got)


def test_packed_signatures_come_back():
    import numpy as np

    from aquilith.llm.partenum import LOW, pack48, unpack48

    sig = np.random.default_rng(2).integers(0, 1 << 63, 1000, dtype=np.uint64) * np.uint64(2)
    assert (unpack48(pack48(sig)) == sig & LOW).all() and len(pack48(sig)) == 6000


def test_groups_are_kept_once(documents):
    import numpy as np

    from aquilith.llm.partenum import groups_of

    sig = np.array([5, 5, 7, 7, 7, 9, 9, 11, 12, 12], np.uint64)
    key = np.array([1, 2, 2, 1, 1, 3, 4, 8, 8, 8], np.int64)
    flag = np.array([0, 0, 0, 0, 0, 0, 1, 0, 0, 0], bool)
    keys, ends, times, far = groups_of(sig, key, flag)
    assert keys.tolist() == [1, 2] and ends.tolist() == [2] and times.tolist() == [2]
    assert sorted(zip(sig[far].tolist(), key[far].tolist(), strict=True)) == [(9, 3), (9, 4)]


def test_intermediate_tables_go(spark, documents, tmp_path):
    import os

    from aquilith.llm.common import shared_folder

    root = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(root))
    out = jaccard_components(documents(corpus(3, 10, 5)))
    (new,) = set(os.listdir(root)) - before
    assert len(os.listdir(f"{root}/{new}")) == 1 and out.count() > 0


def test_an_id_column_with_a_dot(documents):
    docs = documents([(1, "a b c d e f g"), (2, "a b c d e f g"), (3, "other words are here and there")]).withColumnRenamed("doc_id", "doc.id")
    assert sorted(r["doc.id"] for r in one_of_each(docs, id_col="doc.id").collect()) == [1, 3]


def sets_of(size, other, both, rng):
    """Two sets of the sizes given with as many elements in common."""
    x = np.array(rng.sample(range(1 << 62), size + other - both), np.uint64)
    return np.sort(x[:size]), np.sort(x[size - both :])


@pytest.mark.parametrize("threshold", [60, 80, 90])
def test_sets_at_the_threshold_share_a_signature(threshold):
    family, rng = PartEnum(5, threshold), random.Random(threshold)
    for _ in range(400):
        size = int(10 ** rng.uniform(0, 3.3))
        other = rng.randint(-(-threshold * size // 100), 100 * size // threshold)
        both = -(-threshold * (size + other) // (100 + threshold))  # least that links
        if both > min(size, other):
            continue
        a, b = (np.concatenate(family.signatures(s)) for s in sets_of(size, other, both, rng))
        assert len(np.intersect1d(a, b)), (size, other, both)


def test_unrelated_sets_share_no_signature():
    """Sets at the lower end of a band leave out their empty choices too, which would gather all of them."""
    family, rng = PartEnum(5, 80), random.Random(1)
    for size in (300, 450, 1000, 3000):
        found = [np.unique(np.concatenate(family.signatures(sets_of(size + i, 0, 0, rng)[0]))) for i in range(0, size // 4, size // 16)]
        every = np.concatenate(found)
        assert len(np.unique(every)) == len(every), size
