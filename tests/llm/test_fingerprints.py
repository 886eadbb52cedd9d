import hashlib
import random

import pytest
from pyspark.sql import functions as F

from aquilith.llm import fingerprints
from aquilith.llm.fingerprints import ANCHORS, SpotSigs, anchor_hashes, edited, fingerprint_docs, length_partition, likeness, read, spots, spots_of


def plain_spots(text, chain=3):
    """Spots as tuples of words."""
    words = [w.decode().strip(".,;:!?\"'()[]") for w in text.encode().lower().split()]
    def over(anchor, content):
        out = set()
        for i in anchor:
            rest = [words[j] for j in content if j > i][:chain]
            if len(rest) == chain:
                out.add((words[i], *rest))
        return out
    every = range(len(words))
    out = over([i for i in every if words[i] in ANCHORS], [i for i in every if words[i] not in ANCHORS])
    return out


def corpus(seed, n=40):
    rng = random.Random(seed)
    word = lambda: rng.choice(["the", "of", "and"] * 30 + [f"w{i}" for i in range(200)])
    return [(i * 17 % 97 - 20, " ".join(word() for _ in range(rng.choice([60, 90, 200])))) for i in range(n)]


def test_spot_likeness_is_that_of_plain_sets():
    anchors = anchor_hashes()
    texts = [t for _, t in corpus(3)]
    for a, b in zip(texts, texts[1:] + texts[:1], strict=True):
        b = a[: len(a) // 2] + b
        p, q = plain_spots(a), plain_spots(b)
        assert likeness(spots(a.encode(), anchors, 3, 1), spots(b.encode(), anchors, 3, 1)) == pytest.approx(len(p & q) / len(p | q))


def test_rows_equal_brute_force(documents):
    rows = corpus(4) + [(500, "été çà " * 30), (501, "x"), (502, "")]
    got = {r.doc_id: r for r in fingerprint_docs(documents(rows).repartition(7)).collect()}
    order = sorted(rows, reverse=True)
    assert len(got) == len(rows)
    for (i, t), (_, following) in zip(order, order[1:] + order[:1], strict=True):
        n = len(t) // 3
        other = t[: len(t) - n] + following[:n]
        assert edited(t, following) == other
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(other.encode()).hexdigest())
        assert r.near_edited == pytest.approx(likeness(read(r.fingerprint), read(r.edited_fingerprint)))
        assert 0 <= r.near_next <= 1


def test_partitions_by_length_prune_nothing_alike():
    for t in (0.5, 0.8):
        for a in range(1, 200):
            for b in range(a, 200):
                if a / b >= t:
                    assert length_partition(b, t) - length_partition(a, t) in (0, 1)


def test_nulls_ties_repeats_and_empty_tables(documents):
    docs = documents([(1, None), (2, "the same text of words"), (2, "the same text of words"), (2, "another text of words"), (None, "null id"), (None, None)])
    docs = docs.withColumn("bucket", F.lit("x")).withColumn("tail", F.lit(1)).withColumn("at", F.lit(1))
    got = fingerprint_docs(docs).collect()
    assert sorted(str(r.doc_id) for r in got) == ["1", "2", "2", "2", "None", "None"]
    assert len({r.fingerprint for r in got if r.doc_id == 2}) == 2
    assert [r.n_chars for r in got if r.doc_id == 1] == [0]
    assert fingerprint_docs(docs.limit(0)).count() == 0
    (one,) = fingerprint_docs(documents([(7, "only one text")])).collect()
    assert one.near_next == 1.0


def components(sets, threshold):
    """Least ids reachable, by a plain comparison of all pairs."""
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: find(i) for i in sets}


@pytest.mark.parametrize("threshold", [60, 80])
def test_near_copies_equal_brute_force(documents, threshold):
    rng = random.Random(6)
    rows = []
    for i, t in corpus(6, 25):
        rows.append((i, t))
        for k in range(rng.randrange(0, 4)):
            words = t.split()
            for _ in range(rng.randrange(0, 8)):
                words[rng.randrange(len(words))] = rng.choice(["the", "w7", "own"])
            rows.append((1000 + 10 * i + k, " ".join(words)))
    rows += [(9000 + i, "the one shared passage of words and more of the same " * 3 + f"own{i}") for i in range(8)] + [(9100, ""), (9101, "")]
    got = {r.doc_id: (r.copies_id, r.n_spots) for r in fingerprint_docs(documents(rows).repartition(4), threshold=threshold).collect()}
    sets = {i: set(spots(t.encode(), anchor_hashes(), 3, 1).tolist()) for i, t in rows}
    expected = components(sets, threshold)
    assert got == {i: (expected[i], len(s)) for i, s in sets.items()}
    assert sum(i != c for i, c in expected.items()) > 10


def test_rare_spots_go_first():
    import numpy as np

    from aquilith.llm.fingerprints import SpotSigs
    from aquilith.llm.simjoin import CELLS, cell_of

    family = SpotSigs(80, 3, 1)
    s = np.arange(50, dtype=np.uint64)
    counts = np.zeros(CELLS, np.int64)
    counts[cell_of(s[:39])] = 9
    mine, _ = family.with_counts(counts).signatures(s)
    other, _ = family.with_counts(counts).signatures(s[39:])
    assert len(mine) == 11 and len(set(mine.tolist()) & set(other.tolist())) in (0, 3)


def test_string_ids_hot_ids_and_long_texts(documents):
    rows = [(i % 3 if i % 2 else None, f"the text {i} of words and more {'x' * i}") for i in range(120)] + [(7, "the long text of " * 40_000)]
    docs = documents(rows).repartition(3)
    got = fingerprint_docs(docs).collect()
    assert sorted((str(r.doc_id), r.n_chars) for r in got) == sorted((str(i), len(t)) for i, t in rows)
    named = docs.withColumn("doc_id", F.concat(F.lit("é-"), F.col("doc_id").cast("string")))
    got = {(r.doc_id, r.n_chars, r.edited_sha256) for r in fingerprint_docs(named).collect()}
    order = sorted(((f"é-{i}" if i is not None else None, t) for i, t in rows), key=lambda x: (x[0] is not None, x[0] or ""), reverse=True)
    assert {(i, n) for i, n, _ in got} == {(i, len(t)) for i, t in order}
    top, after = [r for r in order if r[0] == "é-7"][0], [t for i, t in order if i == "é-2"]
    mine = next(s for i, n, s in got if i == top[0])
    assert mine in {hashlib.sha256(edited(top[1], t).encode()).hexdigest() for t in after}


def test_many_texts_at_once_equal_one_by_one(monkeypatch):
    """Texts read together share no spots, however they are cut into blocks."""
    rng = random.Random(5)
    words = [*ANCHORS[:12], "Water", "(meter)", "leak,", "...", "\xe9t\xe9", "x" * 90, *(f"w{i}" for i in range(30))]
    texts = [None, b"", b" \n", *(rng.choice(" \n\t").join(rng.choice(words) for _ in range(rng.choice([1, 2, 5, 40, 300]))).encode() for _ in range(60))]
    anchors = anchor_hashes()
    alone = [spots(t or b"", anchors, 3, 1).tolist() for t in texts]
    assert [s.tolist() for s in spots_of(texts, anchors, 3, 1)] == alone
    monkeypatch.setattr(fingerprints, "BLOCK", 50)
    assert [s.tolist() for s in spots_of(texts, anchors, 3, 1)] == alone
    assert [s.tolist() for s in SpotSigs(80, 3, 1).sets_of(texts)] == alone
