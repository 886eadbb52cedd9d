import random

import numpy as np
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aquilith.llm import pieces
from aquilith.llm.packing import best_fit_decreasing, matrix, pack_docs, write_packed
from aquilith.llm.pieces import MODEL


def plain(lengths, length):
    rows, room, changed = [], [], []
    for step, i in enumerate(sorted(range(len(lengths)), key=lambda i: -lengths[i])):
        fit = [(r, j) for j, r in enumerate(room) if r >= lengths[i]]
        if fit:
            least = min(r for r, _ in fit)
            j = max((j for r, j in fit if r == least), key=changed.__getitem__)  # of equals the last touched
        else:
            rows.append([]), room.append(length), changed.append(0)
            j = len(rows) - 1
        rows[j].append(i)
        room[j] -= lengths[i]
        changed[j] = step
    return [sorted(lengths[i] for i in r) for r in rows]


@settings(max_examples=200, deadline=None)
@given(st.integers(1, 40).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.integers(1, n), max_size=60))))
def test_equals_a_search_of_all_rows(case):
    length, lengths = case
    rows = best_fit_decreasing(lengths, length)
    assert sorted(i for r in rows for i in r) == list(range(len(lengths)))
    assert sorted(sorted(lengths[i] for i in r) for r in rows) == sorted(plain(lengths, length))


def unpack(rows):
    parts = {}
    for r in rows:
        ids, places = matrix([r.input_ids])[0], matrix([r.position_ids])[0]
        assert r.cu_seqlens[0] == 0 and r.cu_seqlens[-1] == r.n_tokens and len(r.cu_seqlens) == r.n_segments + 1
        assert not ids[r.n_tokens :].any()
        for a, b, d, s in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], r.doc_ids, r.starts, strict=True):
            assert places[a:b].tolist() == list(range(b - a))
            parts.setdefault(d, []).append((s, ids[a:b].tolist()))
    return {d: [x for _, p in sorted(ps) for x in p] for d, ps in parts.items()}


def test_every_token_is_packed_once(documents, tmp_path, spark):
    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "béta", "γ", "x\n"]) for _ in range(rng.choice([1, 5, 40, 300])))) for i in range(120)]
    packed = pack_docs(documents(rows).repartition(3), length=64, window=2000)
    write_packed(packed, str(tmp_path / "packed"))
    got = spark.read.parquet(str(tmp_path / "packed")).collect()
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    assert unpack(got) == {i: [*sp.encode(t), 2] for i, t in rows}
    assert sum(r.n_tokens for r in got) / (64 * len(got)) > 0.9
    assert all(len(r.input_ids) == len(r.position_ids) == 128 for r in got)


def test_nulls_repeats_long_texts_and_empty_tables(documents):
    docs = documents([(1, None), (2, ""), (None, "no id"), (3, "twice"), (3, "twice"), (4, "long " * 100_000)])
    docs = docs.withColumn("id", F.lit("x")).withColumn("starts", F.lit(1))
    rows = pack_docs(docs).collect()
    held = [d for r in rows for d in r.doc_ids]
    assert {None, 3, 4} == set(held) and held.count(3) == 2 and 1 not in held
    assert sum(r.n_tokens for r in rows if set(r.doc_ids) == {4}) > 90_000
    assert pack_docs(docs.limit(0)).count() == 0


def test_whole_query_equals_brute_force(spark):
    """Every row of the query from the library's own token ids, and the packing of each window against a plain search."""
    from aquilith.llm.queries import QUERIES

    folder = "/root/testdata/sf0.001"
    sp = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    expected = {r.doc_id: [*sp.encode(r.text), 2] for r in spark.read.parquet(f"{folder}/documents.parquet").collect() if r.text and sp.encode(r.text)}
    found, segments = {}, []
    for r in QUERIES["op10_packing"](spark, folder).collect():
        ids, places = (np.frombuffer(x, "<u2").tolist() for x in (r.input_ids, r.position_ids))
        assert len(ids) == len(places) == 2048 and ids[r.n_tokens :] == [0] * (2048 - r.n_tokens)
        for a, b, doc, start in zip(r.cu_seqlens[:-1], r.cu_seqlens[1:], r.doc_ids, r.starts, strict=True):
            found.setdefault(doc, {})[start] = ids[a:b]
            assert places[a:b] == list(range(b - a))
            segments.append(b - a)
    assert {d: [t for s in sorted(x) for t in x[s]] for d, x in found.items()} == expected
    rooms = []  # best fit decreasing, by looking at every row
    for n in sorted(segments, reverse=True):
        fits = [i for i, room in enumerate(rooms) if room >= n]
        if fits:
            rooms[min(fits, key=lambda i: rooms[i])] -= n
        else:
            rooms.append(2048 - n)
    assert len(rooms) == QUERIES["op10_packing"](spark, folder).count()


def test_a_large_vocabulary_is_segmented_once(monkeypatch):
    """More words than a cache with dropout holds: without dropout none is segmented a second time."""
    e, found = pieces.Encoder(), []
    texts = [" ".join(f"w{i}" for i in range(at, at + 50_000)) for at in range(0, 250_000, 50_000)]
    first = e.ids(texts, [0] * len(texts))
    monkeypatch.setattr(e.pieces, "encode_chunks", lambda chunks, **_: found.extend(chunks) or [b""] * len(chunks))
    assert e.ids(texts, [0] * len(texts)) == first
    assert not found
