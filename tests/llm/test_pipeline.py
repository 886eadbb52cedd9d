"""The pipeline's stages one by one and together, against plain versions and on awkward tables."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from aquilith.llm.language import identify, train
from aquilith.llm.mixing import mix
from aquilith.llm.pieces import decode_docs

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def awkward(documents):
    rng = random.Random(3)
    prose = lambda n: " ".join(rng.choice(["the", "of", "and", "house", "river", "they", "was", "old", "with", "water"]) + rng.choice(["", "s", "ly"]) for _ in range(n))
    base = prose(120)
    rows = [(i, prose(60) + f"\nthis footer line is shared by many texts here\n{prose(5)}", "en", "ab"[i % 2]) for i in range(12)]
    rows += [(100, base, "en", "a"), (101, base + " end", "en", "b"), (102, base, "en", None), (102, base, "en", None), (None, base, "en", "a")]
    rows += [(200, None, None, None), (201, "", "en", "a"), (202, "12 34 !", "en", "a"), (203, "le chat noir est dans la maison de la vieille dame " * 8, "fr", "b"), (204, prose(30_000), "en", "b")]
    rows += [(300 + i, "der alte mann und das meer ist ein buch von dem haus " * (i + 2), "de", "c") for i in range(4)]
    return documents(rows)


def test_stages_on_awkward_rows(spark, documents):
    docs = awkward(documents)
    for k, name in enumerate(["_row", "key", "id", "row", "bucket", "items", "dropped"]):
        docs = docs.withColumn(name, F.lit(k))
    columns, model = docs.columns, train(docs)
    told = corpus_pipeline.language(spark, docs, "")
    assert told.columns == columns
    told = spark.createDataFrame(told.collect(), docs.schema)
    langs = {r.doc_id: r.lang_pred for r in identify(docs, model).collect()}
    assert {r.doc_id for r in told.collect()}.isdisjoint({200, 201, 202}) and all(langs[r.doc_id] != "und" for r in told.collect())

    less = corpus_pipeline.lines(spark, told, "")
    assert less.columns == columns and less.count() == told.count()
    less = spark.createDataFrame(less.collect(), docs.schema)
    assert sum("this footer line" in r.text for r in less.collect()) == 1

    one = corpus_pipeline.near_copies(spark, less, "")
    assert one.columns == columns
    one = spark.createDataFrame(one.collect(), docs.schema)
    ids = [r.doc_id for r in one.collect()]
    assert len(ids) == len(set(ids)) and 100 in ids and not {101, 102} & set(ids) and {r.doc_id for r in less.collect()} >= set(ids)

    taken = corpus_pipeline.weights(spark, one, "")
    assert taken.columns == columns
    taken = spark.createDataFrame(taken.collect(), taken.schema)
    words = {r.doc_id: r.taken for r in mix(one).collect()}
    got = {}
    for r in taken.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
    assert got == {i: n for i, n in words.items() if n}

    out = corpus_pipeline.encode(spark, taken, "")
    back = sorted((str(r.doc_id), r.text) for r in decode_docs(out).collect())
    assert back == sorted((str(r.doc_id), r.text) for r in taken.collect()) and out.filter("not lossless").count() == 0


def test_empty_table(spark, documents):
    docs = awkward(documents).limit(0)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.count() == 0 and docs.columns[:5] == COLUMNS
    assert corpus_pipeline.encode(spark, docs, "").count() == 0


def test_run_equals_its_stages_and_cleans_up(spark):
    import os

    from aquilith.llm.common import shared_folder

    root = shared_folder(spark).removeprefix("file://")
    before = set(os.listdir(root))
    got = sorted((str(r.doc_id), r.tokens) for r in corpus_pipeline.run(spark, SF).select("doc_id", "tokens").collect())
    held = {d: len(os.listdir(f"{root}/{d}")) for d in set(os.listdir(root)) - before}
    assert [n for d, n in held.items() if "pipeline" in d] == [1] and max(held.values()) <= 5
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema).coalesce(1)  # copies stay behind each other
    again = sorted((str(r.doc_id), r.tokens) for r in corpus_pipeline.encode(spark, docs, SF).select("doc_id", "tokens").collect())
    assert got == again and len(got) > 100


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_docstrings_state_the_cases(name):
    text = dict(corpus_pipeline.STAGES)[name].__doc__.lower()
    assert "null" in text and "repeated" in text
