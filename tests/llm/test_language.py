import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from aquilith.llm.language import features, fit, identify, keep_identified, train

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def real(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


@pytest.fixture(scope="module")
def model(real):
    return train(real)


def test_held_out_accuracy(real, model):
    got = identify(real, model).join(real.select("doc_id", "lang", "text"), "doc_id").collect()
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in got if zlib.crc32(str(r.doc_id).encode()) % 3 == 1}
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def test_kernel_equals_brute_force():
    texts = ["the cat sat", "le chat noir", "THE CAT", "der Hund", "x"]
    grams = [{t.lower()[i : i + n] for n in range(1, 5) for i in range(len(t) - n + 1)} for t in texts]
    sets = [set(features(t, 1 << 22, 4)) for t in texts]
    for i in range(5):
        for j in range(5):
            assert len(sets[i] & sets[j]) == len(grams[i] & grams[j])


def test_nystrom_with_all_landmarks_is_kernel_ridge_regression():
    texts, labels = ["abab cdcd", "xyzx yzzy", "abba dcdc", "zyxz xxyy", "acac bdbd", "zzyx xyzy"], ["p", "q"] * 3
    m = fit(texts, labels, width=1 << 14, longest=3, landmarks=6, ridge=0.1)
    x = np.zeros((6, 1 << 14))
    for i, t in enumerate(texts):
        x[i, features(t, 1 << 14, 3)] = 1
    x /= np.linalg.norm(x, axis=1)[:, None]
    k, y = x @ x.T, np.array([1.0, -1.0] * 3)
    # ridge regression with a free intercept, in its dual form
    a = np.linalg.solve(np.block([[k + 0.1 * np.eye(6), np.ones((6, 1))], [np.ones((1, 6)), np.zeros((1, 1))]]), np.append(y, 0))
    assert np.allclose(m.scores(texts)[:, 0], k @ a[:6] + a[6], atol=1e-3)


def test_nulls_ties_and_empty_tables(documents, model):
    docs = documents([(1, None), (2, "123 !? \n"), (3, ""), (None, "the and of the ing"), (4, "the and of the ing"), (4, "the and of the ing"), (5, "the " * 200_000)])
    docs = docs.withColumn("held_out", F.lit("x")).withColumn("score", F.lit("y"))
    got = {(r.doc_id, r.lang_pred) for r in identify(docs, model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und")} <= got and {(None, "en"), (4, "en"), (5, "en")} <= got
    assert identify(docs, model).count() == 7
    assert identify(docs.limit(0), model).count() == 0 and train(docs.limit(0)) is None
    assert {r.lang_pred for r in identify(docs, None).collect()} == {"und"}
    kept = keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.filter("text is null or doc_id in (2, 3)").count() == 0 and kept.count() >= 3


def test_prediction_ignores_labels(real, model):
    a = {tuple(r) for r in identify(real.limit(50), model).collect()}
    b = {tuple(r) for r in identify(real.limit(50).withColumn("lang", F.lit("zz")).withColumn("source", F.lit(None)), model).collect()}
    assert a == b


def test_long_and_short_texts_are_told_and_kept(spark, documents, real, model):
    held = real.filter("crc32(cast(cast(doc_id as string) as binary)) % 3 = 1 and text is not null").select("lang", "text").orderBy("doc_id").collect()
    rows = []
    for k, lang in enumerate(model.languages):
        own = " ".join(r.text for r in held if r.lang == lang)
        for j, size in enumerate((1_000_000, 5_000_000)):
            rows.append((10 * k + j, (own * (size // len(own) + 1))[:size], lang))
    short = [("the people", "en"), ("that was the", "en"), ("und die der", "de")]
    rows += [(100 + i, t, lang) for i, (t, lang) in enumerate(short)]
    docs = documents(rows)
    got = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    assert {i: lang for i, _, lang in rows} == {i: lang for i, (lang, _) in got.items()}
    assert all(score > 0.8 for i, (_, score) in got.items() if i < 100)
    assert keep_identified(docs, model).count() == len(rows)


def test_score_does_not_fall_with_length(real, model):
    text = max((r.text for r in real.filter("lang = 'de'").select("text").collect()), key=len)
    text = (text * (4000 // len(text) + 1))[:4000]
    assert np.allclose(model.whole_scores([text * 50]), model.whole_scores([text]), atol=0.02)
    assert np.allclose(model.whole_scores([text + "1 2 3 4 " * 50_000])[0], model.whole_scores([text])[0], atol=0.3)
    assert np.allclose(model.whole_scores([text[:3000]]), model.scores([text[:3000]]))


def test_texts_between_two_languages_are_not_kept(documents):
    m = fit(["abab", "xyxy"], ["p", "q"], width=1 << 14, longest=3, landmarks=2, ridge=0.1)
    kept = keep_identified(documents([(1, "abab"), (2, "xyxy"), (3, "abab xyxy"), (4, "ab")]), m)
    assert {r.doc_id for r in kept.collect()} == {1, 2, 4}


def test_what_is_learned_is_bounded(documents):
    """Repeated ids, letterless rows and a thousand labels neither crowd the others out nor grow what is collected."""
    rows = [(3, "the same text of one id", "en")] * 20_000 + [(6 + 3 * i, f"le chat {i} noir", "fr") for i in range(400)] + [(5000 + i, "12 34", "fr") for i in range(400)]
    rows += [(9, f"the hat {i} and the cat", "en") for i in range(300)] + [(100_000 + i, f"wort {i}", f"l{i % 1000}") for i in range(4000)]
    m = train(documents(rows), most_languages=20, per_language=30)
    assert len(m.languages) == 20 and {"en", "fr"} <= set(m.languages)
    assert train(documents([(3, "12", "en"), (6, "the", None)])) is None


def test_sample_is_of_the_stated_size(documents, monkeypatch):
    from aquilith.llm import language

    seen = {}
    monkeypatch.setattr(language, "fit_rows", lambda rows, labels, **_: seen.update(rows=rows, labels=labels))
    rows = [(i, f"some words {i}", "en") for i in range(3000)] + [(9000 + i, "mot " * (i + 1), "fr") for i in range(60)] + [(20_001, "x" * 2_000_000, "de")] * 50
    train(documents(rows).repartition(7))
    count = {x: seen["labels"].count(x) for x in set(seen["labels"])}
    assert 120 <= count["en"] <= 150 and count["de"] <= 1 and 30 <= count["fr"] <= 60
    assert {len(r) for r in seen["rows"]} == {2048}


def test_long_texts_are_learned_whole(documents):
    """Only the second half of every French text is French; one block alone would teach English for half of them."""
    import random

    rng = random.Random(4)
    words = {"en": "the and of to in is that was for on".split(), "fr": "le la les des est que une dans pour sur".split()}
    many = lambda lang, n: " ".join(rng.choices(words[lang], k=n))
    rows = [(i, many("en", 3000), "en") for i in range(0, 90, 2)] + [(i, many("en", 1500) + " " + many("fr", 1500), "fr") for i in range(1, 90, 2)]
    m = train(documents(rows))
    got = {r.doc_id: r.lang_pred for r in identify(documents([(1000, many("fr", 50)), (1001, many("en", 50)), (1002, rows[-1][1])]), m).collect()}
    assert got == {1000: "fr", 1001: "en", 1002: "fr"}


def test_training_equals_fitting_whole_texts(documents):
    """Kernels made by tasks, block by block, against the same means made here."""
    from aquilith.llm import language

    rng = np.random.default_rng(3)
    rows = [(i, " ".join(rng.choice(["abra", "xyz", "kola", "mnop"][i % 2 :: 2], 1200 + 900 * (i % 3))), "pq"[i % 2]) for i in range(40) if zlib.crc32(str(i).encode()) % 3 != 1]
    m = train(documents(rows), landmarks=4)
    text = rows[0][1]
    blocks = list(language.blocks_of(text))
    by_hand = np.mean([language.kernels([b], m.landmarks, m.width, m.longest)[0] for b in blocks], axis=0)
    assert len(blocks) > 1 and np.allclose(language.block_means([text], lambda t: language.kernels(t, m.landmarks, m.width, m.longest), 4)[0], by_hand)
    k = language.block_means([r[1] for r in rows], lambda t: language.kernels(t, m.landmarks, m.width, m.longest), 4)
    y = np.array([1.0 if r[2] == "p" else -1.0 for r in rows])
    # the normal equations hold at the fitted weights: residuals are orthogonal to the intercept
    phi = np.hstack([k, np.ones((len(k), 1))])
    assert abs((phi @ m.weights[:, 0] - y).mean()) < 1e-3


def test_whole_query_equals_scoring_every_text(spark, real):
    """The query's rows against the model's scores of every text, one text at a time."""
    from aquilith.llm.language import has_letter
    from aquilith.llm.queries import QUERIES

    m = train(real)
    texts = {r.doc_id: r.text for r in real.collect()}
    for r in QUERIES["op9_language"](spark, SF).collect():
        text = texts[r.doc_id]
        if not text or not has_letter(text):
            assert (r.lang_pred, r.score) == ("und", 0)
            continue
        s = m.whole_scores([text])[0]
        assert r.lang_pred == m.languages[int(s.argmax())] and r.score == pytest.approx(min(max((s.max() + 1) / 2, 0), 1), abs=1e-4)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
