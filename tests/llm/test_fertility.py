from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aquilith.llm.fertility import FOLDER, main_script, measure, quality, vocabularies

SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    out, word = [], ""
    for c in text + " ":
        if c in SPACE:
            out, word = (out + [word] if word else out), ""
        else:
            word += c
    return out


def base(text):
    w = words_of(text)
    windows = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines, dup = [], 0
    for x in text.split("\n"):
        dup += bool(words_of(x)) and x in lines
        lines.append(x)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, len(hit), len(w) < 50 or 100 * len(hit) > 50 * len(w)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é#|\n\t\x0b\x1c\xa0 日", max_size=120))
def test_base_equals_brute_force(text):
    got = measure(text.encode(), vocabularies(FOLDER))
    assert got[:6] == base(text)
    assert not (got[5] and got[6])


def test_measures_equal_the_libraries():
    import sentencepiece

    v = vocabularies(FOLDER)
    text = "the quick brown fox jumps over the lazy dog — naïve 日本 🙂ꙮ " * 8
    got = measure(text.encode(), v)
    ids = v.bytes.encode_ordinary(text)
    share = np.array(list(Counter(ids).values())) / len(ids)
    assert got[8] == pytest.approx(got[1] / len(ids))
    assert got[10] == pytest.approx(-(share * np.log2(share)).sum())
    sp = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    assert got[9] == pytest.approx(sum(map(sp.is_byte, sp.encode(text))) / sum(len(w.encode()) for w in words_of(text)))
    assert got[9] > 0


def test_scripts():
    texts = ("abc é 1", "привет мир", "日本語", "123 !", "αβγ", "שלום", "")
    assert [main_script(np.array([ord(c) for c in t], np.uint32)) for t in texts] == ["latin", "cyrillic", "cjk", "none", "greek", "other", "none"]


def test_verdicts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    kept = quality(rows).join(rows.select("doc_id", "text"), "doc_id").collect()
    prose = [r for r in kept if not r.base_failed and r.n_symbols < 5]
    assert np.mean([r.kept for r in prose]) > 0.98
    v = vocabularies(FOLDER)
    import random
    rng = random.Random(1)
    junk = " ".join("".join(chr(rng.randrange(0x1F300, 0x1F5FF)) for _ in range(6)) + "x" for _ in range(80))
    assert not measure(junk.encode(), v)[6]
    assert not measure(" ".join("".join(rng.choice("0123456789abcdefXZQ+/") for _ in range(40)) for _ in range(80)).encode(), v)[6]


def test_nulls_repeats_and_empty_tables(documents):
    docs = documents([(1, None), (2, ""), (None, "a b c"), (3, "x y"), (3, "x y"), (4, "word " * 300_000)])
    docs = docs.withColumn("n_words", F.lit("x")).withColumn("kept", F.lit(1))
    got = sorted((str(r.doc_id), r.n_words, r.base_failed, r.kept) for r in quality(docs).collect())
    assert got == [("1", 0, True, False), ("2", 0, True, False), ("3", 2, True, False), ("3", 2, True, False), ("4", 300_000, True, False), ("None", 3, True, False)]
    assert quality(docs.limit(0)).count() == 0


@pytest.mark.parametrize("around", [("", ""), ("x", ""), ("", "x"), ("a b", " c"), ("'s", "'s 1"), ("#", "#"), ("é\u3000", "\x1cz")])
@pytest.mark.parametrize("unit", ["\n", " ", " \t", "\u2003\r\n", "\xa0"])
def test_long_runs_equal_the_library(around, unit):
    v = vocabularies(FOLDER)
    for n in (4095, 4096, 9000):
        text = f"some words {around[0]}{unit * n}{around[1]} and {unit * 5000}{around[1]}"
        assert np.concatenate(v.tokens(text)).tolist() == v.bytes.encode_ordinary(text)


@pytest.mark.parametrize("unit", ["\n", " ", " \t", "a", "é", "#", "1 "])
def test_ten_megabytes_give_a_row(unit):
    text = "the first words " * 20 + unit * (10_000_000 // len(unit.encode()))
    got = measure(text.encode(), vocabularies(FOLDER))
    assert got[0] >= 60 and got[8] > 0


def test_a_dirty_document_does_not_stop_the_others(documents):
    docs = documents([(1, "\n" * 1_500_000), (2, " \t" * 900_000 + "x"), (3, "plain words " * 40)])
    assert {(r.doc_id, r.n_words) for r in quality(docs).collect()} == {(1, 0), (2, 1), (3, 80)}


def test_verdict_equals_brute_force(spark):
    """Every column of the whole query, measured with the vocabularies' own libraries and the bands as stated."""
    import sentencepiece

    from aquilith.llm.fertility import BANDS
    from aquilith.llm.queries import QUERIES

    v = vocabularies(FOLDER)
    sp = sentencepiece.SentencePieceProcessor(model_file=f"{FOLDER}/piece_bpe_32k.model")
    folder, kept = "/root/testdata/sf0.01", Counter()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in QUERIES["op1_tokeniser_fertility"](spark, folder).collect():
        text = texts[r.doc_id] or ""
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(text)
        words = words_of(text)
        ids = v.bytes.encode_ordinary(text)
        n = len(ids) or 1
        entropy = -sum(c / n * np.log2(c / n) for c in Counter(ids).values())
        fertility = sum(map(len, words)) / n
        missed = sum(len(c.encode()) for w in words for c in w if sp.piece_to_id(c) == sp.unk_id())
        fallback = missed / max(1, sum(len(w.encode()) for w in words))
        band = BANDS[r.script]
        fits = band.chars_per_token[0] <= fertility <= band.chars_per_token[1] and fallback <= band.most_fallback and entropy >= band.least_entropy
        assert r.kept == (bool(words) and fits and not r.base_failed)
        assert (r.chars_per_token, r.fallback_share, r.token_entropy) == pytest.approx((fertility, fallback, entropy) if words else (0, 0, 0), abs=1e-9)
        kept[r.kept] += 1
    assert kept[True] > 500 and kept[False] > 50




def test_many_white_space_runs_take_time_in_proportion():
    import time

    v, runs = vocabularies(FOLDER), lambda n: ("w" + "\n" * n) * (800_000 // n)
    v.tokens("warm up")
    took = []
    for n in (100, 4000):
        began = time.process_time()
        v.tokens(runs(n))
        took.append(time.process_time() - began)
    assert took[1] < 5 * took[0] + 0.5
