import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aquilith.llm.pieces import MODEL, Encoder, decode_docs, encode_docs, slices

SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)
PLAIN, DROP, ALL = Encoder(), Encoder(seed=3, dropout=0.3, variants=3), Encoder(seed=3, dropout=1.0)


def ids(e, text, variant=0):
    import numpy as np

    return np.frombuffer(e.ids([text], [variant])[0], "<u2").tolist()


TEXTS = ["Hello  world\n\tfoo bar", " a", "été où — naïve 日本語 🙂", "x" * 100 + " the" * 50, "   \n  ", "The quick brown fox's 3.14 jumps"]


@pytest.mark.parametrize("text", TEXTS)
def test_without_dropout_equals_the_library(text):
    assert ids(PLAIN, text) == SP.encode(text)


def test_corpus_texts_equal_the_library(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()
    texts = [r.text for r in rows]
    assert [len(x) // 2 for x in PLAIN.ids(texts, [0] * len(texts))] == [len(x) for x in SP.encode(texts)]
    for t in texts[:60]:
        assert ids(PLAIN, t) == SP.encode(t)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=80), st.integers(0, 2))
def test_dropout_is_lossless(text, variant):
    for e in (PLAIN, DROP):
        assert e.decode(e.ids([text], [variant % e.variants])[0]) == text


def plain_dropout(e, chunk, key, p):
    """The agenda over one chunk, symbol by symbol."""
    import numpy as np

    v, n = e.pieces, len(chunk)
    sym = [[int(v.of_char[ord(c)]), i] for i, c in enumerate(chunk)]
    codes = np.array([ord(c) for c in chunk], np.uint32)
    salt = v._salts(codes, np.arange(n), np.array([0]), np.array([n]), key)
    while True:
        best = None
        for j in range(len(sym) - 1):
            (a, i), (b, _) = sym[j], sym[j + 1]
            m = v.pairs.get(a << 16 | b) if a >= 0 and b >= 0 else None
            if m is None or int(v._draw(salt, np.array([i]), np.array([a]), np.array([m]))[0]) < int(p * 2**64):
                continue
            best = min(best or (1 << 60, 0, 0), (int(v.rank[m]), j, m))
        if best is None:
            return [s for s, _ in sym]
        sym[best[1]][0] = best[2]
        del sym[best[1] + 1]


def test_dropout_equals_the_plain_agenda_in_rounds_and_heap():
    import numpy as np

    for chunk in [" international", " the", " understandings", "abc", " " + "banana" * 15]:
        (got,) = DROP.pieces.encode_chunks([chunk], 99, 0.3)
        assert np.frombuffer(got, "<u2").tolist() == plain_dropout(DROP, chunk, 99, 0.3)


def test_seeds_and_variants_vary_and_repeat():
    text = "understanding international organisations " * 5
    assert ids(DROP, text) == ids(Encoder(seed=3, dropout=0.3, variants=3), text)
    assert len({tuple(ids(DROP, text, v)) for v in range(3)} | {tuple(ids(Encoder(seed=4, dropout=0.3), text))}) == 4
    assert len(ids(ALL, text)) == len(text) + 1


def test_slices_join_and_cut_at_chunks():
    text = " " + "ab  cd\n" * 500
    parts = list(slices(text, 100))
    assert "".join(parts) == text and len(parts) > 10
    assert all(p[0] == " " and q[-1] != " " for p, q in zip(parts[1:], parts[:-1], strict=True))


def test_rows_nulls_and_empty_tables(documents):
    docs = documents([(1, None), (2, ""), (None, "null id"), (3, "same row"), (3, "same row"), (4, "long " * 300_000)])
    docs = docs.withColumn("tokens", F.lit("x")).withColumn("id", F.lit(1))
    got = encode_docs(docs).collect()
    by = {(r.doc_id, r.n_tokens): r for r in got}
    assert len(got) == 6 and by[1, 0].lossless is None and by[2, 0].lossless
    assert all(r.lossless for r in got if r.doc_id != 1)
    back = {(r.doc_id, r.text) for r in decode_docs(encode_docs(docs)).collect()}
    assert back == {(r.doc_id, r.text or "") for r in docs.collect()}
    assert encode_docs(docs.limit(0)).count() == 0


def test_every_occurrence_is_drawn_by_itself():
    text = ("understanding international organisations " * 400)[:-1]
    words = DROP.ids([text], [7])
    cuts = {}
    for w in b"".join(DROP.pieces.text[i] + b"|" for i in ids(DROP, text, 7)).split(b" ")[1:]:
        cuts.setdefault(w.replace(b"|", b""), set()).add(w)
    assert all(len(c) > 5 for c in cuts.values()) and len(cuts) == 3
    assert DROP.ids([text], [7]) == words == Encoder(seed=3, dropout=0.3).ids(["x", text], [7, 7])[1:]


def test_occurrences_equal_the_plain_agenda():
    import numpy as np

    from aquilith.llm.common import mix64
    from aquilith.llm.pieces import _CHUNK

    text = "the international banana understandings and the " + "banana" * 15 + " 日本"
    for draw in range(20):
        got = DROP.ids([text], [draw])[0]
        expected = b""
        for n, c in enumerate(_CHUNK.findall(" " + text)):
            key = int(mix64(np.array([n], np.uint64) + np.uint64(DROP._key(draw)), 74)[0])
            expected += DROP.pieces.encode_chunks([c], key, 0.3)[0]
            if c.isascii():
                assert expected.endswith(np.array(plain_dropout(DROP, c, key, 0.3), "<u2").tobytes())
        assert got == expected


def test_copies_of_a_document_differ(documents):
    text = "understanding international organisations " * 20
    one = documents([(1, text)])
    docs = one.crossJoin(one.sparkSession.range(1, 4).withColumnRenamed("id", "copy"))
    got = encode_docs(docs, copy_col="copy").collect()
    assert len({tuple(r.tokens) for r in got}) == 3 and all(r.lossless for r in got)
    assert len({tuple(r.tokens) for r in encode_docs(docs).collect()}) == 1


def test_runs_of_equal_rows_are_cut_differently(spark, documents):
    text = "understanding international organisations " * 20
    docs = documents([(1, text), (1, text), (1, text), (2, text), (1, text)]).coalesce(1)
    got = encode_docs(docs, number_runs=True).collect()
    tokens = [tuple(r.tokens) for r in got]
    assert len(set(tokens[:3])) == 3 and tokens[4] == tokens[0] and all(r.lossless for r in got)
    assert [tuple(r.tokens) for r in encode_docs(docs, number_runs=True).collect()] == tokens


def test_decoding_replaces_a_column_of_that_name(spark):
    docs = spark.createDataFrame([(1, "ab c"), (2, None), (3, "")], "doc_id long, text string")
    encoded = encode_docs(docs).withColumn("text", F.lit("own"))
    assert {r.doc_id: r.text for r in decode_docs(encoded).collect()} == {1: "ab c", 2: "", 3: ""}
    both = decode_docs(encoded, text_col="decoded")
    assert {(r.text, r.decoded) for r in both.collect()} == {("own", "ab c"), ("own", "")}
