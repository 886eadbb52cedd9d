import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from aquilith.llm.spans import dedup_spans, sentences


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab .!?\n\té", max_size=60))
def test_sentences_join_to_the_text(text):
    assert b"".join(sentences(text.encode())) == text.encode()


def test_sentence_ends():
    assert sentences(b"One two. Three 3.5 four! Five\nSix?") == [b"One two. ", b"Three 3.5 four! ", b"Five\n", b"Six?"]


def brute(rows, span, span_words, min_words):
    """First occurrences by a plain dictionary over all runs in order."""
    seen, out = set(), {}
    for i, t in sorted(rows):
        parts = [p.decode() for p in sentences(t.encode())]
        full = [j for j, p in enumerate(parts) if p.split()]
        dead = set()
        for a in range(len(full)):
            words, stop = [], None
            for b in range(a, min(a + span, len(full))):
                words += parts[full[b]].split()
                if len(words) >= span_words or b == a + span - 1:
                    stop = b
                    break
            if stop is None or len(words) < min_words:
                continue
            if tuple(words) in seen:
                dead.update(range(full[a], full[stop] + 1))
            seen.add(tuple(words))
        out[i] = ("".join(p for j, p in enumerate(parts) if j not in dead), len(dead & set(full)))
    return out


def corpus(seed):
    rng = random.Random(seed)
    def sentence():
        return " ".join(rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.choice([1, 4, 9, 15]))) + rng.choice([". ", "! ", ".\n", "\n"])
    passages = ["".join(sentence() for _ in range(6)) for _ in range(4)] + [" ".join(f"long{i}" for i in range(60)) + ". "]
    rows = []
    for i in range(60):
        parts = [sentence() for _ in range(rng.randrange(0, 8))]
        for _ in range(rng.randrange(0, 3)):
            parts.insert(rng.randrange(len(parts) + 1), rng.choice(passages))
        rows.append((i * 7 % 61, "".join(parts)))
    return rows


def test_equals_brute_force(documents):
    rows = corpus(5)
    got = {r.doc_id: (r.text, r.n_removed) for r in dedup_spans(documents(rows).repartition(5)).collect()}
    assert got == brute(rows, 3, 40, 10)
    assert sum(n for _, n in got.values()) > 20


def test_nulls_repeats_ties_and_clashes(documents):
    text = "One two three four five. Six seven eight nine ten. Eleven twelve thirteen fourteen fifteen. "
    docs = documents([(1, text), (1, text), (2, text + "Own end."), (None, text), (3, None), (4, ""), (5, " \n ")])
    docs = docs.withColumn("key", F.lit("x")).withColumn("dropped", F.lit(1)).withColumn("hash", F.lit(2))
    got = sorted(((str(r.doc_id), r.text, r.n_removed) for r in dedup_spans(docs).collect()), key=str)
    assert got == sorted([("1", text, 0), ("1", text, 0), ("2", "Own end.", 3), ("None", "", 3), ("3", None, 0), ("4", "", 0), ("5", " \n ", 0)], key=str)
    assert dedup_spans(docs.limit(0)).count() == 0


def test_repeats_inside_one_long_document(documents):
    block = "".join(f"s{i} is a sentence of seven words. " for i in range(2000))
    (row,) = dedup_spans(documents([(1, block + block)])).collect()
    assert row.text == block and row.n_removed == 2000
