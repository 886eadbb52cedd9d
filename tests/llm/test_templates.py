import random
from collections import defaultdict

from pyspark.sql import functions as F

from aquilith.llm.templates import dedup_lines, drop_lines, templates


def brute(rows, min_docs):
    """Templates written out as token tuples and counted in a dictionary."""
    def written(line):
        w = ["<*>" if any(c in "0123456789" for c in x) else x for x in line.encode().decode().split()]
        if len(w) < 3:
            return set()
        if len(w) - 2 <= 3:
            return {(None, *w)}
        return {(c, *(("*",) if i >= 2 and (i - 2) % 3 == c else (x,) for i, x in enumerate(w))) for c in range(3)}

    texts, first = defaultdict(set), {}
    for i, t in sorted(rows):
        for line in t.split("\n"):
            for k in written(line):
                texts[k].add(t)
                first.setdefault(k, i)
    out = {}
    for i, t in rows:
        keep = [x for x in t.split("\n") if not any(len(texts[k]) >= min_docs and first[k] != i for k in written(x))]
        out[i] = ("\n".join(keep), len(t.split("\n")) - len(keep))
    return out


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: rng.choice("klmnop") + rng.choice("aeiou") * rng.randrange(1, 4)
    rows = []
    for i in range(150):
        lines = [" ".join(word() for _ in range(rng.randrange(0, 12))) for _ in range(rng.randrange(1, 6))]
        if rng.random() < 0.4:
            lines.insert(0, f"Posted on 20{i:02d}-01-02 by {word()} in the main room")
        if rng.random() < 0.3:
            lines.append("All rights reserved.")
        rows.append((i * 37 % 151, "\n".join(lines)))
    return rows + [(1000 + i, rows[3][1]) for i in range(20)]


def test_equals_brute_force(documents):
    rows = corpus(9)
    docs = documents(rows).repartition(6)
    expected = brute(rows, 5)
    assert {r.doc_id: (r.text, r.n_dropped) for r in dedup_lines(docs).collect()} == expected
    assert {r.doc_id: r.text for r in drop_lines(docs).collect()} == {i: t for i, (t, _) in expected.items()}
    assert sum(n for _, n in expected.values()) > 60


def test_variable_fields_share_a_template():
    same = lambda a, b: set(templates(a, 2, 3, 3)) & set(templates(b, 2, 3, 3))
    assert same(b"Page 3 of 17", b"Page 9 of 20")
    assert same(b"logged in as anna from the north gate", b"logged in as berta from the north gate")
    assert not same(b"logged in as anna from the north gate", b"logged in as berta from the south gate now")
    assert templates(b"too short", 2, 3, 3) == []


def test_nulls_repeats_empty_and_clashes(spark, documents):
    line = "a line that many share"
    docs = documents([(i, f"{line}\nown text number {'x' * i} here now") for i in range(6)] + [(0, f"{line}\nown text number  here now"), (9, None), (10, ""), (None, line)])
    docs = docs.withColumn("line", F.lit("x")).withColumn("template", F.lit(2)).withColumn("key", F.lit(3))
    got = {(r.doc_id, r.text) for r in drop_lines(docs).collect()}
    assert (9, None) in got and (10, "") in got and (None, "") in got
    assert sum(line in (t or "") for _, t in got) == 1
    assert drop_lines(docs).count() == docs.count() and drop_lines(docs).columns == docs.columns
    assert drop_lines(docs.limit(0)).count() == 0
    none = drop_lines(docs, keep_first=False).collect()
    assert not any(line in (r.text or "") for r in none)


def test_long_line(documents):
    text = " ".join(f"w{'x' * (i % 50)}" for i in range(50_000))
    rows = [(i, f"{text}\n{'z' * i}") for i in range(6)]
    assert sorted(r.n_dropped for r in dedup_lines(documents(rows)).collect()) == [0, 1, 1, 1, 1, 1]


def test_long_lines_recur_from_the_second_text(spark, documents):
    import corpus_pipeline

    passage = " ".join(f"word{'abcdefghijklmnop'[i]}" for i in range(14))
    other = passage.replace("wordd", "name")  # in one class of fields
    rows = [(1, f"{passage}\nown a b"), (2, f"own c d\n{other}"), (3, "a short line\nown e f"), (4, "a short line\nown g h")]
    rows += [(5, "row 1 2 3 4 5 6 7 8 9 10 11 12 13"), (6, "row 2 3 4 5 6 7 8 9 10 11 12 13 14")]
    docs = documents(rows)
    got = {r.doc_id: r.text for r in corpus_pipeline.lines(spark, docs, "").collect()}
    assert got == {**dict(rows), 2: "own c d"}
    assert {r.doc_id: r.text for r in drop_lines(docs).collect()} == dict(rows)


def test_long_and_short_templates_equal_brute_force(documents):
    rows = corpus(4)
    rows += [(2000 + i, f"{t}\nextra {i} own") for i, t in rows[:6] for _ in range(1)]
    docs = documents(rows).repartition(5)
    every = {r.doc_id: r.n_dropped for r in dedup_lines(docs, long_tokens=0).collect()}
    assert every == {i: n for i, (_, n) in brute(rows, 2).items()}
    some = {r.doc_id: r.n_dropped for r in dedup_lines(docs, long_tokens=8).collect()}
    none = {r.doc_id: r.n_dropped for r in dedup_lines(docs).collect()}
    assert all(none[i] <= some[i] <= every[i] for i in every) and sum(none.values()) < sum(some.values()) < sum(every.values())


def test_clashing_names_survive(documents):
    line = "a line that many share"
    docs = documents([(i, f"{line}\n{'x' * i}") for i in range(6)])
    names = ["_row", "_dropped", "_id", "_key", "c1", "first", "content"]
    for k, c in enumerate(names):
        docs = docs.withColumn(c, F.lit(f"own {k}"))
    got = drop_lines(docs)
    assert got.columns == docs.columns and sum(line in r.text for r in got.collect()) == 1
    assert [tuple(r) for r in got.select(*names).distinct().collect()] == [tuple(f"own {k}" for k in range(len(names)))]


def test_a_hot_template_and_a_hot_text(documents):
    """A third of all rows share one line, another third are copies of one text."""
    rows = [(i, f"the line that a third share\nown {'x' * (i % 60)} {'y' * (i // 60)} words stand") for i in range(700)]
    rows += [(1000 + i, "a text that is copied\nwith these two lines") for i in range(700)] + [(2000 + i, f"row {'p' * (i % 60)} {'q' * (i // 60)} alone") for i in range(700)]
    got = {r.doc_id: (r.text, r.n_dropped) for r in dedup_lines(documents(rows).repartition(5)).collect()}
    assert got == {i: v for i, v in brute(rows, 5).items()}
