"""Line dedup by a fixed-depth template tree.

A line is parsed down a tree of fixed depth: its number of tokens, then its
``lead`` leading tokens, where a token with a digit is a variable field and
reads ``<*>``. At a leaf the other positions are dealt to ``fields`` residue
classes; a template keeps the tokens of all classes but one, whose positions
read ``<*>``, so at least (fields - 1)/fields of the trailing tokens are
constant and fields may vary in any one class. A line therefore has up to
``fields`` templates and no template needs a look at another line: recurrence
is a plain count, whatever the size of a leaf.

A template met in ``min_docs`` or more different texts recurs; with ``long_tokens``,
one that keeps as many tokens without a digit recurs from ``long_docs`` on, as long
passages are not met twice by chance. A line with a
recurring template is dropped from all documents but the template's first, the
least id (nulls last), or from that one too with ``keep_first=False``. Texts
are counted once however many copies they have, so copies of whole documents
are no templates.
"""

from __future__ import annotations

import re

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HOT_SHARE, Workspace, batches_of, binary_values, row_key, lean, small, spread_join

_FIELD = re.compile(rb"[^ \t-\r]*[0-9][^ \t-\r]*")


def templates(line: bytes, lead: int, fields: int, min_tokens: int, long_tokens: int | None = None) -> list[int]:
    """The line's template ids, as signed 64-bit numbers; none if it is short.

    With ``long_tokens``, the lowest bit says whether the template keeps as many tokens without a digit.
    """
    tokens = _FIELD.sub(b"<*>", line).split()
    n = len(tokens)
    if n < min_tokens:
        return []
    top = b"%d " % n + b" ".join(tokens[:lead])
    rest = [b" ".join(tokens[lead + i :: fields]) for i in range(fields)]
    out = []
    for i in range(fields):
        if i and n <= lead + i:
            break  # an empty class: the same template as the whole line, unless it is the only one
        kept, words = b"\n".join(r for j, r in enumerate(rest) if j != i), n - len(range(lead + i, n, fields))
        if n - lead <= fields:  # too few tokens to leave any out
            kept, i, words = b"\n".join(rest), fields, n
        written = b"%s\n%d\n%s" % (top, i, kept)
        out.append(xxhash.xxh64_intdigest(written) - (1 << 63))
        if long_tokens is not None:
            out[-1] = out[-1] & ~1 | (words - written.count(b"<*>") >= long_tokens)
        if i == fields:
            break
    return out


def _lines(lead: int, fields: int, min_tokens: int, long_tokens: int | None):
    @lean()
    def run(batches):
        for b in small(batches, 2, 8_000_000):
            texts = binary_values(b.column(2))
            for span in batches_of(texts, 8_000_000):
                row, at, ids = [], [], []
                for i in span:
                    for n, line in enumerate(texts[i].split(b"\n") if texts[i] else ()):
                        got = templates(line, lead, fields, min_tokens, long_tokens)
                        row += [i] * len(got)
                        at += [n] * len(got)
                        ids += got
                take = pa.array(row, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), b.column(0).take(take), b.column(1).take(take), b.column(3).take(take), pa.array(at, pa.int32())],
                    ["template", "id", "key", "content", "line"],
                )

    return run


def _cut(text: bytes | None, gone: list[int] | None) -> bytes | None:
    if text is None or not gone:
        return text
    gone = set(gone)
    return b"\n".join(x for n, x in enumerate(text.split(b"\n")) if n not in gone)


def _without(text_at: int, names: list[str]):
    """The first columns under their ``names``, the text without the lines that the column behind them lists."""
    columns = len(names)

    @lean()
    def run(batches):
        for b in small(batches, text_at):
            texts = [_cut(t, d) for t, d in zip(binary_values(b.column(text_at)), b.column(columns).to_pylist(), strict=True)]
            arrays = [b.column(i) for i in range(columns)]
            arrays[text_at] = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(arrays, names)

    return run


def recurring_lines(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    lead: int = 2,
    fields: int = 3,
    min_tokens: int = 3,
    min_docs: int = 5,
    long_tokens: int | None = None,
    long_docs: int = 2,
    keep_first: bool = True,
) -> DataFrame:
    """(_id, _key, _dropped): by document, the line numbers that its recurring templates drop."""
    narrow = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        row_key(id_col, text_col).alias("key"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("content"),
    )
    id_type = narrow.schema["id"].dataType.simpleString()
    work = Workspace(docs.sparkSession, "templates")
    lines = work.put(narrow.mapInArrow(_lines(lead, fields, min_tokens, long_tokens), f"template long, id {id_type}, key long, content long, line int"))
    need = F.lit(min_docs) if long_tokens is None else F.when(F.col("template").bitwiseAND(1) == 1, long_docs).otherwise(min_docs)
    # by (template, content) first: a hot template is spread over its texts
    first = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "key"))
    hot = F.col("rows") > lines.count() / HOT_SHARE
    counted = (
        lines.groupBy("template", "content")
        .agg(first.alias("first"), F.count("*").alias("rows"))
        .groupBy("template")
        .agg(F.count("*").alias("texts"), F.min("first").alias("first"), F.sum("rows").alias("rows"))
        .select("template", "first", (F.col("texts") >= need).alias("recurs"), hot.alias("hot"))
    )
    counted = work.put(counted.filter("recurs or hot"))
    hit = spread_join(lines.select("template", "id", "key", "line"), counted.filter("recurs").select("template", "first"), "template", counted.filter("hot").select("template"))
    if keep_first:
        hit = hit.filter(~(F.col("id").eqNullSafe(F.col("first.id")) & (F.col("key") == F.col("first.key"))))
    out = work.put(hit.groupBy("id", "key").agg(F.collect_set("line").alias("dropped")).select(F.col("id").alias("_id"), F.col("key").alias("_key"), F.col("dropped").alias("_dropped")))
    work.only(out)
    return out


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, text, n_lines, n_dropped) for every row of ``docs``.

    Lines are what ``\\n`` separates; a text that loses all of them is empty. A
    null text stays null with 0 lines. Lines of under ``min_tokens`` tokens
    never drop. Equal rows get equal results; ties of the least id go by row key.
    Texts are read whole, however long. Other columns are ignored, whatever their
    names; an empty table gives an empty one.
    """
    dropped = recurring_lines(docs, id_col=id_col, text_col=text_col, **how)
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), row_key(id_col, text_col).alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    joined = narrow.join(dropped, narrow.id.eqNullSafe(dropped["_id"]) & (narrow.key == dropped["_key"]), "left").select("id", "key", "text", F.col("_dropped").alias("dropped"))
    n_lines = F.when(F.col("text").isNull(), 0).otherwise(F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1)
    counted = joined.select("id", n_lines.cast("long").alias("n_lines"), F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), "text", "dropped")
    cut = counted.mapInArrow(_without(3, ["id", "n_lines", "n_dropped", "text"]), f"id {id_type}, n_lines long, n_dropped long, text string")
    return cut.select(F.col("id").alias(id_col), F.col("text").alias(text_col), "n_lines", "n_dropped")


def drop_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with all columns, whatever their names, the text without recurring lines.

    No row goes: a text that loses all its lines is empty, a null text stays
    null, repeated rows come back repeated, an empty table stays empty. Whole
    texts are read, however long.
    """
    dropped = recurring_lines(docs, id_col=id_col, text_col=text_col, **how)
    columns = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    keyed = docs.select(*columns, row_key(id_col, text_col).alias("_row"))
    same = keyed[f"c{docs.columns.index(id_col)}"].eqNullSafe(dropped["_id"]) & (keyed["_row"] == dropped["_key"])
    joined = keyed.join(dropped, same, "left").select(*(f"c{i}" for i in range(len(columns))), "_dropped")
    return joined.mapInArrow(_without(docs.columns.index(text_col), docs.columns), docs.schema)
