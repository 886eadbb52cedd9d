"""Sentence-span dedup: removes sentences covered by a repeated run of sentences.

A text is cut into sentences without loss (a sentence ends after ``.``, ``!``
or ``?`` before white space, or at a line end, and keeps the white space behind
it). Every sentence starts one run: ``span`` consecutive sentences, or fewer if
those hold ``span_words`` words already, so that passages of a few long
sentences count too; a run of under ``min_words`` words is none. Runs are hashed over
their words and ranked over the whole corpus by (id, row key, position); every
run but the first of its hash is removed, sentence by sentence.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import binary_values, hash_words, mix64, row_key, slices_of

_END = re.compile(rb"[.!?][ \t-\r]+|\n[ \t-\r]*")


def sentences(text: bytes) -> list[bytes]:
    """Pieces that join to the text again."""
    cuts = [m.end() for m in _END.finditer(text)]
    if not cuts or cuts[-1] < len(text):
        cuts.append(len(text))
    return [text[i:j] for i, j in zip([0, *cuts[:-1]], cuts, strict=True)]


def runs(text: bytes, span: int, span_words: int, min_words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first sentence, sentences covered) of every run of a text."""
    words = [s.split() for s in sentences(text)]
    counts = np.array([len(w) for w in words], np.int64)
    flat = hash_words([w for s in words for w in s])
    ends = np.concatenate([[0], np.cumsum(counts)])
    full = np.flatnonzero(counts)  # sentences of white space only are no part of a run
    if not len(full):
        return np.empty(0, np.uint64), full, full
    at = np.arange(len(full))
    stop = np.minimum(at + span, len(full)) - 1
    # the first sentence by which span_words words are reached
    by_words = np.searchsorted(ends[full + 1], ends[full] + span_words)
    early = by_words < stop
    whole = (at + span <= len(full)) | (by_words < len(full))
    stop = np.where(early | (at + span > len(full)), np.minimum(by_words, len(full) - 1), stop)
    first, last = ends[full], ends[full[stop] + 1]
    ok = whole & (last - first >= min_words)
    # a polynomial over the run's word hashes, from prefix sums; wraps modulo 2**64
    power = np.full(len(flat) + 1, 0xD6E8FEB86659FD93, np.uint64)
    power[0] = 1
    power = np.cumprod(power, dtype=np.uint64)
    prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(flat, 41) * power[:-1], dtype=np.uint64)])
    total = (prefix[last] - prefix[first]) * power[len(flat) - first]
    h = mix64(total * _unscale(len(flat)), 42)
    return (h + mix64((last - first).astype(np.uint64), 43))[ok], full[ok], (full[stop] - full + 1)[ok]


def _unscale(n: int) -> np.uint64:
    """The inverse of the multiplier's n-th power modulo 2**64."""
    return np.uint64(pow(pow(0xD6E8FEB86659FD93, n, 1 << 64), -1, 1 << 64))


def _runs(span: int, span_words: int, min_words: int):
    """Rows (hash, id, key, start, length, again).

    again = 1 marks a run met earlier in the same batch, in this order of
    documents: it is removed whatever other batches hold, so a hot run reaches
    its task once a batch.
    """

    def run(batches):
        for b in (part for whole in batches for part in slices_of(whole, 2, 8_000_000)):
            texts = binary_values(b.column(2))
            all_ids, all_keys = b.column(0), b.column(1).to_numpy(zero_copy_only=False)
            # in the order by which the first is chosen; nulls last
            order_of = [(x is None, x if x is not None else 0, k) for x, k in zip(all_ids.to_pylist(), all_keys.tolist(), strict=True)]
            rank = np.empty(len(texts), np.int64)
            rank[sorted(range(len(texts)), key=order_of.__getitem__)] = np.arange(len(texts))
            got, done = [], set()
            for i, text in enumerate(texts):
                if text and order_of[i] not in done:
                    done.add(order_of[i])
                    h, start, length = runs(text, span, span_words, min_words)
                    got.append((h, np.full(len(h), i), start, length))
            if not got:
                continue
            h, row, start, length = (np.concatenate(x) for x in zip(*got, strict=True))
            order = np.lexsort((start, rank[row], h))
            h, row, start, length = h[order], row[order], start[order], length[order]
            again = np.zeros(len(h), np.int8)
            again[1:] = h[1:] == h[:-1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), all_ids.take(pa.array(row)), pa.array(all_keys[row]), pa.array(start.astype(np.int32)), pa.array(length.astype(np.int32)), pa.array(again)],
                ["hash", "id", "key", "start", "length", "again"],
            )

    return run


def _without(batches):
    """Texts without the sentences that the runs of column 3 (start in the high half, length in the low) cover."""
    for b in (part for whole in batches for part in slices_of(whole, 2, 2_000_000)):
        counts = pc.fill_null(pc.list_value_length(b.column(3)), 0).to_numpy(zero_copy_only=False)
        dropped, end = b.column(3).flatten().to_numpy(), np.cumsum(counts)
        out, total, gone = [], [], []
        for t, n, e in zip(binary_values(b.column(2)), counts, end, strict=True):
            parts = sentences(t) if t else []
            cover = np.zeros(len(parts) + 1, np.int64)
            mine = dropped[e - n : e]
            np.add.at(cover, mine >> 32, 1)
            np.add.at(cover, (mine >> 32) + (mine & 0xFFFFFFFF), -1)
            covered = (np.cumsum(cover)[:-1] > 0).tolist()
            out.append(None if t is None else b"".join(p for p, c in zip(parts, covered, strict=True) if not c))
            full = [not p.isspace() for p in parts]
            total.append(sum(full))
            gone.append(sum(f and c for f, c in zip(full, covered, strict=True)))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(out, pa.binary()).cast(pa.string()), pa.array(total, pa.int64()), pa.array(gone, pa.int64())],
            ["id", "key", "text", "n_sentences", "n_removed"],
        )


def dedup_spans(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    span: int = 3,
    span_words: int = 40,
    min_words: int = 10,
) -> DataFrame:
    """(id, text, n_sentences, n_removed) for every row: texts without repeated runs.

    The first occurrence of a run, by id (nulls last), then row key, then
    position, stays. Equal rows (id and text) are one document and get equal
    results; equal texts under other ids are copies, emptied but for the first,
    unless they are too short to hold a run (under ``span`` sentences and
    ``span_words`` words, or under ``min_words`` words): such texts stay. Ties of
    id are decided by row key. A null text stays null, an empty one empty. Texts
    are read whole, however long. Other columns are ignored, whatever their
    names; an empty table gives an empty one.
    """
    spark = docs.sparkSession
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), row_key(id_col, text_col).alias("key"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    found = narrow.mapInArrow(_runs(span, span_words, min_words), f"hash long, id {id_type}, key long, start int, length int, again byte")
    removed = (
        found.withColumn("salt", F.when(F.col("again") == 1, F.pmod("key", F.lit(1024)) + 1).otherwise(0))
        .withColumn("rank", F.expr("rank() over (partition by hash, salt order by id nulls last, key, start)"))
        .filter("again = 1 or rank > 1")
        .groupBy("id", "key")
        .agg(F.collect_set(F.expr("shiftleft(cast(start as bigint), 32) + length")).alias("dropped"))
        .select(F.col("id").alias("_id"), F.col("key").alias("_key"), "dropped")
    )
    cut = narrow.join(removed, narrow.id.eqNullSafe(removed["_id"]) & (narrow.key == removed["_key"]), "left").select("id", "key", "text", "dropped")
    return cut.mapInArrow(_without, f"id {id_type}, key long, text string, n_sentences long, n_removed long").select(
        F.col("id").alias(id_col), F.col("text").alias(text_col), "n_sentences", "n_removed"
    )
