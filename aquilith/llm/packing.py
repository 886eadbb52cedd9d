"""Packing token ids into rows of one length, best fit decreasing.

Documents are encoded (an end mark behind each), those over ``length`` are split
into full rows and a remainder, and the segments of a window are packed in
descending order of length, each into the open row with the least room that
still holds it. A segment tree over the room left finds that row in log(length)
steps. A window is what one task reads until it holds ``window`` tokens, so
memory is bounded and no shuffle is needed.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import batches_of, binary_values, lean, small
from .pieces import MODEL, encoder


def best_fit_decreasing(lengths: list[int], length: int) -> list[list[int]]:
    """Rows, as lists of indices into ``lengths``; equal lengths keep their order.

    The tree counts open rows by room left: leaf ``leaves + c`` those with room
    c. The least room of n or more is found by climbing from leaf n to the first
    filled right neighbour and descending to its leftmost filled leaf.
    """
    leaves = 1 << length.bit_length()
    tree = [0] * (2 * leaves)
    by_room: list[list[int]] = [[] for _ in range(length + 1)]
    rows: list[list[int]] = []

    def count(room: int, by: int) -> None:
        at = leaves + room
        while at:
            tree[at] += by
            at >>= 1

    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        n = lengths[i]
        at = leaves + n
        if not tree[at]:
            while at > 1 and (at & 1 or not tree[at + 1]):
                at >>= 1
            if at > 1:
                at += 1
                while at < leaves:
                    at = 2 * at if tree[2 * at] else 2 * at + 1
        if at > 1:
            room = at - leaves
            row = by_room[room].pop()
            count(room, -1)
        else:
            room, row = length, len(rows)
            rows.append([])
        rows[row].append(i)
        if room > n:
            by_room[room - n].append(row)
            count(room - n, 1)
    return rows


def _packed(segments: list[tuple], length: int, pad: int, id_type: pa.DataType) -> pa.RecordBatch:
    """segments: (id, first token in its document, 16-bit ids)."""
    columns: list[list] = [[] for _ in range(7)]
    for row in best_fit_decreasing([len(s[2]) // 2 for s in segments], length):
        own = [segments[i] for i in row]
        sizes = [len(s[2]) // 2 for s in own]
        held = sum(sizes)
        places = np.concatenate([np.arange(n, dtype="<u2") for n in [*sizes, length - held]])
        ids = b"".join(s[2] for s in own) + np.full(length - held, pad, "<u2").tobytes()
        for c, v in zip(columns, (held, len(own), ids, places.tobytes(), [0, *np.cumsum(sizes).tolist()], [s[0] for s in own], [s[1] for s in own]), strict=True):
            c.append(v)
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(id_type), pa.list_(pa.int64())]
    names = ["n_tokens", "n_segments", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "starts"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)


def _rows(path: str, length: int, window: int, end: int, pad: int):
    mark = np.array([end], "<u2").tobytes()

    @lean("pieces")
    def run(batches):
        e = encoder(path, 0, 0.0)
        full, rest, held, kind = [], [], 0, pa.int64()
        for b in small(batches, 1):
            ids, texts, kind = b.column(0).to_pylist(), [(t or b"").decode("utf-8", "replace") for t in binary_values(b.column(1))], b.column(0).type
            for span in batches_of(texts, 1_000_000):
                for i, tokens in zip(span, e.ids([texts[i] for i in span], [0] * len(span)), strict=True):
                    if not tokens:
                        continue
                    tokens += mark
                    for at in range(0, len(tokens), 2 * length):
                        part = tokens[at : at + 2 * length]
                        (full if len(part) == 2 * length else rest).append((ids[i], at // 2, part))
                    held += len(tokens) // 2
                if held >= window:
                    yield _packed([*full, *_ordered(rest)], length, pad, kind)
                    full, rest, held = [], [], 0
        if held:
            yield _packed([*full, *_ordered(rest)], length, pad, kind)

    return run


def _ordered(segments: list[tuple]) -> list[tuple]:
    return sorted(segments, key=lambda s: (-len(s[2]), s[0] is None, s[0] if s[0] is not None else 0, s[1], s[2]))


def pack_docs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str = MODEL,
    length: int = 2048,
    window: int = 4_000_000,
    end: int = 2,
    pad: int = 0,
) -> DataFrame:
    """Packed rows of ``length`` token ids; every token of every text is in exactly one.

    (n_tokens, n_segments, input_ids, position_ids, cu_seqlens, doc_ids, starts):
    input_ids and position_ids are one matrix row of little-endian 16-bit
    numbers, the unused rest filled with ``pad``; positions start anew with
    every segment and with the rest; cu_seqlens are the segments' bounds, from 0
    to n_tokens; doc_ids and starts say which document's tokens, from which
    token on, a segment holds. A null or empty text has no tokens and is in no
    row. Repeated rows are packed as often as they occur; texts are packed whole,
    however long; segments of equal length that tie go where the last one went, in
    the order read. Which segments share a row follows from the order in which a
    task reads them, ``window`` tokens at a time: for rows that agree between runs
    on other splits, range the table by id first. Other columns are ignored,
    whatever their names; an empty table gives an empty one.
    """
    if not 1 <= length < 1 << 16:
        raise ValueError("length must fit 16 bits")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType.simpleString()
    return narrow.mapInArrow(
        _rows(path, length, window, end, pad),
        f"n_tokens int, n_segments int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<{id_type}>, starts array<long>",
    )


def write_packed(packed: DataFrame, path: str) -> None:
    """The packed matrices as Parquet: one row a matrix row, fixed-width binary ids."""
    packed.write.parquet(path)


def matrix(column: list[bytes]) -> np.ndarray:
    """A rows x length matrix of ids or positions."""
    return np.frombuffer(b"".join(column), "<u2").reshape(len(column), -1)
