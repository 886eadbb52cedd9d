"""N-gram Jaccard self-join by PartEnum signatures, and its components.

Two sets of sizes a and b with Jaccard likeness of T/100 or more differ in at
most (a + b)(100 - T)/(100 + T) elements. Sizes are cut into bands [l, r] with
r = floor(100 l / T); a set signs for its own band and the next one, so every
pair that can link meets in one band, where it differs in at most
k = floor(2 r (100 - T) / (100 + T)) elements.

Within a band the feature domain is split by hash into n1 first-level parts,
each into n2 second-level parts. With n1 (k2 + 1) > k some first-level part
differs in at most k2 elements, so some choice of n2 - k2 of its second-level
parts is equal in both sets: each such choice is a signature. A signature over
an empty content says nothing and would gather unrelated sets, so a few more
first-level parts are made (the band's slack), and a set that is smaller than
r differs from its partners in fewer elements than k, so more of its parts are
equal up to k2 (``spare``). Empty choices are left out by sets that have them
in no more parts than they have to spare: such a set still shares a non-empty
one with every partner. Sets with more empties (few) keep all of theirs.

Signatures are exchanged and pairs checked by ``simjoin``.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_words, mix64, roll
from .simjoin import LOW, Family, _far_apart, components, groups_of, pack48, sketch, unpack48, wide_sketch

__all__ = ["LOW", "PartEnum", "_far_apart", "groups_of", "jaccard_components", "one_of_each", "pack48", "sketch", "unpack48", "wide_sketch"]


def shingle_set(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles; a shorter text is one shingle."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = hash_words(words)
    return np.unique(roll(h, min(n, len(h))))


def bands_up_to(size: int, threshold: int) -> list[tuple[int, int]]:
    out, low = [], 1
    while low <= size:
        high = max(low, 100 * low // threshold)
        out.append((low, high))
        low = high + 1
    low = out[-1][1] + 1 if out else 1
    return [*out, (low, max(low, 100 * low // threshold))]


def plan(high: int, threshold: int, n2: int, k2: int) -> tuple[int, int, int, int]:
    """(n1, n2, k2, slack) for a band whose largest size is ``high``."""
    k = 2 * high * (100 - threshold) // (100 + threshold)
    if k == 0:
        return 1, 1, 0, 0
    if k <= 6:  # few differences: one part, more choices, so that contents stay large
        return 1, k + 2, k, 0
    least = k // (k2 + 1) + 1
    slack = 2 + least // 50
    return least + slack, n2, k2, slack


def spare(size: int, high: int, threshold: int, k2: int, slack: int) -> int:
    """How many of its parts a set can do without in the band of ``high``.

    Its partners there have at most ``high`` elements, and 100 / threshold times its own.
    """
    most = (size + min(high, 100 * size // threshold)) * (100 - threshold) // (100 + threshold)
    return slack + 2 * high * (100 - threshold) // (100 + threshold) // (k2 + 1) - most // (k2 + 1)


def signatures(s: np.ndarray, band: int, n1: int, n2: int, k2: int, spared: int) -> np.ndarray:
    """The PartEnum signatures of a set for one band."""
    spread = mix64(s, 21)
    cell = ((spread >> np.uint64(33)) % np.uint64(n1 * n2)).astype(np.int64)
    content = np.zeros(n1 * n2, np.uint64)
    np.add.at(content, cell, mix64(s, 22))
    filled = (np.bincount(cell, minlength=n1 * n2) > 0).reshape(n1, n2)
    content = content.reshape(n1, n2)
    part = np.arange(n1, dtype=np.uint64) * np.uint64(4096)
    out, empty = [], []
    for j, choice in enumerate(combinations(range(n2), n2 - k2)):
        total = content[:, choice].sum(axis=1, dtype=np.uint64)
        out.append(mix64(total + mix64(part + np.uint64(j), 23), band))
        empty.append(~filled[:, choice].any(axis=1))
    if 0 < np.any(empty, axis=0).sum() <= spared:
        return np.concatenate(out)[~np.concatenate(empty)]
    return np.concatenate(out)


class PartEnum(Family):
    """Sets of word shingles with PartEnum signatures."""

    def __init__(self, shingle: int, threshold: int, n2: int = 3, k2: int = 1):
        self.shingle, self.threshold, self.n2, self.k2 = shingle, threshold, n2, k2

    def set_of(self, text: bytes | None) -> np.ndarray:
        return shingle_set(text, self.shingle)

    def signatures(self, s: np.ndarray) -> list[np.ndarray]:
        levels = bands_up_to(len(s), self.threshold)
        out = []
        for at in (len(levels) - 2, len(levels) - 1):
            n1, n2, k2, slack = plan(levels[at][1], self.threshold, self.n2, self.k2)
            out.append(signatures(s, at, n1, n2, k2, spare(len(s), levels[at][1], self.threshold, k2, slack)))
        return out


def jaccard_components(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = 5,
    threshold: int = 80,
    n2: int = 3,
    k2: int = 1,
    hot: int | None = None,
) -> DataFrame:
    """(id, n_shingles, component_id) for every row of ``docs``.

    Documents link when 100 |A & B| >= threshold |A | B| over their sets of
    distinct ``shingle``-word shingles (A-Z lower-cased); component_id is the
    least id reachable by links. A text of fewer words is one shingle. A null
    or wordless text has n_shingles 0, links with nothing and keeps its own id.
    Rows with a null id take part; their id counts only if all of a component
    are null. Rows repeated come back repeated. Texts are taken whole, however
    long. Other columns are ignored, whatever their names; an empty table gives
    an empty one. Sets are told apart by a 64-bit hash. ``hot`` is the number of
    sets of a shipment from which a signature they share is spread; by default it
    follows the size of the table, so that no bucket outgrows its task.
    """
    found = components(docs, PartEnum(shingle, threshold, n2, k2), id_col=id_col, text_col=text_col, hot=hot)
    return found.withColumnRenamed("n_items", "n_shingles")


def one_of_each(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` without near copies: of each component the least id stays.

    Of rows repeated with id and text one stays; an id repeated with several
    texts stays with all of them if it heads a component. Rows with a null id
    and texts that are null, empty or without words stay. Whole texts are compared,
    however long; all columns come back, whatever their names; an empty table
    gives an empty one.
    """
    found = jaccard_components(docs, id_col=id_col, text_col=text_col, **how)
    name = f"`{id_col}`"
    found = found.select(F.col(name).alias("_found"), "component_id").filter("_found is not null")
    keep = found.filter("_found = component_id").select(F.col("_found").alias("_keep")).distinct()
    kept = docs.join(keep, docs[name] == keep["_keep"], "left_semi")
    twice = found.groupBy(F.col("_found").alias("_twice")).count().filter("count > 1").select("_twice")
    if twice.limit(1).count():
        again = kept.join(twice, kept[name] == twice["_twice"], "left_semi").dropDuplicates([id_col, text_col])
        kept = kept.join(twice, kept[name] == twice["_twice"], "left_anti").unionByName(again)
    return kept.unionByName(docs.filter(F.col(name).isNull()))
