"""SpotSigs fingerprints.

A spot is an occurrence of a common word (an anchor) with the chain of the next
``chain`` content words behind it, every ``step``-th of them; content words are
those that are no anchors. A text's fingerprint is the set of its spots'
32-bit hashes, in hex and in order. Two fingerprints are compared by Jaccard
likeness. Near copies are found over the whole table: sets are partitioned by
length, as sets of one partition can only reach the threshold with sets of the
same partition or the next, and within a partition they meet in an inverted index
on their rarest spots, so many of them that two sets over the threshold share
one. Lengths and sketches prune pairs, the rest is compared exactly (``simjoin``).

A text with under ``LEAST`` spots takes every word as an anchor and all words as
content, so short texts and texts in other languages have fingerprints too.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, batches_of, binary_values, mix64, partitions
from .simjoin import Family, cell_of, components, set_key

LEAST = 4

#: Common words of English, French, German and Spanish.
ANCHORS = (
    "the of and to in is was that it for on as with be by this are from or an at which has have had he she his her not but they you we "
    "le la les un une des du de et en est que qui pour dans par sur avec au aux il elle ne pas ce se son sa "
    "der die das den dem ein eine und zu im mit von für auf ist nicht sich auch als an bei nach wird "
    "el los las una y a es por con para del al lo su como más pero sus o no si"
).split()


#: What is cut off a word's ends, and what a byte is: 0 white space, 1 such a mark, 2 anything else.
MARKS = b".,;:!?\"'()[]"
_KIND = np.full(256, 2, np.uint8)
_KIND[list(b" \t\n\v\f\r")], _KIND[list(MARKS)] = 0, 1
#: A word's hash is the sum of its bytes' values, each times an odd factor of its place.
_BYTE, _FACTOR = mix64(np.arange(256, dtype=np.uint64), 58), mix64(np.arange(64, dtype=np.uint64), 59) | np.uint64(1)
#: Bytes whose words are hashed at once.
BLOCK = 1_000_000


def word_hashes(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of a text's words without marks at their ends, A-Z lower-cased, and where the words begin.

    A word of marks alone is an empty one.
    """
    text, out, start = text.lower(), [(np.zeros(0, np.uint64), np.zeros(0, np.int64))], 0
    while start < len(text):
        stop = start + BLOCK
        while stop < len(text) and _KIND[text[stop]]:
            stop += 1
        h, begin = _hashed(np.frombuffer(text, np.uint8)[start:stop])
        out.append((h, begin + start))
        start = stop
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _hashed(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    kind = _KIND[data]
    edge = np.flatnonzero(np.diff(kind > 0, prepend=False, append=False))
    begin, end = edge[::2], edge[1::2]
    core = np.flatnonzero(kind == 2)
    before = np.concatenate([[0], np.cumsum(kind == 2)])
    least, most = before[begin], before[end]
    out = np.zeros(len(begin), np.uint64)
    full = np.flatnonzero(most > least)
    if len(full):
        first = core[least[full]]
        length = core[most[full] - 1] + 1 - first
        at = np.cumsum(length) - length
        place = np.arange(at[-1] + length[-1]) - np.repeat(at, length)
        longest = int(length.max())
        factor = _FACTOR if longest <= len(_FACTOR) else mix64(np.arange(longest, dtype=np.uint64), 59) | np.uint64(1)
        out[full] = np.add.reduceat(_BYTE[data[place + np.repeat(first, length)]] * factor[place], at) + length.astype(np.uint64)
    return mix64(out, 60), begin


def anchor_hashes() -> np.ndarray:
    return np.unique(word_hashes(" ".join(ANCHORS).encode())[0])


def spots(text: bytes, anchors: np.ndarray, chain: int, step: int) -> np.ndarray:
    """Sorted distinct 32-bit hashes of a text's spots."""
    return spots_of([text], anchors, chain, step)[0]


def spots_of(texts: list[bytes | None], anchors: np.ndarray, chain: int, step: int) -> list[np.ndarray]:
    """The spots of each text; many texts are read at once, as short ones cost little more than the calls."""
    out = []
    for span in batches_of(texts, BLOCK):
        out += _spots([texts[i] or b"" for i in span], anchors, chain, step)
    return out


def _spots(texts: list[bytes], anchors: np.ndarray, chain: int, step: int) -> list[np.ndarray]:
    h, begin = word_hashes(b" ".join(texts))
    ends = np.cumsum([len(t) + 1 for t in texts])
    own = np.searchsorted(ends, begin, side="right")
    at = np.searchsorted(anchors, h)
    at[at == len(anchors)] = 0
    common = anchors[at] == h
    anchor = np.flatnonzero(common)
    out, of = _chains(h, own, anchor, np.flatnonzero(~common), np.cumsum(~common)[anchor], chain, step)
    few = np.bincount(of, minlength=len(texts)) < LEAST
    parts, owners = [out[~few[of]]], [of[~few[of]]]
    bound = np.searchsorted(own, np.arange(len(texts) + 1))
    for i in np.flatnonzero(few & (np.diff(bound) > 0)).tolist():
        mine = h[bound[i] : bound[i + 1]]
        every = np.arange(len(mine))
        parts.append(_chains(mine, 0 * every, every, every, every + 1, min(chain, max(1, len(mine) - 1)), 1)[0] if len(mine) > 1 else mix64(mine, 51))
        owners.append(np.full(len(parts[-1]), i))
    found = np.unique(np.concatenate(owners).astype(np.uint64) << np.uint64(32) | np.concatenate(parts) >> np.uint64(32))
    cuts = np.searchsorted(found, np.arange(1, len(texts), dtype=np.uint64) << np.uint64(32))
    return np.split(found.astype(np.uint32), cuts)


def _chains(h: np.ndarray, own: np.ndarray, anchor: np.ndarray, content: np.ndarray, start: np.ndarray, chain: int, step: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the chains that end in their anchor's text, and the texts; ``start`` is the first content word behind an anchor."""
    last = start + (chain - 1) * step
    ok = np.flatnonzero(last < len(content))
    ok = ok[own[content[last[ok]]] == own[anchor[ok]]]
    anchor, start = anchor[ok], start[ok]
    out = mix64(h[anchor], 52)
    for i in range(chain):
        out = mix64(out + h[content[start + i * step]], 53 + i)
    return out, own[anchor]


def written(s: np.ndarray) -> str:
    return s.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def likeness(a: np.ndarray, b: np.ndarray, threshold: float = 0.0) -> float:
    """Jaccard likeness of two spot sets; 0 where the lengths rule out ``threshold``.

    Two empty sets are alike (1), an empty and another one are not (0).
    """
    small, large = sorted((len(a), len(b)))
    if not large:
        return 1.0
    if small < threshold * large:
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (small + large - both)


def length_partition(n: int, threshold: float) -> int:
    """Partition of sets by length: likeness of ``threshold`` needs the same or neighbouring ones."""
    return int(math.log(n) / -math.log(threshold)) if n else -1


class SpotSigs(Family):
    """Spot sets, which sign by partition of length with their rarest spots."""

    counted = True

    def __init__(self, threshold: int, chain: int, step: int, counts: np.ndarray | None = None):
        self.threshold, self.chain, self.step, self.counts, self.anchors = threshold, chain, step, counts, anchor_hashes()

    def sets_of(self, texts: list[bytes | None]):
        for s in spots_of(texts, self.anchors, self.chain, self.step):
            yield s.astype(np.uint64)

    def with_counts(self, counts: np.ndarray) -> SpotSigs:
        return SpotSigs(self.threshold, self.chain, self.step, counts)

    def signatures(self, s: np.ndarray) -> list[np.ndarray]:
        # two sets that link share threshold % of the larger one, so they agree in one of so many least spots
        first = len(s) + 1 - -(-self.threshold * len(s) // 100)
        least = s[np.lexsort((s, self.counts[cell_of(s)]))[:first]]
        own = length_partition(len(s), self.threshold / 100)
        return [mix64(least, 1000 + own), mix64(least, 1001 + own)]


def edited(text: str, following: str) -> str:
    n = len(text) // 3
    return (text[: len(text) - n] + following[:n]) if n else text


_NAMES = ["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_spots", "length_partition", "copies_id"]


def _rows(chain: int, step: int, threshold: float):
    anchors = anchor_hashes()

    def sigs(texts: list[bytes]) -> list[np.ndarray]:
        return spots_of(texts, anchors, chain, step)

    def run(batches):
        held = None  # the row that waits for the next one: (bucket, id, text, spots, component)
        key, component = None, None  # of the component row that came last
        for b in batches:
            buckets, kinds, keys = b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(4).to_pylist()
            ids, texts, roots = b.column(2), binary_values(b.column(3)), b.column(5)
            done, found = [], sigs(texts)
            for i, (bucket, kind) in enumerate(zip(buckets, kinds, strict=True)):
                if kind == COMPONENT:
                    key, component = keys[i], roots[i]
                    continue
                text = (texts[i] or b"").decode("utf-8", "replace")
                mine = found[i]
                if held is not None and held[0] == bucket:
                    done.append((held, text, mine))
                held = None if kind == TAIL else (bucket, ids[i], text, mine, component if keys[i] == key else ids[i])
            others = [edited(held[2], text).encode("utf-8", "replace") for held, text, _ in done]
            out = [_row(row, other, s, following, threshold) for (row, _, following), other, s in zip(done, others, sigs(others), strict=True)]
            columns = list(zip(*out, strict=True)) if out else [[]] * len(_NAMES)
            types = [ids.type, pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64(), pa.int32(), ids.type]
            yield pa.RecordBatch.from_arrays([pa.array([v.as_py() if isinstance(v, pa.Scalar) else v for v in c], k) for c, k in zip(columns, types, strict=True)], _NAMES)

    return run


def _row(held, other: bytes, changed: np.ndarray, next_spots: np.ndarray, threshold: float):
    """The row held, with its edited text and that one's spots, and the next document's."""
    _, row_id, text, mine, component = held
    return (
        row_id,
        len(text),
        hashlib.sha256(other).hexdigest(),
        written(mine),
        written(changed),
        likeness(mine, changed),
        likeness(mine, next_spots),
        len(mine),
        length_partition(len(mine), threshold),
        component,
    )


#: Kinds of rows in their order: a document's component, the document, the first document of the next range.
COMPONENT, DOCUMENT, TAIL = range(3)


def _place(id_: F.Column, kind) -> F.Column:
    """A long that is no greater for a lesser id: the id itself, or for text the number its first bytes make."""
    if isinstance(kind, T.NumericType):
        return id_
    return F.conv(F.rpad(F.hex(F.substring(id_.cast("string").cast("binary"), 1, 7)), 14, "0"), 16, 10).cast("long")


def _buckets(rows: DataFrame, ranges: int) -> tuple[F.Column, F.Column]:
    """Range of a row (id in descending order, nulls last), and its part of the range, by the text's hash.

    A place that holds several ranges' worth of rows is one range in as many parts.
    """
    found = rows.agg(F.percentile_approx("at", [i / ranges for i in range(1, ranges)], 20 * ranges).alias("q"), F.count("*").alias("n"), F.count_if(F.col("at").isNull()).alias("nulls")).first()
    quantiles = found.q or []
    cuts = sorted(set(quantiles))
    bucket = F.when(F.col("at").isNull(), F.lit(2 * len(cuts) + 1))
    # an even range lies between two cuts, an odd one is a cut itself
    if cuts:
        less = F.size(F.filter(F.array(*map(F.lit, cuts)), lambda c: c < F.col("at")))
        bucket = bucket.otherwise(2 * len(cuts) - 2 * less - F.when(F.array_contains(F.array(*map(F.lit, cuts)), F.col("at")), 1).otherwise(0))
    else:
        bucket = bucket.otherwise(0)
    hot = {2 * len(cuts) - 2 * i - 1: quantiles.count(c) for i, c in enumerate(cuts) if quantiles.count(c) > 1}
    hot |= {2 * len(cuts) + 1: ranges * found.nulls // max(1, found.n) + 1}
    parts = F.coalesce(F.element_at(F.create_map(*[F.lit(x) for pair in hot.items() for x in pair]), F.col("bucket")), F.lit(1))
    return bucket.cast("int"), F.shiftright(F.shiftrightunsigned("h", 32) * parts, 31).cast("int")


def fingerprint_docs(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    chain: int = 3,
    step: int = 1,
    threshold: int = 80,
) -> DataFrame:
    """Fingerprints of every text and of its edited text, their likenesses, and its near copies over the whole table.

    The edited text has its last third replaced by the start of the next
    document, in descending order of id (nulls last; rows of one id by their
    text's hash; behind the last comes the first, behind a single row that row). A
    null text is empty; an empty one has the empty fingerprint. copies_id is the
    least id reachable over pairs of fingerprints of ``threshold`` % likeness or
    more, the row's own included. Whole texts are read, however long. Ids are
    numbers or strings. Other columns are ignored, whatever their names; repeated
    rows come back repeated; an empty table gives an empty one.

    Ids are cut into ranges at quantiles (one number a range reaches the driver),
    an id that many rows share into parts by the text's hash; each part is read in
    order, and gets the head of the next as its tail, so that no task needs more
    than one row of another.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "fingerprints")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    # the hash without its lowest bit, so that it orders as an unsigned number
    narrow = narrow.withColumn("h", F.shiftrightunsigned(F.xxhash64("text"), 1))
    kind = narrow.schema["id"].dataType
    named = narrow.select(F.struct(F.col("id").isNull().alias("none"), F.col("id").alias("id"), F.col("h").alias("h")).alias("row"), "text")
    copies = work.put(components(named, SpotSigs(threshold, chain, step), id_col="row", text_col="text").select("row.id", "row.h", F.col("component_id.id").alias("other")).distinct())

    placed = narrow.withColumn("at", _place(F.col("id"), kind))
    bucket, part = _buckets(placed, 4 * partitions(spark))
    place = lambda df: df.withColumn("at", _place(F.col("id"), kind)).withColumn("bucket", bucket).withColumn("part", part)
    placed = place(narrow)
    # the first row of every part, by id, then hash: a row a part
    first = F.struct(F.col("id").isNotNull().alias("some"), F.col("id").alias("id"), (-F.col("h")).alias("back"))
    tops = placed.groupBy("bucket", "part").agg(F.max(first).alias("top"))
    firsts = placed.join(F.broadcast(tops), ["bucket", "part"]).filter(F.col("id").eqNullSafe(F.col("top.id")) & (-F.col("h") == F.col("top.back")))
    heads = work.put(firsts.groupBy("bucket", "part", "id", "h").agg(F.min("text").alias("text")))
    held = [(r.bucket, r.part) for r in heads.select("bucket", "part").distinct().orderBy("bucket", "part").collect()]
    before = [(*held[i], *held[i - 1]) for i in range(len(held))]  # of the first: the last
    follows = spark.createDataFrame(before or [(0, 0, 0, 0)], "bucket int, part int, to_bucket int, to_part int")
    no = F.lit(None).cast(kind).alias("other")
    tails = heads.join(F.broadcast(follows), ["bucket", "part"]).select(F.col("to_bucket").alias("bucket"), F.col("to_part").alias("part"), F.lit(TAIL).alias("kind"), "id", "text", "h", no)
    rows = placed.select("bucket", "part", F.lit(DOCUMENT).alias("kind"), "id", "text", "h", no).unionByName(tails)
    rows = rows.unionByName(place(copies).select("bucket", "part", F.lit(COMPONENT).alias("kind"), "id", F.lit(None).cast("string").alias("text"), "h", "other"))
    order = ["bucket", "part", (F.col("kind") == TAIL), F.col("id").desc_nulls_last(), "h", "kind", "text"]
    rows = rows.repartition(partitions(spark), "bucket", "part").sortWithinPartitions(*order)
    key = F.when(F.col("kind") != TAIL, F.concat_ws(":", F.col("id").cast("string"), F.col("h").cast("string"))).alias("key")
    sent = rows.select(F.struct("bucket", "part").cast("string").alias("bucket"), "kind", "id", "text", key, "other")
    id_type = kind.simpleString()
    out = sent.mapInArrow(
        _rows(chain, step, threshold / 100),
        f"id {id_type}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_spots long, length_partition int, copies_id {id_type}",
    )
    work.only(heads, copies)
    return out.withColumnRenamed("id", id_col)
