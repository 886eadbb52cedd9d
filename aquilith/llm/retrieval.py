"""Ranked lexical search: three phases over postings kept by term (TPUT).

Documents are cut into blocks of consecutive rows. A list slice is what one
block adds to a term's list: places in the block, occurrences, document lengths.
Slices are written dealt by term, so that a list is spread over its slices and a
frequent term fills no task.

1. Every list sends its best ``k`` entries. Their sums over an item's lists give
   each item a lower bound, its k-th greatest sum.
2. Every list of an item gets one threshold t, as great as it may be for a
   document that is below t in all lists (or has their greatest value, where
   that is smaller) to stay under the bound. Lists send what reaches the lowest
   threshold of their items, once for all of them; sums meet by block, where a
   document's unseen lists add at most t - 1 each. What can reach the item's
   k-th greatest sum is a candidate.
3. Candidates are looked up in all lists of their items, and exact scores ranked.

Memory is bounded by a block (``BLOCK`` documents and the items' terms), and the
items are taken in groups of ``ITEM_BYTES`` of text, each against all documents.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, IntegerType, LongType, StructField, StructType

from .common import Workspace, binary_values, lean, partitions, small

#: Documents of a block, at most, and bytes of item text that are searched together.
BLOCK, ITEM_BYTES = 16_384, 2_000_000

#: Space for what is no term, a-z for A-Z; all bytes beyond ASCII belong to terms.
_TERMS = bytes(b if b > 127 or chr(b).isdigit() or chr(b).islower() else b + 32 if chr(b).isupper() else 32 for b in range(256))


def terms(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_TERMS).split()


def _slices(vocabulary: dict[bytes, int], block: int, id_type: pa.DataType):
    """Documents as list slices; a block's own row (term -1) holds its ids and lengths."""

    def packed(number: int, ids: list, sizes: list, found: list) -> pa.RecordBatch:
        lengths = np.array(sizes, "<u4")
        place = np.repeat(np.arange(len(found)), [len(x) for x in found])
        term = np.fromiter((t for x in found for t in x), np.int64, len(place))
        times = np.fromiter((n for x in found for n in x.values()), np.int64, len(place))
        order = np.argsort(term, kind="stable")
        term, place, times = term[order], place[order], times[order]
        cuts = np.flatnonzero(np.diff(term, prepend=-1))
        ends = [*cuts[1:].tolist(), len(term)] if len(term) else []
        rows = [(int(term[a]), place[a:b].astype("<u2").tobytes(), times[a:b].astype("<u4").tobytes(), lengths[place[a:b]].tobytes()) for a, b in zip(cuts.tolist(), ends, strict=True)]
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number] * (n + 1), pa.int64()),
                pa.array([r[0] for r in rows] + [-1], pa.int32()),
                *(pa.array([r[i] for r in rows] + [lengths.tobytes() if i == 3 else b""], pa.binary()) for i in (1, 2, 3)),
                pa.array([None] * n + [ids], pa.list_(id_type)),
                pa.array([None] * n + [int((lengths > 0).sum())], pa.int64()),
                pa.array([None] * n + [int(lengths.sum(dtype=np.int64))], pa.int64()),
            ],
            ["block", "term", "places", "times", "lengths", "ids", "n_docs", "n_terms"],
        )

    @lean()
    def run(batches):
        number = TaskContext.get().partitionId() << 32
        ids, sizes, found = [], [], []
        for b in small(batches, 1):
            for i, text in zip(b.column(0).to_pylist(), binary_values(b.column(1)), strict=True):
                words = terms(text)
                ids.append(i)
                sizes.append(len(words))
                found.append(Counter(map(vocabulary.__getitem__, filter(vocabulary.__contains__, words))))
                if len(ids) == block:
                    yield packed(number, ids, sizes, found)
                    ids, sizes, found, number = [], [], [], number + 1
        if ids:
            yield packed(number, ids, sizes, found)

    return run


class _Scorer:
    """Values of postings before an item's weights: occurrences against the document's length."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, max(n_terms, 1)

    def weight(self, df: int) -> int:
        return math.floor(1000 * math.log((2 * self.n_docs + 2) / (2 * df + 1)))

    def __call__(self, times: bytes, lengths: bytes) -> np.ndarray:
        tf = np.frombuffer(times, "<u4").astype(np.int64)
        m = 75 + np.frombuffer(lengths, "<u4").astype(np.int64) * 25 * self.n_docs // self.n_terms
        return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def _heads(score: _Scorer, k: int):
    """The k best entries of every slice, one row an entry."""

    @lean()
    def run(batches):
        for b in batches:
            block, term, place, value = [], [], [], []
            for at, t, places, times, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                v = score(times, lengths)
                best = np.argpartition(-v, k - 1)[:k] if len(v) > k else np.arange(len(v))
                block += [at] * len(best)
                term += [t] * len(best)
                place += np.frombuffer(places, "<u2")[best].tolist()
                value += v[best].tolist()
            yield pa.RecordBatch.from_arrays([pa.array(block, pa.int64()), pa.array(term, pa.int32()), pa.array(place, pa.int32()), pa.array(value, pa.int64())], ["block", "term", "place", "value"])

    return run


def _sent(score: _Scorer, least: dict[int, int]):
    """Of every slice the entries that reach its term's least threshold."""

    @lean()
    def run(batches):
        for b in batches:
            rows = []
            for block, term, places, times, lengths in zip(*(c.to_pylist() for c in b.columns), strict=True):
                v = score(times, lengths)
                keep = v >= least[term]
                if keep.any():
                    rows.append((block, term, np.frombuffer(places, "<u2")[keep].tobytes(), v[keep].astype("<i4").tobytes()))
            kinds = [pa.int64(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["block", "term", "places", "values"])

    return run


def _summed(lists: dict[int, list[tuple[int, int, int]]], bounds: dict[int, int], k: int):
    """A block's candidates by item. ``lists``: by item (term, weight, threshold, what an unseen entry adds at most)."""

    def run(group: pa.Table) -> pa.Table:
        sent = {t: (np.frombuffer(p, "<u2"), np.frombuffer(v, "<i4").astype(np.int64)) for t, p, v in zip(*(group.column(c).to_pylist() for c in ("term", "places", "values")), strict=True)}
        block = group.column("block")[0].as_py()
        size = 1 + max((int(p.max()) for p, _ in sent.values()), default=0)
        item, place, low, high = [], [], [], []
        for i, own in lists.items():
            sums, seen = np.zeros(size, np.int64), np.zeros(size, np.int64)
            for term, weight, threshold, unseen in own:
                if term in sent:
                    p, v = sent[term]
                    v = v * weight
                    if threshold > 1:
                        p, v = p[v >= threshold], v[v >= threshold]
                    sums[p] += v
                    seen[p] += unseen
            most = sums + (sum(x[3] for x in own) - seen)
            need = max(bounds[i], int(np.partition(sums, -k)[-k]) if size > k else 0, 1)
            hit = np.flatnonzero((most >= need) & (sums > 0))
            item.append(np.full(len(hit), i))
            place.append(hit)
            low.append(sums[hit])
            high.append(most[hit])
        columns = [np.concatenate(x) if x else np.zeros(0, np.int64) for x in (item, place, low, high)]
        return pa.table({"item": pa.array(columns[0], pa.int32()), "block": pa.array([block] * len(columns[0]), pa.int64()), "place": pa.array(columns[1], pa.int32()), "low": pa.array(columns[2], pa.int64()), "high": pa.array(columns[3], pa.int64())})

    return run


def _exact(score: _Scorer, lists: dict[int, list[tuple[int, int, int]]]):
    """A block's candidates with their scores, looked up in all lists of their items."""

    def run(wanted: pa.Table, slices: pa.Table) -> pa.Table:
        items, places = wanted.column("item").to_numpy(), wanted.column("place").to_numpy()
        size = 1 + max(int(places.max()) if len(places) else 0, 0)
        found = {}
        if len(places):
            for t, p, n, m in zip(*(slices.column(c).to_pylist() for c in ("term", "places", "times", "lengths")), strict=True):
                found[t] = (np.frombuffer(p, "<u2"), n, m)
        values: dict[int, np.ndarray] = {}
        total = np.zeros(len(places), np.int64)
        for i in np.unique(items).tolist():
            mine = np.flatnonzero(items == i)
            for term, weight, *_ in lists[i]:
                if term in found:
                    p, n, m = found[term]
                    at = np.searchsorted(p, places[mine])
                    at[at == len(p)] = 0
                    hit = p[at] == places[mine]
                    if hit.any():
                        if term not in values:
                            values[term] = score(n, m)
                        total[mine[hit]] += weight * values[term][at[hit]]
        block = wanted.column("block")
        return pa.table({"item": wanted.column("item"), "block": block, "place": wanted.column("place"), "score": pa.array(total, pa.int64())})

    return run


def _best(df: DataFrame, by: str, k: int, *order) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(by).orderBy(*order))).filter(F.col("_n") <= k)


def _threshold(bound: int, most: list[int]) -> int:
    """The greatest t for which the sum of min(t - 1, most) over the lists is under the bound; 1 without a bound."""
    left, n = max(bound, 1) - 1, len(most)
    for m in sorted(most):
        if left // n < m:
            break
        left, n = left - m, n - 1
    return left // n + 1 if n else max(most, default=0) + 1


def _search(docs: DataFrame, asked: list[Counter], k: int, block: int, work: Workspace) -> DataFrame:
    """(item, block, place, score) and the blocks' ids, for items given as term counts."""
    vocabulary = {t: n for n, t in enumerate(dict.fromkeys(t for terms_ in asked for t in terms_))}
    id_type = docs.schema["id"].dataType
    schema = StructType(
        [StructField("block", LongType()), StructField("term", IntegerType()), *(StructField(c, BinaryType()) for c in ("places", "times", "lengths")), StructField("ids", ArrayType(id_type)), StructField("n_docs", LongType()), StructField("n_terms", LongType())]
    )
    from pyspark.sql.pandas.types import to_arrow_type

    sliced = docs.mapInArrow(_slices(vocabulary, block, to_arrow_type(id_type)), schema)
    # dealt by term, a list in segments of 64 blocks
    postings = work.put(sliced.repartition(partitions(docs.sparkSession), "term", F.shiftright("block", 6)))
    slices = postings.filter("term >= 0").select("block", "term", "places", "times", "lengths")
    totals = postings.filter("term = -1").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    score = _Scorer(totals[0] or 0, totals[1] or 0)
    # one row for each term that an item asks for
    weights = {r.term: score.weight(r.df) for r in slices.groupBy("term").agg((F.sum(F.length("places")) / 2).cast("long").alias("df")).collect()}
    own = {i: [(vocabulary[t], n * weights[vocabulary[t]]) for t, n in x.items() if weights.get(vocabulary[t], 0) > 0] for i, x in enumerate(asked)}

    entries = work.put(_best(slices.mapInArrow(_heads(score, k), "block long, term int, place int, value long"), "term", k, F.desc("value"), "block", "place"))
    most = {r.term: r.value for r in entries.groupBy("term").agg(F.max("value").alias("value")).collect()}
    spark = docs.sparkSession
    pairs = spark.createDataFrame([(i, t, w) for i, x in own.items() for t, w in x] or [(-1, -1, 0)], "item int, term int, weight long")
    sums = entries.join(F.broadcast(pairs), "term").groupBy("item", "block", "place").agg(F.sum(F.col("value") * F.col("weight")).alias("low"))
    bounds = {r.item: r.low for r in _best(sums, "item", k, F.desc("low")).filter(F.col("_n") == k).collect()}
    bounds = {i: bounds.get(i, 0) for i in own}

    lists, least = {}, {}
    for i, x in own.items():
        top = {t: w * most[t] for t, w in x}
        t0 = _threshold(bounds[i], list(top.values()))
        lists[i] = [(t, w, t0, min(t0 - 1, top[t])) for t, w in x]
        for t, w in x:
            if top[t] >= t0:
                least[t] = min(least.get(t, 1 << 62), -(-t0 // w))
    sent = slices.filter(F.col("term").isin(list(least)) if len(least) < 200 else F.lit(True)).mapInArrow(_sent(score, {t: least.get(t, 1 << 62) for t in weights}), "block long, term int, places binary, values binary")
    possible = work.put(sent.groupBy("block").applyInArrow(_summed(lists, bounds, k), "item int, block long, place int, low long, high long"))
    bar = _best(possible.select("item", "low", "block", "place"), "item", k, F.desc("low")).groupBy("item").agg(F.min("low").alias("bar"), F.count("*").alias("n")).filter(F.col("n") == k)
    candidates = possible.join(F.broadcast(bar.select("item", "bar")), "item", "left").filter(F.col("bar").isNull() | (F.col("high") >= F.col("bar"))).select("item", "block", "place")
    scored = candidates.groupBy("block").cogroup(slices.groupBy("block")).applyInArrow(_exact(score, lists), "item int, block long, place int, score long")
    ids = postings.filter("term = -1").select("block", F.posexplode("ids").alias("place", "id"))
    return _best(scored.join(ids, ["block", "place"]), "item", k, F.desc("score"), F.col("id").asc_nulls_last(), "block", "place")


def search(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    k: int = 20,
    block: int = BLOCK,
    item_bytes: int = ITEM_BYTES,
) -> DataFrame:
    """(item, rank, id, score): for every row of ``items`` the ``k`` rows of ``docs`` with the greatest scores above 0.

    Whole texts are read, however long. A term is a run of letters, digits and
    characters beyond ASCII, A-Z in lower case; its weight in an item is the
    floored 1000 * ln((2 N + 2) / (2 df + 1)) times its occurrences there, N
    counting documents with a term. A null or empty text has no terms: such
    documents are never found, such items find nothing. Equal scores go by
    ascending id, nulls last. Repeated documents are ranked one by one, repeated
    items answered one by one. Other columns are ignored, whatever their names; an
    empty table on either side gives an empty result. The items' texts, in groups of
    ``item_bytes``, are read by the driver and shipped; every group meets all documents.
    """
    if not 1 <= block <= 65_536:
        raise ValueError("places in a block must fit 16 bits")
    spark = docs.sparkSession
    work = Workspace(spark, "retrieval")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{item_text_col}`").cast("string").alias("text")).filter("text is not null")
    item_type, id_type = asked.schema["item"].dataType, narrow.schema["id"].dataType
    total = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = -(-total // item_bytes)
    out = []
    for group in range(groups):
        own = asked if groups == 1 else asked.filter(F.pmod(F.xxhash64("item", "text"), F.lit(groups)) == group)
        rows = [(r.item, Counter(terms(r.text.encode("utf-8", "surrogatepass")))) for r in own.collect()]
        names = spark.createDataFrame([(n, r[0]) for n, r in enumerate(rows)], StructType([StructField("item", IntegerType()), StructField("name", item_type)]))
        found = _search(narrow, [r[1] for r in rows], k, block, work)
        out.append(found.join(F.broadcast(names), "item").select(F.col("name").alias("item"), F.col("_n").alias("rank"), "id", "score"))
    schema = StructType([StructField("item", item_type), StructField("rank", IntegerType()), StructField("id", id_type), StructField("score", LongType())])
    answers = work.put(out[0] if len(out) == 1 else _union(out)) if out else spark.createDataFrame([], schema)
    if out:
        work.only(answers)
    return answers.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    return whole
