"""The prefix trie of conversations, merged family first.

A family is the conversations whose id has the same multiple of ``family`` as its
base. Its turns meet in one task, as hashes and word counts without their
texts, the base conversation first; each conversation is rebuilt from the base's
opening as it streams by, and the family's small trie is built. Only the trie's nodes are
shuffled on: one row for each node and family, merged by the node's key (the hash
chain of its turns) into members, smallest member and children.

Sums over a subtree go back the same way. A node's own value is booked in the family of
its smallest member; each family sums what it booked over the subtrees of
its own trie, and these sums are added by key. Digests of members that end in a
node are streamed in order of the bases, whose families hold disjoint ranges
of ids, so no list of members is ever held.
"""

from __future__ import annotations

import hashlib
from itertools import groupby

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import WORD_PATTERN, Workspace, hot_keys, lean, partitions, spread_join

#: The key of the textless root.
ROOT = bytes(16)
#: Rows of a batch that tasks return, and turns of an opening, at most.
ROWS, OPENINGS = 50_000, 255


class _Family:
    """A family's trie; a node's parent always has a smaller number."""

    def __init__(self, base: int):
        self.base = base
        self.at = {ROOT: 0}
        self.keys, self.depth, self.parent, self.words = [ROOT], [0], [-1], [0]
        self.n, self.first, self.ends = [0], [None], [None]

    def walk(self, conv: int, path) -> None:
        """Adds a rebuilt conversation, given as (hash, words) of its turns."""
        here = 0
        self._met(0, conv)
        for turn, words in path:
            key = hashlib.md5(self.keys[here] + turn).digest()
            there = self.at.get(key)
            if there is None:
                there = self.at[key] = len(self.keys)
                for column, v in ((self.keys, key), (self.depth, self.depth[here] + 1), (self.parent, here), (self.words, words), (self.n, 0), (self.first, None), (self.ends, None)):
                    column.append(v)
            here = there
            self._met(here, conv)
        self.ends[here] = [*(self.ends[here] or ()), conv]

    def _met(self, node: int, conv: int) -> None:
        self.n[node] += 1
        self.first[node] = conv if self.first[node] is None else min(conv, self.first[node])

    def rows(self):
        parents = [None if p < 0 else self.keys[p] for p in self.parent]
        ends = [None if e is None else ",".join(map(str, sorted(e))) for e in self.ends]
        columns = (self.keys, [self.base] * len(self.keys), range(len(self.keys)), self.parent, parents, self.depth, self.words, self.n, self.first, ends)
        return zip(*columns, strict=True)


_NODES = {"key": pa.binary(), "base": pa.int64(), "node": pa.int64(), "above": pa.int64(), "parent": pa.binary(), "depth": pa.int64(), "words": pa.int64(), "n": pa.int64(), "first": pa.int64(), "ends": pa.string()}


def _batch(rows: list[tuple], kinds: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds.values())], list(kinds))


def _rows_of(batches, n: int):
    for b in batches:
        yield from zip(*(b.column(i).to_pylist() for i in range(n)), strict=True)


def _in_batches(rows, kinds: dict[str, pa.DataType]):
    held = []
    for r in rows:
        held.append(r)
        if len(held) == ROWS:
            yield _batch(held, kinds)
            held = []
    if held:
        yield _batch(held, kinds)


def _runs(rows, at: int):
    """(value, rows) of consecutive rows with one value, the rows to be used up before the next run."""
    return groupby(rows, key=lambda r: r[at])


@lean()
def _families(batches):
    """Turns, sorted by family with its base first, to the nodes of each family's trie."""

    def nodes():
        for base, own in _runs(_rows_of(batches, 5), 0):
            family, opening = _Family(base), []
            for conv, turns in _runs(own, 1):
                family.walk(conv, _own(opening, turns) if conv == base else _rebuilt(opening, turns))
            yield from family.rows()

    yield from _in_batches(nodes(), _NODES)


def _own(opening: list[tuple], turns):
    """The base's own turns, of which the first few are kept as the family's opening."""
    for _, _, _, turn, words in turns:
        if len(opening) < OPENINGS:
            opening.append((turn, words))
        yield turn, words


def _rebuilt(opening: list[tuple], turns):
    """The base's first h turns, then the conversation's own after its first h."""
    for n, (_, _, h, turn, words) in enumerate(turns):
        if n == 0:
            yield from opening[:h]
        if n >= h:
            yield turn, words


_SUMS = {"key": pa.binary(), "parent_conv_id": pa.int64(), "n_leaves": pa.int64(), "saved_tokens": pa.int64()}


@lean()
def _subtrees(batches):
    """Nodes of families with their merged figures, sorted by family and node, to sums over the family's subtrees."""

    def sums():
        for _, own in _runs(_rows_of(batches, 9), 0):
            rows = list(own)
            saved, leaves = [0] * len(rows), [0] * len(rows)
            for node in range(len(rows) - 1, -1, -1):
                _, _, above, _, words, mine, first, n, children = rows[node]
                if mine == first:
                    saved[node] += (n - 1) * words
                    leaves[node] += children == 0
                if above >= 0:
                    saved[above] += saved[node]
                    leaves[above] += leaves[node]
            for node, r in enumerate(rows):
                yield r[3], rows[r[2]][6] if r[2] >= 0 else None, leaves[node], saved[node]

    yield from _in_batches(sums(), _SUMS)


_DIGESTS = {"key": pa.binary(), "ends_sha256": pa.string()}


@lean()
def _digests(batches):
    """Lists of ids, sorted by node and base, to one digest a node, of which only the running state is held."""

    def digests():
        for key, lists in _runs(_rows_of(batches, 2), 0):
            digest, between = hashlib.sha256(), ""
            for _, ids in lists:
                digest.update((between + ids).encode())
                between = ","
            yield key, digest.hexdigest()

    yield from _in_batches(digests(), _DIGESTS)


def prefix_trie(
    conversations: DataFrame,
    *,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
    family: int = 20,
    openings: int = 4,
) -> DataFrame:
    """One row a node of the trie of rebuilt conversations.

    (conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256). Turns are ordered by number, nulls first, ties by the hash of
    role and text, so repeated rows are turns behind each other. A null role or text is
    empty. Of conversation c the first h = crc32(c) % ``openings`` turns are replaced by
    those of its base c - c % ``family`` (all it has, none if it is absent). Rows with a
    null conversation id belong to no conversation and are left out. Texts are
    hashed whole, however long, to 128 bits; they are not shuffled. Other columns are
    ignored, whatever their names; an empty table has no conversation and so gives
    no node. A family's trie is held by one task, about 400 bytes a node.
    """
    if not 1 <= openings <= 256:
        raise ValueError("openings must be 1 to 256")
    deal = partitions(conversations.sparkSession)
    work = Workspace(conversations.sparkSession, "tries")
    conv, role, text = F.col(f"`{conv_col}`").cast("long"), F.coalesce(F.col(f"`{role_col}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    turns = conversations.filter(conv.isNotNull()).select(
        (conv - conv % family).alias("base"),
        conv.alias("conv"),
        (F.crc32(conv.cast("string")) % openings).cast("int").alias("h"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("turn"),
        F.regexp_count(text, F.lit(WORD_PATTERN)).cast("long").alias("words"),
        F.col(f"`{turn_col}`").alias("number"),
    )
    dealt = turns.repartition(deal, "base").sortWithinPartitions("base", F.col("conv") != F.col("base"), "conv", F.col("number").asc_nulls_first(), "turn")
    schema = "key binary, base long, node long, above long, parent binary, depth long, words long, n long, first long, ends string"
    nodes = work.put(dealt.select("base", "conv", "h", "turn", "words").mapInArrow(_families, schema))

    merged = work.put(nodes.groupBy("key").agg(F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("n_convs"), F.min("first").alias("conv_id"), F.count("*").alias("families")))
    children = merged.filter("parent is not null").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("n_children"))
    whole = work.put(merged.join(children, "key", "left").select("key", "depth", "conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).alias("n_children"), "families"))
    work.drop(merged)
    known = spread_join(nodes.select("key", "base", "node", "above", "words", "first"), whole.select("key", "conv_id", "n_convs", "n_children"), "key", hot_keys(whole, "key", "families"))
    known = known.select("base", "node", "above", "key", "words", "first", "conv_id", "n_convs", "n_children")
    sums = known.repartition(deal, "base").sortWithinPartitions("base", "node").mapInArrow(_subtrees, "key binary, parent_conv_id long, n_leaves long, saved_tokens long")
    sums = sums.groupBy("key").agg(F.max("parent_conv_id").alias("parent_conv_id"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    ended = nodes.filter("ends is not null").select("key", "base", "ends").repartition(deal, "key").sortWithinPartitions("key", "base")
    digests = ended.select("key", "ends").mapInArrow(_digests, "key binary, ends_sha256 string")
    out = work.put(
        whole.join(sums, "key").join(digests, "key", "left").select(
            F.col("conv_id").alias(conv_col), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256")
        )
    )
    work.only(out)
    return out
