"""Self-join of texts' sets by shared signatures, checked exactly, and its components.

A ``Family`` says which set a text has and which signatures a set, so that any
two sets that link share one. Two sets link when 100 |A & B| >= threshold |A | B|.

Signatures travel packed: a shipment of many sets sends each bucket of the
signature space one row, six bytes for a signature (the bucket gives the rest)
and two for its owner. A bucket is sorted in memory, and only groups of two sets
or more leave it, each member list once. A signature that very many sets of a
shipment share is sent to its bucket once a shipment; its other members are
dealt evenly, marked with their group, and joined as plain rows.

Candidates are checked exactly. Members of a signature group are first compared
with one central member, that of most shared signatures, then, only where a group
still holds more than one component, with 16, 256, 4096 ... more of its members,
until every pair of the group is compared or known to be connected: no link
between different components can be missed, and no group is expanded into pairs
up front. Every set carries a sketch of ``64 WORDS`` bits, in which each element
flips one bit: two sketches differ in no more bits than the sets in elements, so
pairs whose sketches differ in more than k bits are no links.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import Workspace, batches_of, binary_values, connected, mix64, partitions, lean, small

#: Longs of a set's parity sketch.
WORDS = 8
#: Signatures of one shipment, about, and members of one row of groups.
SHIPPED, PART = 800_000, 100_000
#: Signatures that a bucket is to hold; its task keeps them in memory at once.
BUCKET = 2_000_000
#: Marks an owner whose signature is hot in its shipment; a shipment has fewer sets.
FLAG = 1 << 15
LOW = np.uint64((1 << 48) - 1)
#: Pairs of one set that are checked in one group of rows.
SPREAD = 256
#: Candidate ids are broadcast up to this number (8 bytes each), else joined by shuffle.
BROADCAST_IDS = 1_000_000


#: Cells in which a family's elements are counted, and cells of one row of counts.
CELLS, SLICE = 1 << 18, 1 << 12


class Family:
    """Which set a text has, and which signatures a set."""

    threshold: int
    #: Whether signatures depend on how often elements occur; see ``with_counts``.
    counted = False

    def set_of(self, text: bytes | None) -> np.ndarray:
        """Sorted distinct unsigned longs; none for a text that links with nothing."""
        raise NotImplementedError

    def sets_of(self, texts: list[bytes | None]):
        """The sets of several texts, in their order."""
        return map(self.set_of, texts)

    def signatures(self, s: np.ndarray) -> list[np.ndarray]:
        raise NotImplementedError

    def with_counts(self, counts: np.ndarray) -> Family:
        """The family that knows how many sets hold an element of each of ``CELLS`` cells."""
        raise NotImplementedError


def cell_of(s: np.ndarray) -> np.ndarray:
    return (mix64(s, 41) % np.uint64(CELLS)).astype(np.int64)


def set_key(s: np.ndarray) -> int:
    """64-bit identity of a set, as a signed long."""
    return int(mix64(mix64(s, 11).sum(dtype=np.uint64)[None] + np.uint64(len(s)), 12).view(np.int64)[0])


def sketch(s: np.ndarray) -> np.ndarray:
    """Parities of the set's elements in 64 WORDS cells, as longs."""
    odd = np.bincount((mix64(s, 31) % np.uint64(64 * WORDS)).astype(np.int64), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def wide_sketch(s: np.ndarray) -> np.ndarray:
    """The same with as many bits as the next power of two from the set's size, 64 at least."""
    bits = max(64, 1 << (len(s) - 1).bit_length())
    odd = np.bincount((mix64(s, 32) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _far_apart(threshold: int) -> str:
    """SQL: whether the wide sketches of sets a and b differ in more bits than linked sets can.

    Cells are hashes modulo a power of two, so the halves of a longer sketch
    fold into one of half its length.
    """

    def folded(x: str, y: str) -> str:
        half = f"cast(size({x}.wide) div 2 as int)"
        fold = f"zip_with(slice({x}.wide, 1, {half}), slice({x}.wide, {half} + 1, {half}), (p, q) -> p ^ q)"
        return f"if(size({x}.wide) = 2 * size({y}.wide), {fold}, {x}.wide)"

    bits = f"aggregate(zip_with({folded('a', 'b')}, {folded('b', 'a')}, (p, q) -> bit_count(p ^ q)), 0, (t, x) -> t + x)"
    near = "size(a.wide) in (size(b.wide), 2 * size(b.wide), cast(size(b.wide) div 2 as int))"
    return f"if({near}, {bits} > (a.size + b.size) * {100 - threshold} div {100 + threshold}, false)"


_KEYED = "n_items long, key long, slice int, counts array<long>"


def _keys(family: Family, id_type):
    """(id, n_items, key) of every text; for a counted family, rows of counts by slice of cells come behind."""

    @lean()
    def run(batches):
        counts, kind = np.zeros(CELLS if family.counted else 0, np.int64), None
        names = ["id", *(x.split()[0] for x in _KEYED.split(", "))]
        for b in small(batches, 1):
            kind, sizes, keys = b.column(0).type, [], []
            for s in family.sets_of(binary_values(b.column(1))):
                sizes.append(len(s))
                keys.append(set_key(s) if len(s) else None)
                if family.counted:
                    np.add.at(counts, cell_of(s), 1)
            none = [pa.nulls(len(sizes), k) for k in (pa.int32(), pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.int64()), *none], names)
        if family.counted and kind is not None:
            rows = CELLS // SLICE
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(rows, kind), pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int64()), pa.array(range(rows), pa.int32()), pa.array(list(counts.reshape(rows, SLICE)), pa.list_(pa.int64()))], names
            )

    return run


def _added(batches):
    """(slice, counts): rows of counts added up; rows of a slice come in order."""
    now, total = None, None
    row = lambda: pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([total], pa.list_(pa.int64()))], ["slice", "counts"])
    for b in batches:
        for at, counts in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            if at != now:
                if now is not None:
                    yield row()
                now, total = at, np.zeros(SLICE, np.int64)
            total = total + np.array(counts, np.int64)
    if now is not None:
        yield row()


def _counted(keyed: DataFrame) -> np.ndarray:
    """How many texts hold an element of each cell: ``CELLS`` numbers, whatever the size of the table."""
    parts = keyed.filter("slice is not null").select("slice", "counts").repartition(partitions(keyed.sparkSession), "slice").sortWithinPartitions("slice")
    out = np.zeros((CELLS // SLICE, SLICE), np.int64)
    for r in parts.mapInArrow(_added, "slice int, counts array<long>").collect():
        out[r.slice] = r.counts
    return out.ravel()


def pack48(x: np.ndarray) -> bytes:
    """The lowest six bytes of every number."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()


def unpack48(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 6, 8), np.uint8)
    out[:, :6] = np.frombuffer(data, np.uint8).reshape(-1, 6)
    return out.view(np.uint64).ravel()


def _bucket(sig: np.ndarray, buckets: int) -> np.ndarray:
    return (sig >> np.uint64(40)) % np.uint64(buckets)


def _group_id(sig: np.ndarray, bucket: np.ndarray) -> np.ndarray:
    """A signature's group: its bucket and the six bytes that travel."""
    return mix64((sig & LOW) + mix64(bucket, 26), 24)


class _Shipment:
    """Signatures of several sets on their way to their buckets.

    Where more than ``hot`` of its sets share a signature, only the first goes to
    the signature's own bucket; the others are dealt evenly, with their group's id.
    """

    def __init__(self, buckets: int, hot: int):
        self.buckets, self.hot = buckets, hot
        self.clear()

    def clear(self) -> None:
        self.seen, self.keys, self.sigs, self.held = set(), [], [], 0

    def add(self, key: int, sigs: list[np.ndarray]) -> None:
        self.seen.add(key)
        self.keys.append(key)
        self.sigs.append(np.concatenate(sigs))
        self.held += len(self.sigs[-1])

    def full(self) -> bool:
        return self.held >= SHIPPED or len(self.keys) >= FLAG - 1

    def rows(self):
        """(bucket, hot, signatures, owners, keys): numbers as bytes; an owner is the place of its set's key."""
        if not self.held:
            return
        keys = np.array(self.keys, np.int64)
        sig, own = np.concatenate(self.sigs), np.repeat(np.arange(len(keys), dtype=np.uint16), list(map(len, self.sigs)))
        order = np.lexsort((own, sig))
        sig, own = sig[order], own[order]
        fresh = np.ones(len(sig), bool)  # a set can hold a signature twice, by chance
        fresh[1:] = (sig[1:] != sig[:-1]) | (own[1:] != own[:-1])
        sig, own = sig[fresh], own[fresh]
        first = np.ones(len(sig), bool)
        first[1:] = sig[1:] != sig[:-1]
        count = np.diff(np.append(np.flatnonzero(first), len(sig)))
        many = np.repeat(count > self.hot, count)
        home = _bucket(sig, self.buckets)
        if many.any():
            away = many & ~first
            dealt = mix64(sig[away] + own[away], 25) % np.uint64(self.buckets)
            yield from self._by_bucket(dealt, 1, _group_id(sig[away], home[away]), own[away], keys)
            sig, own, home = sig[~away], own[~away] | np.where(many[~away], np.uint16(FLAG), np.uint16(0)), home[~away]
        yield from self._by_bucket(home, 0, sig, own, keys)

    @staticmethod
    def _by_bucket(at: np.ndarray, hot: int, sig: np.ndarray, own: np.ndarray, keys: np.ndarray):
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for part in np.split(order, cuts):
            sets, owner = np.unique(own[part] & np.uint16(FLAG - 1), return_inverse=True)
            owner = owner.astype(np.uint16) | (own[part] & np.uint16(FLAG))
            yield int(at[part[0]]), hot, sig[part].tobytes() if hot else pack48(sig[part]), owner.tobytes(), keys[sets].tobytes()


_SHIPPED = "bucket int, hot byte, sigs binary, owners binary, keys binary"


def _signed(family: Family, buckets: int, hot: int):
    """Rows of ``_SHIPPED``: many signatures in each, by bucket, every set once a shipment."""

    def batch(rows) -> pa.RecordBatch:
        kinds = [pa.int32(), pa.int8(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in _SHIPPED.split(", ")])

    @lean()
    def run(batches):
        out = _Shipment(buckets, hot)
        for b in small(batches, 0):
            for s in family.sets_of(binary_values(b.column(0))):
                if not len(s) or (key := set_key(s)) in out.seen:
                    continue
                out.add(key, family.signatures(s))
                if out.full():
                    yield batch(list(out.rows()))
                    out.clear()
        if out.held:
            yield batch(list(out.rows()))

    return run


def _runs(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begins and lengths of the runs that ``first`` marks."""
    begin = np.flatnonzero(first)
    return begin, np.diff(np.append(begin, len(first)))


def groups_of(sig: np.ndarray, key: np.ndarray, flag: np.ndarray):
    """(keys, ends, times) of the groups of two sets or more, each member list once, and the (sig, key) of hot ones."""
    order = np.lexsort((key, sig))
    sig, key, flag = sig[order], key[order], flag[order]
    new = np.ones(len(sig), bool)
    new[1:] = sig[1:] != sig[:-1]
    begin, count = _runs(new)
    hot = np.repeat(np.logical_or.reduceat(flag, begin), count)
    fresh = new.copy()
    fresh[1:] |= key[1:] != key[:-1]
    far = hot & fresh
    sig, key, new = sig[fresh & ~hot], key[fresh & ~hot], new[fresh & ~hot]
    if not len(sig):
        return key, np.empty(0, np.int64), np.empty(0, np.int64), order[far]
    begin, count = _runs(new)
    content = np.add.reduceat(mix64(key.view(np.uint64), 27), begin) + count.astype(np.uint64)
    content[count < 2] = 0
    lists, at, times = np.unique(content, return_index=True, return_counts=True)
    at, times = at[lists != 0], times[lists != 0]
    mine = np.repeat(begin[at] - (np.cumsum(count[at]) - count[at]), count[at]) + np.arange(count[at].sum())
    return key[mine], np.cumsum(count[at]), times, order[far]


_GROUPS = "part long, keys array<long>, ends array<long>, times array<long>, hot_sigs array<long>, hot_keys array<long>"


@lean()
def _met(batches):
    """Rows of ``_GROUPS`` of buckets, which come in order; long ones are cut between groups."""

    def done(bucket: int, held: list):
        plain = [h for h in held if not h[0]]
        key, ends, times, away = np.empty(0, np.int64), [], [], [np.concatenate(x) if x else np.empty(0, t) for x, t in (([h[1] for h in held if h[0]], np.uint64), ([h[2] for h in held if h[0]], np.int64))]
        if plain:
            sig, own, flag = (np.concatenate(x) for x in list(zip(*plain, strict=True))[1:])
            key, ends, times, far = groups_of(sig, own, flag)
            away = [np.concatenate([away[0], _group_id(sig[far], np.full(len(far), bucket, np.uint64))]), np.concatenate([away[1], own[far]])]
        start, number = 0, 0
        while start < len(ends) or (not number and len(away[0])):
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + PART, side="right"))) if len(ends) else 0
            mine = slice(before, int(ends[stop - 1]) if stop else 0)
            hot = away if not number else [x[:0] for x in away]
            yield bucket << 24 | number, key[mine], np.asarray(ends[start:stop], np.int64) - before, times[start:stop], hot[0].view(np.int64), hot[1]
            start, number = max(stop, 1), number + 1

    def batch(rows) -> pa.RecordBatch:
        lists = pa.list_(pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), *(pa.array([r[i] for r in rows], lists) for i in range(1, 6))], [x.split()[0] for x in _GROUPS.split(", ")])

    now, held = None, []
    for b in batches:
        for bucket, hot, sigs, owners, keys in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
            if bucket != now:
                for row in done(now, held) if held else ():
                    yield batch([row])
                now, held = bucket, []
            owner = np.frombuffer(owners, np.uint16)
            key = np.frombuffer(keys, np.int64)[owner & np.uint16(FLAG - 1)]
            held.append((hot, np.frombuffer(sigs, np.uint64) if hot else unpack48(sigs), key, (owner & np.uint16(FLAG)) > 0))
    for row in done(now, held) if held else ():
        yield batch([row])


def _longs(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64, copy=False)


def _lists(batch: pa.RecordBatch, *columns: int):
    """Row by row the named list columns' items, as Arrow slices: a row is a part of many thousand members, and as Python objects a batch of them outgrows a worker."""
    for i in range(batch.num_rows):
        yield [batch.column(c)[i].values for c in columns]


def _weights(batches):
    """(part, key, weight): by part and set, the members that its groups hold, once for every signature."""
    for b in batches:
        for part, row in zip(b.column(0).to_pylist(), _lists(b, 1, 2, 3), strict=True):
            keys, ends, times = map(_longs, row)
            if not len(keys):
                continue
            count = np.diff(ends, prepend=0)
            found, at = np.unique(keys, return_inverse=True)
            weight = np.bincount(at, np.repeat(count * times, count)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(found), part)), pa.array(found), pa.array(weight)], ["part", "key", "weight"])


def _open(tried: int):
    """(part, keys, ends): the groups in which sets are neither all connected nor all compared."""

    @lean()
    def run(batches):
        for b in batches:
            for part, (keys, ends, info) in zip(b.column(0).to_pylist(), _lists(b, 1, 2, 3), strict=True):
                known, root = _sorted_info(info, "root")
                key, end = _longs(keys), _longs(ends)
                root, begin = root[np.searchsorted(known, key)], np.append(0, end[:-1])
                open_ = (np.minimum.reduceat(root, begin) != np.maximum.reduceat(root, begin)) & (end - begin > tried + 1)
                if open_.any():
                    size = (end - begin)[open_]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part], pa.int64()), pa.array([key[np.repeat(open_, end - begin)]], pa.list_(pa.int64())), pa.array([np.cumsum(size)], pa.list_(pa.int64()))], ["part", "keys", "ends"]
                    )

    return run


def _sorted_info(info: pa.StructArray, *columns: str) -> list[np.ndarray]:
    """Keys in order, and the columns of their rows."""
    out = [_longs(info.field(c)) for c in ("key", *columns)]
    order = np.argsort(out[0])
    return [x[order] for x in out]


def _stars(tried: int, width: int, threshold: int):
    """(u, v): members ``tried`` to ``tried + width`` of every group, by weight, each with those not known to be connected to it.

    From the second round on, sizes and sketches come along, and pairs that they
    rule out as links are not made.
    """

    @lean()
    def run(batches):
        for b in batches:
            for keys, ends, info in _lists(b, 0, 1, 2):
                known, weight, root = _sorted_info(info, "weight", "root")
                key, end = _longs(keys), _longs(ends)
                at = np.searchsorted(known, key)
                seg = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
                order = np.lexsort((key, -weight[at], seg))  # groups stay in their places
                key, at = key[order], at[order]
                root = root[at]
                begin = np.append(0, end[:-1])
                open_ = (np.minimum.reduceat(root, begin) != np.maximum.reduceat(root, begin)) & (end - begin > tried + 1)
                if info.type.get_field_index("n") >= 0:
                    sketched = _sorted_info(info, "n", *(f"s{i}" for i in range(WORDS)))[1:]
                    n, bits = sketched[0][at], np.stack(sketched[1:], axis=1)[at].view(np.uint64)
                else:
                    n = bits = None
                u, v = np.empty(0, np.int64), np.empty(0, np.int64)
                for t in range(tried, tried + width):
                    open_ &= end - begin > t
                    if not open_.any():
                        break
                    mine = np.flatnonzero(open_[seg])
                    head = np.repeat(begin[open_] + t, (end - begin)[open_])
                    far = root[head] != root[mine]
                    head, mine = head[far], mine[far]
                    if n is not None:
                        near = 100 * np.minimum(n[head], n[mine]) >= threshold * np.maximum(n[head], n[mine])
                        near &= np.bitwise_count(bits[head] ^ bits[mine]).sum(axis=1, dtype=np.int64) <= (n[head] + n[mine]) * (100 - threshold) // (100 + threshold)
                        head, mine = head[near], mine[near]
                    u, v = np.concatenate([u, key[head]]), np.concatenate([v, key[mine]])
                    if len(u) > 4 * PART:
                        u, v = _distinct(u, v)
                u, v = _distinct(u, v)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

    return run


def _distinct(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    u, v = np.minimum(u, v), np.maximum(u, v)
    order = np.lexsort((v, u))
    u, v = u[order], v[order]
    new = np.ones(len(u), bool)
    new[1:] = (u[1:] != u[:-1]) | (v[1:] != v[:-1])
    return u[new], v[new]


def _sets(family: Family):
    """Rows (key, items, s0, s1 ...) of the documents given: sets and their sketches."""

    @lean()
    def run(batches):
        for b in small(batches, 0):
            texts = binary_values(b.column(0))
            for span in batches_of(texts, 4_000_000):
                done, keys, items, bits, wides = set(), [], [], [], []
                for s in family.sets_of([texts[i] for i in span]):
                    if len(s) and (key := set_key(s)) not in done:
                        done.add(key)
                        keys.append(key)
                        items.append(s.view(np.int64))
                        bits.append(sketch(s))
                        wides.append(wide_sketch(s))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys, pa.int64()), pa.array(items, pa.list_(pa.int64())), pa.array(wides, pa.list_(pa.int64())), *(pa.array([b[i] for b in bits], pa.int64()) for i in range(WORDS))],
                    ["key", "items", "wide", *(f"s{i}" for i in range(WORDS))],
                )

    return run


def components(docs: DataFrame, family: Family, *, id_col: str, text_col: str, hot: int | None = None) -> DataFrame:
    """(id, n_items, component_id) for every row of ``docs``.

    component_id is the least id reachable by links. A text whose set is empty
    links with nothing and keeps its own id. Rows with a null id take part; their
    id counts only if all of a component are null. Rows repeated come back
    repeated. Texts are taken whole, however long. Other columns are ignored,
    whatever their names; an empty table gives an empty one. Sets are told apart
    by a 64-bit hash. ``hot`` is the number of sets of a shipment from which a
    signature they share is spread; by default it follows the size of the table,
    so that no bucket outgrows its task.
    """
    spark = docs.sparkSession
    work = Workspace(spark, "jaccard")
    narrow = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    id_type = narrow.schema["id"].dataType
    keyed = work.put(narrow.mapInArrow(_keys(family, id_type), f"id {id_type.simpleString()}, {_KEYED}"))
    if family.counted:
        family = family.with_counts(_counted(keyed))
    keyed = keyed.filter("slice is null").select("id", "n_items", "key")
    total = keyed.agg(F.sum("n_items")).first()[0] or 0
    threshold = family.threshold
    buckets = max(8 * partitions(spark), total // BUCKET + 1)
    hot = max(1, BUCKET // (4 * partitions(spark) + total // SHIPPED)) if hot is None else hot
    shipped = narrow.select("text").mapInArrow(_signed(family, buckets, hot), _SHIPPED)
    groups = work.put(shipped.repartition(partitions(spark), "bucket").sortWithinPartitions("bucket").mapInArrow(_met, _GROUPS))
    weighed = work.put(groups.select("part", "keys", "ends", "times").mapInArrow(_weights, "part long, key long, weight long"))
    spread = work.put(groups.select(F.explode(F.arrays_zip("hot_sigs", "hot_keys")).alias("h")).select(F.col("h.hot_sigs").alias("sig"), F.col("h.hot_keys").alias("key")).distinct())
    groups = groups.filter("size(keys) > 0").select("part", "keys", "ends")
    rank = weighed.select("key", "weight")
    any_spread = spread.limit(1).count() > 0
    if any_spread:
        of_sig = spread.groupBy("sig").agg(F.count("*").alias("weight"))
        rank = rank.unionByName(spread.join(of_sig, "sig").select("key", "weight"))
    rank = work.put(rank.groupBy("key").agg(F.sum("weight").alias("weight")))
    sets = _candidates(narrow, keyed, rank.select("key"), family, id_type, work)
    bits = [f"s{i}" for i in range(WORDS)]
    members = work.put(sets.select("key", F.size("items").alias("n"), *bits).join(rank, "key"))

    links, roots, tried, width = [], None, 0, 1
    while True:
        now = members if roots is None else members.join(roots, members.key == roots.node, "left").drop("node")
        now = now.withColumn("root", F.coalesce("root", "key") if roots is not None else F.col("key"))
        if tried:
            groups = work.put(_informed(groups, weighed, now.select("key", "root")).mapInArrow(_open(tried), "part long, keys array<long>, ends array<long>"))
            weighed = work.put(groups.select("part", F.explode(F.array_distinct("keys")).alias("key")))
        state = now.select("key", "weight", "root", *(["n", *bits] if tried else []))
        near = _informed(groups, weighed, state).select("keys", "ends", "info").mapInArrow(_stars(tried, width, threshold), "u long, v long")
        if any_spread:
            near = near.unionByName(_spread_stars(spread.join(now, "key"), tried, width, threshold, bits))
        tested = work.put(near.distinct())
        compared = tested.limit(1).count()
        if not compared and not (tried and groups.limit(1).count()) and not (any_spread and _still_open(spread.join(now.select("key", "root"), "key"), tried).limit(1).count()):
            break
        if compared:
            found = work.put(_linked(tested, members, sets, bits, threshold, work))
            links.append(found)
            if found.limit(1).count():
                edges = links[0]
                for more in links[1:]:
                    edges = edges.union(more)
                roots = connected(edges, work)
        work.drop(tested)
        tried, width = tried + width, 16 * width

    filled = keyed.filter("key is not null")
    nodes = filled.groupBy("key").agg(F.min("id").alias("least"))
    if roots is None:
        least = nodes.select("key", F.col("least").alias("component_id"))
    else:
        rooted = nodes.join(roots, nodes.key == roots.node, "left").select("key", "least", F.coalesce("root", "key").alias("root"))
        of_root = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
        least = rooted.join(of_root, "root").select("key", "component_id")
    empty = keyed.filter("key is null").select("id", "n_items", F.col("id").alias("component_id"))
    out = work.put(filled.join(least, "key").select("id", "n_items", "component_id").unionByName(empty))
    work.only(out)
    return out.select(F.col("id").alias(id_col), "n_items", "component_id")


def _candidates(narrow: DataFrame, keyed: DataFrame, wanted: DataFrame, family: Family, id_type: T.DataType, work: Workspace) -> DataFrame:
    """The sets whose keys are ``wanted``, once each, with their sketches."""
    few = wanted.count() <= BROADCAST_IDS
    ids = keyed.join(F.broadcast(wanted) if few else wanted, "key", "left_semi").groupBy("key").agg(F.min("id").alias("id")).select("id")
    # at most one id a key: as few as the keys, and of a fixed size if they are numbers
    fixed = all(isinstance(k, (T.NumericType, T.BooleanType)) for k in ([f.dataType for f in id_type.fields] if isinstance(id_type, T.StructType) else [id_type]))
    some = narrow.join(F.broadcast(ids) if few and fixed else ids, "id", "left_semi")
    if keyed.filter("id is null and key is not null").limit(1).count():
        some = some.unionByName(narrow.filter("id is null"))
    sets = work.put(some.select("text").mapInArrow(_sets(family), f"key long, items array<long>, wide array<long>, {', '.join(f's{i} long' for i in range(WORDS))}"))
    if sets.select("key").distinct().count() < sets.count():  # repeated ids
        sets = work.put(sets.dropDuplicates(["key"]))
    return sets


def _informed(groups: DataFrame, weighed: DataFrame, state: DataFrame) -> DataFrame:
    """Groups with what is known of their members: a part's rows are bounded, as its members are."""
    info = weighed.select("part", "key").join(state, "key").groupBy("part").agg(F.collect_list(F.struct(*state.columns)).alias("info"))
    return groups.select("part", "keys", "ends").join(info, "part").select("part", "keys", "ends", "info")


def _still_open(now: DataFrame, tried: int) -> DataFrame:
    """Spread signatures whose sets are neither all connected nor all compared."""
    found = now.groupBy("sig").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("members"))
    return found.filter((F.col("lo") != F.col("hi")) & (F.col("members") > tried + 1)).select("sig")


def _allowed(bits: list[str], threshold: int) -> str:
    """SQL: that sizes and short sketches of rows a and b allow a link."""
    differ = " + ".join(f"bit_count(a.{x} ^ b.{x})" for x in bits)
    return f"100 * least(a.n, b.n) >= {threshold} * greatest(a.n, b.n) and {differ} <= (a.n + b.n) * {100 - threshold} div {100 + threshold}"


def _spread_stars(now: DataFrame, tried: int, width: int, threshold: int, bits: list[str]) -> DataFrame:
    """The pairs of ``_stars`` for groups whose members are spread over rows (sig, key, weight, root, n, sketch)."""
    now = now.join(_still_open(now, tried), "sig", "left_semi")
    heads = now.withColumn("at", F.expr("row_number() over (partition by sig order by weight desc, key)")).filter((F.col("at") <= tried + width) & (F.col("at") > tried))
    pairs = heads.alias("a").join(now.alias("b"), F.expr(f"a.sig = b.sig and a.root != b.root and {_allowed(bits, threshold)}"))
    return pairs.select(F.least("a.key", "b.key").alias("u"), F.greatest("a.key", "b.key").alias("v"))


def _linked(pairs: DataFrame, members: DataFrame, sets: DataFrame, bits: list[str], threshold: int, work: Workspace) -> DataFrame:
    """The pairs (u, v) that link: sizes and short sketches go first, then sketches of the sets' size, then the sets.

    A set with many pairs is repeated for every ``SPREAD`` of them, so none gathers them in one task.
    """
    sketched = pairs.join(members.alias("a"), F.expr("u = a.key")).join(members.alias("b"), F.expr(f"v = b.key and {_allowed(bits, threshold)}"))
    sketched = sketched.select("u", "v", F.col("a.n").alias("un"), F.col("b.n").alias("vn"))
    a, b = (sets.select(F.col("key").alias(x), F.col("wide").alias(f"{x}w")) for x in "uv")
    wide = sketched.join(a, "u").join(b, "v").select("u", "v", F.struct(F.col("uw").alias("wide"), F.col("un").alias("size")).alias("a"), F.struct(F.col("vw").alias("wide"), F.col("vn").alias("size")).alias("b"))
    pairs = work.put(wide.filter(f"not {_far_apart(threshold)}").select("u", "v"))
    # the one of a pair that has more pairs is the head, which is repeated; the other's set travels
    of_set = pairs.select(F.col("u").alias("key")).unionAll(pairs.select(F.col("v").alias("key"))).groupBy("key").agg(F.count("*").alias("number"))
    counted = pairs.join(of_set.select(F.col("key").alias("u"), F.col("number").alias("un")), "u").join(of_set.select(F.col("key").alias("v"), F.col("number").alias("vn")), "v")
    counted = counted.selectExpr("u", "v", "if(un >= vn, u, v) as head", "if(un >= vn, v, u) as other", f"greatest(un, vn) div {SPREAD} + 1 as parts")
    dealt = counted.withColumn("part", F.expr("pmod(xxhash64(other), parts)"))
    heads = sets.select(F.col("key").alias("head"), F.col("items").alias("left")).join(counted.groupBy("head").agg(F.max("parts").alias("parts")), "head")
    heads = heads.select("head", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), "left")
    right = dealt.join(sets.select(F.col("key").alias("other"), F.col("items").alias("right")), "other").select("u", "v", "head", "part", "right")
    both = right.join(heads, ["head", "part"]).withColumn("both", F.size(F.array_intersect("left", "right")))
    return both.filter(F.expr(f"100 * both >= {threshold} * (size(left) + size(right) - both)")).select("u", "v")
