"""What the text operators share: word rules, hashing, shared-folder tables."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import uuid
from collections.abc import Callable
from contextlib import contextmanager, suppress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of bytes other than space and \t \n \v \f \r, which is what
#: ``bytes.split()`` yields; the Spark side uses this pattern.
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
SPACE_PATTERN = r"[\x20\x09-\x0D]+"

_M1 = np.uint64(0xBF58476D1CE4E5B9)
_M2 = np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix64(x: np.ndarray, salt: int = 0) -> np.ndarray:
    """Finalise 64-bit values into well-spread hashes; wraps silently."""
    x = x + np.uint64((salt * 0x9E3779B97F4A7C15 + 0x632BE59BD9B4E019) & 0xFFFFFFFFFFFFFFFF)
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))


def roll(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive entries of h."""
    out = mix64(h[: len(h) - n + 1], 1)
    for i in range(1, n):
        out = mix64(out * _GOLD + h[i : len(h) - n + 1 + i], i + 1)
    return out


def binary_values(column: pa.Array) -> list[bytes | None]:
    """A string column's values as UTF-8 bytes, without decoding them."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def batches_of(values: list, size: int):
    """Index ranges of consecutive values that hold about ``size`` bytes together."""
    start, held = 0, 0
    for i, v in enumerate(values):
        held += len(v) if v is not None else 0
        if held >= size:
            yield range(start, i + 1)
            start, held = i + 1, 0
    if start < len(values):
        yield range(start, len(values))


def slices_of(batch: pa.RecordBatch, column: int, size: int):
    """Consecutive slices of a batch whose texts hold about ``size`` bytes together."""
    held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    cuts = [0, *(np.flatnonzero(np.diff(held // size)) + 1).tolist(), len(held)]
    for start, stop in zip(cuts[:-1], cuts[1:], strict=True):
        if stop > start:
            yield batch.slice(start, stop - start)


#: What operators keep in a worker between tasks, and how it is dropped.
_KEPT: dict[str, Callable[[], None]] = {}


def keeps(name: str, drop: Callable[[], None]) -> None:
    """Says that an operator keeps something in workers, which others may drop."""
    _KEPT[name] = drop


def settle(name: str = "") -> None:
    """At a task's start: drops what other operators kept in this worker, and gives freed memory back.

    Workers outlive tasks and stages, so without this one stage's caches count
    against the next one's memory.
    """
    for other, drop in _KEPT.items():
        if other != name:
            drop()
    pa.default_memory_pool().release_unused()
    with suppress(AttributeError, OSError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(name: str = ""):
    """Settles the worker before and after a function over Arrow batches."""

    def wrap(run):
        def inner(batches):
            settle(name)
            yield from run(batches)
            settle(name)

        return inner

    return wrap


def small(batches, column: int, size: int = 2_000_000):
    """The batches in slices whose texts hold about ``size`` bytes together, as a batch of long texts outgrows a worker."""
    for b in batches:
        yield from slices_of(b, column, size)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_key(id_col: str, text_col: str):
    """Identity of a row: rows with equal id and text are one document."""
    return F.xxhash64(F.col(f"`{id_col}`"), F.col(f"`{text_col}`"))


_ROOTS: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that all nodes share, as the cluster names it; one of our own only on a single machine."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all nodes share")
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        _ROOTS[app] = tempfile.mkdtemp(prefix="aquilith-")
    return f"file://{_ROOTS[app]}"


#: Rows that Spark sends to a Python worker at once while a table is written. Ten thousand, its own
#: default, are 30 MB of ordinary texts and more of long ones, in the JVM's direct memory and in the worker's.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def bound_batches(spark: SparkSession) -> str:
    """Fewer rows a batch from now on, unless the session asks for fewer still; gives the setting before."""
    before = spark.conf.get(_BATCH)
    spark.conf.set(_BATCH, str(min(BATCH_ROWS, int(before)) if int(before) > 0 else BATCH_ROWS))
    return before


@contextmanager
def small_batches(spark: SparkSession):
    """``bound_batches`` while the block runs."""
    before = bound_batches(spark)
    try:
        yield
    finally:
        spark.conf.set(_BATCH, before)


class Workspace:
    """Tables written to the shared folder: each cuts the lineage above it.

    A written table survives lost executors, and its size on disk is known
    to the planner. ``drop`` removes one that is no longer read, ``only`` all but
    those that a lazily returned result reads; these go when the driver exits.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.path = spark, f"{shared_folder(spark)}/aquilith-{name}-{uuid.uuid4().hex}"
        self.count, self.held = 0, set()
        atexit.register(self.clear)

    def put(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.path}/{self.count:04d}"
        with small_batches(self.spark):
            df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._aquilith_path = path
        self.held.add(path)
        return out

    def _delete(self, path: str) -> None:
        jvm = self.spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)

    def drop(self, table: DataFrame) -> None:
        self._delete(table._aquilith_path)
        self.held.discard(table._aquilith_path)

    def only(self, *tables: DataFrame) -> None:
        """Removes all tables but these."""
        kept = {t._aquilith_path for t in tables}
        for path in self.held - kept:
            self._delete(path)
        self.held &= kept

    def clear(self) -> None:
        with suppress(Exception):  # the JVM may be gone at exit
            self._delete(self.path)


def connected(edges: DataFrame, work: Workspace) -> DataFrame:
    """Components of an edge list (u, v: long) as (node, root), root the least node.

    Every round each node takes the least label among its neighbours and its
    label's own label, so that chains halve. Nothing is collected but one
    count a round.
    """
    both = work.put(edges.select("u", "v").union(edges.select(F.col("v"), F.col("u"))).distinct())
    labels = work.put(both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.col("u")).alias("root")))
    while True:
        near = (
            both.join(labels.select(F.col("node").alias("v"), F.col("root").alias("r")), "v")
            .groupBy(F.col("u").alias("node"))
            .agg(F.min("r").alias("near"))
        )
        up = labels.select(F.col("node").alias("root"), F.col("root").alias("up"))
        stepped = (
            labels.join(near, "node")
            .join(up, "root", "left")
            .select("node", "root", F.least("root", "near", F.coalesce("up", "root")).alias("new"))
        )
        new = work.put(stepped)
        work.drop(labels)
        labels = new.select("node", F.col("new").alias("root"))
        labels._aquilith_path = new._aquilith_path
        if not new.filter("new != root").limit(1).count():
            work.drop(both)
            return labels


#: Of a join's rows, a key that holds more than one in so many is hot, so there are fewer hot keys than this.
HOT_SHARE = 1000


def hot_keys(counts: DataFrame, key: str, rows: str) -> DataFrame:
    """The keys that hold more than 1/HOT_SHARE of all rows; ``counts`` has each key's number of ``rows``."""
    total = counts.agg(F.sum(rows)).first()[0] or 0
    return counts.filter(F.col(rows) > total / HOT_SHARE).select(key)


def spread_join(many: DataFrame, one: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """``many`` joined with ``one`` (unique in ``key``) without dealing a hot key's rows to one task.

    Hot keys are under HOT_SHARE in number, so their rows of ``one`` are broadcast and
    their rows of ``many`` stay where they are; all other keys are shuffled.
    """
    met = F.broadcast(hot)
    hotly = many.join(F.broadcast(one.join(met, key, "left_semi")), key)
    return hotly.unionByName(many.join(met, key, "left_anti").join(one.join(met, key, "left_anti"), key))
