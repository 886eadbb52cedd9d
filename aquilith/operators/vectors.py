"""Nearest vectors by cosine: exactly, and through a fitted index of inverted lists.

Both join a table of queries with a table of vectors in blocks. Vectors of a list
are dealt to blocks of at most ``rows`` rows and its queries to blocks as well; every
pair of blocks meets in one task as two matrices, which sends k rows a query. So a
list that holds a third of all vectors is many tasks, and nothing passes through
the driver. The exact search is the same join with one list.

The index is fitted on a bounded sample: the ``SAMPLE`` vectors with the least
hash of their ids, in which spherical k-means finds the lists' centroids. Every vector
is then put into the list of its nearest centroid; a query probes the lists of its
nearest centroids, and what these hold is ranked exactly. How many it probes is
fitted too: as many as the sample's own neighbours need for the recall asked for, which
is few where vectors lie in groups and most of the lists where they do not.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Vectors that the centroids are fitted on, at most, and lists, at most.
SAMPLE, MOST_LISTS = 20_000, 1024
#: Rows of a block.
ROWS = 8192


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """A column of vectors of one length as rows, scaled to unit length; rows of length 0 stay so."""
    whole = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    x = whole.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(whole), -1) if len(whole) else np.zeros((0, 1))
    norm = np.sqrt((x * x).sum(axis=1))
    return x / np.where(norm > 0, norm, 1)[:, None]


def _named(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, vector) of the rows with a vector that is not null and not of length 0."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    return rows.filter(F.col("vector").isNotNull() & F.exists("vector", lambda x: x != 0))


def _blocks(lists: DataFrame, rows: int) -> DataFrame:
    """(list, n): how many blocks the rows of each list make."""
    return lists.groupBy("list").agg(F.ceil(F.count("*") / rows).cast("int").alias("n"))


def _nearest(k: int):
    def run(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        ids, asked = (t.column("id").to_numpy().astype(np.int64) for t in (vectors, queries))
        out: list[list[np.ndarray]] = [[], [], []]
        if len(ids) and len(asked):
            x, q = _matrix(vectors.column("vector")), _matrix(queries.column("vector"))
            for start in range(0, len(q), 512):
                own = asked[start : start + 512]
                cosine = np.round(q[start : start + 512] @ x.T, 12)
                cosine[own[:, None] == ids[None, :]] = -np.inf
                if k < len(ids):  # ties at the k-th place all come along
                    bar = np.partition(cosine, -k, axis=1)[:, -k]
                    row, at = np.nonzero((cosine >= bar[:, None]) & np.isfinite(cosine))
                else:
                    row, at = np.nonzero(np.isfinite(cosine))
                value = cosine[row, at]
                order = np.lexsort((ids[at], -value, row))
                row, at, value = row[order], at[order], value[order]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                keep = place < k
                for part, v in zip(out, (own[row[keep]], ids[at[keep]], value[keep]), strict=True):
                    part.append(v)
        columns = [np.concatenate(p) if p else np.zeros(0) for p in out]
        return pa.table({"query_id": pa.array(columns[0], pa.int64()), "id": pa.array(columns[1], pa.int64()), "cosine": pa.array(columns[2], pa.float64())})

    return run


def _met(vectors: DataFrame, queries: DataFrame, k: int, rows: int) -> DataFrame:
    """(query_id, id, cosine, rank) of (list, id, vector) rows on both sides, by pairs of blocks of a list.

    The sizes of the lists are a row a list, at most ``MOST_LISTS``, so they are broadcast.
    """
    nv, nq = _blocks(vectors, rows).withColumnRenamed("n", "nv"), _blocks(queries, rows).withColumnRenamed("n", "nq")
    sizes = F.broadcast(nv.join(nq, "list"))
    at = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    v = vectors.join(sizes, "list").select("list", at("nv").alias("v"), every("nq").alias("q"), "id", "vector")
    q = queries.join(sizes, "list").select("list", at("nq").alias("q"), every("nv").alias("v"), "id", "vector")
    near = v.groupBy("list", "v", "q").cogroup(q.groupBy("list", "v", "q")).applyInArrow(_nearest(k), "query_id long, id long, cosine double")
    best = Window.partitionBy("query_id").orderBy(F.desc("cosine"), "id")
    return near.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def top_similar(vectors: DataFrame, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", block_bytes: int = 4_000_000) -> DataFrame:
    """(query_id, id, cosine, rank): the k nearest of all vectors for each stated query, exactly.

    Queries are a table of any size; blocks hold ``block_bytes`` of vectors at most. Ids are
    whole numbers, unique on each side, vectors of one length; null vectors and those of length 0
    are near nothing. Cosines are rounded to 12 places, ties go by id.
    """
    kind = vectors.schema[id_col].dataType.simpleString()
    length = vectors.agg(F.max(F.size(F.col(f"`{vector_col}`")))).first()[0] or 1
    rows = max(1, block_bytes // (16 * max(length, 1)))
    one = lambda df: _named(df, id_col, vector_col).select(F.lit(0).alias("list"), "id", "vector")
    found = _met(one(vectors), one(queries), k, rows)
    return found.select(F.col("query_id").cast(kind).alias("query_id"), F.col("id").cast(kind).alias(id_col), "cosine", "rank")


def centroids_of(sample: np.ndarray, lists: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from evenly drawn rows; a list that empties keeps its centroid."""
    centroids = sample[np.linspace(0, len(sample) - 1, min(lists, len(sample))).astype(int)]
    for _ in range(rounds):
        own = (sample @ centroids.T).argmax(axis=1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, sample)
        norm = np.sqrt((sums * sums).sum(axis=1))
        centroids = np.where(norm[:, None] > 0, sums / np.where(norm > 0, norm, 1)[:, None], centroids)
    return centroids


def fitted_probes(sample: np.ndarray, centroids: np.ndarray, recall: float, k: int = 10, asked: int = 256) -> int:
    """The least number of probes that finds this share of some rows' k nearest within the sample."""
    if len(sample) <= 1:
        return 1
    rows = np.unique(np.linspace(0, len(sample) - 1, asked).astype(int))
    cosine = sample[rows] @ sample.T
    cosine[np.arange(len(rows)), rows] = -np.inf
    k = min(k, len(sample) - 1)
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    own = (sample @ centroids.T).argmax(axis=1)
    place = np.argsort(np.argsort(-(sample[rows] @ centroids.T), axis=1, kind="stable"), axis=1)
    needed = np.sort(np.take_along_axis(place, own[near], 1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))) - 1)]) + 1


def _probed(centroids: np.ndarray, probes: int):
    """Each row's nearest lists, a row each."""

    def run(batches):
        for b in batches:
            x = _matrix(b.column(1))
            if len(x):
                cosine = np.round(x @ centroids.T, 12)
                lists = np.argsort(-cosine, axis=1, kind="stable")[:, :probes]
                take = pa.array(np.repeat(np.arange(len(x)), lists.shape[1]))
                yield pa.RecordBatch.from_arrays([pa.array(lists.ravel().astype(np.int32)), b.column(0).take(take), b.column(1).take(take)], ["list", "id", "vector"])

    return run


class VectorIndex:
    """An index in a folder: ``centroids`` (one row a list) and ``lists`` (every vector once)."""

    def __init__(self, spark: SparkSession, path: str, *, rows: int = ROWS):
        self.spark, self.path, self.rows = spark, path.rstrip("/"), rows
        self._centroids: np.ndarray | None = None
        self._probes = 1

    def build(self, vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", lists: int | None = None, sample: int = SAMPLE, recall: float = 0.95) -> VectorIndex:
        """Fits and fills the index; ``lists`` is the root of the number of vectors by default, and MOST_LISTS at most; ``recall`` is what the probes are fitted to on the sample."""
        named = _named(vectors, id_col, vector_col)
        n = named.count()
        lists = min(MOST_LISTS, lists or max(1, round(n**0.5)))
        drawn = named.orderBy(F.xxhash64("id"), "id").limit(sample).select("vector").toArrow()
        known = _matrix(drawn.column(0))
        centroids = centroids_of(known, lists) if n else np.zeros((0, 1))
        probes = fitted_probes(known, centroids, recall) if n else 1
        self.spark.createDataFrame([(i, c.tolist(), probes) for i, c in enumerate(centroids)], "list int, centroid array<double>, probes int").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/centroids")
        self._centroids, self._probes = centroids, probes
        filled = self._in_lists(named, 1)
        # a list in segments, so that a great one is not one file
        filled.withColumn("segment", F.pmod(F.xxhash64("id"), F.lit(16))).repartition("list", "segment").drop("segment").sortWithinPartitions("list").write.mode("overwrite").parquet(f"{self.path}/lists")
        return self

    def centroids(self) -> np.ndarray:
        if self._centroids is None:
            rows = self.spark.read.parquet(f"{self.path}/centroids").orderBy("list").collect()  # MOST_LISTS rows
            self._centroids, self._probes = np.array([r.centroid for r in rows]) if rows else np.zeros((0, 1)), rows[0].probes if rows else 1
        return self._centroids

    def _in_lists(self, named: DataFrame, probes: int) -> DataFrame:
        centroids = self.centroids()
        if not len(centroids):
            return self.spark.createDataFrame([], "list int, id long, vector array<double>")
        return named.mapInArrow(_probed(centroids, probes), "list int, id long, vector array<double>")

    def search(self, queries: DataFrame, k: int, *, id_col: str = "vec_id", vector_col: str = "embedding", probes: int | None = None) -> DataFrame:
        """(query_id, id, cosine, rank): the k nearest of what the ``probes`` nearest lists hold, as many as were fitted by default.

        With as many probes as lists the answer is exact. Nulls and ties are as for ``top_similar``.
        """
        self.centroids()
        asked = self._in_lists(_named(queries, id_col, vector_col), probes or self._probes)
        found = _met(self.spark.read.parquet(f"{self.path}/lists"), asked, k, self.rows)
        return found.withColumnRenamed("id", id_col)


def recall(found: DataFrame, exact: DataFrame, id_col: str = "vec_id") -> float:
    """The share of the exact answers that were found."""
    n = exact.count()
    return exact.join(found, ["query_id", id_col], "left_semi").count() / n if n else 1.0
