"""Upserts as DataFrame plans: the state after a merge, from the state before it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .route import KEY, ORDER, latest


#: What tells log rows apart. Offsets begin anew where a topic is made again, so a
#: position alone does not; a row delivered twice agrees in all of these.
IDENTITY = ("kafka_partition", "kafka_offset", "kafka_timestamp", "ingest_timestamp", "raw_payload")


def identity(*tables: DataFrame | list[str]) -> tuple[str, ...]:
    """The columns of ``IDENTITY`` that all the tables, or lists of columns, have."""
    return tuple(c for c in IDENTITY if all(c in (t if isinstance(t, list) else t.columns) for t in tables))


def newest(df: DataFrame, keys: tuple[str, ...] = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The latest row of each key; rows with a null key never match and all stay."""
    return latest(df.dropna(subset=list(keys)), keys, order).unionByName(df.filter(" or ".join(f"{k} is null" for k in keys)))


def merge_latest(target: DataFrame, source: DataFrame, keys: tuple[str, ...] = KEY, order: tuple[str, ...] = ORDER) -> DataFrame:
    """The target with the source's rows inserted, or updating where they are newer.

    The source is deduplicated first and ties keep the target's row, so a merge
    repeated changes nothing. Rows with a null key never match: such source rows
    are inserted.
    """
    news = newest(source, keys, order)
    both = target.withColumn("_old", F.lit(1)).unionByName(news.withColumn("_old", F.lit(0)))
    keyed = both.dropna(subset=list(keys))
    merged = latest(keyed, keys, (*order, "_old"))
    return merged.unionByName(both.filter(" or ".join(f"{k} is null" for k in keys))).drop("_old")


def insert_absent(target: DataFrame, source: DataFrame, keys: tuple[str, ...] | None = None) -> DataFrame:
    """The source rows whose keys, nulls equal, the target lacks; one a key.

    Without ``keys`` these are a log row's ``IDENTITY``, as far as both have it. (meter,
    time, offset) alone would lose rows: offsets repeat over partitions, and failed
    payloads have no meter or time.
    """
    keys = identity(target, source) if keys is None else keys
    t = target.select(*[F.col(k).alias(f"_{k}") for k in keys]).distinct()
    on = None
    for k in keys:
        same = source[k].eqNullSafe(t[f"_{k}"])
        on = same if on is None else on & same
    return source.join(t, on, "left_anti").dropDuplicates(list(keys))
