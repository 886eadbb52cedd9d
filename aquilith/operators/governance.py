"""Row filters, masks and storage tiers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .vectors import top_similar


def row_filter(df: DataFrame, entitlements: DataFrame, user: str, on: str = "region") -> DataFrame:
    """The rows whose region the user is entitled to."""
    return df.join(entitlements.filter(F.col("user") == user).select(on).distinct(), on, "left_semi").select(*df.columns)


def masked(df: DataFrame, *, tag: str = "pii", columns: tuple[str, ...] = ()) -> DataFrame:
    """``df`` with the named columns, and those whose metadata carry the tag, replaced by their digests."""
    tagged = {f.name for f in df.schema.fields if tag in f.metadata.values() or f.metadata.get(tag)}
    return df.select(*[F.sha2(F.col(c).cast("string"), 256).alias(c) if c in tagged or c in columns else F.col(c) for c in df.columns])


def expired(df: DataFrame, today: date | str, *, cool_days: int = 90, archive_days: int = 365) -> DataFrame:
    """(ingest_date, tier) of each partition date: hot, cool or archive."""
    age = F.datediff(F.lit(today).cast("date"), F.col("ingest_date"))
    return df.select("ingest_date").distinct().withColumn("tier", F.when(age > archive_days, "archive").when(age > cool_days, "cool").otherwise("hot"))


__all__ = ["expired", "masked", "row_filter", "top_similar"]
