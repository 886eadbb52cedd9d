"""Pipeline settings, from keywords, Spark conf or JSON."""

from __future__ import annotations

import argparse
import json
from dataclasses import dataclass, fields

from pyspark.sql import SparkSession

PREFIX = "aquilith."


@dataclass(frozen=True)
class Config:
    catalog: str = ""
    lookback_days: int = 3
    watermark_hours: int = 24
    max_clock_skew_hours: int = 1
    max_plausible_liters: float = 1e9
    max_offsets_per_trigger: int = 2_000_000
    namespace: str = ""
    topic: str = ""
    consumer_group: str = "bronze-streaming"
    secret_scope: str = ""
    trigger: str = "30 seconds"

    def guard(self) -> Config:
        """Reconciliation must look back further than the watermark waits."""
        if self.lookback_days * 24 <= self.watermark_hours:
            raise ValueError(f"a lookback of {self.lookback_days} days must exceed the watermark of {self.watermark_hours} hours")
        return self

    @classmethod
    def _of(cls, found: dict) -> Config:
        kinds = {f.name: type(f.default) for f in fields(cls)}
        return cls(**{k: kinds[k](v) for k, v in found.items() if k in kinds and v is not None})

    @classmethod
    def from_conf(cls, spark: SparkSession) -> Config:
        """Keys ``aquilith.<name>``, also under ``bronze.`` or ``silver.``."""
        found = {}
        for f in fields(cls):
            for part in ("", "bronze.", "silver."):
                found[f.name] = spark.conf.get(f"{PREFIX}{part}{f.name}", None) or found.get(f.name)
        return cls._of(found)

    @classmethod
    def from_json(cls, text: str) -> Config:
        return cls._of({k.rpartition(".")[2]: v for k, v in json.loads(text).items()})

    @classmethod
    def from_args(cls, argv: list[str]) -> Config:
        parser = argparse.ArgumentParser(prog="reconcile")
        parser.add_argument("--catalog", required=True)
        for name in ("lookback_days", "watermark_hours", "max_clock_skew_hours", "max_plausible_liters"):
            default = getattr(cls, name)
            parser.add_argument(f"--{name.replace('_', '-')}", type=type(default), default=default)
        return cls(**vars(parser.parse_args(argv)))

    #: When the reconciliation runs, in UTC: a cron line, minute first.
    schedule = "30 2 * * *"

    def table(self, schema: str, name: str) -> str:
        return ".".join(x for x in (self.catalog, schema, name) if x)
