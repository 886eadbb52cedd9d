"""``python -m aquilith.sources.generate``: meters and their readings as JSON lines."""

from __future__ import annotations

import argparse
import sys
from datetime import UTC, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from ..schemas import EVENT
from ..session import build
from .synthetic import leaking, meters, readings
from .tables import write_jsonl


def arguments(parser: argparse.ArgumentParser, hours: float) -> argparse.ArgumentParser:
    """The arguments that this and the simulator share."""
    parser.add_argument("--meters", type=int, default=1000)
    parser.add_argument("--hours", type=float, default=hours)
    parser.add_argument("--leak-rate", type=float, default=0.01, help="share of meters that may leak")
    parser.add_argument("--seed", type=int, default=42)
    return parser


def population(spark: SparkSession, args: argparse.Namespace, start: datetime | None = None) -> tuple[DataFrame, DataFrame]:
    """(master, events) from the arguments; events start with the hour."""
    start = start or datetime.now(UTC).replace(minute=0, second=0, microsecond=0)
    master = meters(spark, args.meters, args.seed, str(start.date()))
    events = readings(master, start, start + timedelta(hours=args.hours), leaks=leaking(master, args.leak_rate, args.seed), seed=args.seed)
    return master, events.select(*EVENT.fieldNames())


def main(argv: list[str], spark: SparkSession | None = None) -> None:
    parser = arguments(argparse.ArgumentParser(prog="generate"), 24)
    parser.add_argument("--out-dir", default="mock_data")
    args = parser.parse_args(argv)
    master, events = population(spark or build(), args)
    write_jsonl(master, f"{args.out_dir}/meter_master.jsonl")
    write_jsonl(events, f"{args.out_dir}/readings.jsonl")


if __name__ == "__main__":
    main(sys.argv[1:])
