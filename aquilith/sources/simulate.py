"""``python -m aquilith.sources.simulate``: events as keyed log batches, from JSON lines or generated."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from ..schemas import EVENT
from ..session import build
from .generate import arguments, population
from .log import publish
from .tables import read_jsonl


def parse(argv: list[str]) -> argparse.Namespace:
    parser = arguments(argparse.ArgumentParser(prog="simulate"), 1)
    parser.add_argument("--log", required=True, help="folder of the log, or topic where --servers is given")
    parser.add_argument("--servers", help="Kafka servers; needs the connector")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--input", help="readings.jsonl")
    source.add_argument("--generate", action="store_true")
    parser.add_argument("--events-per-second", type=float, help="without it as fast as can be")
    parser.add_argument("--batch-rows", type=int, default=500, help="most events of one batch")
    return parser.parse_args(argv)


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    args = parse(argv)
    spark = spark or build()
    events = read_jsonl(spark, args.input, EVENT) if args.input else population(spark, args)[1]
    return publish(events, args.log, servers=args.servers, events_per_second=args.events_per_second, batch_rows=args.batch_rows)


if __name__ == "__main__":
    print(main(sys.argv[1:]))
