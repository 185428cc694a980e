"""The streaming job: Kafka topic -> lake and current state."""

from __future__ import annotations

import argparse

from ..session import build_session
from ..sources.readers import kafka_options, read_messages
from ..sources.sinks import lake_path
from ..streaming.control import log_dropped, wait_any
from ..streaming.etl import start_etl

# Keeps the deduplication state on local disk instead of the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Stream observations into the lake.")
    parser.add_argument("servers")
    parser.add_argument("topic")
    parser.add_argument("root", help="folder of the lake, the state and the checkpoints")
    parser.add_argument("--delay", help="watermark of the deduplication, such as '2 days'; later rows are dropped and logged")
    parser.add_argument("--max-per-trigger", type=int, default=None)
    args = parser.parse_args(argv)
    spark = build_session("stationflow-stream", spark__sql__streaming__stateStore__providerClass=STATE_STORE)
    messages = read_messages(spark, kafka_options(args.servers, args.topic, args.max_per_trigger))
    log_dropped(spark)
    start_etl(
        messages,
        lake_path(args.root, "enriched", "weather"),
        lake_path(args.root, "state", "current"),
        lake_path(args.root, "checkpoints", "weather"),
        delay=args.delay,
    )
    wait_any(spark)


if __name__ == "__main__":
    main()
