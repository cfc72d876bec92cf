"""Entry point for a deployment (``spark-submit tillstream/streaming/run.py``).

Starts the store summary, product performance and realtime metrics streams on
one message source and waits on all of them; on request also the raw
transactions table, and the streams of the customer-events (sessions) and
inventory (stock levels) topics. With ``--decode-once`` messages are parsed by
one stream, and the three read its table. Outputs and checkpoints go below ``--root``, or below the
cluster's ``spark.checkpoint.dir``; without either the program ends, because a
restart has to find its tables and state where they were.
"""

from __future__ import annotations

import argparse
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from pyspark.sql import SparkSession  # noqa: E402

from tillstream.schemas import CUSTOMER_SESSIONS  # noqa: E402
from tillstream.session import configure  # noqa: E402
from tillstream.sources.streams import kafka_stream, text_stream  # noqa: E402
from tillstream.streaming import jobs  # noqa: E402
from tillstream.streaming.jobs import TRIGGERS, StreamPaths, await_all, start_retail_streams  # noqa: E402


def parse_args(argv=None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="tillstream.streaming.run")
    p.add_argument("--source", choices=("kafka", "files"), default="kafka")
    p.add_argument("--bootstrap-servers", default=None, help="Kafka bootstrap servers")
    p.add_argument("--starting-offsets", default="latest")
    p.add_argument("--max-offsets-per-trigger", type=int, default=None,
                   help="upper bound of messages per micro-batch (Kafka)")
    p.add_argument("--input", default=None, help="folder of message files (--source files)")
    p.add_argument("--root", default=None, help="output + checkpoint root (shared storage)")
    p.add_argument("--raw-transactions", action="store_true", help="also keep the raw transactions table")
    p.add_argument("--decode-once", action="store_true", help="parse messages in one stream, aggregate from its table")
    p.add_argument("--customer-events", nargs="?", const=True, default=None, metavar="FOLDER",
                   help="also keep customer sessions (from the topic, or from a folder with --source files)")
    p.add_argument("--inventory", nargs="?", const=True, default=None, metavar="FOLDER",
                   help="also keep stock levels (from the topic, or from a folder with --source files)")
    p.add_argument("--once", action="store_true", help="process what is available, then stop")
    return p.parse_args(argv)


def root_of(args: argparse.Namespace, spark: SparkSession) -> str:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not (args.root or shared):
        raise SystemExit("--root or spark.checkpoint.dir is required")
    return args.root or f"{shared.rstrip('/')}/tillstream"


def main(argv=None, spark: SparkSession | None = None) -> list:
    args = parse_args(argv)
    spark = configure(spark or SparkSession.builder.appName("tillstream-streams").getOrCreate())
    root = root_of(args, spark)
    if args.source == "kafka":
        if not args.bootstrap_servers:
            raise SystemExit("--bootstrap-servers is required for --source kafka")
        source = lambda kind="transactions", folder=None: kafka_stream(
            spark, args.bootstrap_servers, kind, starting_offsets=args.starting_offsets,
            max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        if not args.input or True in (args.customer_events, args.inventory):
            raise SystemExit("--source files needs --input, and a folder for each further topic")
        source = lambda kind="transactions", folder=None: text_stream(spark, folder or args.input)
    now = {"availableNow": True} if args.once else None
    triggers = {k: now for k in (*TRIGGERS, "decoded")} if args.once else None
    logs: list = []
    paths = StreamPaths(root)
    if args.decode_once:
        if args.raw_transactions:
            raise SystemExit("--raw-transactions reads the topic itself: leave out --decode-once")
        queries = jobs.start_decoded_streams(source(), paths, triggers, logs)
    else:
        queries = start_retail_streams(spark, source, paths, triggers, raw_transactions=args.raw_transactions, logs=logs)
    if args.customer_events:
        log = jobs.start_stream(jobs.session_stream(source("customer_events", args.customer_events)), paths,
                                CUSTOMER_SESSIONS, "customer_sessions", now)
        logs.append(log)
        queries.append(log.query)
    if args.inventory:
        queries.append(jobs.run_stock(source("inventory", args.inventory), paths, now))
    try:
        if args.once:
            for q in queries:
                q.awaitTermination()
                if q.exception() is not None:
                    raise q.exception()
        else:
            await_all(spark, queries)
    finally:
        for log in logs:
            log.save(least=1)
    return queries


if __name__ == "__main__":
    main()
