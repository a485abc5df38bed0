"""Command line: follow a stream (default), backfill a range, print the status."""

from __future__ import annotations

import argparse
import json
import signal
import sys
from pathlib import Path

from tidewheel.control.config import Config, ConfigError, load
from tidewheel.control.lock import Busy, WriterLock

#: Exit codes (fixed values).
OK, FAILED, LOCKED = 0, 1, 3


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidewheel", description=__doc__)
    for name in ("config", "stream", "data-dir", "max-mb", "expire-hours"):
        top.add_argument(f"--{name}")
    top.add_argument("--redis", dest="redis_url")
    top.add_argument("--source", help="folder of JSON lines with stream_id and fields, instead of a Redis stream")
    top.add_argument("--max-idle-ms", type=int)
    until = top.add_mutually_exclusive_group()
    until.add_argument("--once", action="store_true")
    until.add_argument("--max-reads", type=int)
    commands = top.add_subparsers(dest="command")
    commands.add_parser("follow")
    again = commands.add_parser("backfill")
    again.add_argument("--from", dest="first", default="0")
    again.add_argument("--to", dest="last", default="+")
    commands.add_parser("status").add_argument("--json", action="store_true")
    return top


def collector(spark, config: Config):
    from pyspark.sql import functions as F

    from tidewheel.operators.retention import cap_bytes
    from tidewheel.sources.store import Store
    from tidewheel.streaming.follow import Collector

    base = Path(config.data_dir)
    return Collector(spark, Store(spark, f"file://{base.resolve()}"), base, config.expire_hours, F.current_timestamp, cap_bytes(config.max_mb), config.redis_url, config.stream)


def main(argv: list[str] | None = None, spark=None) -> int:
    try:
        args = parser().parse_args(argv)
    except SystemExit as end:
        return OK if end.code in (0, None) else FAILED
    try:
        config = load({k: getattr(args, k) for k in ("config", "redis_url", "stream", "data_dir", "max_mb", "expire_hours")})
    except ConfigError as error:
        print(f"tidewheel: {error}", file=sys.stderr)
        return FAILED
    from pyspark.sql import SparkSession

    from tidewheel.sources.redis_stream import RedisStreamSource
    from tidewheel.streaming.follow import WIRE_SCHEMA, status_lines

    spark = spark or SparkSession.builder.appName("tidewheel").getOrCreate()
    if args.command == "status":
        found = collector(spark, config).manifest()
        print(json.dumps(found) if args.json else "\n".join(status_lines(found)))
        return OK
    try:
        with WriterLock(config.data_dir):
            job = collector(spark, config)
            if args.command == "backfill":
                from tidewheel.sources.events import check_bound, wire_from_json

                first, last = check_bound(args.first), check_bound(args.last)
                if args.source:
                    wire = wire_from_json(spark, args.source)
                else:
                    spark.dataSource.register(RedisStreamSource)
                    wire = spark.read.format("redis_stream").options(url=config.redis_url, stream=config.stream, first=first, last=last).load()
                job.start()
                done = job.backfill(wire, first, last)
                print(f"{done.raw_lines} events, {done.session_rows} sessions, checkpoint {done.checkpoint}")
                return OK
            if args.source:
                stream = spark.readStream.schema(WIRE_SCHEMA).json(args.source)
            else:
                spark.dataSource.register(RedisStreamSource)
                stream = spark.readStream.format("redis_stream").option("url", config.redis_url).option("stream", config.stream).load()

            def stop(*_):
                for name in (signal.SIGTERM, signal.SIGINT):  # a second signal ends the process at once
                    signal.signal(name, signal.SIG_DFL)
                for query in spark.streams.active:
                    query.stop()

            for name in (signal.SIGTERM, signal.SIGINT):
                signal.signal(name, stop)
            job.follow(stream, f"file://{Path(config.data_dir).resolve()}/.offsets", once=args.once, max_idle_ms=args.max_idle_ms, max_reads=args.max_reads)
            return OK
    except Busy as error:
        print(f"tidewheel: {error}", file=sys.stderr)
        return LOCKED
    except Exception as error:
        print(f"tidewheel: {error}", file=sys.stderr)
        return FAILED


if __name__ == "__main__":
    sys.exit(main())
