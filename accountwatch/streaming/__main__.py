r"""Run the three detectors on a topic (or on message files) until stopped.

    python -m accountwatch.streaming --servers host:9092 --topic events \
        --lanes hdfs://shared/lanes --checkpoints hdfs://shared/checkpoints
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from accountwatch.config import RiskConfig
from accountwatch.operators.detect import with_event_time
from accountwatch.sources import lanes as store
from accountwatch.sources.events import parse_events, read_event_files, read_events_stream
from accountwatch.streaming.lanes import await_lanes, start_lanes


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="accountwatch.streaming", description=__doc__)
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--topic")
    source.add_argument("--files", help="folder of message files instead of a topic")
    parser.add_argument("--servers", help="broker list, with --topic")
    parser.add_argument("--starting", help="latest, earliest or an offset map")
    sink = parser.add_mutually_exclusive_group(required=True)
    sink.add_argument("--lanes", help="folder for the lane tables")
    sink.add_argument("--jdbc-url")
    sink.add_argument("--console", action="store_true")
    parser.add_argument("--console-rows", type=int, default=20, help="rows of a batch to print, with --console")
    parser.add_argument("--files-per-batch", type=int, help="files that a batch is written to, with --lanes")
    parser.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE")
    parser.add_argument("--checkpoints", required=True, help="shared folder for stream state and offsets")
    parser.add_argument("--mode", choices=("append", "update"), default="append")
    parser.add_argument(
        "--once", action="store_true", help="stop when everything available is processed; windows still open are not stored in append mode"
    )
    parser.add_argument("--min-mrr", type=float, default=RiskConfig.min_mrr)
    parser.add_argument("--width", default=RiskConfig.window_width)
    parser.add_argument("--slide", default=RiskConfig.window_slide)
    parser.add_argument("--watermark", default=RiskConfig.watermark)
    args = parser.parse_args(argv)
    if args.topic and not args.servers:
        parser.error("--topic needs --servers")
    return args


def main(argv: list[str] | None = None) -> None:
    args = arguments(argv)
    spark = SparkSession.builder.appName("accountwatch").getOrCreate()
    if args.topic:
        raw = read_events_stream(spark, args.servers, args.topic, args.starting)
    else:
        raw = read_event_files(spark, args.files)
    if args.lanes:
        sink = store.parquet_sink(args.lanes, store.new_run_id(), args.files_per_batch)
    elif args.jdbc_url:
        # Rows that replace earlier ones need their run and batch to be told apart.
        run_id = store.new_run_id() if args.mode == "update" else None
        sink = store.jdbc_sink(args.jdbc_url, dict(p.split("=", 1) for p in args.jdbc_property), run_id)
    else:
        sink = store.console_sink(args.console_rows)
    cfg = RiskConfig(
        min_mrr=args.min_mrr, window_width=args.width, window_slide=args.slide, watermark=args.watermark
    )
    trigger = {"availableNow": True} if args.once else None
    events = with_event_time(parse_events(raw))
    await_lanes(start_lanes(events, sink, args.checkpoints, cfg, args.mode, trigger))


if __name__ == "__main__":
    main()
