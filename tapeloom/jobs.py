"""The jobs to submit to a cluster, with the repository on PYTHONPATH.

    spark-submit tapeloom/jobs.py ingest  --table T --checkpoints C --servers S --topic P
    spark-submit tapeloom/jobs.py ingest  --table T --checkpoints C --files DIR --once
    spark-submit tapeloom/jobs.py publish --frames DIR --checkpoints C --servers S --topic P
    spark-submit tapeloom/jobs.py backfill --table T --servers S --topic P
    spark-submit tapeloom/jobs.py compact --table T
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.publish import RECORD_KEY, trade_records
from tapeloom.operators.upsert import TTL_SECONDS
from tapeloom.plans import backfill as sliced
from tapeloom.plans.table import TradeTable
from tapeloom.sources import files, kafka
from tapeloom.streaming import job, sinks
from tapeloom.streaming.audit import DeliveryAudit


def ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    """Feed the table from a topic, or from stored topic rows."""
    if args.files:
        rows = files.stream_parquet(spark, args.files, max_files_per_trigger=args.max_files)
    else:
        limits = kafka.ORIGINAL_LIMITS if args.original_limits else {}
        if args.max_offsets:
            limits = limits | {"max_offsets_per_trigger": args.max_offsets}
        options = kafka.topic_options(args.servers, args.topic, min_partitions=args.min_partitions, **limits)
        rows = kafka.read_topic(spark, options)
    queries = job.start(
        kafka.topic_records(rows),
        _table(spark, args),
        args.checkpoints,
        preview_rows=sinks.PREVIEW_ROWS if args.preview else 0,
        refuse_bad_keys=args.refuse_bad_keys,
        trigger=_trigger(args),
        rebalance=args.rebalance,
    )
    job.wait(queries)


def backfill(spark: SparkSession, args: argparse.Namespace) -> None:
    """Store what a topic, or a folder of its rows, holds now, in slices of offsets.

    Run again under the same name it goes on where it was interrupted.
    """
    read = None
    if args.files:
        rows = files.read_parquet(spark, args.files)
    else:
        options = kafka.topic_options(args.servers, args.topic)
        rows = kafka.read_topic_once(spark, options)

        def read(ranges):
            return kafka.topic_records(kafka.read_topic_once(spark, kafka.range_options(options, ranges)))

    records = kafka.topic_records(rows)
    sliced.backfill(_table(spark, args), records, args.backfill, args.slice, read, args.rebalance)


def publish(spark: SparkSession, args: argparse.Namespace) -> None:
    """Publish the trade messages among raw frames to a topic.

    The record key is a constant, as in the original, unless `--key` names a place in the
    message: a constant key fills one partition of the topic.
    """
    frames = files.stream_frames(spark, args.frames, max_files_per_trigger=args.max_files)
    key = F.get_json_object(F.col("value").cast("string"), args.key) if args.key else RECORD_KEY
    sink = sinks.publish_sink(
        trade_records(frames, key),
        sinks.topic_writer(args.servers, args.topic),
        args.topic,
        f"{args.checkpoints}/publish",
        _trigger(args),
    )
    with DeliveryAudit(spark, f"{args.checkpoints}/deliveries", [args.topic]) as audit:
        audit.fold()
        job.wait([sink.start()])


def compact(spark: SparkSession, args: argparse.Namespace) -> None:
    """Fold the table's new batches; at one time by one job only."""
    as_of = datetime.fromisoformat(args.as_of).replace(tzinfo=timezone.utc) if args.as_of else None
    TradeTable(spark, args.table, args.name).compact(as_of, full=args.full)


def _table(spark: SparkSession, args: argparse.Namespace) -> TradeTable:
    return TradeTable.create(spark, args.table, args.lifetime, args.buckets, args.name)


def _trigger(args: argparse.Namespace) -> dict:
    return {"availableNow": True} if args.once else sinks.TRIGGER


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(description="Trade-message jobs")
    commands = parser.add_subparsers(required=True)

    stream = argparse.ArgumentParser(add_help=False)
    stream.add_argument("--servers")
    stream.add_argument("--topic")
    stream.add_argument("--checkpoints", required=True)
    stream.add_argument("--max-files", type=int)
    stream.add_argument("--once", action="store_true", help="stop when all there is has been read")

    into = argparse.ArgumentParser(add_help=False)
    into.add_argument("--table", required=True)
    into.add_argument("--name", help="how the table's parts begin in the catalog, such as market.trades")
    into.add_argument("--files", help="stored topic rows to read instead of a topic")
    into.add_argument("--rebalance", action="store_true", help="write files of even size")
    into.add_argument("--lifetime", type=int, default=TTL_SECONDS, help="seconds, of a new table")
    into.add_argument("--buckets", type=int, default=16, help="symbol buckets of a new table")

    command = commands.add_parser("ingest", parents=[stream, into], help=ingest.__doc__)
    command.add_argument("--max-offsets", type=int, help="offsets a trigger; none by default")
    command.add_argument("--original-limits", action="store_true", help="5000 offsets, losses tolerated")
    command.add_argument("--min-partitions", type=int)
    command.add_argument("--preview", action="store_true", help="also show rows on the console")
    command.add_argument("--refuse-bad-keys", action="store_true", help="fail on a trade without key")
    command.set_defaults(run=ingest)

    command = commands.add_parser("backfill", parents=[into], help=backfill.__doc__)
    command.add_argument("--servers")
    command.add_argument("--topic")
    command.add_argument("--backfill", default="first", help="name under which the backfill can go on")
    command.add_argument("--slice", type=int, default=sliced.SLICE_OFFSETS, help="offsets of a partition in one batch")
    command.set_defaults(run=backfill)

    command = commands.add_parser("publish", parents=[stream], help=publish.__doc__)
    command.add_argument("--frames", required=True)
    command.add_argument("--key", help="JSON path of the record key, such as $.data[0].s")
    command.set_defaults(run=publish)

    command = commands.add_parser("compact", help=compact.__doc__)
    command.add_argument("--table", required=True)
    command.add_argument("--name", help="how the table's parts begin in the catalog")
    command.add_argument("--full", action="store_true", help="rewrite all days")
    command.add_argument("--as-of", help="UTC time to which rows must have lived; now by default")
    command.set_defaults(run=compact)
    return parser


def main(arguments: list[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(arguments)
    if args.run in (ingest, backfill, publish) and not getattr(args, "files", None):
        if not (args.servers and args.topic):
            parser.error("--servers and --topic are needed to reach a topic")
    args.run(SparkSession.builder.appName("tapeloom").getOrCreate(), args)


if __name__ == "__main__":
    main()
