"""Command line: ``python -m ledgermill <command> --help`` or the same through spark-submit."""

from __future__ import annotations

import argparse
import sys

from ledgermill.operators import gate, validation
from ledgermill.plans import payment_store
from ledgermill.plans.gold_days import build_gold
from ledgermill.plans.run import Lake, load_silver, run_days
from ledgermill.schema import STEP_EPOCH, as_day
from ledgermill.session import build_session, path_exists
from ledgermill.sources import raw, tables
from ledgermill.sources.bronze import read_bronze
from ledgermill.sources.publish import publish as resume_publish
from ledgermill.streaming.arrivals import arrivals_stream, read_arrivals
from ledgermill.streaming.ingest import ROLL_RECORDS, ROLL_SECONDS, ingest_stream


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="ledgermill")
    commands = parser.add_subparsers(dest="command", required=True)

    publish = commands.add_parser("publish", help="raw CSV to keyed messages")
    publish.add_argument("--csv", required=True)
    publish.add_argument("--servers", required=True)
    publish.add_argument("--topic", required=True)
    publish.add_argument("--limit", type=int, default=0, help="records to send, 0 for all")
    publish.add_argument("--max-days", type=int, default=0, help="event days to send, 0 for all")
    publish.add_argument("--checkpoint", help="follow a CSV folder and resume from here")
    publish.add_argument("--ledger", help="note what is delivered here and go on after it")
    publish.add_argument("--done-marker", help="path to write once all is delivered")

    ingest = commands.add_parser("ingest", help="messages to Bronze")
    ingest.add_argument("--servers", required=True)
    ingest.add_argument("--topic", required=True)
    ingest.add_argument("--bronze-path", required=True)
    ingest.add_argument("--checkpoint", required=True)
    ingest.add_argument("--min-partitions", type=int, help="tasks that share the topic partitions")
    ingest.add_argument("--max-offsets", type=int, help="messages to take in per batch")
    ingest.add_argument("--roll-records", type=int, default=ROLL_RECORDS)
    ingest.add_argument("--roll-seconds", type=int, default=ROLL_SECONDS)
    ingest.add_argument("--available-now", action="store_true")

    arrivals = commands.add_parser("arrivals", help="counts of messages by event day, for the gate")
    arrivals.add_argument("--servers", required=True)
    arrivals.add_argument("--topic", required=True)
    arrivals.add_argument("--arrivals-path", required=True)
    arrivals.add_argument("--checkpoint", required=True)
    arrivals.add_argument("--min-partitions", type=int, help="tasks that share the topic partitions")
    arrivals.add_argument("--max-offsets", type=int, help="messages to take in per batch")
    arrivals.add_argument("--step-epoch", default=STEP_EPOCH)
    arrivals.add_argument("--available-now", action="store_true")

    silver = commands.add_parser("silver", help="Bronze to Silver and quarantine")
    silver.add_argument("--bronze-path", required=True)
    silver.add_argument("--silver-path", required=True)
    silver.add_argument("--target-tx-date", help="one event day, all days if left out")
    silver.add_argument("--scratch", help="shared folder for records in between")
    _add_window(silver)
    _add_rules(silver)

    store = commands.add_parser("store", help="valid records of Bronze to the bucketed store, and Silver from it")
    store.add_argument("--store-path", required=True)
    store.add_argument("--bronze-path", help="take in its records; one ingest day or window at a time")
    store.add_argument("--buckets", type=int, help="buckets of a day, for the first batch only")
    store.add_argument("--merge-day", action="append", default=[], help="merge the files of an event day")
    store.add_argument("--silver-path", help="write Silver from the store")
    store.add_argument("--target-tx-date", help="one event day of Silver, all days if left out")
    _add_window(store)
    _add_rules(store)

    gold = commands.add_parser("gold", help="Silver to the Gold tables")
    gold.add_argument("--silver-path", required=True)
    gold.add_argument("--gold-path", required=True)

    ready = commands.add_parser("ready", help="exit 0 once an event day has arrived, else 1")
    counted = ready.add_mutually_exclusive_group(required=True)
    counted.add_argument("--bronze-path", help="count the records of Bronze")
    counted.add_argument("--arrivals-path", help="read the counts that the arrivals stream keeps")
    ready.add_argument("--day", required=True)
    ready.add_argument("--done-marker")
    ready.add_argument("--step-epoch", default=STEP_EPOCH)
    _add_window(ready)

    run = commands.add_parser("run", help="all layers for a range of event days")
    run.add_argument("--root", required=True, help="folder that holds all layers")
    run.add_argument("--start", required=True)
    run.add_argument("--end", help="last day, the first one if left out")
    run.add_argument("--done-marker")
    _add_window(run)
    _add_rules(run)
    return parser


def _add_rules(command: argparse.ArgumentParser) -> None:
    command.add_argument("--step-epoch", default=STEP_EPOCH)
    command.add_argument("--strict", action="store_true", help="reject amounts without a decimal")


def _add_window(command: argparse.ArgumentParser) -> None:
    command.add_argument("--ingest-from", help="first ingest day to read, all if left out")
    command.add_argument("--ingest-to", help="last ingest day to read, all if left out")


def _publish(spark, args) -> int:
    if args.checkpoint:
        records = raw.first_days(raw.stream_raw_csv(spark, args.csv), args.max_days)
        messages = raw.to_messages(records)
        raw.publish_stream(messages, args.servers, args.topic, args.checkpoint).awaitTermination()
    elif args.ledger:
        resume_publish(
            spark,
            args.csv,
            args.ledger,
            lambda messages: raw.write_messages(messages, args.servers, args.topic),
            args.limit,
            args.max_days,
        )
    else:
        records = raw.first_days(raw.read_raw_csv(spark, args.csv), args.max_days)
        messages = raw.to_messages(records, args.limit)
        raw.write_messages(messages, args.servers, args.topic)
    if args.done_marker:
        tables.write_feed_marker(spark, args.done_marker)
    return 0


def _message_options(args) -> dict[str, str]:
    """Options of the message source; those left out keep Spark's defaults."""
    options = {
        "kafka.bootstrap.servers": args.servers,
        "subscribe": args.topic,
        "startingOffsets": "earliest",
        "minPartitions": args.min_partitions,
        "maxOffsetsPerTrigger": args.max_offsets,
    }
    return {name: str(value) for name, value in options.items() if value is not None}


def _ingest(spark, args) -> int:
    messages = spark.readStream.format("kafka").options(**_message_options(args)).load()
    ingest_stream(
        messages,
        args.bronze_path,
        args.checkpoint,
        args.roll_records,
        args.roll_seconds,
        args.available_now,
    ).awaitTermination()
    return 0


def _arrivals(spark, args) -> int:
    messages = spark.readStream.format("kafka").options(**_message_options(args)).load()
    arrivals_stream(
        messages,
        args.arrivals_path,
        args.checkpoint,
        args.step_epoch,
        available_now=args.available_now,
    ).awaitTermination()
    return 0


def _silver(spark, args) -> int:
    report = load_silver(
        spark,
        read_bronze(spark, args.bronze_path, args.ingest_from, args.ingest_to),
        args.silver_path,
        args.target_tx_date,
        step_epoch=args.step_epoch,
        strict=args.strict,
        scratch_root=args.scratch,
    )
    print(report.summary())
    return 0


def _store(spark, args) -> int:
    if args.bronze_path:
        bronze = read_bronze(spark, args.bronze_path, args.ingest_from, args.ingest_to)
        labelled = validation.label(bronze, args.strict)
        payment_store.take_in_bronze(labelled, args.store_path, args.buckets, args.step_epoch)
    payment_store.merge_batches(spark, args.store_path, map(as_day, args.merge_day))
    if args.silver_path:
        payment_store.write_silver_days(spark, args.store_path, args.silver_path, args.target_tx_date)
    found = payment_store.repeated_keys(spark, args.store_path).first()
    print(f"buckets={payment_store.bucket_count(spark, args.store_path)} in_several_batches={found.failures}")
    return 0


def _gold(spark, args) -> int:
    build_gold(spark, args.silver_path, args.gold_path)
    return 0


def _ready(spark, args) -> int:
    done = _feed_done(spark, args)
    if args.arrivals_path:
        counts = read_arrivals(spark, args.arrivals_path)
        state = gate.day_ready_from(counts, args.day, done).first()
    elif path_exists(spark, args.bronze_path):
        bronze = read_bronze(spark, args.bronze_path, args.ingest_from, args.ingest_to)
        state = gate.day_ready(bronze, args.day, done, args.step_epoch).first()
    else:
        print(f"day={args.day} no Bronze yet")
        return 1
    print(f"day={args.day} rows={state.day_rows} later={state.later_rows} ready={state.ready}")
    return 0 if state.ready else 1


def _run(spark, args) -> int:
    report = run_days(
        spark,
        Lake.below(args.root),
        args.start,
        args.end or args.start,
        _feed_done(spark, args),
        args.step_epoch,
        args.strict,
        ingest_from=args.ingest_from,
        ingest_to=args.ingest_to,
    )
    print(report.summary())
    return 0 if report.ready else 1


def _feed_done(spark, args) -> bool:
    return bool(args.done_marker) and tables.feed_done(spark, args.done_marker)


COMMANDS = {
    "publish": _publish,
    "ingest": _ingest,
    "arrivals": _arrivals,
    "silver": _silver,
    "store": _store,
    "gold": _gold,
    "ready": _ready,
    "run": _run,
}


def main(argv: list[str] | None = None) -> int:
    # Launchers add options of their own, which are none of ours to reject.
    parser = _parser()
    args, _ = parser.parse_known_args(argv)
    if args.command == "publish" and args.checkpoint and args.limit:
        parser.error("--limit caps one batch and cannot be combined with --checkpoint")
    return COMMANDS[args.command](build_session(f"ledgermill {args.command}"), args)


if __name__ == "__main__":
    sys.exit(main())
