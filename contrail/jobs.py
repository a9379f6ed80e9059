"""The three jobs: ``python -m contrail.jobs publish|land|process``."""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession

from contrail.operators.audit import counted, observed
from contrail.operators.messages import to_messages
from contrail.plans.batch import run
from contrail.settings import Settings, create_spark_session
from contrail.sinks.lake import remove_old_versions
from contrail.sinks.topic import publish
from contrail.sources.files import read_lookup, read_trips
from contrail.sources.lake import read_raw
from contrail.streaming.landing import BatchCounts, land, read_topic
from contrail.streaming.publishing import publish_files, read_trip_files
from contrail.streaming.seen import SeenIndex


def trip_file(spark: SparkSession, settings: Settings, names_from_header: bool) -> DataFrame:
    if names_from_header:
        return read_trips(spark, settings.trips_path, schema=None)
    return read_trips(spark, settings.trips_path)


def with_broker(fmt: str, broker: dict, options: dict) -> dict:
    """Options given by hand come on top of the broker's; other formats have only theirs."""
    return {**broker, **options} if fmt == "kafka" else options


def publish_job(trips: DataFrame, settings: Settings, fmt: str, options: dict) -> dict:
    """Trip file to topic, in one pass; returns the statistics of the run."""
    started = datetime.now(UTC).replace(tzinfo=None).isoformat()
    trips, read = counted(trips, "read")
    messages, sent = counted(to_messages(trips), "sent")
    publish(messages, fmt, with_broker(fmt, settings.topic_sink(), options))
    total, published = observed(read).get("rows", 0), observed(sent).get("rows", 0)
    return {
        "total_rows": total,
        "published": published,
        "skipped": total - published,
        "start_time": started,
        "end_time": datetime.now(UTC).replace(tzinfo=None).isoformat(),
    }


def publish_files_job(
    spark: SparkSession, settings: Settings, fmt: str, options: dict, files_per_batch: int
) -> dict:
    """Trip files that no earlier run has sent to the topic; returns the statistics of this run."""
    started, found = datetime.now(UTC).replace(tzinfo=None).isoformat(), []
    trips = read_trip_files(spark, settings.trips_path, files_per_batch)
    sink = with_broker(fmt, settings.topic_sink(), options)
    publish_files(trips, fmt, sink, settings.publishing_checkpoint, found.append).awaitTermination()
    total, published = (sum(getattr(s, name) for s in found) for name in ("total_rows", "published"))
    return {
        "total_rows": total,
        "published": published,
        "skipped": total - published,
        "start_time": started,
        "end_time": datetime.now(UTC).replace(tzinfo=None).isoformat(),
    }


def land_job(
    spark: SparkSession,
    settings: Settings,
    fmt: str,
    options: dict,
    drop_repeats: bool,
    file_bytes: int | None,
    rows_per_batch: int | None = None,
    min_tasks: int | None = None,
) -> dict:
    """Topic to raw lake; returns what became of the messages, over all batches."""
    found: list[BatchCounts] = []
    source = settings.topic_source(rows_per_batch, min_tasks)
    messages = read_topic(spark, fmt, with_broker(fmt, source, options))
    folders = settings.raw_root, settings.landing_checkpoint
    index = settings.seen_root if drop_repeats else None
    land(messages, *folders, index, file_bytes, found.append).awaitTermination()
    names = ("messages", "unreadable", "repeats", "landed")
    return {name: sum(getattr(counts, name) for counts in found) for name in names}


def process_job(
    spark: SparkSession,
    trips: DataFrame,
    settings: Settings,
    tables_only: bool,
    compact: bool,
    from_lake: bool = False,
) -> None:
    run(
        spark,
        trips,
        read_lookup(spark, settings.carriers_path),
        read_lookup(spark, settings.airports_path),
        settings.feature_store(),
        None if tables_only else settings.processed_root,
        settings.quarter,
        compact=compact,
        from_lake=from_lake,
    )
    if not tables_only:
        remove_old_versions(spark, settings.processed_root)


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="contrail")
    jobs = parser.add_subparsers(dest="job", required=True)
    publishing, landing, processing = (jobs.add_parser(n) for n in ("publish", "land", "process"))
    for job in (publishing, landing):
        job.add_argument("--format", default="kafka")
        job.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    for job in (publishing, processing):
        job.add_argument("--names-from-header", action="store_true")
    landing.add_argument("--drop-repeats", action="store_true", help="land a trip once, whenever it is sent")
    landing.add_argument("--compact-index", action="store_true", help="only rewrite what --drop-repeats remembers")
    landing.add_argument("--file-bytes", type=int, help="text per file, for a backlog of many months")
    publishing.add_argument(
        "--files-per-batch", type=int, help="send file by file, and only files not sent by an earlier run"
    )
    processing.add_argument("--source", choices=("file", "lake"), default="file")
    processing.add_argument("--tables-only", action="store_true", help="write no processed lake")
    landing.add_argument("--rows-per-batch", type=int, help="paces the reading of the broker")
    landing.add_argument("--min-tasks", type=int, help="splits a topic with few partitions")
    processing.add_argument(
        "--in-date-order", action="store_true", help="write the lake without a shuffle"
    )
    return parser


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    settings = Settings.from_env()
    spark = create_spark_session(f"trip-features-{args.job}")
    try:
        if args.job == "publish" and args.files_per_batch:
            options = _options(args.option)
            print(publish_files_job(spark, settings, args.format, options, args.files_per_batch))
        elif args.job == "publish":
            trips = trip_file(spark, settings, args.names_from_header)
            print(publish_job(trips, settings, args.format, _options(args.option)))
        elif args.job == "land" and args.compact_index:
            print({"trips": SeenIndex(spark, settings.seen_root).compact()})
        elif args.job == "land":
            options = _options(args.option)
            limits = args.drop_repeats, args.file_bytes, args.rows_per_batch, args.min_tasks
            print(land_job(spark, settings, args.format, options, *limits))
        elif args.source == "lake":
            trips = read_raw(spark, settings.raw_root, quarter=settings.quarter)
            process_job(spark, trips, settings, args.tables_only, not args.in_date_order, from_lake=True)
        else:
            trips = trip_file(spark, settings, args.names_from_header)
            process_job(spark, trips, settings, args.tables_only, not args.in_date_order)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
