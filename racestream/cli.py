"""Command line of the jobs.

    spark-submit run_job.py leaderboard --checkpoint <folder>
    spark-submit run_job.py replay --landing <folder> --topics <folder>
    spark-submit run_job.py late --checkpoint <folder of the leaderboard> --output <folder>

Topics are those of the Kafka broker in KAFKA_BOOTSTRAP_SERVERS, or with ``--topics`` folders of files.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from racestream.operators.enrichment import KEYS, SESSION_KEYS
from racestream.operators.replay import TIMELINE_ORDER, merged, messages, schedule
from racestream.session import use_utc
from racestream.settings import Settings
from racestream.sources.landing import read_session
from racestream.sources.topics import FileTopics, KafkaTopics, Topics
from racestream.streaming import jobs

STREAMS = ("leaderboard", "enrichment", "complete-enrichment", "alerts", "malformed")
BATCHES = ("replay", "schedule", "late")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Motorsport timing jobs")
    parser.add_argument("job", choices=STREAMS + BATCHES)
    parser.add_argument("--topics", help="root folder of file topics, in place of Kafka")
    parser.add_argument("--checkpoint", help="checkpoint folder of a streaming job")
    parser.add_argument("--once", action="store_true", help="process what is there, then stop")
    parser.add_argument("--by-session", action="store_true", help="keep sessions apart")
    parser.add_argument("--whole-words", action="store_true", help="match alert patterns at word boundaries")
    parser.add_argument("--on-malformed", choices=("drop", "fail"), help="default: the job's own")
    parser.add_argument("--keep-for", help="forget pit stops older than this, such as '2 hours'")
    parser.add_argument("--keep-by", choices=("event_time", "ingest_time"), default="event_time", help="what --keep-for goes by")
    parser.add_argument("--time-fallback", choices=("ingest", "epoch", "null"), default="ingest", help="time of records without a date")
    parser.add_argument("--last-by", choices=("arrival", "event_time"), default="arrival", help="which position of a window counts")
    parser.add_argument("--max-lap", default="10 minutes", help="how long after its start a lap's pit stop can come")
    parser.add_argument("--release", action="store_true", help="complete-enrichment: after --once, give out the laps that still wait")
    parser.add_argument("--table", help="raw table whose malformed records are collected")
    parser.add_argument("--landing", help="root folder of landed session data")
    parser.add_argument("--format", default="json", help="format of landed data")
    parser.add_argument("--unordered", action="store_true", help="replay in fewer steps, without the order of each key")
    parser.add_argument("--missing-time", choices=("epoch", "drop"), default="epoch")
    parser.add_argument("--output", help="folder for the results of 'malformed', 'schedule' and 'late'")
    args = parser.parse_args(argv)
    needed = {"malformed": ("checkpoint", "table", "output"), "replay": ("landing",), "schedule": ("landing", "output"), "late": ("checkpoint", "output")}
    for name in needed.get(args.job, ("checkpoint",)):
        if getattr(args, name) is None:
            parser.error(f"{args.job} needs --{name}")
    if args.release and not (args.once and args.job == "complete-enrichment"):
        parser.error("--release goes with complete-enrichment --once")
    return args


def stream(spark: SparkSession, topics: Topics, args: argparse.Namespace):
    """The configured writer of a streaming job."""
    policy = {} if args.on_malformed is None else {"on_malformed": args.on_malformed}
    keys = SESSION_KEYS if args.by_session else KEYS
    if args.job == "leaderboard":
        return jobs.leaderboard_job(
            spark,
            topics,
            args.checkpoint,
            time_fallback=args.time_fallback,
            by_session=args.by_session,
            last_by=args.last_by,
            **policy,
        )
    if args.job == "alerts":
        return jobs.alerts_job(spark, topics, args.checkpoint, whole_words=args.whole_words, **policy)
    if args.job == "enrichment":
        return jobs.enrichment_job(
            spark, topics, args.checkpoint, keys=keys, keep_for=args.keep_for, time_fallback=args.time_fallback, keep_by=args.keep_by, **policy
        )
    if args.job == "complete-enrichment":
        return jobs.complete_enrichment_job(
            spark, topics, args.checkpoint, keys=keys, max_lap=args.max_lap, time_fallback=args.time_fallback, **policy
        )
    return jobs.malformed_job(spark, topics, args.table, args.output, args.checkpoint)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    config = Settings.from_env()
    spark = use_utc(spark or SparkSession.builder.appName(f"racestream-{args.job}").getOrCreate())
    topics = FileTopics(args.topics) if args.topics else KafkaTopics(config.bootstrap_servers)
    if args.job in STREAMS:
        writer = stream(spark, topics, args)
        (writer.trigger(availableNow=True) if args.once else writer).start().awaitTermination()
        if args.release:
            keys = SESSION_KEYS if args.by_session else KEYS
            jobs.release_laps(spark, topics, args.checkpoint, keys, args.max_lap)
        return
    if args.job == "late":
        dropped = jobs.late_positions(spark, topics, args.checkpoint, args.on_malformed or "drop", args.time_fallback)
        dropped.write.parquet(args.output)
        return
    session = read_session(
        spark, args.landing, config.session_key, format=args.format, on_malformed=args.on_malformed or "fail"
    )
    if args.job == "replay":
        jobs.replay_job(session, topics, args.missing_time, in_order=not args.unordered)
    else:
        scheduled = schedule(merged(session, args.missing_time), config.replay_speed).orderBy(*TIMELINE_ORDER)
        messages(scheduled).write.parquet(args.output)
