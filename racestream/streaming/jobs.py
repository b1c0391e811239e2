"""The jobs, from topic to topic. Each streaming job returns a configured writer; call ``start()`` on it.

Streaming state lives in the checkpoint, so a restarted job goes on where it stopped. The number of shuffle
partitions of a stateful job is fixed by its first start.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from racestream import settings
from racestream.functions.json_codec import decode, split_malformed
from racestream.operators import alerts as alert_ops
from racestream.operators import leaderboard as board_ops
from racestream.operators import replay as replay_ops
from racestream.operators.enrichment import KEYS, enriched_json, tag
from racestream.schemas import RAW_TABLES
from racestream.session import use_utc
from racestream.sources.key_order import LANES, PART_ROWS, arranged
from racestream.sources.topics import KafkaTopics, Topics, typed
from racestream.streaming import progress
from racestream.streaming.arrival_enrichment import enrich_arrival_stream
from racestream.streaming.complete_enrichment import enrich_complete_stream, release

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the streaming jobs: UTC, and state outside the Java heap, saved as changes.

    They hold for the first start of a job; a checkpoint keeps the state format it was made with.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    return use_utc(spark)


def leaderboard_snapshots(
    positions: DataFrame, watermark: str = settings.OUT_OF_ORDERNESS, by_session: bool = False, last_by: str = "arrival"
) -> DataFrame:
    """Snapshots of closed windows, from a stream of positions. Two states: drivers of a window, and windows."""
    last = board_ops.window_last_positions(positions.withWatermark("t", watermark), by_session=by_session, last_by=last_by)
    return board_ops.snapshot_json(board_ops.driver_snapshots(last))


def leaderboard_job(
    spark: SparkSession,
    topics: Topics,
    checkpoint: str,
    on_malformed: str = "drop",
    time_fallback: str = "ingest",
    by_session: bool = False,
    last_by: str = "arrival",
) -> DataStreamWriter:
    """Positions to leaderboard snapshots. Malformed records are ignored. ``last_by='event_time'`` suits replayed topics."""
    records = topics.read_stream(prepare(spark), settings.TOPIC_POSITIONS)
    positions = typed(records, "positions", on_malformed, time_fallback)
    snapshots = leaderboard_snapshots(positions, by_session=by_session, last_by=last_by)
    return topics.write_stream(snapshots, settings.TOPIC_LEADERBOARD, checkpoint)


def alerts_job(
    spark: SparkSession, topics: Topics, checkpoint: str, on_malformed: str = "fail", whole_words: bool = False
) -> DataStreamWriter:
    """Race-control messages to alerts. No state, no shuffle."""
    records = topics.read_stream(prepare(spark), settings.TOPIC_RACE_CONTROL)
    messages = typed(records, "race_control", on_malformed)
    alerts = alert_ops.alert_json(alert_ops.alerts(messages, whole_words))
    return topics.write_stream(alerts, settings.TOPIC_ALERTS, checkpoint)


def _laps_and_pits(
    spark: SparkSession, topics: Topics, on_malformed: str, time_fallback: str = "ingest"
) -> tuple[DataFrame, DataFrame]:
    laps = typed(topics.read_stream(spark, settings.TOPIC_LAPS), "laps", on_malformed, time_fallback)
    pits = typed(topics.read_stream(spark, settings.TOPIC_PIT_STOPS), "pit_stops", on_malformed, time_fallback)
    return laps, pits


def _publish_laps(topics: Topics) -> Callable[[DataFrame, int], None]:
    """Writes the enriched laps of a micro-batch; files of a repeated batch are replaced."""
    def write(rows: DataFrame, batch_id: int) -> None:
        values = enriched_json(rows)
        if isinstance(topics, KafkaTopics):
            no_key = F.lit(None).cast("string").alias("key")
            topics.write(values.select(F.lit(settings.TOPIC_LAPS_ENRICHED).alias("topic"), no_key, "value"))
        else:
            folder = f"{topics.path(settings.TOPIC_LAPS_ENRICHED)}/batch={batch_id}"
            values.write.mode("overwrite").format(topics.format).save(folder)

    return write


def enrichment_job(
    spark: SparkSession,
    topics: Topics,
    checkpoint: str,
    on_malformed: str = "fail",
    keys: Sequence[str] = KEYS,
    keep_for: str | None = None,
    time_fallback: str = "ingest",
    keep_by: str = "event_time",
) -> DataStreamWriter:
    """Laps and pit stops to laps with the pit stop seen before them. State is kept below the checkpoint.

    ``keep_by='ingest_time'`` measures ``keep_for`` by the time of the records in their topics.
    """
    laps, pits = (
        rows.withColumn("ingest_time", F.col("seq.ingest_time"))
        for rows in _laps_and_pits(prepare(spark), topics, on_malformed, time_fallback)
    )
    writer = enrich_arrival_stream(
        laps, pits, f"{checkpoint}/seen-pit-stops", _publish_laps(topics), keys, keep_for, keep_by=keep_by, checkpoint=checkpoint
    )
    return writer.option("checkpointLocation", checkpoint)


def complete_enrichment_job(
    spark: SparkSession,
    topics: Topics,
    checkpoint: str,
    on_malformed: str = "fail",
    keys: Sequence[str] = KEYS,
    max_lap: str = "10 minutes",
    time_fallback: str = "ingest",
) -> DataStreamWriter:
    """Laps and pit stops to laps with their pit stop, once it can no longer follow.

    Laps without a date go by the time they were ingested, unless ``time_fallback`` says otherwise.
    """
    laps, pits = _laps_and_pits(prepare(spark), topics, on_malformed, time_fallback)
    writer = enrich_complete_stream(laps, pits, f"{checkpoint}/waiting", _publish_laps(topics), keys, max_lap)
    return writer.option("checkpointLocation", checkpoint)


def release_laps(
    spark: SparkSession, topics: Topics, checkpoint: str, keys: Sequence[str] = KEYS, max_lap: str = "10 minutes"
) -> None:
    """Publishes the laps that a stopped complete-enrichment job still holds; for the end of a session, not for a restart."""
    laps, pits = (typed(topics.read(spark, topic), name) for topic, name in ((settings.TOPIC_LAPS, "laps"), (settings.TOPIC_PIT_STOPS, "pit_stops")))
    release(spark, f"{checkpoint}/waiting", tag(laps, pits, keys).schema, _publish_laps(topics), keys, max_lap)


def late_positions(spark: SparkSession, topics: Topics, checkpoint: str, on_malformed: str = "drop", time_fallback: str = "ingest") -> DataFrame:
    """The records that a leaderboard job has dropped as too late, with their micro-batch and window; options are those of the job."""
    batches = progress.micro_batches(use_utc(spark), checkpoint)
    records = topics.read(spark, settings.TOPIC_POSITIONS)
    if isinstance(topics, KafkaTopics):
        read = progress.of_offsets(records, batches, settings.TOPIC_POSITIONS)
    else:
        read = progress.of_files(records, progress.files_of(spark, checkpoint))
    kept = typed(read.select("key", "value", "ingest_time", F.struct("batch_id", "partition").alias("partition"), "offset"), "positions", on_malformed, time_fallback)
    return progress.late(kept.withColumn("batch_id", F.col("seq.partition.batch_id")), batches).drop("seq")


def malformed_job(spark: SparkSession, topics: Topics, table: str, folder: str, checkpoint: str) -> DataStreamWriter:
    """The malformed records of a raw topic, as raw text with their place in the topic, to parquet files.

    Run it next to a job that drops them.
    """
    records = topics.read_stream(prepare(spark), RAW_TABLES[table].topic)
    _, bad = split_malformed(decode(records, RAW_TABLES[table].schema, on_malformed="keep"))
    writer = bad.writeStream.format("parquet").option("path", folder)
    return writer.option("checkpointLocation", checkpoint).outputMode("append")


def replay_job(
    tables: Mapping[str, DataFrame],
    topics: Topics,
    missing_time: str = "epoch",
    in_order: bool = True,
    lanes: int = LANES,
    part_rows: int = PART_ROWS,
) -> dict[str, int]:
    """Publish the raw tables of a session to their topics, in time order; an empty session publishes nothing.

    Returns the records of each topic that got any, counted as they are written.

    The offsets of each key follow its event times, ties in the order of the source, see ``sources.key_order``. Without ``in_order``
    the timeline is written by many tasks at once, in fewer steps, and a broker may receive neighbouring ranges of time side by side;
    the leaderboard of such topics needs ``last_by='event_time'``.
    """
    observation = Observation()
    names = [RAW_TABLES[name].topic for name in tables]
    counts = [F.count_if(F.col("topic") == topic).alias(topic) for topic in names]
    observe = lambda rows: rows.observe(observation, *counts)
    if in_order:
        records = replay_ops.merged(tables, missing_time)
        topics.write_in_order(arranged(records, replay_ops.TIMELINE_ORDER, replay_ops.messages, lanes, part_rows, observe))
    else:
        topics.write(observe(replay_ops.timeline(tables, missing_time)))
    return {topic: n for topic, n in observation.get.items() if n}
