"""The registered queries: every operator, run over the tables derived from the test data."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from racestream import schemas, settings
from racestream.functions.event_time import event_time
from racestream.functions.json_codec import decode, encode, split_malformed
from racestream.operators import alerts as alert_ops
from racestream.operators import board_increments
from racestream.operators import enrichment as lap_ops
from racestream.operators import leaderboard as board_ops
from racestream.operators import replay as replay_ops
from racestream.plans import defects
from racestream.schemas import RAW_TABLES
from racestream.session import new_folder
from racestream.sources.event_tables import DelayedEvents, delayed_events, read_table, read_tables, stream_tables, three_sessions
from racestream.sources.landing import read_landed
from racestream.sources.topics import FileTopics
from racestream.streaming import progress
from racestream.streaming.arrival_enrichment import enrich_arrival_stream, to_folder
from racestream.streaming.complete_enrichment import enrich_complete_stream, release
from racestream.streaming.jobs import leaderboard_snapshots, prepare, replay_job

Query = Callable[[SparkSession, str], DataFrame]


def _plain(column: str) -> Column:
    """UTC date-time without a zone, as other engines store timestamps."""
    return F.col(column).cast("timestamp_ntz").alias(column.split(".")[-1])


def _window_start() -> Column:
    return F.col("window.start").cast("timestamp_ntz").alias("window_start")


# Leaderboard

def window_last_position(spark: SparkSession, folder: str) -> DataFrame:
    last = board_ops.window_last_positions(read_table(spark, folder, "positions"))
    return last.select(_window_start(), "driver_number", "position")


def leaderboard_10s(spark: SparkSession, folder: str) -> DataFrame:
    return board_ops.leaderboard(read_table(spark, folder, "positions")).select(
        _window_start(), "position", "driver_number"
    )


def leaderboard_by_session(spark: SparkSession, folder: str) -> DataFrame:
    positions = three_sessions(read_table(spark, folder, "positions"))
    return board_ops.leaderboard(positions, by_session=True).select(
        _window_start(), "session_key", "position", "driver_number"
    )


def leaderboard_json(spark: SparkSession, folder: str) -> DataFrame:
    ranked = board_ops.leaderboard(read_table(spark, folder, "positions"))
    return board_ops.snapshot_json(board_ops.snapshots(ranked)).select(_plain("window_start"), _plain("window_end"), "value")


def leaderboard_event_order(spark: SparkSession, folder: str) -> DataFrame:
    """The last position by event time counts, whatever order the records arrived in."""
    ranked = board_ops.leaderboard(read_table(spark, folder, "positions"), last_by="event_time")
    return ranked.select(_window_start(), "position", "driver_number")


# Lap enrichment

def laps_enriched_arrival(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_tables(spark, folder, "laps", "pit_stops")
    return lap_ops.enrich_arrival(tables["laps"], tables["pit_stops"])


def laps_enriched_arrival_crowded(spark: SparkSession, folder: str) -> DataFrame:
    """With a limit so low that keys are cut into ranges."""
    tables = read_tables(spark, folder, "laps", "pit_stops")
    return lap_ops.enrich_arrival(tables["laps"], tables["pit_stops"], max_group_rows=3)


def laps_enriched_arrival_by_session(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_tables(spark, folder, "laps", "pit_stops")
    laps, pits = three_sessions(tables["laps"]), three_sessions(tables["pit_stops"])
    return lap_ops.enrich_arrival(laps, pits, lap_ops.SESSION_KEYS)


def laps_enriched_complete(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_tables(spark, folder, "laps", "pit_stops")
    return lap_ops.enrich_complete(tables["laps"], tables["pit_stops"])


def laps_enriched_complete_by_session(spark: SparkSession, folder: str) -> DataFrame:
    tables = read_tables(spark, folder, "laps", "pit_stops")
    laps, pits = three_sessions(tables["laps"]), three_sessions(tables["pit_stops"])
    return lap_ops.enrich_complete(laps, pits, lap_ops.SESSION_KEYS)


# Alerts

def race_alerts(spark: SparkSession, folder: str) -> DataFrame:
    return alert_ops.alerts(read_table(spark, folder, "race_control"), keep=("seq",))


def race_alerts_whole_words(spark: SparkSession, folder: str) -> DataFrame:
    return alert_ops.alerts(read_table(spark, folder, "race_control"), whole_words=True, keep=("seq",))


def race_alerts_json(spark: SparkSession, folder: str) -> DataFrame:
    found = alert_ops.alerts(read_table(spark, folder, "race_control"), keep=("seq",))
    return alert_ops.alert_json(found, keep=("seq",))


# Decoding and event time

def _decoded(name: str) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        documents = defects.documents(read_table(spark, folder, name), name)
        return decode(documents, defects.SCHEMAS[name], on_malformed="drop")

    return query


def decode_matrix_exact(spark: SparkSession, folder: str) -> DataFrame:
    """Laps whose documents take all kinds of values in turn; malformed ones without their values."""
    kinds = F.array(*[F.lit(text) for text in defects.matrix_documents()])
    laps = read_table(spark, folder, "laps").select("seq")
    documents = laps.select("seq", F.get(kinds, (F.col("seq") % F.size(kinds)).cast("int")).alias("value"))
    rows = decode(documents, schemas.LAPS, on_malformed="keep", exact=True)
    fields = ["lap_number", "lap_duration", "date_start", "is_pit_out_lap"]
    return rows.select("seq", "malformed", *[F.when(~F.col("malformed"), F.col(c)).alias(c) for c in fields])


def malformed_positions(spark: SparkSession, folder: str) -> DataFrame:
    documents = defects.documents(read_table(spark, folder, "positions"), "positions")
    _, bad = split_malformed(decode(documents, schemas.POSITIONS, on_malformed="keep"))
    return bad.select("seq", "value")


def laps_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    published = read_table(spark, folder, "laps").select("seq", encode(*schemas.LAPS.names).alias("value"))
    return decode(published, schemas.LAPS, on_malformed="fail")


def pit_stops_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    published = read_table(spark, folder, "pit_stops").select("seq", encode(*schemas.PIT_STOPS.names).alias("value"))
    return decode(published, schemas.PIT_STOPS, on_malformed="fail")


def event_time_fallback(spark: SparkSession, folder: str) -> DataFrame:
    dates = defects.odd_dates(read_table(spark, folder, "positions"))
    text = F.col("text")
    return dates.select(
        "seq",
        event_time(text, F.col("t")).cast("timestamp_ntz").alias("ingest"),
        event_time(text, "epoch").cast("timestamp_ntz").alias("epoch"),
        event_time(text, "null").isNull().alias("unusable"),
    )


# Session filter and replay

def _landed(spark: SparkSession, folder: str, format: str) -> DataFrame:
    """Positions of three sessions, landed as files, and one session read back."""
    landed = new_folder(spark, "landed")
    positions = three_sessions(read_table(spark, folder, "positions")).select(*schemas.POSITIONS.names)
    positions.write.format(format).save(landed)
    rows = read_landed(spark, landed, "positions", settings.DEFAULT_SESSION_KEY, format=format)
    return rows.select(*schemas.POSITIONS.names)


def session_filter(spark: SparkSession, folder: str) -> DataFrame:
    return _landed(spark, folder, "parquet")


def session_filter_json(spark: SparkSession, folder: str) -> DataFrame:
    return _landed(spark, folder, "json")


def timeline(spark: SparkSession, folder: str) -> DataFrame:
    ordered = replay_ops.timeline(read_tables(spark, folder))
    return ordered.select(_plain("time"), "source_rank", "seq", "topic", "key")


# The fields of all four payloads.
_PAYLOAD = (
    "session_key INT, driver_number INT, position INT, lap_number INT, lap_duration DOUBLE, pit_duration DOUBLE, date STRING, "
    "date_start STRING, is_pit_out_lap BOOLEAN, message STRING, category STRING, flag STRING"
)


def timeline_messages(spark: SparkSession, folder: str) -> DataFrame:
    """All payloads, decoded; those without fractions, whose text may differ by engine, as text too."""
    ordered = replay_ops.timeline(read_tables(spark, folder))
    exact = F.col("topic").isin(settings.TOPIC_POSITIONS, settings.TOPIC_RACE_CONTROL)
    return ordered.select(
        "seq",
        "topic",
        "key",
        F.when(exact, F.col("value")).alias("value"),
        F.from_json("value", _PAYLOAD).alias("payload"),
    ).select("seq", "topic", "key", "value", "payload.*")


def _scheduled(tables: dict[str, DataFrame], missing_time: str, speed: float) -> DataFrame:
    scheduled = replay_ops.schedule(replay_ops.merged(tables, missing_time), speed)
    return scheduled.orderBy(*replay_ops.TIMELINE_ORDER).select("seq", "topic", _plain("time"), "target_ms")


def replay_schedule(spark: SparkSession, folder: str) -> DataFrame:
    return _scheduled(read_tables(spark, folder), "epoch", settings.DEFAULT_REPLAY_SPEED)


def _some_undated(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    tables = read_tables(spark, folder)
    undated = F.when(F.col("seq") % 50 != 7, F.col("date")).alias("date")
    return {**tables, "pit_stops": tables["pit_stops"].withColumn("date", undated)}


def replay_schedule_undated_first(spark: SparkSession, folder: str) -> DataFrame:
    return _scheduled(_some_undated(spark, folder), "epoch", 3.0)


def replay_schedule_undated_dropped(spark: SparkSession, folder: str) -> DataFrame:
    return _scheduled(_some_undated(spark, folder), "drop", 3.0)


def published_in_key_order(spark: SparkSession, folder: str) -> DataFrame:
    """All topics after a replay in many small parts: of each key, the place of a record by offset, and its time.

    Payloads without fractions, whose text may differ by engine, tell records of equal times apart.
    """
    topics = FileTopics(new_folder(spark, "topics"))
    tables = read_tables(spark, folder)
    replay_job(tables, topics, lanes=7, part_rows=997)
    by_offset = Window.partitionBy("topic", "key").orderBy("offset")
    logs = [topics.read(spark, RAW_TABLES[name].topic).withColumn("topic", F.lit(RAW_TABLES[name].topic)) for name in tables]
    exact = F.col("topic").isin(settings.TOPIC_POSITIONS, settings.TOPIC_RACE_CONTROL)
    return reduce(DataFrame.unionByName, logs).select(
        "topic",
        "key",
        F.row_number().over(by_offset).cast("long").alias("nth"),
        F.col("ingest_time").cast("timestamp_ntz").alias("time"),
        F.when(exact, F.col("value")).alias("value"),
    )


def published_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Records by topic, counted while they are published."""
    counts = replay_job(read_tables(spark, folder), FileTopics(new_folder(spark, "topics")))
    return spark.createDataFrame(list(counts.items()), "topic STRING, records BIGINT")


def leaderboard_by_increments(spark: SparkSession, folder: str) -> DataFrame:
    """Positions that arrive in five parts, out of order; each is reduced and stored once, and merged with the others."""
    positions = read_table(spark, folder, "positions")
    store = new_folder(spark, "board")
    for part in range(5):
        board_increments.add(store, part, positions.where(F.col("seq") % 5 == (3 * part + 2) % 5))
        if part == 2:
            board_increments.fold(spark, store)
    return board_ops.rankings(board_increments.last_positions(spark, store)).select(_window_start(), "position", "driver_number")


def leaderboard_changed_by_increment(spark: SparkSession, folder: str) -> DataFrame:
    """The boards of those windows that the last of several parts has touched."""
    positions = read_table(spark, folder, "positions")
    store = new_folder(spark, "board")
    parts = [F.col("driver_number") <= 12, F.col("seq") % 40 < 20, F.col("seq") % 40 == 39]
    for part, condition in enumerate(parts):
        board_increments.add(store, part, positions.where(condition))
    changed = board_increments.last_positions(spark, store, changed_by=2)
    return board_ops.rankings(changed).select(_window_start(), "position", "driver_number")


def topic_counts(spark: SparkSession, folder: str) -> DataFrame:
    return replay_ops.topic_counts(replay_ops.merged(read_tables(spark, folder)))


# Streams

def _run(writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what is there, then stop."""
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def _run_to_table(spark: SparkSession, rows: DataFrame, purpose: str) -> DataFrame:
    folder = new_folder(spark, purpose)
    _run(rows.writeStream.format("parquet").option("path", f"{folder}/out").outputMode("append"), f"{folder}/checkpoint")
    return spark.read.schema(rows.schema).parquet(f"{folder}/out")


def leaderboard_stream(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    snapshots = leaderboard_snapshots(stream_tables(spark, folder, "positions")["positions"])
    return _run_to_table(spark, snapshots, "leaderboard").select(_plain("window_start"), _plain("window_end"), "value")


def race_alerts_stream(spark: SparkSession, folder: str) -> DataFrame:
    found = alert_ops.alerts(stream_tables(spark, folder, "race_control")["race_control"], keep=("seq",))
    return _run_to_table(spark, found, "alerts")


def laps_enriched_stream(spark: SparkSession, folder: str) -> DataFrame:
    tables = stream_tables(spark, folder, "laps", "pit_stops")
    target = new_folder(spark, "laps-enriched")
    out = to_folder(f"{target}/out")
    _run(enrich_arrival_stream(tables["laps"], tables["pit_stops"], f"{target}/state", out, fold_every=3), f"{target}/checkpoint")
    return spark.read.parquet(f"{target}/out").drop("batch")


def laps_enriched_complete_stream(spark: SparkSession, folder: str) -> DataFrame:
    """All laps: those settled while the streams ran, and those given out at their end."""
    tables = stream_tables(spark, folder, "laps", "pit_stops")
    target = new_folder(spark, "laps-complete")
    out = to_folder(f"{target}/out")
    _run(enrich_complete_stream(tables["laps"], tables["pit_stops"], f"{target}/state", out), f"{target}/checkpoint")
    release(spark, f"{target}/state", lap_ops.tag(tables["laps"], tables["pit_stops"]).schema, out)
    return spark.read.parquet(f"{target}/out").drop("batch")


# Restarts, and what the checkpoints tell


class _Stopped(Exception):
    """Stands for the loss of the driver."""


def _run_interrupted(make: Callable[[Callable], DataStreamWriter], write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Runs a stream that is stopped twice: before a micro-batch is written, and between its write and its commit."""
    stops = {2: "before", 5: "after"}

    def stopping(rows: DataFrame, batch_id: int) -> None:
        when = stops.pop(batch_id, None)
        if when != "before":
            write(rows, batch_id)
        if when is not None:
            raise _Stopped(f"stopped {when} the write of batch {batch_id}")

    while True:
        try:
            _run(make(stopping), checkpoint)
        except StreamingQueryException as error:
            if _Stopped.__name__ not in str(error):
                raise
        else:
            return


def leaderboard_stream_restarted(spark: SparkSession, folder: str) -> DataFrame:
    prepare(spark)
    snapshots = leaderboard_snapshots(stream_tables(spark, folder, "positions")["positions"])
    target = new_folder(spark, "leaderboard")
    make = lambda write: snapshots.writeStream.outputMode("append").foreachBatch(write)
    _run_interrupted(make, to_folder(f"{target}/out"), f"{target}/checkpoint")
    rows = spark.read.schema(snapshots.schema).parquet(f"{target}/out")
    return rows.select(_plain("window_start"), _plain("window_end"), "value")


def laps_enriched_stream_restarted(spark: SparkSession, folder: str) -> DataFrame:
    tables = stream_tables(spark, folder, "laps", "pit_stops")
    target = new_folder(spark, "laps-enriched")
    make = lambda write: enrich_arrival_stream(tables["laps"], tables["pit_stops"], f"{target}/state", write, fold_every=3)
    _run_interrupted(make, to_folder(f"{target}/out"), f"{target}/checkpoint")
    return spark.read.parquet(f"{target}/out").drop("batch")


def laps_enriched_complete_stream_restarted(spark: SparkSession, folder: str) -> DataFrame:
    tables = stream_tables(spark, folder, "laps", "pit_stops")
    target = new_folder(spark, "laps-complete")
    out = to_folder(f"{target}/out")
    make = lambda write: enrich_complete_stream(tables["laps"], tables["pit_stops"], f"{target}/state", write)
    _run_interrupted(make, out, f"{target}/checkpoint")
    release(spark, f"{target}/state", lap_ops.tag(tables["laps"], tables["pit_stops"]).schema, out)
    return spark.read.parquet(f"{target}/out").drop("batch")


def laps_enriched_stream_by_ingest_time(spark: SparkSession, folder: str) -> DataFrame:
    """Laps whose pit stops arrive late or early, and are forgotten five minutes of ingest time after they came."""
    tables = delayed_events(spark, folder).streams("laps", "pit_stops")
    target = new_folder(spark, "laps-enriched")
    writer = enrich_arrival_stream(
        tables["laps"],
        tables["pit_stops"],
        f"{target}/state",
        to_folder(f"{target}/out"),
        keep_for="5 minutes",
        fold_every=3,
        keep_by="ingest_time",
        checkpoint=f"{target}/checkpoint",
    )
    _run(writer, f"{target}/checkpoint")
    return spark.read.parquet(f"{target}/out").drop("batch")


def _delayed_leaderboard(spark: SparkSession, folder: str) -> tuple[DelayedEvents, str, StreamingQuery]:
    """Delayed events, the checkpoint of a leaderboard of them, and the query that has run."""
    prepare(spark)
    events = delayed_events(spark, folder)
    target = new_folder(spark, "leaderboard")
    writer = leaderboard_snapshots(events.streams("positions")["positions"]).writeStream.format("parquet").option("path", f"{target}/out").outputMode("append")
    query = writer.option("checkpointLocation", f"{target}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return events, f"{target}/checkpoint", query


def leaderboard_late_by_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Per micro-batch: rows read, records too late and groups of them, and Spark's counters of dropped and open groups."""
    events, checkpoint, query = _delayed_leaderboard(spark, folder)
    read = progress.files_of(spark, checkpoint)
    positions = events.read("positions", lambda rows: progress.of_files(rows, read))
    late = progress.late(positions, progress.micro_batches(spark, checkpoint)).groupBy("batch_id")
    late = late.agg(F.count(F.lit(1)).alias("late_records"), F.count_distinct("window", "driver_number").alias("late_groups"))
    counted = progress.counters(query).where("input_rows > 0").join(late, "batch_id", "left")
    return counted.select(
        "batch_id",
        "input_rows",
        *[F.coalesce(c, F.lit(0)).alias(c) for c in ("late_records", "late_groups")],
        "dropped_groups",
        "open_groups",
    )


def leaderboard_open_windows(spark: SparkSession, folder: str) -> DataFrame:
    """What the leaderboard still holds when its input has ended: the last position of each driver of an open window."""
    _, checkpoint, _ = _delayed_leaderboard(spark, folder)
    held = progress.state(spark, checkpoint, operator=1)
    return held.select(_plain("key.window.start").alias("window_start"), "key.driver_number", F.col("value.valueWithExtremumOrdering").alias("position"))


QUERIES: dict[str, Query] = {
    "leaderboard_10s": leaderboard_10s,
    "leaderboard_by_session": leaderboard_by_session,
    "leaderboard_json": leaderboard_json,
    "leaderboard_event_order": leaderboard_event_order,
    "window_last_position": window_last_position,
    "leaderboard_stream": leaderboard_stream,
    "laps_enriched_arrival": laps_enriched_arrival,
    "laps_enriched_arrival_crowded": laps_enriched_arrival_crowded,
    "laps_enriched_arrival_by_session": laps_enriched_arrival_by_session,
    "laps_enriched_complete": laps_enriched_complete,
    "laps_enriched_complete_by_session": laps_enriched_complete_by_session,
    "laps_enriched_stream": laps_enriched_stream,
    "laps_enriched_complete_stream": laps_enriched_complete_stream,
    "leaderboard_stream_restarted": leaderboard_stream_restarted,
    "laps_enriched_stream_restarted": laps_enriched_stream_restarted,
    "laps_enriched_complete_stream_restarted": laps_enriched_complete_stream_restarted,
    "laps_enriched_stream_by_ingest_time": laps_enriched_stream_by_ingest_time,
    "leaderboard_late_by_batch": leaderboard_late_by_batch,
    "leaderboard_open_windows": leaderboard_open_windows,
    "race_alerts": race_alerts,
    "race_alerts_whole_words": race_alerts_whole_words,
    "race_alerts_json": race_alerts_json,
    "race_alerts_stream": race_alerts_stream,
    "decode_positions": _decoded("positions"),
    "decode_laps": _decoded("laps"),
    "decode_race_control": _decoded("race_control"),
    "malformed_positions": malformed_positions,
    "laps_roundtrip": laps_roundtrip,
    "pit_stops_roundtrip": pit_stops_roundtrip,
    "event_time_fallback": event_time_fallback,
    "session_filter": session_filter,
    "session_filter_json": session_filter_json,
    "timeline": timeline,
    "timeline_messages": timeline_messages,
    "replay_schedule": replay_schedule,
    "replay_schedule_undated_first": replay_schedule_undated_first,
    "replay_schedule_undated_dropped": replay_schedule_undated_dropped,
    "topic_counts": topic_counts,
    "published_in_key_order": published_in_key_order,
    "published_counts": published_counts,
    "leaderboard_by_increments": leaderboard_by_increments,
    "leaderboard_changed_by_increment": leaderboard_changed_by_increment,
    "decode_matrix_exact": decode_matrix_exact,
}
