"""Streams against the same queries in batch, over several micro-batches."""

import json

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import tables
from racestream import schemas, settings
from racestream.functions.json_codec import encode
from racestream.operators.alerts import alert_json, alerts
from racestream.operators.enrichment import enrich_arrival, enrich_complete, tag
from racestream.operators.leaderboard import leaderboard, snapshot_json, snapshots
from racestream.sources.topics import FileTopics
from racestream.streaming import arrival_enrichment, jobs
from racestream.streaming.arrival_enrichment import enrich_arrival_stream, to_folder
from racestream.streaming.complete_enrichment import enrich_complete_stream, release


class Feed:
    """A folder that grows by one file per micro-batch."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files, self.schema = spark, str(path), 0, None

    def add(self, *frames):
        for df in frames:
            self.schema = df.schema
            df.coalesce(1).write.parquet(f"{self.path}/{self.files:03d}")
            self.files += 1
        return self

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.option("recursiveFileLookup", "true").parquet(self.path)


def run(writer, checkpoint):
    query = writer.option("checkpointLocation", str(checkpoint)).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_to_folder(rows, path):
    query = run(rows.writeStream.format("parquet").option("path", f"{path}/out").outputMode("append"), f"{path}/checkpoint")
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{path}/out"), query


def dropped_late(query):
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def boards(df):
    start = int(tables.START.timestamp())
    rows = df.select(F.unix_timestamp("window_start").alias("s"), "value").collect()
    return {r.s - start: json.loads(r.value)["rankings"] for r in rows}


def test_leaderboard_stream_emits_the_closed_windows_of_the_batch(spark, tmp_path):
    rows = [(i * 0.7, i * 7 % 20, i * 3 % 12) for i in range(90)]
    whole = tables.positions(spark, rows)
    feed = Feed(spark, tmp_path / "in").add(*[whole.where(F.col("seq").between(k, k + 29)) for k in (0, 30, 60)])
    streamed, query = run_to_folder(jobs.leaderboard_snapshots(feed.stream()), tmp_path)
    batch = snapshot_json(snapshots(leaderboard(whole)))
    newest = tables.at(rows[-1][0] - 5)
    closed = batch.where(F.col("window_end") <= F.lit(newest))
    assert boards(streamed) == boards(closed)
    assert len(boards(closed)) == len(boards(batch)) - 2
    assert dropped_late(query) == 0


def test_window_closes_five_seconds_after_its_end(spark, tmp_path):
    feed = Feed(spark, tmp_path / "in").add(tables.positions(spark, [(10, 44, 2), (24.999, 1, 1)]))
    before, _ = run_to_folder(jobs.leaderboard_snapshots(feed.stream()), tmp_path)
    assert boards(before) == {}
    feed.add(tables.positions(spark, [(25, 63, 1)]))
    after, _ = run_to_folder(jobs.leaderboard_snapshots(feed.stream()), tmp_path)
    assert boards(after) == {10: {"2": 44}}


def test_late_records(spark, tmp_path):
    """A record is tested against the watermark of the micro-batch before its own."""
    feed = Feed(spark, tmp_path / "in").add(
        tables.positions(spark, [(1, 44, 1)]),
        tables.positions(spark, [(30, 1, 1), (3, 63, 2)]),  # 27 s behind, but the watermark has not moved yet
        tables.positions(spark, [(31, 1, 1), (4, 77, 3)]),  # this batch closes the window, and still counts it
        tables.positions(spark, [(32, 1, 1), (5, 20, 4)]),  # late
        tables.positions(spark, [(60, 1, 1)]),
    )
    streamed, query = run_to_folder(jobs.leaderboard_snapshots(feed.stream()), tmp_path)
    assert boards(streamed)[0] == {"1": 44, "2": 63, "3": 77}
    assert dropped_late(query) == 1


def test_a_record_without_date_can_make_later_records_late(spark, tmp_path):
    """With the ingest time as fallback the watermark leaps a year ahead; without, the record is left out."""
    def position(driver, second):
        date = "null" if second is None else f'"2023-05-28T13:00:{second:02d}Z"'
        return f'{{"driver_number":{driver},"position":{driver},"date":{date}}}'

    batches = ([position(44, 1), position(9, None)], [position(1, 2)], [position(63, 3), position(63, 40)])
    for fallback, expected in (("ingest", {"1": 1, "44": 44}), ("null", {"1": 1, "44": 44, "63": 63})):
        topics = FileTopics(str(tmp_path / fallback), options={"maxFilesPerTrigger": "1"})
        for i, documents in enumerate(batches):
            data = [(None, d, tables.at(86_400 * 365), 0, 10 * i + k) for k, d in enumerate(documents)]
            rows = spark.createDataFrame(data, schemas.TOPIC_RECORD)
            rows.coalesce(1).write.mode("append").parquet(topics.path(settings.TOPIC_POSITIONS))
        checkpoint = str(tmp_path / fallback / "checkpoint")
        run(jobs.leaderboard_job(spark, topics, checkpoint, time_fallback=fallback), checkpoint)
        values = topics.read(spark, settings.TOPIC_LEADERBOARD).select("value").collect()
        assert expected in [json.loads(v.value)["rankings"] for v in values]


def arrival_feed(spark, path, batches=3):
    whole_laps = tables.laps(spark, [(i, i, i % 3, i // 2 % 4) for i in range(0, 60, 2)])
    whole_pits = tables.pits(spark, [(i, i, i % 3, i // 2 % 4, None if i % 5 == 0 else i / 2) for i in range(1, 60, 2)])
    size = 60 // batches
    cuts = [(k * size, (k + 1) * size - 1) for k in range(batches)]
    lap_feed = Feed(spark, path / "laps").add(*[whole_laps.where(F.col("seq").between(a, b)) for a, b in cuts])
    pit_feed = Feed(spark, path / "pits").add(*[whole_pits.where(F.col("seq").between(a, b)) for a, b in cuts])
    return whole_laps, whole_pits, lap_feed, pit_feed


@pytest.mark.parametrize("max_group_rows", [None, 2])
def test_arrival_stream_equals_batch(spark, tmp_path, max_group_rows):
    whole_laps, whole_pits, lap_feed, pit_feed = arrival_feed(spark, tmp_path)
    writer = enrich_arrival_stream(
        lap_feed.stream(), pit_feed.stream(), f"{tmp_path}/state", to_folder(f"{tmp_path}/out"), max_group_rows=max_group_rows
    )
    run(writer, tmp_path / "checkpoint")
    streamed = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    expected = enrich_arrival(whole_laps, whole_pits)
    assert sorted(streamed.collect()) == sorted(expected.collect())
    assert expected.where("had_pit_stop").count() > 0


def test_arrival_stream_repeats_a_failed_batch_and_goes_on(spark, tmp_path):
    whole_laps, whole_pits, lap_feed, pit_feed = arrival_feed(spark, tmp_path)
    to_out = to_folder(f"{tmp_path}/out")
    failures = [1]

    def fail_once_in_the_second_batch(rows, batch_id):
        to_out(rows, batch_id)
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("lost after the write")

    def writer():
        return enrich_arrival_stream(lap_feed.stream(), pit_feed.stream(), f"{tmp_path}/state", fail_once_in_the_second_batch)

    with pytest.raises(StreamingQueryException):
        run(writer(), tmp_path / "checkpoint")
    run(writer(), tmp_path / "checkpoint")
    streamed = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert sorted(streamed.collect()) == sorted(enrich_arrival(whole_laps, whole_pits).collect())


def test_arrival_state_is_folded(spark, tmp_path, monkeypatch):
    """Seven or more batches with a fold every two; the folder does not grow, and a repeated fold changes nothing."""
    monkeypatch.setattr(arrival_enrichment, "FOLD_EVERY", 2)
    whole_laps, whole_pits, lap_feed, pit_feed = arrival_feed(spark, tmp_path, batches=10)
    to_out = to_folder(f"{tmp_path}/out")
    failures = [3, 4, 8]

    def write(rows, batch_id):
        to_out(rows, batch_id)
        if batch_id in failures:
            failures.remove(batch_id)
            raise RuntimeError("lost after the write")

    for expect_failure in (True, True, True, False):
        writer = enrich_arrival_stream(lap_feed.stream(), pit_feed.stream(), f"{tmp_path}/state", write)
        if expect_failure:
            with pytest.raises(StreamingQueryException):
                run(writer, tmp_path / "checkpoint")
        else:
            run(writer, tmp_path / "checkpoint")
    streamed = spark.read.parquet(f"{tmp_path}/out").drop("batch")
    assert sorted(streamed.collect()) == sorted(enrich_arrival(whole_laps, whole_pits).collect())
    assert sorted(p.name for p in (tmp_path / "state").iterdir()) == [
        "append-0", "append-1", "append-2", "append-3", "fold-0", "fold-1"
    ]


def test_what_arrived_earlier_counts_whatever_its_time(spark, tmp_path):
    laps = Feed(spark, tmp_path / "laps").add(tables.laps(spark, []), tables.laps(spark, [(1, 1, 44, 1), (2, 2, 63, 1)]))
    pits = Feed(spark, tmp_path / "pits").add(
        tables.pits(spark, [(900, 9, 44, 1, 20.0)]), tables.pits(spark, [(5, 10, 63, 1, 30.0)])
    )
    writer = enrich_arrival_stream(laps.stream(), pits.stream(), f"{tmp_path}/state", to_folder(f"{tmp_path}/out"))
    run(writer, tmp_path / "checkpoint")
    got = {r.driver_number: r.pit_duration for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {44: 20.0, 63: None}


def test_pit_stops_can_be_forgotten(spark, tmp_path):
    laps = Feed(spark, tmp_path / "laps").add(
        tables.laps(spark, [(7200, 1, 1, 1)]), tables.laps(spark, [(7201, 2, 44, 1), (7202, 3, 63, 1)])
    )
    pits = Feed(spark, tmp_path / "pits").add(
        tables.pits(spark, [(1, 1, 44, 1, 20.0), (7100, 2, 63, 1, 30.0)]), tables.pits(spark, [(7300, 4, 5, 5, 1.0)])
    )
    writer = enrich_arrival_stream(
        laps.stream(), pits.stream(), f"{tmp_path}/state", to_folder(f"{tmp_path}/out"), keep_for="1 hour"
    )
    run(writer, tmp_path / "checkpoint")
    got = {r.driver_number: r.pit_duration for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {1: None, 44: None, 63: 30.0}


def complete(spark, path, lap_batches, pit_batches, **options):
    """Laps by sequence number: given out by the stream, then by the release, and those that came too late."""
    laps = Feed(spark, path / "laps").add(*[tables.laps(spark, rows) for rows in lap_batches])
    pits = Feed(spark, path / "pits").add(*[tables.pits(spark, rows) for rows in pit_batches])
    state, out = f"{path}/state", to_folder(f"{path}/out")
    out(enrich_complete(tables.laps(spark, []), tables.pits(spark, [])), -1)  # the folder is there, whatever falls due
    run(enrich_complete_stream(laps.stream(), pits.stream(), state, out, **options), path / "checkpoint")

    def outcome():
        return {r.seq: (r.pit_duration, r.had_pit_stop) for r in spark.read.parquet(f"{path}/out").collect()}

    settled = outcome()
    late = sorted(r.seq for r in spark.read.parquet(f"{state}/late").collect())
    release(spark, state, tag(tables.laps(spark, []), tables.pits(spark, [])).schema, out, **options)
    return settled, {k: v for k, v in outcome().items() if k not in settled}, late


@pytest.mark.parametrize("max_group_rows", [None, 1])
def test_complete_stream(spark, tmp_path, max_group_rows):
    settled, rest, late = complete(
        spark,
        tmp_path,
        [[(0, 1, 44, 1), (1, 2, 63, 1), (2, 3, 1, 1), (3, 4, 7, 1)], [(5000, 9, 44, 99)], [(5001, 10, 44, 99)]],
        [
            [(80, 1, 44, 1, 20.0), (700, 2, 63, 1, 21.0), (90, 3, 7, 1, 30.0)],
            [(85, 4, 44, 1, 22.0), (95, 5, 7, 1, None), (5000, 9, 5, 99, 1.0)],
            [(5001, 10, 5, 99, 1.0)],
        ],
        max_group_rows=max_group_rows,
    )
    # Two pit stops: the later one. Pit stop after more than ten minutes: none. Later one without duration: none.
    assert settled == {1: (22.0, True), 2: (None, False), 3: (None, False), 4: (None, False)}
    assert rest == {9: (None, False), 10: (None, False)}
    assert late == []


@pytest.mark.parametrize("second", [560, 600, 610, 655, 660, 665, 670, 719, 725])
def test_a_pit_stop_is_kept_as_long_as_its_lap_waits(spark, tmp_path, second):
    """Whatever the point at which the streams are cut into micro-batches."""
    settled, rest, late = complete(
        spark,
        tmp_path,
        [[(0, 1, 44, 1)], [(second, 2, 5, 5)], [(2000, 3, 5, 6)]],
        [[(1, 1, 44, 1, 20.5)], [(second, 2, 6, 6, 1.0)], [(2000, 3, 6, 7, 1.0)]],
    )
    assert settled[1] == (20.5, True)
    assert {**settled, **rest} == {1: (20.5, True), 2: (None, False), 3: (None, False)}
    assert late == []


def test_a_late_lap_is_set_aside_and_never_called_unmatched(spark, tmp_path):
    settled, rest, late = complete(
        spark,
        tmp_path,
        [[(0, 1, 5, 5)], [(5000, 2, 5, 6)], [(70, 3, 44, 1), (5001, 4, 5, 7)]],
        [[(80, 1, 44, 1, 20.0)], [(5000, 2, 6, 6, 1.0)], [(5001, 3, 6, 7, 1.0)]],
    )
    assert 3 not in settled and 3 not in rest
    assert late == [3]


def test_a_silent_input_does_not_stop_the_other(spark, tmp_path):
    times = [0, 1800, 3600, 5400, 7200]
    settled, rest, late = complete(
        spark,
        tmp_path,
        [[(t, i, 44, i)] for i, t in enumerate(times)],
        [[(100, 1, 44, 0, 20.0)], [(101, 2, 9, 9, 1.0)]],
        idle="30 minutes",
    )
    assert settled == {0: (20.0, True), 1: (None, False), 2: (None, False)}
    assert set(rest) == {3, 4} and late == []


def test_complete_stream_equals_batch_over_many_micro_batches(spark, tmp_path):
    lap_rows = [(40 * i, i, i % 5, i % 7) for i in range(120)]
    pit_rows = [(37 * i, i, i % 5, i % 7, None if i % 6 == 0 else float(i)) for i in range(120)]
    settled, rest, late = complete(
        spark,
        tmp_path,
        [lap_rows[k : k + 10] for k in range(0, 120, 10)],
        [pit_rows[k : k + 10] for k in range(0, 120, 10)],
    )
    expected = enrich_complete(tables.laps(spark, lap_rows), tables.pits(spark, pit_rows), max_lap="10 minutes")
    assert {**settled, **rest} == {r.seq: (r.pit_duration, r.had_pit_stop) for r in expected.collect()}
    assert len(settled) > 60 and len(rest) > 5 and late == []


def test_what_a_micro_batch_writes_does_not_grow(spark, tmp_path):
    """The state takes the new rows only, and buckets go once they are settled."""
    lap_rows = [(60 * i, i, 1, i) for i in range(60)]
    pit_rows = [(60 * i, i, 2, i, 1.0) for i in range(60)]
    laps = Feed(spark, tmp_path / "laps").add(*[tables.laps(spark, lap_rows[k : k + 6]) for k in range(0, 60, 6)])
    pits = Feed(spark, tmp_path / "pits").add(*[tables.pits(spark, pit_rows[k : k + 6]) for k in range(0, 60, 6)])
    held = []

    def write(rows, batch_id):
        found = [p.parent for p in (tmp_path / "state" / "rows").glob("batch=*/bucket=*/*.parquet")]
        mine = [p for p in found if p.parent.name == f"batch={batch_id}"]
        held.append((len(set(mine)), len(set(found))))

    run(enrich_complete_stream(laps.stream(), pits.stream(), f"{tmp_path}/state", write), tmp_path / "checkpoint")
    assert len(held) >= 6
    assert all(own <= 12 for own, _ in held)
    assert max(total for _, total in held) <= 40


def publish(spark, topics, topic, documents):
    data = [(None, d, tables.at(i), 0, i) for i, d in enumerate(documents)]
    spark.createDataFrame(data, schemas.TOPIC_RECORD).coalesce(1).write.mode("append").parquet(topics.path(topic))


def test_alerts_job_goes_on_after_a_restart(spark, tmp_path):
    topics, checkpoint = FileTopics(str(tmp_path / "topics")), str(tmp_path / "checkpoint")
    rows = tables.race_control(spark, [("RED", None), ("GREEN", None), (None, "DRS DISABLED")])
    documents = [r.v for r in rows.select(encode(*schemas.RACE_CONTROL.names).alias("v")).collect()]
    publish(spark, topics, settings.TOPIC_RACE_CONTROL, documents[:1])
    run(jobs.alerts_job(spark, topics, checkpoint), checkpoint)
    publish(spark, topics, settings.TOPIC_RACE_CONTROL, documents[1:])
    run(jobs.alerts_job(spark, topics, checkpoint), checkpoint)
    got = sorted(r.value for r in topics.read(spark, settings.TOPIC_ALERTS).collect())
    assert got == sorted(r.value for r in alert_json(alerts(rows)).collect())


def test_malformed_record_ends_the_alerts_job(spark, tmp_path):
    topics, checkpoint = FileTopics(str(tmp_path / "topics")), str(tmp_path / "checkpoint")
    publish(spark, topics, settings.TOPIC_RACE_CONTROL, ["oops"])
    with pytest.raises(StreamingQueryException, match="malformed record"):
        run(jobs.alerts_job(spark, topics, checkpoint), checkpoint)


def test_from_session_to_all_processed_topics(spark, tmp_path):
    """Replay a session to its topics, run all jobs on them, read the processed topics."""
    topics = FileTopics(str(tmp_path / "topics"))
    laps = tables.laps(spark, [(0, 1, 44, 1), (90, 2, 44, 2), (1200, 3, 44, 3)])
    pits = tables.pits(spark, [(80, 1, 44, 1, 20.0), (85, 2, 44, 2, 21.0), (1300, 3, 63, 3, 22.0)])
    positions = tables.positions(spark, [(1, 44, 1), (2, 63, 2), (40, 44, 2)])
    messages = tables.race_control(spark, [("YELLOW", None), (None, None)])
    jobs.replay_job({"positions": positions, "laps": laps, "pit_stops": pits, "race_control": messages}, topics)

    for name, job in (
        ("leaderboard", jobs.leaderboard_job),
        ("alerts", jobs.alerts_job),
        ("enrichment", jobs.enrichment_job),
    ):
        checkpoint = str(tmp_path / name)
        run(job(spark, topics, checkpoint), checkpoint)

    def read(topic):
        return [json.loads(r.value) for r in topics.read(spark, topic).collect()]

    assert read(settings.TOPIC_LEADERBOARD) == [{"type": "leaderboard", "rankings": {"1": 44, "2": 63}}]
    assert [a["severity"] for a in read(settings.TOPIC_ALERTS)] == ["MEDIUM"]
    enriched = sorted((e["lap_number"], e["pit_duration"], e["had_pit_stop"]) for e in read(settings.TOPIC_LAPS_ENRICHED))
    assert enriched == [(1, None, False), (2, 21.0, True), (3, None, False)]


def test_complete_enrichment_job(spark, tmp_path):
    topics, checkpoint = FileTopics(str(tmp_path / "topics")), str(tmp_path / "checkpoint")
    laps = tables.laps(spark, [(0, 1, 44, 1), (2000, 3, 44, 3)])
    pits = tables.pits(spark, [(80, 1, 44, 1, 20.0), (2000, 3, 63, 3, 22.0)])
    jobs.replay_job({"laps": laps, "pit_stops": pits}, topics)
    run(jobs.complete_enrichment_job(spark, topics, checkpoint), checkpoint)
    jobs.release_laps(spark, topics, checkpoint)
    values = [json.loads(r.value) for r in topics.read(spark, settings.TOPIC_LAPS_ENRICHED).collect()]
    assert sorted((v["lap_number"], v["pit_duration"]) for v in values) == [(1, 20.0), (3, None)]
