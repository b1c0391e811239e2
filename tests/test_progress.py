"""What checkpoints tell about micro-batches, late records, state and restarts."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

import tables
from racestream import schemas, settings
from racestream.cli import main
from racestream.functions.json_codec import encode
from racestream.sources.topics import FileTopics
from racestream.streaming import jobs, progress
from racestream.streaming.arrival_enrichment import enrich_arrival_stream, to_folder
from test_streaming import Feed, run


@pytest.fixture
def late_feed(spark, tmp_path):
    """Micro-batches of positions; 63 and 77 come behind the newest record but are still counted, 20 twice and 21 are not."""
    return Feed(spark, tmp_path / "in").add(
        tables.positions(spark, [(1, 44, 1)]),
        tables.positions(spark, [(30, 1, 1), (3, 63, 2)]),
        tables.positions(spark, [(31, 1, 1), (4, 77, 3)]),
        tables.positions(spark, [(32, 1, 1), (5, 20, 4), (6, 20, 5), (9.999, 21, 6), (20, 5, 9)]),
        tables.positions(spark, [(60, 1, 1)]),
    )


def test_late_records_by_micro_batch(spark, tmp_path, late_feed):
    jobs.prepare(spark)
    checkpoint = str(tmp_path / "checkpoint")
    writer = jobs.leaderboard_snapshots(late_feed.stream()).writeStream.format("parquet").option("path", f"{tmp_path}/out")
    query = run(writer, checkpoint)
    batches = progress.micro_batches(spark, checkpoint)
    seconds = lambda c: F.unix_timestamp(c) - int(tables.START.timestamp())
    found = [tuple(r) for r in batches.orderBy("batch_id").select("batch_id", seconds("watermark"), seconds("late_before"), "committed").collect()]
    epoch = -int(tables.START.timestamp())
    assert found == [(0, epoch, epoch, True), (1, -4, epoch, True), (2, 25, -4, True), (3, 26, 25, True), (4, 27, 26, True), (5, 55, 27, True)]
    records = progress.of_files(spark.read.schema(late_feed.schema).option("recursiveFileLookup", True).parquet(late_feed.path), progress.files_of(spark, checkpoint))
    assert {(r.batch_id, r.n) for r in records.groupBy("batch_id").agg(F.count("*").alias("n")).collect()} == {(0, 1), (1, 2), (2, 2), (3, 5), (4, 1)}
    late = progress.late(records, batches).select("batch_id", "driver_number", seconds("window.start")).collect()
    assert sorted(map(tuple, late)) == [(3, 20, 0), (3, 20, 0), (3, 21, 0)]
    counted = {r.batch_id: (r.input_rows, r.dropped_groups, r.open_groups) for r in progress.counters(query).collect()}
    assert counted[3] == (5, 2, 2) and counted[2] == (2, 0, 1)
    held = progress.state(spark, checkpoint, operator=1, batch_id=1).select("key.driver_number").collect()
    assert sorted(r.driver_number for r in held) == [1, 44, 63]


def test_late_job_on_file_topics(spark, tmp_path, late_feed):
    root, topics = str(tmp_path / "topics"), FileTopics(str(tmp_path / "topics"), options={"maxFilesPerTrigger": "1"})
    whole = spark.read.schema(late_feed.schema).option("recursiveFileLookup", True)
    for k in range(late_feed.files):
        rows = whole.parquet(f"{late_feed.path}/{k:03d}")
        record = rows.select(F.lit(None).cast("string").alias("key"), encode(*schemas.POSITIONS.names).alias("value"), F.col("t").alias("ingest_time"), F.lit(0).alias("partition"), F.col("seq").alias("offset"))
        record.coalesce(1).write.mode("append").parquet(topics.path(settings.TOPIC_POSITIONS))
    checkpoint = str(tmp_path / "checkpoint")
    run(jobs.leaderboard_job(spark, topics, checkpoint), checkpoint)
    main(["late", "--topics", root, "--checkpoint", checkpoint, "--output", str(tmp_path / "late")], spark)
    rows = spark.read.parquet(str(tmp_path / "late"))
    assert sorted((r.batch_id, r.driver_number, r.position) for r in rows.collect()) == [(3, 20, 4), (3, 20, 5), (3, 21, 6)]


def test_batches_of_a_broker(spark, tmp_path):
    """The offset log of a topic with two partitions, the second of which begins in the second batch."""
    ends = ['{"f1.positions":{"0":3}}', '{"f1.positions":{"0":3,"1":2}}', '{"f1.positions":{"0":5,"1":2}}']
    (tmp_path / "offsets").mkdir()
    (tmp_path / "commits").mkdir()
    for i, end in enumerate(ends):
        (tmp_path / "offsets" / str(i)).write_text(f'v1\n{{"batchWatermarkMs":{i * 1000}}}\n{end}')
        if i < 2:
            (tmp_path / "commits" / str(i)).write_text("v1\n{}")
    batches = progress.micro_batches(spark, str(tmp_path))
    assert [r.committed for r in batches.orderBy("batch_id").collect()] == [True, True, False]
    records = spark.createDataFrame([(0, o) for o in range(6)] + [(1, o) for o in range(3)], "partition INT, offset BIGINT")
    found = progress.of_offsets(records, batches, "f1.positions").select("batch_id", "partition", "offset").collect()
    assert sorted(map(tuple, found)) == [(0, 0, 0), (0, 0, 1), (0, 0, 2), (1, 1, 0), (1, 1, 1), (2, 0, 3), (2, 0, 4)]


def test_restarts_commit_every_batch_once(spark, tmp_path, late_feed):
    checkpoint, calls = str(tmp_path / "checkpoint"), []
    snapshots = jobs.leaderboard_snapshots(late_feed.stream())
    out = to_folder(f"{tmp_path}/out")

    def write(rows, batch_id):
        out(rows, batch_id)
        calls.append(batch_id)
        if calls.count(batch_id) == 1 and batch_id in (2, 3):
            raise RuntimeError("lost between write and commit")

    for k in range(3):
        if k < 2:
            with pytest.raises(StreamingQueryException):
                run(snapshots.writeStream.foreachBatch(write), checkpoint)
            assert progress.micro_batches(spark, checkpoint).where("NOT committed").count() == 1
        else:
            run(snapshots.writeStream.foreachBatch(write), checkpoint)
    assert calls == [0, 1, 2, 2, 3, 3, 4, 5]
    assert progress.micro_batches(spark, checkpoint).where("NOT committed").count() == 0
    whole = str(tmp_path / "whole")
    run(snapshots.writeStream.format("parquet").option("path", whole), f"{whole}/checkpoint")
    expected = sorted(map(tuple, spark.read.schema(snapshots.schema).parquet(whole).collect()))
    assert sorted(map(tuple, spark.read.schema(snapshots.schema).parquet(f"{tmp_path}/out").drop("batch").collect())) == expected != []


def ingest_rows(spark, laps, pits):
    """Rows of (event time, ingest time, seq, driver, lap[, duration])."""
    arrived = lambda df, rows: df.join(spark.createDataFrame([(r[2], tables.at(r[1])) for r in rows], "seq BIGINT, ingest_time TIMESTAMP"), "seq")
    return (
        arrived(tables.laps(spark, [(t, s, d, n) for t, _, s, d, n in laps]), laps),
        arrived(tables.pits(spark, [(t, s, d, n, x) for t, _, s, d, n, x in pits]), pits),
    )


@pytest.mark.parametrize("keep_for, expected", [(None, {1: 20.0, 2: 20.0, 3: 20.0}), ("100 seconds", {1: 20.0, 2: 20.0, 3: None})])
def test_pit_stops_are_forgotten_by_ingest_time(spark, tmp_path, keep_for, expected):
    """Event times a year ahead forget nothing; the watermark is that of the slower input of earlier batches."""
    year = 86_400 * 365
    frames = [
        ingest_rows(spark, [(9, 9, 0, 99, 9)], [(1, 1, 100, 44, 1, 20.0)]),
        ingest_rows(spark, [(year, 150, 1, 44, 1)], [(year, 149, 101, 99, 9, 1.0)]),
        ingest_rows(spark, [(160, 160, 2, 44, 1)], [(161, 90, 102, 98, 9, 1.0)]),
        ingest_rows(spark, [(170, 170, 3, 44, 1)], [(171, 171, 103, 97, 9, 1.0)]),
    ]
    # The marks are: none, 1 - 5, 149 - 5, 149 - 5 seconds; the pit stop came at 1.
    if keep_for:
        expected = {**expected, 2: None}
    lap_feed = Feed(spark, tmp_path / "laps").add(*[f[0] for f in frames])
    pit_feed = Feed(spark, tmp_path / "pits").add(*[f[1] for f in frames])
    writer = enrich_arrival_stream(
        lap_feed.stream(), pit_feed.stream(), f"{tmp_path}/state", to_folder(f"{tmp_path}/out"),
        keep_for=keep_for, keep_by="ingest_time", checkpoint=f"{tmp_path}/checkpoint", fold_every=2,
    )
    run(writer, f"{tmp_path}/checkpoint")
    rows = spark.read.parquet(f"{tmp_path}/out").where("seq > 0").collect()
    assert {r.seq: r.pit_duration for r in rows} == expected
    marks = progress.micro_batches(spark, f"{tmp_path}/checkpoint").orderBy("batch_id").select(F.unix_timestamp("watermark").alias("w")).collect()
    assert [m.w - int(tables.START.timestamp()) for m in marks[1:4]] == [-4, 144, 144]


def test_ingest_time_needs_a_checkpoint(spark, tmp_path):
    laps, pits = tables.laps(spark, [(1, 1, 1, 1)]), tables.pits(spark, [(1, 1, 1, 1, 1.0)])
    for options in ({"keep_by": "ingest_time"}, {"keep_by": "moon"}):
        with pytest.raises(ValueError):
            enrich_arrival_stream(laps, pits, str(tmp_path), to_folder(str(tmp_path)), **options)
