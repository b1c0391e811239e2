"""Records of a key keep their order, however many tasks write them."""

from itertools import groupby

import pytest
from pyspark.sql import functions as F

import tables
from racestream import settings
from racestream.operators.replay import TIMELINE_ORDER, merged, messages
from racestream.sources import key_order
from racestream.sources.key_order import arranged, waves
from racestream.sources.topics import FileTopics, KafkaTopics
from racestream.streaming.jobs import replay_job


def session(spark, n=3000):
    """A driver with two thirds of all positions, many of them at one time, in mixed order."""
    rows = [((i * 7919) % n // 3 if i % 4 else 5, 44 if i % 3 else i % 10, i % 20) for i in range(n)]
    return {"positions": tables.positions(spark, rows), "race_control": tables.race_control(spark, [("RED", None)] * 50)}


def expected(session):
    rows = merged(session).select("topic", "key", "time", "seq").collect()
    keyed = sorted((r.topic, r.key, r.time, r.seq) for r in rows)
    return {key: [r[2:] for r in group] for key, group in groupby(keyed, key=lambda r: r[:2])}


@pytest.mark.parametrize("lanes, part_rows", [(1, 100), (5, 250), (64, 1_000_000), (3, 1)])
def test_places_follow_the_order_of_each_key(spark, lanes, part_rows):
    data = session(spark, 3000 if part_rows > 1 else 60)
    rows = arranged(merged(data), TIMELINE_ORDER, messages, lanes, part_rows).collect()
    lanes_of = {}
    for r in rows:
        lanes_of.setdefault((r.topic, r.lane), []).append(r.place)
    assert all(sorted(places) == list(range(len(places))) for places in lanes_of.values())
    keyed = sorted((r.topic, r.key, r.place, r.time, r.seq) for r in rows)
    assert {key: [r[3:] for r in group] for key, group in groupby(keyed, key=lambda r: r[:2])} == expected(data)
    assert all(r.value.startswith('{"session_key":9161') for r in rows)


def test_waves_hold_one_part_of_each_lane_in_one_task(spark):
    data = session(spark)
    table = arranged(merged(data), TIMELINE_ORDER, messages, lanes=4, part_rows=300)
    sent, tasks = {}, []
    for wave in waves(table):
        rows = wave.withColumn("task", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id()).collect()
        by_lane = {}
        for r in sorted(rows, key=lambda r: r["at"]):
            by_lane.setdefault((r.topic, r.lane), set()).add(r.task)
            sent.setdefault((r.topic, r.key), []).append((r.time, r.seq))
        assert all(len(t) == 1 for t in by_lane.values())
        tasks.append(max(sum(r.lane == lane and r.topic == topic for r in rows) for topic, lane in by_lane))
    assert len(tasks) > 5 and max(tasks) < 600
    assert sent == expected(data)


def test_offsets_go_on_from_what_is_there(spark, tmp_path):
    topics, data = FileTopics(str(tmp_path / "topics")), session(spark, 300)
    for _ in range(2):
        replay_job(data, topics, lanes=3, part_rows=50)
    rows = topics.read(spark, settings.TOPIC_POSITIONS).collect()
    places = {}
    for r in rows:
        places.setdefault(r.partition, []).append(r.offset)
    assert len(rows) == 600 and all(sorted(p) == list(range(len(p))) for p in places.values())
    times = {}
    for r in sorted(rows, key=lambda r: r.offset):
        times.setdefault(r.key, []).append(r.ingest_time)
    for key, found in times.items():
        half = len(found) // 2
        assert found[:half] == found[half:] == sorted(found[:half])


def test_kafka_writes_wave_by_wave(spark, monkeypatch):
    sent = []
    monkeypatch.setattr("pyspark.sql.DataFrameWriter.save", lambda self: sent.append(self))
    table = arranged(merged(session(spark, 600)), TIMELINE_ORDER, messages, lanes=2, part_rows=100)
    KafkaTopics("broker:9092").write_in_order(table)
    assert len(sent) == table.agg(F.max("nth")).first()[0] + 1 > 2
    assert KafkaTopics("b").write_options(in_order=True)["kafka.max.in.flight.requests.per.connection"] == "1"
    assert "kafka.max.in.flight.requests.per.connection" not in KafkaTopics("b").write_options()


def test_nothing_to_publish(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    empty = {name: df.limit(0) for name, df in session(spark, 30).items()}
    replay_job(empty, topics)
    assert topics.read(spark, settings.TOPIC_POSITIONS).count() == 0
    assert list(waves(arranged(merged(empty), TIMELINE_ORDER, messages))) == []
    with pytest.raises(ValueError):
        arranged(merged(empty), TIMELINE_ORDER, lanes=0)


def test_records_without_a_key_keep_their_order(spark):
    rows = spark.range(500).selectExpr("'t' AS topic", "CAST(NULL AS STRING) AS key", "(id * 37) % 500 AS time")
    found = arranged(rows, ["time"], lanes=4, part_rows=60).collect()
    assert all(r.place == r.time for r in found)


@pytest.mark.parametrize("task_rows, most_tasks", [(100_000, 1), (400, 10)])
def test_small_parts_share_a_task(spark, monkeypatch, task_rows, most_tasks):
    """The tasks, and so what they send to the driver, follow the records, however small the parts."""
    tasks, written = [], key_order.written

    def watched(df, purpose):
        if purpose == "published":
            tasks.append(df.rdd.getNumPartitions())
        return written(df, purpose)

    monkeypatch.setattr(key_order, "TASK_ROWS", task_rows, raising=False)
    monkeypatch.setattr(key_order, "written", watched)
    data = session(spark)
    table = arranged(merged(data), TIMELINE_ORDER, messages, lanes=4, part_rows=10)
    assert tasks[0] <= most_tasks and (tasks[0] > 1 or most_tasks == 1)
    rows = table.collect()
    keyed = sorted((r.topic, r.key, r.place, r.time, r.seq) for r in rows)
    assert {key: [r[3:] for r in group] for key, group in groupby(keyed, key=lambda r: r[:2])} == expected(data)
    parts, places = {}, {}
    for r in rows:
        parts.setdefault((r.topic, r.lane, r.nth), []).append(r.place)
        places.setdefault((r.topic, r.lane), []).append(r.place)
    assert max(len(part) for part in parts.values()) <= 10
    assert all(max(part) - min(part) == len(part) - 1 for part in parts.values())
    assert all(sorted(found) == list(range(len(found))) for found in places.values())
