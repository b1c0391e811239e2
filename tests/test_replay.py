import json

import pytest

import tables
from pyspark.sql import functions as F

from racestream import schemas
from racestream.operators.replay import TIMELINE_ORDER, merged, messages, schedule, timeline, topic_counts
from racestream.sources.event_tables import read_tables


def session(spark, position_times=(0, 3.001, 10)):
    return {
        "positions": tables.positions(spark, [(t, 44, 1) for t in position_times]),
        "laps": tables.laps(spark, [(10, 0, 44, 1)]),
        "pit_stops": tables.pits(spark, [(10, 0, 63, 1, 20.5)]),
        "race_control": tables.race_control(spark, []),
    }


def targets(tables_, **options):
    scheduled = schedule(merged(tables_, **options), 2.0).orderBy(*TIMELINE_ORDER)
    return [r.target_ms for r in scheduled.collect() if r.topic == "f1.positions"]


def test_offsets_are_scaled_and_truncated(spark):
    assert targets(session(spark)) == [0, 1500, 5000]


def test_a_record_without_time_becomes_the_start(spark):
    got = targets(session(spark, (0, 3.001, 10, None)))
    assert got[0] == 0 and all(t > 26 * 365 * 86_400_000 for t in got[1:])
    assert targets(session(spark, (0, 3.001, 10, None)), missing_time="drop") == [0, 1500, 5000]


def test_equal_times_keep_table_and_source_order(spark):
    all_at_zero = {
        "race_control": tables.race_control(spark, [("RED", None)]),
        "pit_stops": tables.pits(spark, [(0, 5, 63, 1, None)]),
        "laps": tables.laps(spark, [(0, 9, 44, 2), (0, 2, 44, 1)]),
        "positions": tables.positions(spark, [(0, 44, 1), (0, 1, 2)]),
    }
    rows = timeline(all_at_zero).collect()
    assert [(r.topic, r.key) for r in rows] == [
        ("f1.positions", "44"), ("f1.positions", "1"), ("f1.laps", "44"), ("f1.laps", "44"), ("f1.pit_stops", "63"),
        ("f1.race_control", "rc"),
    ]
    assert [json.loads(r.value)["lap_number"] for r in rows if r.topic == "f1.laps"] == [1, 2]


def test_payload_has_the_fields_of_the_table_and_its_nulls(spark):
    row = messages(merged({"pit_stops": tables.pits(spark, [(0, 5, 63, 1, None)])})).first()
    assert row.asDict().keys() == {"time", "source_rank", "seq", "topic", "key", "value"}
    assert json.loads(row.value) == {
        "session_key": 9161, "driver_number": 63, "lap_number": 1, "pit_duration": None, "date": tables.iso(0)
    }
    assert list(json.loads(row.value)) == schemas.PIT_STOPS.names


def test_empty_session(spark):
    nothing = {"positions": tables.positions(spark, []), "laps": tables.laps(spark, [])}
    assert schedule(merged(nothing)).collect() == []


def test_counts(spark):
    assert {r.topic: r.records for r in topic_counts(merged(session(spark))).collect()} == {
        "f1.positions": 3, "f1.laps": 1, "f1.pit_stops": 1
    }


@pytest.mark.parametrize("speed", [0, -1, float("nan")])
def test_speed_must_be_positive(spark, speed):
    with pytest.raises(ValueError):
        schedule(merged(session(spark)), speed)


def test_unknown_handling_of_missing_times(spark):
    with pytest.raises(ValueError):
        merged(session(spark), "skip")


def test_timeline_is_in_order_within_and_across_partitions(spark):
    """On generated data: every partition is sorted, and none reaches into the next."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = timeline(read_tables(spark, "/root/testdata/sf0.01"))
        rows = ordered.select(*TIMELINE_ORDER, F.monotonically_increasing_id().alias("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    rows.sort(key=lambda r: r.n)
    keys = [(r.time, r.source_rank, r.seq) for r in rows]
    assert len(keys) == 10_000 and keys == sorted(keys)
    assert len({r.n >> 33 for r in rows}) > 1
