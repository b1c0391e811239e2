import json

import pytest
from pyspark.sql import functions as F

import tables
from racestream.operators.leaderboard import driver_snapshots, leaderboard, rankings, snapshot_json, snapshots, window_last_positions


def boards(df):
    """Start of the window in seconds -> ranking."""
    rows = snapshot_json(snapshots(df)).select(F.unix_timestamp("window_start").alias("s"), "value").collect()
    start = int(tables.START.timestamp())
    return {r.s - start: r.value for r in rows}


G1 = [(0, 44, 1), (4, 44, 3), (9, 1, 1), (10, 44, 2), (11, 63, 3), (12, 1, 2)]


def test_last_position_per_driver_and_window(spark):
    got = boards(leaderboard(tables.positions(spark, G1)))
    assert got == {
        0: '{"type":"leaderboard","rankings":{"1":1,"3":44}}',
        10: '{"type":"leaderboard","rankings":{"2":1,"3":63}}',
    }


def test_arrival_decides_and_not_event_time(spark):
    got = boards(leaderboard(tables.positions(spark, [(5, 44, 1), (3, 44, 2)])))
    assert json.loads(got[0])["rankings"] == {"2": 44}


def test_ranking_is_in_numeric_order(spark):
    got = boards(leaderboard(tables.positions(spark, [(1, 5, 10), (2, 44, 2), (3, 7, 1)])))
    assert got[0].endswith('"rankings":{"1":7,"2":44,"10":5}}')


def test_windows_start_at_the_epoch_also_before_it(spark):
    before = tables.positions(spark, [(0, 1, 1)]).withColumn("t", F.timestamp_millis(F.lit(-1)))
    row = leaderboard(before).select(F.unix_millis("window.start").alias("s"), F.unix_millis("window.end").alias("e")).first()
    assert (row.s, row.e) == (-10000, 0)


def test_sessions_share_a_board_unless_told_apart(spark):
    both = tables.positions(spark, [(1, 44, 1)], session=1).unionByName(
        tables.positions(spark, [(2, 1, 1)], session=2).withColumn("seq", F.lit(9).cast("bigint"))
    )
    assert [(r.position, r.driver_number) for r in leaderboard(both).collect()] == [(1, 1)]
    apart = {(r.session_key, r.position, r.driver_number) for r in leaderboard(both, by_session=True).collect()}
    assert apart == {(1, 1, 44), (2, 1, 1)}


def test_records_without_time_are_left_out(spark):
    assert leaderboard(tables.positions(spark, [(None, 44, 1)])).count() == 0


def test_struct_arrival_orders_across_partitions(spark):
    """Offsets are compared only after the ingest time."""
    rows = tables.positions(spark, [(1, 44, 1), (2, 63, 1)]).withColumn(
        "seq",
        F.struct(
            F.col("t").alias("ingest_time"),
            F.when(F.col("driver_number") == 44, 2).otherwise(0).alias("partition"),
            F.when(F.col("driver_number") == 44, 900).otherwise(3).alias("offset"),
        ),
    )
    assert [(r.position, r.driver_number) for r in leaderboard(rows).collect()] == [(1, 63)]


def test_a_crowded_window_and_driver(spark):
    """A third of all rows in one window and driver: the last one counts."""
    n = 30_000
    rows = spark.range(n).select(
        F.lit(9161).alias("session_key"),
        F.when(F.col("id") % 3 == 0, 44).otherwise(F.col("id") % 20).cast("int").alias("driver_number"),
        (F.col("id") % 1000).cast("int").alias("position"),
        F.when(F.col("id") % 3 == 0, F.lit(tables.at(5)))
        .otherwise(F.timestamp_seconds(F.unix_seconds(F.lit(tables.START)) + F.col("id") % 600))
        .alias("t"),
        F.col("id").alias("seq"),
    )
    last = window_last_positions(rows).where((F.col("driver_number") == 44) & (F.col("window.start") == F.lit(tables.START)))
    assert last.first().position == (n - 3) % 1000


def test_last_by_event_time(spark):
    """Arrival order differs from time order: by arrival driver 44 is second, by event time first."""
    rows = tables.positions(spark, [(5, 44, 1), (3, 44, 2), (4, 63, 1)])
    by_arrival = {r.position: r.driver_number for r in leaderboard(rows).collect()}
    by_time = {r.position: r.driver_number for r in leaderboard(rows, last_by="event_time").collect()}
    assert by_arrival == {1: 63, 2: 44}
    assert by_time == {1: 44}
    with pytest.raises(ValueError):
        leaderboard(rows, last_by="offset")


@pytest.mark.parametrize("last_by", ["arrival", "event_time"])
def test_driver_snapshots_equal_ranked_ones(spark, last_by):
    rows = tables.positions(spark, [(i * 1.3 % 60, i * 7 % 20, i * 3 % 12) for i in range(200)])
    last = window_last_positions(rows, last_by=last_by)
    assert sorted(map(str, driver_snapshots(last).collect())) == sorted(map(str, snapshots(rankings(last)).collect()))
