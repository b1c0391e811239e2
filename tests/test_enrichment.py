import random

import pytest
from pyspark.sql import functions as F

import tables
from racestream.operators import carry_forward
from racestream.operators.enrichment import SESSION_KEYS, enrich_arrival, enrich_complete, enriched_json

# Arrival order: lap 1, pit lap 2, lap 2, pit lap 2 without duration, lap 2 again, lap 3, pit lap 3.
LAPS = [(1, 1, 44, 1), (3, 3, 44, 2), (5, 5, 44, 2), (6, 6, 44, 3)]
PITS = [(2, 2, 44, 2, 20.1), (4, 4, 44, 2, None), (7, 7, 44, 3, 25.0)]


def outcome(df):
    return [(r.seq, r.lap_number, r.pit_duration, r.had_pit_stop) for r in df.orderBy("seq").collect()]


@pytest.mark.parametrize("max_group_rows", [None, 1000, 1])
def test_arrival(spark, max_group_rows):
    got = enrich_arrival(tables.laps(spark, LAPS), tables.pits(spark, PITS), max_group_rows=max_group_rows)
    assert outcome(got) == [(1, 1, None, False), (3, 2, 20.1, True), (5, 2, None, False), (6, 3, None, False)]


@pytest.mark.parametrize("max_broadcast_bytes", [100_000, 0])
def test_complete(spark, max_broadcast_bytes):
    got = enrich_complete(tables.laps(spark, LAPS), tables.pits(spark, PITS), max_broadcast_bytes=max_broadcast_bytes)
    assert outcome(got) == [(1, 1, None, False), (3, 2, None, False), (5, 2, None, False), (6, 3, 25.0, True)]


def test_complete_within_a_longest_lap(spark):
    laps = tables.laps(spark, [(0, 1, 44, 1), (100, 2, 44, 1)])
    pits = tables.pits(spark, [(50, 3, 44, 1, 20.0), (700, 4, 44, 1, 30.0)])
    assert outcome(enrich_complete(laps, pits)) == [(1, 1, 30.0, True), (2, 1, 30.0, True)]
    assert outcome(enrich_complete(laps, pits, max_lap="10 minutes")) == [(1, 1, 20.0, True), (2, 1, 30.0, True)]


def test_laps_precede_pit_stops_at_equal_times(spark):
    got = enrich_arrival(tables.laps(spark, [(1, 9, 44, 1)]), tables.pits(spark, [(1, 1, 44, 1, 20.0)]))
    assert outcome(got) == [(9, 1, None, False)]


@pytest.mark.parametrize("enrich", [enrich_arrival, enrich_complete])
def test_sessions_bleed_unless_told_apart(spark, enrich):
    laps = tables.laps(spark, [(5, 5, 44, 9)], session=2)
    pits = tables.pits(spark, [(1, 1, 44, 9, 21.0)], session=1)
    assert outcome(enrich(laps, pits)) == [(5, 9, 21.0, True)]
    assert outcome(enrich(laps, pits, SESSION_KEYS)) == [(5, 9, None, False)]


def test_json_keeps_nulls(spark):
    got = enriched_json(enrich_arrival(tables.laps(spark, [(1, 1, 44, 1)]), tables.pits(spark, []))).first().value
    assert got == (
        '{"session_key":9161,"driver_number":44,"lap_number":1,"lap_duration":80.5,'
        '"date_start":"2023-05-28T13:00:01.000000+00:00","is_pit_out_lap":false,"pit_duration":null,"had_pit_stop":false}'
    )


def brute_force(laps, pits):
    """Walk the merged rows one by one."""
    merged = sorted([(t, 0, s, d, n, None) for t, s, d, n in laps] + [(t, 1, s, d, n, x) for t, s, d, n, x in pits])
    seen, result = {}, []
    for _, rank, seq, driver, lap, duration in merged:
        if rank == 1:
            seen[driver, lap] = duration
        else:
            found = seen.get((driver, lap))
            result.append((seq, lap, found, found is not None))
    return sorted(result)


@pytest.mark.parametrize("max_group_rows", [None, 400, 50, 7])
def test_arrival_with_crowded_keys_and_times(spark, max_group_rows):
    """A third of the rows in one key, a third of those at one time; small limits cut them into many slices."""
    rng = random.Random(7)
    laps, pits = [], []
    for seq in range(1500):
        crowded = rng.random() < 0.34
        driver, lap = (44, 1) if crowded else (rng.randrange(1, 30), rng.randrange(1, 20))
        t = 0 if crowded and rng.random() < 0.34 else rng.randrange(0, 500)
        if rng.random() < 0.6:
            laps.append((t, seq, driver, lap))
        else:
            pits.append((t, seq, driver, lap, None if rng.random() < 0.2 else round(rng.uniform(18, 40), 3)))
    got = enrich_arrival(tables.laps(spark, laps), tables.pits(spark, pits), max_group_rows=max_group_rows)
    assert outcome(got) == brute_force(laps, pits)


def test_rows_without_time_come_first(spark):
    laps, pits = [(None, 1, 44, 1), (3, 3, 44, 1)], [(None, 2, 44, 1, 20.0)]
    for limit in (None, 1):
        got = enrich_arrival(tables.laps(spark, laps), tables.pits(spark, pits), max_group_rows=limit)
        assert outcome(got) == [(1, 1, None, False), (3, 1, 20.0, True)]


def test_complete_takes_the_latest_of_several(spark):
    laps = tables.laps(spark, [(1, 1, 44, 1)])
    pits = tables.pits(spark, [(9, 3, 44, 1, 22.0), (5, 8, 44, 1, 30.0), (9, 4, 44, 1, 23.0)])
    assert outcome(enrich_complete(laps, pits)) == [(1, 1, 23.0, True)]


def test_other_columns_do_not_leak(spark):
    laps = tables.laps(spark, [(1, 1, 44, 1)]).withColumn("ingest_time", F.current_timestamp())
    assert enrich_arrival(laps, tables.pits(spark, [])).columns == enrich_complete(laps, tables.pits(spark, [])).columns


@pytest.mark.parametrize("max_ways", [64, 5])
def test_a_key_of_many_slices_is_cut_round_by_round(spark, monkeypatch, max_ways):
    """What is kept of a range does not grow with the key, and slices are as small as asked for."""
    bounds, slices = [], []
    written, across = carry_forward.written, carry_forward._across_slices

    def watched(df, purpose):
        table = written(df, purpose)
        if purpose == "crowded-bounds":
            bounds.append(table.agg(F.max(F.size("_bounds"))).first()[0])
        return table

    def measured(sliced, *args):
        slices.append(sliced.groupBy("driver_number", "lap_number", "_slice").count().agg(F.max("count"), F.count("*")).first())
        return across(sliced, *args)

    monkeypatch.setattr(carry_forward, "MAX_WAYS", max_ways, raising=False)
    monkeypatch.setattr(carry_forward, "written", watched)
    monkeypatch.setattr(carry_forward, "_across_slices", measured)
    rng = random.Random(3)
    laps, pits = [], []
    for seq, t in enumerate(rng.sample(range(100_000), 3000)):
        if rng.random() < 0.6:
            laps.append((t, seq, 44, 1))
        else:
            pits.append((t, seq, 44, 1, None if rng.random() < 0.2 else round(rng.uniform(18, 40), 3)))
    got = enrich_arrival(tables.laps(spark, laps), tables.pits(spark, pits), max_group_rows=3)
    assert outcome(got) == brute_force(laps, pits)
    assert len(bounds) > 1 and max(bounds) < max_ways
    assert slices[0][0] <= 8 and slices[0][1] > 700
