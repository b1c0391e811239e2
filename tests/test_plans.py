"""The physical plans: what reaches the scan, what is shuffled, and what happens to crowded keys."""

import pytest
from pyspark.sql import functions as F

import tables
from racestream.operators import carry_forward
from racestream.operators.enrichment import enrich_complete
from racestream.plans.queries import QUERIES
from racestream.sources.event_tables import read_table

FOLDER = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


BATCH = [name for name in QUERIES if not name.endswith("_stream")]


@pytest.mark.parametrize("name", BATCH)
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "MapInPandas", "FlatMapGroups"):
        assert operator not in text


@pytest.mark.parametrize("name", ["leaderboard_10s", "window_last_position", "leaderboard_by_session"])
def test_leaderboard_hashes_and_combines_before_each_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "SortAggregate" not in text
    aggregations = 1 if name == "window_last_position" else 2
    assert text.count("Exchange hashpartitioning") == aggregations
    assert text.count("partial_max_by") == aggregations


def test_scan_reads_the_columns_it_needs(spark):
    text = plan(QUERIES["leaderboard_10s"](spark, FOLDER))
    assert "In(event_type, [click,signup])" in text
    assert "value" not in text.split("ReadSchema: struct<", 1)[1].split(">", 1)[0]


@pytest.mark.parametrize("name", ["race_alerts", "race_alerts_json", "decode_positions", "session_filter", "event_time_fallback"])
def test_row_by_row_queries_do_not_shuffle(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert "Exchange hashpartitioning" not in text and "Exchange rangepartitioning" not in text


def test_crowded_keys_are_not_copied(spark, monkeypatch):
    """Only the crowded keys and their bounds are written; the rows are read from their source again."""
    purposes = []
    original = carry_forward.written
    monkeypatch.setattr(carry_forward, "written", lambda df, purpose: purposes.append((purpose, df.columns)) or original(df, purpose))
    result = QUERIES["laps_enriched_arrival_crowded"](spark, FOLDER)
    assert [purpose for purpose, _ in purposes] == ["crowded-keys", "crowded-bounds"]
    assert all("t" not in columns and "seq" not in columns for _, columns in purposes)
    assert result.count() == 188
    assert "Exchange rangepartitioning" not in plan(result)


@pytest.mark.parametrize("name", ["timeline", "replay_schedule"])
def test_timeline_is_sorted_by_range(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    assert text.count("Exchange rangepartitioning") == 1
    assert "Exchange hashpartitioning" not in text


def test_few_pit_stops_are_broadcast_and_laps_stay_in_place(spark):
    text = plan(QUERIES["laps_enriched_complete"](spark, FOLDER))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text


def test_many_pit_stops_are_joined_by_key_and_a_crowded_key_is_split(spark):
    """A third of the laps belong to one key."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        laps = spark.range(0, 60_000, 1, 8).selectExpr(
            "9161 AS session_key", "IF(id % 3 = 0, 44, CAST(id % 1000 AS INT)) AS driver_number",
            "IF(id % 3 = 0, 1, CAST(id % 7 AS INT)) AS lap_number", "80.5D AS lap_duration", "uuid() AS date_start",
            "false AS is_pit_out_lap", "timestamp_seconds(id) AS t", "id AS seq",
        )
        pits = tables.pits(spark, [(1, 1, 44, 1, 20.0)])
        joined = enrich_complete(laps, pits, max_broadcast_bytes=0)
        assert joined.where("had_pit_stop").count() >= 20_000
        joined.collect()
        text = plan(joined)
        assert "SortMergeJoin(skew=true)" in text
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_filters_on_derived_columns_do_not_repeat_the_derivation(spark):
    rows = read_table(spark, FOLDER, "race_control").where(F.col("flag").isNotNull() & (F.col("message") == "RED FLAG"))
    assert plan(rows).count("get_json_object") == 1
