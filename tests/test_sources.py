import json

import pytest
from pyspark.errors import PySparkException

import tables
from racestream import settings
from racestream.schemas import LAPS, POSITIONS, TOPIC_RECORD
from racestream.sources.landing import FOLDERS, files_without_rows, read_landed, read_session
from racestream.sources.topics import FileTopics, KafkaTopics, typed
from racestream.streaming.jobs import replay_job


def land(path, documents):
    path.mkdir(parents=True)
    (path / "a.json").write_text("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))
    return str(path)


POSITION = {"session_key": 1, "driver_number": 44, "position": 3, "date": "2023-05-28T13:00:00Z", "extra": {"a": 1}}


def test_landed_json_is_reduced_and_filtered(spark, tmp_path):
    path = land(tmp_path / "position", [POSITION, {**POSITION, "session_key": 2}, {**POSITION, "driver_number": "63"}])
    rows = read_landed(spark, path, "positions", session_key=1)
    assert rows.columns == [*POSITIONS.names, "t", "seq"]
    assert [r.driver_number for r in rows.orderBy("seq").collect()] == [44, 63]


def test_landed_array(spark, tmp_path):
    path = land(tmp_path / "position", [json.dumps([POSITION, POSITION], indent=1)])
    assert read_landed(spark, path, "positions", multi_line=True).count() == 2


def test_malformed_landed_records(spark, tmp_path):
    path = land(tmp_path / "position", [POSITION, "oops", {**POSITION, "position": True}])
    assert read_landed(spark, path, "positions", on_malformed="drop").count() == 1
    with pytest.raises(PySparkException, match="malformed record"):
        read_landed(spark, path, "positions").collect()


def test_missing_path_is_an_empty_table(spark, tmp_path):
    for format in ("json", "parquet"):
        rows = read_landed(spark, str(tmp_path / "nothing"), "laps", session_key=1, format=format)
        assert rows.columns == [*LAPS.names, "t", "seq"] and rows.count() == 0


def test_session_filter_reaches_the_parquet_scan(spark, tmp_path):
    path = str(tmp_path / "laps")
    tables.laps(spark, [(1, 1, 44, 1)], session=7).select(*LAPS.names).write.parquet(path)
    rows = read_landed(spark, path, "laps", session_key=7, format="parquet").select("lap_number")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(session_key,7)" in plan
    assert "ReadSchema: struct<session_key:int,lap_number:int>" in plan
    assert rows.count() == 1


def test_landed_parquet_takes_the_defaults_of_json(spark, tmp_path):
    ddl = "session_key INT, driver_number INT, position INT, date STRING"
    rows = [(7, None, 3, None), (None, 44, None, "2023-05-28T13:00:00Z")]
    path = str(tmp_path / "position")
    spark.createDataFrame(rows, ddl).write.parquet(path)
    found = [r[:3] for r in read_landed(spark, path, "positions", session_key=7, format="parquet").collect()]
    assert found == [(7, 0, 3)]
    found = [r[:3] for r in read_landed(spark, path, "positions", session_key=0, format="parquet").collect()]
    assert found == [(0, 44, 0)]


def test_whole_session(spark, tmp_path):
    land(tmp_path / FOLDERS["positions"], [POSITION])
    found = read_session(spark, str(tmp_path), session_key=1)
    assert {name: df.count() for name, df in found.items()} == {
        "positions": 1, "laps": 0, "pit_stops": 0, "race_control": 0
    }


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_publish_and_read_back(spark, tmp_path, format):
    topics = FileTopics(str(tmp_path / "topics"), format)
    laps = tables.laps(spark, [(2, 0, 44, 1), (1, 1, 63, 1)])
    replay_job({"laps": laps, "race_control": tables.race_control(spark, [("RED", None)])}, topics)
    records = topics.read(spark, settings.TOPIC_LAPS)
    assert records.columns == TOPIC_RECORD.names
    assert {(r.key, r.offset) for r in records.collect()} == {("44", 0), ("63", 0)}
    back = typed(records, "laps")
    assert sorted(back.select(*LAPS.names).collect()) == sorted(laps.select(*LAPS.names).collect())
    assert {r.t for r in back.select("t").collect()} == {r.t for r in laps.select("t").collect()}
    assert topics.read(spark, settings.TOPIC_RACE_CONTROL).first().key == "rc"
    assert topics.read(spark, settings.TOPIC_POSITIONS).count() == 0


def test_time_fallbacks(spark):
    records = spark.createDataFrame([("44", '{"date":null}', tables.at(5), 0, 1)], TOPIC_RECORD)
    assert typed(records, "positions").first().t == typed(records, "positions", time_fallback="ingest").first().t
    assert typed(records, "positions", time_fallback="null").first().t is None
    assert typed(records, "positions", time_fallback="epoch").selectExpr("unix_millis(t) AS m").first().m == 0


def test_kafka_options():
    topics = KafkaTopics("broker:9092", options={"kafka.security.protocol": "SSL"})
    read = topics.read_options(settings.TOPIC_LAPS)
    assert read["subscribe"] == "f1.laps" and read["startingOffsets"] == "earliest"
    assert read["kafka.bootstrap.servers"] == "broker:9092"
    write = topics.write_options()
    assert (write["kafka.acks"], write["kafka.retries"], write["kafka.linger.ms"]) == ("1", "3", "5")
    assert read["kafka.security.protocol"] == write["kafka.security.protocol"] == "SSL"


def test_settings():
    assert settings.Settings.from_env({}) == settings.Settings("localhost:9092", 9161, 2.0)
    env = {"KAFKA_BOOTSTRAP_SERVERS": "b:1", "SESSION_KEY": "7", "REPLAY_SPEED": "4"}
    assert settings.Settings.from_env(env) == settings.Settings("b:1", 7, 4.0)
    with pytest.raises(ValueError):
        settings.Settings.from_env({"REPLAY_SPEED": "0"})


@pytest.mark.parametrize("format", ["parquet", "json"])
def test_unreadable_files_are_left_out_and_named(spark, tmp_path, format):
    path = tmp_path / "position"
    rows = spark.createDataFrame([(7, 44, i, "2023-05-28T13:00:00Z") for i in range(1, 401)], POSITIONS)
    rows.repartition(2).write.format(format).option("compression", "gzip").save(str(path))
    first, second = sorted(path.glob("part-*"))
    good = spark.read.schema(POSITIONS).format(format).load(str(second)).count()
    first.write_bytes(first.read_bytes()[:8])
    (path / f".{first.name}.crc").unlink()
    with pytest.raises(Exception):
        read_landed(spark, str(path), "positions", format=format).collect()
    rows = read_landed(spark, str(path), "positions", format=format, on_unreadable="skip")
    assert rows.count() == len(rows.collect()) == good
    named = files_without_rows(spark, str(path), "positions", format).collect()
    assert [(r.path.rpartition("/")[2], r.length) for r in named] == [(first.name, 8)]
    with pytest.raises(ValueError):
        read_landed(spark, str(path), "positions", on_unreadable="maybe")
