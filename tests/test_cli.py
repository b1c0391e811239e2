import json

import pytest

import tables
from racestream import settings
from racestream.cli import arguments, main
from racestream.sources.landing import FOLDERS
from racestream.sources.topics import FileTopics


@pytest.fixture
def landing(tmp_path):
    def land(name, *documents):
        folder = tmp_path / "landing" / FOLDERS[name]
        folder.mkdir(parents=True)
        (folder / "part.json").write_text("\n".join(json.dumps(d) for d in documents))

    own = {"session_key": 9161, "driver_number": 44}
    land("positions", {**own, "position": 1, "date": tables.iso(0)}, {**own, "position": 2, "date": tables.iso(30)})
    land("laps", {**own, "lap_number": 2, "date_start": tables.iso(90)}, {"session_key": 1, "date_start": tables.iso(1)})
    land("pit_stops", {**own, "lap_number": 2, "pit_duration": 20.0, "date": tables.iso(80)})
    land("race_control", {"session_key": 9161, "flag": "RED", "message": "RED FLAG", "date": tables.iso(5)})
    return str(tmp_path / "landing")


def test_a_session_through_all_jobs(spark, tmp_path, landing):
    root = str(tmp_path / "topics")
    topics = FileTopics(root)

    def run(job, *options):
        main([job, "--topics", root, *options], spark)

    def values(topic):
        return [json.loads(r.value) for r in topics.read(spark, topic).collect()]

    run("replay", "--landing", landing)
    for job in ("leaderboard", "alerts", "enrichment"):
        run(job, "--once", "--checkpoint", str(tmp_path / job))
    assert values(settings.TOPIC_LEADERBOARD) == [{"type": "leaderboard", "rankings": {"1": 44}}]
    assert [a["severity"] for a in values(settings.TOPIC_ALERTS)] == ["CRITICAL"]
    assert [(e["lap_number"], e["pit_duration"]) for e in values(settings.TOPIC_LAPS_ENRICHED)] == [(2, 20.0)]


def test_schedule(spark, tmp_path, landing, monkeypatch):
    monkeypatch.setenv("REPLAY_SPEED", "4")
    main(["schedule", "--landing", landing, "--output", str(tmp_path / "out")], spark)
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted((r.topic, r.target_ms) for r in rows) == [
        ("f1.laps", 22500), ("f1.pit_stops", 20000), ("f1.positions", 0), ("f1.positions", 7500),
        ("f1.race_control", 1250),
    ]


def test_malformed_records_are_collected(spark, tmp_path):
    topics = FileTopics(str(tmp_path / "topics"))
    documents = [("f1.laps", "44", '{"lap_number":1}'), ("f1.laps", "44", "oops")]
    rows = spark.createDataFrame(documents, "topic STRING, key STRING, value STRING")
    topics.write(rows)
    options = ["--table", "laps", "--output", str(tmp_path / "bad"), "--checkpoint", str(tmp_path / "checkpoint")]
    main(["malformed", "--once", "--topics", topics.root, *options], spark)
    assert [r.value for r in spark.read.parquet(str(tmp_path / "bad")).collect()] == ["oops"]


def test_missing_options(capsys):
    with pytest.raises(SystemExit):
        arguments(["replay"])
    with pytest.raises(SystemExit):
        arguments(["leaderboard"])
    with pytest.raises(SystemExit):
        arguments(["complete-enrichment", "--checkpoint", "c", "--release"])


def test_waiting_laps_are_released(spark, tmp_path, landing):
    root = str(tmp_path / "topics")
    main(["replay", "--topics", root, "--landing", landing], spark)
    options = ["--once", "--release", "--max-lap", "5 minutes", "--time-fallback", "null"]
    main(["complete-enrichment", "--topics", root, "--checkpoint", str(tmp_path / "c"), *options], spark)
    values = [json.loads(r.value) for r in FileTopics(root).read(spark, settings.TOPIC_LAPS_ENRICHED).collect()]
    assert [(v["lap_number"], v["pit_duration"]) for v in values] == [(2, None)]
