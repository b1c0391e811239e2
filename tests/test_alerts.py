import json

import pytest

import tables
from racestream.operators.alerts import alert_json, alerts
from racestream.schemas import ALERTS

CASES = [
    ("RED", None, "CRITICAL"),
    (None, "Red flag shown", "CRITICAL"),
    ("CHEQUERED", None, "CRITICAL"),
    (None, "CHEQUERED FLAG", "CRITICAL"),
    ("RED", "SAFETY CAR DEPLOYED", "CRITICAL"),
    ("YELLOW", "SAFETY CAR DEPLOYED", "HIGH"),
    (None, "VIRTUAL SAFETY CAR ENDING", "HIGH"),
    ("Virtual Safety Car", None, "HIGH"),
    (None, "SAFETY CAR IN THIS LAP", "HIGH"),
    ("yellow", None, "MEDIUM"),
    ("DOUBLE YELLOW", "DRS DISABLED", "MEDIUM"),
    (None, "drs disabled", "LOW"),
    (None, "YELLOW IN SECTOR 3", None),
    ("GREEN", "DRS ENABLED", None),
    (None, None, None),
    ("", "", None),
]


def severities(spark, **options):
    found = alerts(tables.race_control(spark, [(f, m) for f, m, _ in CASES]), keep=("seq",), **options)
    by_seq = {r.seq: r.severity for r in found.collect()}
    return [by_seq.get(i) for i in range(len(CASES))]


def test_classification(spark):
    assert severities(spark) == [s for _, _, s in CASES]


def test_whole_words_spare_the_finish(spark):
    expected = [None if "CHEQUERED" in (f, (m or "").split(" ")[0]) else s for f, m, s in CASES]
    assert severities(spark, whole_words=True) == expected


def test_json_keeps_nulls(spark):
    value = alert_json(alerts(tables.race_control(spark, [(None, "DRS DISABLED")]))).first().value
    assert '"driver_number":null' in value and '"flag":null' in value
    assert list(json.loads(value)) == ALERTS.names
    assert json.loads(value)["type"] == "race_alert"


@pytest.mark.parametrize("category", ["Flag", "SafetyCar", None])
def test_category_plays_no_role(spark, category):
    from pyspark.sql import functions as F

    rows = tables.race_control(spark, [("GREEN", None)]).withColumn("category", F.lit(category))
    assert alerts(rows).count() == 0
