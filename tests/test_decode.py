import math

import pytest
from pyspark.errors import PySparkException

from racestream.functions.json_codec import decode, encode, split_malformed
from racestream.schemas import LAPS, POSITIONS, RACE_CONTROL

BAD = object()


def check(spark, schema, field, cases):
    """Decode all documents in one job; each case is (text, expected value or BAD)."""
    documents = [(i, text) for i, (text, _) in enumerate(cases)]
    rows = decode(spark.createDataFrame(documents, "seq INT, value STRING"), schema, on_malformed="drop").collect()
    got = {r.seq: tuple(r[n] for n in schema.names) if field is None else r[field] for r in rows}
    for i, (text, expected) in enumerate(cases):
        value = got.get(i, BAD)
        both_nan = isinstance(value, float) and isinstance(expected, float) and math.isnan(value) and math.isnan(expected)
        assert both_nan or (value is BAD and expected is BAD) or (value == expected and type(value) is type(expected)), text


def check_field(spark, schema, field, cases):
    check(spark, schema, field, [(f'{{"{field}":{text}}}', expected) for text, expected in cases])


INTEGERS = [
    ("null", 0), ('""', 0), ('"  "', 0), ('"null"', 0),
    ("44", 44), ('"44"', 44), ('" 7 "', 7), ('"+44"', 44), ("-3", -3), ("-0", 0),
    ("44.0", 44), ("44.7", 44), ("-44.7", -44), ("1e2", 100),
    ("2147483647", 2147483647), ("-2147483648", -2147483648),
    ("2147483648", BAD), ("2147483647.5", BAD), ("-2147483648.9", BAD), ("3000000000", BAD), ("1e400", BAD),
    ("true", BAD), ("{}", BAD), ("[1]", BAD), ('"x"', BAD), ('"1d"', BAD), ('"NaN"', BAD), ('"4 4"', BAD),
    ("01", BAD), ("NaN", BAD),
]


def test_int(spark):
    check_field(spark, POSITIONS, "driver_number", INTEGERS)


def test_optional_int(spark):
    cases = [("null", None), ('""', None), ("44", 44), ('"44"', 44), ("44.7", 44), ("true", BAD)]
    check_field(spark, RACE_CONTROL, "driver_number", cases)


BOOLEANS = [
    ("true", True), ("false", False), ("null", False), ('""', False), ('"  "', False), ('"null"', False),
    ("1", True), ("0", False), ("2", True), ("-0", False), ("2147483648", True),
    ('"true"', True), ('"True"', True), ('"TRUE"', True), ('" true "', True), ('"FALSE"', False),
    ('"tRUE"', BAD), ('"no"', BAD), ("1.0", BAD), ("1e2", BAD), ("{}", BAD), ("[1]", BAD),
]


def test_boolean(spark):
    check_field(spark, LAPS, "is_pit_out_lap", BOOLEANS)


DOUBLES = [
    ("null", None), ('""', None), ('" "', None), ('"null"', None),
    ("44.7", 44.7), ("44", 44.0), ('"20.5"', 20.5), ('" 44 "', 44.0), ("9.05e1", 90.5), ('"1e2"', 100.0),
    ('"NaN"', math.nan), ('"INF"', math.inf), ('"-Infinity"', -math.inf), ("1e400", math.inf),
    ("NaN", BAD), ("true", BAD), ("{}", BAD), ('"20.5d"', BAD), ('"20.5f"', BAD), ('"."', BAD), ('"0x1p3"', BAD), ('"x"', BAD),
]


def test_double(spark):
    check_field(spark, LAPS, "lap_duration", DOUBLES)


def test_string(spark):
    cases = [('"x"', "x"), ("5", "5"), ("1.25", "1.25"), ("true", "true"), ("null", None), ('""', "")]
    check_field(spark, RACE_CONTROL, "message", cases)


DOCUMENTS = [
    ("{}", (0, 0, 0, None)),
    ('{"position":3,"unknown":{"a":[1]}}', (0, 0, 3, None)),
    ('{"position":1}{"position":2}', (0, 0, 1, None)),
    ('{"Position":5}', (0, 0, 0, None)),
    ("", BAD), ("  ", BAD), ("null", BAD), ("not json", BAD), ('{"position":', BAD), ('[{"position":1}]', BAD),
    ("{'position':1}", BAD), (None, BAD),
]


def test_document(spark):
    check(spark, POSITIONS, None, DOCUMENTS)


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame([(1, '{"position":3}'), (2, "oops")], "seq BIGINT, value STRING")


def test_quarantine(mixed):
    good, bad = split_malformed(decode(mixed, POSITIONS, on_malformed="keep"))
    assert [(r.seq, r.position) for r in good.collect()] == [(1, 3)]
    assert [(r.seq, r.value) for r in bad.collect()] == [(2, "oops")]
    assert good.columns == [*POSITIONS.names, "seq"]


def test_fail(mixed):
    with pytest.raises(PySparkException, match="malformed record: oops"):
        decode(mixed, POSITIONS, on_malformed="fail").select("seq").collect()
    assert decode(mixed.where("seq = 1"), POSITIONS, on_malformed="fail").count() == 1


def test_unknown_policy(mixed):
    with pytest.raises(ValueError):
        decode(mixed, POSITIONS, on_malformed="ignore")


def test_parsed_once_even_under_a_filter(mixed):
    rows = decode(mixed, POSITIONS, on_malformed="drop").where("position > 1")
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_encode_writes_nulls(spark):
    rows = spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b, CAST(NULL AS DOUBLE) AS c")
    assert rows.select(encode("a", "b", "c").alias("v")).first().v == '{"a":1,"b":null,"c":null}'


def test_exact_decoding_tells_types_apart(spark):
    """Read as text these are the same; a document is parsed once."""
    documents = ['{"position":"44.0"}', '{"position":44.0}', '{"date":{}}', '{"date":"{}"}', '{"position":1,"position":2}', None]
    rows = spark.createDataFrame([(d,) for d in documents], "value STRING")
    exact = decode(rows, POSITIONS, on_malformed="keep", exact=True)
    found = {r.value: (r.position, r.date, r.malformed) for r in exact.collect()}
    assert found['{"position":"44.0"}'][2] and found['{"date":{}}'][2] and found[None][2]
    assert found['{"position":44.0}'] == (44, None, False) and found['{"date":"{}"}'] == (0, "{}", False)
    assert found['{"position":1,"position":2}'][2]
    plan = exact._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("parse_json") == 1 or plan.lower().count("parsejson") == 1
