"""The seven tables of the system.

Raw tables list the fields of their JSON documents; unknown fields are ignored on read. A field that is
not nullable takes 0 or false when the document leaves it out (see ``functions.json_codec``).

Decoded tables also carry two technical columns used by the operators:

* ``t``   TIMESTAMP, the event time;
* ``seq``, the arrival order: any type that sorts, unique within a table. Files have a number, topic
  records the struct ``(ingest_time, partition, offset)``, as an offset alone orders one partition only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from racestream import settings


_INT, _DOUBLE, _BOOLEAN, _STRING = T.IntegerType(), T.DoubleType(), T.BooleanType(), T.StringType()


def _required(name: str, kind: T.DataType) -> T.StructField:
    return T.StructField(name, kind, nullable=False)


# The fields of the documents, by name, in document order.

POSITIONS = T.StructType(
    [_required("session_key", _INT), _required("driver_number", _INT), _required("position", _INT), T.StructField("date", _STRING)]
)

LAPS = T.StructType(
    [
        _required("session_key", _INT),
        _required("driver_number", _INT),
        _required("lap_number", _INT),
        T.StructField("lap_duration", _DOUBLE),
        T.StructField("date_start", _STRING),
        _required("is_pit_out_lap", _BOOLEAN),
    ]
)

PIT_STOPS = T.StructType(
    [
        _required("session_key", _INT),
        _required("driver_number", _INT),
        _required("lap_number", _INT),
        T.StructField("pit_duration", _DOUBLE),
        T.StructField("date", _STRING),
    ]
)

RACE_CONTROL = T.StructType(
    [
        _required("session_key", _INT),
        T.StructField("message", _STRING),
        T.StructField("category", _STRING),
        T.StructField("flag", _STRING),
        T.StructField("date", _STRING),
        T.StructField("driver_number", _INT),
    ]
)

LEADERBOARD = T.StructType([_required("type", _STRING), _required("rankings", T.MapType(_INT, _INT))])

LAPS_ENRICHED = T.StructType([*LAPS.fields, T.StructField("pit_duration", _DOUBLE), _required("had_pit_stop", _BOOLEAN)])

ALERTS = T.StructType(
    [
        _required("type", _STRING),
        _required("severity", _STRING),
        T.StructField("flag", _STRING),
        T.StructField("category", _STRING),
        T.StructField("message", _STRING),
        T.StructField("date", _STRING),
        T.StructField("driver_number", _INT),
        _required("session_key", _INT),
    ]
)

# One record of a topic, as read from a broker or from a directory standing in for one.
TOPIC_RECORD = T.StructType(
    [
        T.StructField("key", _STRING),
        T.StructField("value", _STRING),
        T.StructField("ingest_time", T.TimestampType()),
        T.StructField("partition", _INT),
        T.StructField("offset", T.LongType()),
    ]
)


@dataclass(frozen=True)
class RawTable:
    """A raw table: where it is published, which field holds its time, and its rank among equal times."""

    name: str
    schema: T.StructType
    topic: str
    time_field: str
    rank: int


RAW_TABLES = {
    table.name: table
    for table in (
        RawTable("positions", POSITIONS, settings.TOPIC_POSITIONS, "date", 0),
        RawTable("laps", LAPS, settings.TOPIC_LAPS, "date_start", 1),
        RawTable("pit_stops", PIT_STOPS, settings.TOPIC_PIT_STOPS, "date", 2),
        RawTable("race_control", RACE_CONTROL, settings.TOPIC_RACE_CONTROL, "date", 3),
    )
}
