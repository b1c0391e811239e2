"""The four raw tables derived from the ``events`` table of the test data.

Thirty days of events are compressed a thousandfold, to about 43 minutes, so that a ten-second window
holds a field of drivers. Event types become tables: click and signup positions, view laps, purchase pit
stops, error race-control messages. ``seq`` is the event id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from racestream import settings
from racestream.session import new_folder, use_utc

EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)

# 2023-05-28 13:00:00 UTC, and the milliseconds of real time that become one of race time.
START_MILLIS = 1685278800000
COMPRESSION = 1000

# The type of event, and the columns, of each table. A struct is unnested into its fields, so that filters
# on them do not repeat their derivation.
_DERIVED = {
    "positions": (
        "event_type IN ('click', 'signup')",
        ["seq", "t", "session_key", "driver_number", "k % 20 + 1 AS position", "date"],
    ),
    "laps": (
        "event_type = 'view'",
        [
            "seq", "t", "session_key", "driver_number", "k % 78 + 1 AS lap_number",
            "CASE WHEN seq % 17 != 0 THEN value END AS lap_duration", "date AS date_start", "seq % 10 = 0 AS is_pit_out_lap",
        ],
    ),
    "pit_stops": (
        "event_type = 'purchase'",
        [
            "seq", "t", "session_key", "driver_number", "k % 78 + 1 AS lap_number",
            "CASE WHEN seq % 13 != 0 THEN value END AS pit_duration", "date",
        ],
    ),
    "race_control": (
        "event_type = 'error'",
        [
            "seq", "t", "session_key", "date",
            """inline(array(struct(
              CASE k % 12 WHEN 0 THEN 'RED FLAG' WHEN 1 THEN 'SAFETY CAR DEPLOYED' WHEN 2 THEN 'Virtual Safety Car ending'
                WHEN 3 THEN 'DRS DISABLED' WHEN 4 THEN 'DRS ENABLED' WHEN 5 THEN NULL ELSE 'INCIDENT NOTED' END AS message,
              CASE k % 3 WHEN 0 THEN 'Flag' WHEN 1 THEN 'SafetyCar' ELSE 'Other' END AS category,
              CASE k % 11 WHEN 0 THEN 'GREEN' WHEN 1 THEN 'yellow' WHEN 2 THEN 'DOUBLE YELLOW' WHEN 3 THEN 'RED'
                WHEN 4 THEN 'CHEQUERED' WHEN 5 THEN 'BLUE' WHEN 6 THEN 'CLEAR' END AS flag,
              CASE WHEN k % 2 = 0 THEN driver_number END AS driver_number)))""",
        ],
    ),
}


def _rounded_millis(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp") + F.expr("INTERVAL 500 MICROSECONDS"))


def _race_columns(events: DataFrame, first: Column, *keep: str) -> DataFrame:
    """``first`` is the earliest ``ts`` of all events."""
    since_start = F.floor((_rounded_millis(F.col("ts")) - _rounded_millis(first)) / COMPRESSION)
    return events.withColumn("t", F.timestamp_millis(since_start + START_MILLIS)).selectExpr(
        *keep,
        "event_type",
        "event_id AS seq",
        f"{settings.DEFAULT_SESSION_KEY} AS session_key",
        "CAST(user_id % 20 + 1 AS INT) AS driver_number",
        "CAST(get_json_object(props, '$.k') AS INT) AS k",
        "value",
        "t",
        "concat(date_format(t, \"yyyy-MM-dd'T'HH:mm:ss.SSS\"), '+00:00') AS date",
    )


def _derive(race: DataFrame, name: str, *keep: str) -> DataFrame:
    condition, columns = _DERIVED[name]
    return race.where(condition).selectExpr(*keep, *columns)


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return use_utc(spark).read.schema(EVENTS).parquet(f"{folder}/events.parquet")


def _race(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    return _race_columns(events, events.agg(F.min("ts")).scalar())


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return _derive(_race(spark, folder), name)


def read_tables(spark: SparkSession, folder: str, *names: str) -> dict[str, DataFrame]:
    race = _race(spark, folder)
    return {name: _derive(race, name) for name in names or _DERIVED}


def in_time_order(events: DataFrame, files: int) -> str:
    """A copy of the events as a folder of about ``files`` files in time order, as a stream would bring them.

    The file source takes files by their time of modification, which is set to their order.
    """
    spark = events.sparkSession
    folder = new_folder(spark, "events")
    events.repartitionByRange(files, "ts").sortWithinPartitions("ts", "event_id").write.parquet(folder)
    _touch_in_order(spark, f"{folder}/part-*", lambda path: path.getName())
    return folder


def _touch_in_order(spark: SparkSession, pattern: str, key) -> None:
    """Sets the times of files to the order of a key of their paths."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for i, file in enumerate(sorted((f.getPath() for f in store.globStatus(path)), key=key)):
        store.setTimes(file, 1_000_000_000_000 + 1000 * i, -1)


#: SQL of the milliseconds of race time by which a record arrives late, and the race time that a micro-batch of the delayed stream holds.
DELAY = "CASE event_id % 9 WHEN 4 THEN 600000 WHEN 7 THEN 1100000 ELSE 0 END"
BATCH_MILLIS = 500_000


@dataclass(frozen=True)
class DelayedEvents:
    """Events in the order of their arrival, which for some is minutes after their event time, as a folder of one file per micro-batch.

    A micro-batch holds what arrives in ``BATCH_MILLIS`` of race time, so the records themselves tell which batch they are in.
    """

    spark: SparkSession
    folder: str
    first: object

    def streams(self, *names: str) -> dict[str, DataFrame]:
        """The tables as streams, with ``ingest_time``, their arrival."""
        reader = self.spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True)
        race = _race_columns(reader.parquet(self.folder), F.lit(self.first))
        arrival = F.timestamp_millis(F.unix_millis("t") + F.expr(DELAY.replace("event_id", "seq")))
        return {name: _derive(race, name).withColumn("ingest_time", arrival) for name in names}

    def read(self, name: str, in_batch: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A table with the ``batch_id`` that ``in_batch`` adds to the rows of the files."""
        events = in_batch(self.spark.read.schema(EVENTS).option("recursiveFileLookup", True).parquet(self.folder))
        return _derive(_race_columns(events, F.lit(self.first), "batch_id"), name, "batch_id")


def delayed_events(spark: SparkSession, folder: str) -> DelayedEvents:
    events = _events(spark, folder)
    first = events.agg(F.min("ts").alias("first")).first().first
    since_start = F.floor((_rounded_millis(F.col("ts")) - _rounded_millis(F.lit(first))) / COMPRESSION)
    arriving = events.withColumn("bucket", F.floor((since_start + F.expr(DELAY)) / BATCH_MILLIS))
    target = new_folder(spark, "events")
    # A bucket is a single value of the range, so it lies in one task and becomes one file.
    arriving.repartitionByRange(8, "bucket").write.partitionBy("bucket").parquet(target)
    _touch_in_order(spark, f"{target}/bucket=*/part-*", lambda path: int(path.getParent().getName().partition("=")[2]))
    return DelayedEvents(spark, target, first)


def stream_tables(spark: SparkSession, folder: str, *names: str, files: int = 10) -> dict[str, DataFrame]:
    """The tables as streams over the events in time order, a file and so a micro-batch at a time."""
    events = _events(spark, folder)
    first = events.agg(F.min("ts").alias("first")).first().first
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(in_time_order(events, files))
    race = _race_columns(stream, F.lit(first))
    return {name: _derive(race, name) for name in names or _DERIVED}


def three_sessions(table: DataFrame) -> DataFrame:
    """The same rows spread over three sessions."""
    return table.withColumn("session_key", F.expr(f"CAST({settings.DEFAULT_SESSION_KEY} + seq % 3 AS INT)"))
