"""Replay timeline: the four raw tables of a session as one time-ordered, schedulable stream of messages."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream import settings
from racestream.functions.event_time import event_time
from racestream.functions.json_codec import encode
from racestream.schemas import RAW_TABLES

# Time first; equal times keep the order of the tables, then that of the source.
TIMELINE_ORDER = ("time", "source_rank", "seq")


def envelope(table: DataFrame, name: str, missing_time: str = "epoch") -> DataFrame:
    """``time, source_rank, seq, topic, key`` of a raw table, and its fields, which become the payload.

    A record without a usable time is placed at 1970-01-01T00:00:00Z (``'epoch'``) or left out (``'drop'``).
    """
    raw = RAW_TABLES[name]
    text = F.col(raw.time_field)
    if missing_time == "epoch":
        timed = table.withColumn("time", event_time(text, "epoch"))
    else:
        # Unnested, so that the filter does not parse the time a second time.
        timed = table.select("*", F.explode(F.array(event_time(text))).alias("time")).where(F.col("time").isNotNull())
    key = F.lit(settings.RACE_CONTROL_KEY) if name == "race_control" else F.col("driver_number").cast("string")
    return timed.select(
        "time",
        F.lit(raw.rank).alias("source_rank"),
        "seq",
        F.lit(raw.topic).alias("topic"),
        key.alias("key"),
        *raw.schema.names,
    )


def merged(tables: Mapping[str, DataFrame], missing_time: str = "epoch") -> DataFrame:
    """All records of the given tables in one envelope, unordered, with the fields of all tables.

    With ``missing_time='epoch'`` a single record without a usable time becomes the start of the session, which
    delays every other record by decades; ``'drop'`` leaves such records out.
    """
    if missing_time not in ("epoch", "drop"):
        raise ValueError(f"missing_time must be 'epoch' or 'drop', got {missing_time!r}")
    envelopes = [envelope(table, name, missing_time) for name, table in tables.items()]
    return reduce(lambda one, other: one.unionByName(other, allowMissingColumns=True), envelopes)


def messages(records: DataFrame) -> DataFrame:
    """The records with their JSON payload as ``value``, in the place of the fields."""
    fields = {name for raw in RAW_TABLES.values() for name in raw.schema.names}
    payloads = [
        F.when(F.col("source_rank") == raw.rank, encode(*raw.schema.names))
        for raw in RAW_TABLES.values()
        if set(raw.schema.names) <= set(records.columns)
    ]
    return records.select(*[c for c in records.columns if c not in fields], F.coalesce(*payloads).alias("value"))


def timeline(tables: Mapping[str, DataFrame], missing_time: str = "epoch") -> DataFrame:
    """All messages in total order.

    The sort is range-partitioned, and ``seq`` also splits a crowd of equal times. Payloads are encoded
    behind it: finding the ranges runs everything before the sort a second time.
    """
    return messages(merged(tables, missing_time).orderBy(*TIMELINE_ORDER))


def schedule(records: DataFrame, speed: float = settings.DEFAULT_REPLAY_SPEED) -> DataFrame:
    """Adds ``target_ms``: milliseconds after the start of the replay at which a message is due.

    The start of the session is a one-value subquery; it reads the time columns only. Apply before
    sorting: ``schedule(merged(tables)).orderBy(*TIMELINE_ORDER)``.
    """
    if not speed > 0:
        raise ValueError(f"speed must be positive, got {speed}")
    start = records.agg(F.min(F.unix_millis("time"))).scalar()
    return records.withColumn("target_ms", F.floor((F.unix_millis("time") - start) / F.lit(float(speed))))


def topic_counts(records: DataFrame) -> DataFrame:
    return records.groupBy("topic").agg(F.count(F.lit(1)).alias("records"))
