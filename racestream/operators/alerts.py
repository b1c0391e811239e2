"""Race alerts: classify, filter, project. One narrow stage, for batch and streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream import schemas
from racestream.functions.json_codec import encode
from racestream.functions.severity import classify


def alerts(race_control: DataFrame, whole_words: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """The race-control messages that are alerts, with their severity; ``keep`` names further columns."""
    classified = race_control.withColumns(
        {"type": F.lit("race_alert"), "severity": classify(F.col("flag"), F.col("message"), whole_words)}
    )
    return classified.where(F.col("severity").isNotNull()).select(*schemas.ALERTS.names, *keep)


def alert_json(alert_rows: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The published form, explicit nulls included."""
    return alert_rows.select(*keep, encode(*schemas.ALERTS.names).alias("value"))
