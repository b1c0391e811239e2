"""The leaderboard from stored partial aggregates, so that new positions are merged in without reading old ones.

The last position of a driver in a window is an accumulator that merges: of two, the one with the later ``last_seq`` counts. An increment of
positions is reduced to those and stored; whoever reads merges the increments. ``fold`` replaces the increments so far by one.
An increment is named by its number, so adding it again after a failure replaces it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racestream import settings
from racestream.operators.leaderboard import window_last_positions
from racestream.session import remove


def merge(partials: DataFrame) -> DataFrame:
    """One row per window and driver (and session): the position with the latest ``last_seq``."""
    session = [c for c in ("session_key",) if c in partials.columns]
    return partials.groupBy("window", *session, "driver_number").agg(
        F.max_by("position", "last_seq").alias("position"), F.max("last_seq").alias("last_seq")
    )


def add(folder: str, number: int, positions: DataFrame, window: str = settings.LEADERBOARD_WINDOW, by_session: bool = False) -> None:
    """Stores increment ``number``: the last positions of the windows and drivers that occur in it. Only its positions are read."""
    window_last_positions(positions, window, by_session).write.mode("overwrite").parquet(f"{folder}/increment={number}")


def last_positions(spark: SparkSession, folder: str, changed_by: int | None = None) -> DataFrame:
    """The merged last positions of all windows, or of those windows that increment ``changed_by`` holds; for ``leaderboard.rankings``."""
    stored = spark.read.parquet(folder)
    if changed_by is not None:
        touched = stored.where(F.col("increment") == changed_by).select("window").distinct()
        stored = stored.join(touched, "window", "left_semi")
    return merge(stored.drop("increment"))


def fold(spark: SparkSession, folder: str) -> None:
    """Replaces all increments so far by their merge, which gets a new negative number.

    A failure in between loses nothing: the merge appears as a whole, and increments that it holds already change nothing when merged again.
    Increments must not be added meanwhile.
    """
    stored = spark.read.parquet(folder)
    numbers = {row["increment"] for row in stored.select("increment").distinct().collect()}
    merge(stored.drop("increment")).write.parquet(f"{folder}/increment={min(0, *numbers) - 1}")
    remove(spark, f"{folder}/increment=*", lambda name: int(name.partition("=")[2]) in numbers)
