"""Ranked leaderboard per tumbling event-time window, for batch and streaming DataFrames.

Input: decoded positions with ``t`` and ``seq``. A stream must carry a watermark on ``t``; each window is
then emitted once, in append mode, when the watermark passes its end. In a batch all windows are emitted,
the last one included.

The work is spread by window and driver first, and each step aggregates before it shuffles, so neither a
busy window nor a busy driver gathers its records in one task. With a numeric ``seq`` both aggregations
hash; a struct, as topic records have, makes Spark sort instead. Only drivers with a record inside a window
appear in its ranking; nothing is carried over from earlier windows.

Late records, compared with a record-at-a-time engine: Spark tests a record against the watermark of the
previous micro-batch, so one that is late within the current micro-batch is still counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream import settings
from racestream.functions.json_codec import encode


def window_last_positions(
    positions: DataFrame, window: str = settings.LEADERBOARD_WINDOW, by_session: bool = False, last_by: str = "arrival"
) -> DataFrame:
    """Last position of each driver in each window: by ``'arrival'`` (``seq``), or by ``'event_time'`` and then arrival.

    Topics that were filled by many writers at once, as a replay does, do not keep the order of time: use ``'event_time'`` there.
    """
    if last_by not in ("arrival", "event_time"):
        raise ValueError(f"last_by must be 'arrival' or 'event_time', got {last_by!r}")
    session = ["session_key"] if by_session else []
    order = F.col("seq") if last_by == "arrival" else F.struct("t", "seq")
    return positions.groupBy(F.window("t", window).alias("window"), *session, "driver_number").agg(
        F.max_by("position", order).alias("position"),
        F.max(order).alias("last_seq"),
    )


def rankings(last_positions: DataFrame) -> DataFrame:
    """One driver per window and position.

    When several drivers claim a position, the one whose last record is newest keeps it.
    """
    session = [c for c in ("session_key",) if c in last_positions.columns]
    return last_positions.groupBy("window", *session, "position").agg(
        F.max_by("driver_number", "last_seq").alias("driver_number")
    )


def leaderboard(
    positions: DataFrame, window: str = settings.LEADERBOARD_WINDOW, by_session: bool = False, last_by: str = "arrival"
) -> DataFrame:
    """``window, [session_key], position, driver_number``."""
    return rankings(window_last_positions(positions, window, by_session, last_by))


def snapshots(ranked: DataFrame) -> DataFrame:
    """One row per window with ``rankings``, a map from position to driver in ascending order."""
    session = [c for c in ("session_key",) if c in ranked.columns]
    entries = F.sort_array(F.collect_list(F.struct("position", "driver_number")))
    return ranked.groupBy("window", *session).agg(F.map_from_entries(entries).alias("rankings"))


def driver_snapshots(last_positions: DataFrame) -> DataFrame:
    """The same as ``snapshots(rankings(last_positions))`` in one aggregation, which a stream keeps as a single state.

    A window gathers a row per driver, not per record. Sorted by position and time, the last of each position is its driver.
    """
    session = [c for c in ("session_key",) if c in last_positions.columns]
    claims = F.sort_array(F.collect_list(F.struct("position", "last_seq", "driver_number")))
    gathered = last_positions.groupBy("window", *session).agg(claims.alias("claims"))
    following = lambda i: F.get("claims", i + 1)["position"]
    holders = F.filter("claims", lambda c, i: ~following(i).eqNullSafe(c["position"]))
    entries = F.transform(holders, lambda c: F.struct(c["position"], c["driver_number"]))
    return gathered.select("window", *session, F.map_from_entries(entries).alias("rankings"))


def snapshot_json(snapshot: DataFrame) -> DataFrame:
    """The published form, next to the window it describes."""
    session = [c for c in ("session_key",) if c in snapshot.columns]
    value = encode(F.lit("leaderboard").alias("type"), F.col("rankings"))
    return snapshot.select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), *session, value.alias("value")
    )
