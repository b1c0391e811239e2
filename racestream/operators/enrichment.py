"""Laps annotated with their pit stop.

Input: decoded laps and pit stops with ``t`` and ``seq``. Two semantics:

* ``enrich_arrival``: a lap sees the pit stops that arrived before it. Laps and pit stops are merged by
  ``(t, laps first, seq)``, the order in which a replay publishes them. As a lap is published at its start
  and its pit stop later, the lap that ends in the pits usually finds nothing.
* ``enrich_complete``: a lap sees the latest pit stop of its driver and lap, whenever it arrived.

In both, a later pit stop replaces an earlier one even if its duration is null. The default keys leave
out the session, so a pit stop can match a lap of another session; pass ``SESSION_KEYS`` to separate them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from racestream import schemas
from racestream.functions.json_codec import encode
from racestream.operators.carry_forward import MAX_GROUP_ROWS, carry_forward
from racestream.session import written

KEYS = ("driver_number", "lap_number")
SESSION_KEYS = ("session_key", "driver_number", "lap_number")

# Bytes of the pit-stop side that may be sent to every executor.
MAX_BROADCAST_BYTES = 64 << 20

# Among equal times laps precede pit stops.
LAP_RANK, PIT_RANK = 0, 1
ARRIVAL_ORDER = ("t", "source_rank", "seq")

_LAP_COLUMNS = schemas.LAPS.names


def tag(laps: DataFrame, pits: DataFrame, keys: Sequence[str] = KEYS, keep: Sequence[str] = ()) -> DataFrame:
    """Both inputs in one table, with the columns ``keep`` of both. ``pit`` is a struct, so that a pit stop without duration is still a pit stop."""
    lap_rows = laps.select(*_LAP_COLUMNS, "t", "seq", *keep, F.lit(LAP_RANK).alias("source_rank"))
    pit_rows = pits.select(
        *keys, "t", "seq", *keep, F.lit(PIT_RANK).alias("source_rank"), F.struct("pit_duration").alias("pit")
    )
    return lap_rows.unionByName(pit_rows, allowMissingColumns=True)


def project(rows: DataFrame, *keep: str) -> DataFrame:
    """Lap columns, ``pit_duration`` and ``had_pit_stop``, from rows with a ``pit_duration``."""
    return rows.select(*keep, *_LAP_COLUMNS, "pit_duration", F.col("pit_duration").isNotNull().alias("had_pit_stop"))


def look_up(tagged: DataFrame, keys: Sequence[str] = KEYS, max_group_rows: int | None = MAX_GROUP_ROWS) -> DataFrame:
    """The laps among ``tagged``, each with the latest pit stop before it."""
    carried = carry_forward(tagged, keys, ARRIVAL_ORDER, "pit", "seen", max_group_rows)
    laps = carried.where(F.col("source_rank") == LAP_RANK)
    return project(laps.withColumn("pit_duration", F.col("seen.pit_duration")), "seq")


def enrich_arrival(
    laps: DataFrame, pits: DataFrame, keys: Sequence[str] = KEYS, max_group_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """One row per lap, with the latest pit stop that arrived before it."""
    return look_up(tag(laps, pits, keys), keys, max_group_rows)


def latest_pits(pits: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The latest pit stop of each key, aggregated before the shuffle."""
    return pits.groupBy(*keys).agg(F.max_by("pit_duration", F.struct("t", "seq")).alias("pit_duration"))


def look_ahead(
    tagged: DataFrame, keys: Sequence[str], max_lap: str, max_group_rows: int | None = MAX_GROUP_ROWS
) -> DataFrame:
    """The laps among ``tagged``, each with the latest pit stop from its start to ``max_lap`` later.

    Seen from the end of that time, it is the last pit stop before, unless that lies before the start.
    """
    is_lap = F.col("source_rank") == LAP_RANK
    placed = tagged.withColumns(
        {
            "at": F.when(is_lap, F.col("t") + F.expr(f"INTERVAL {max_lap}")).otherwise(F.col("t")),
            "pits_first": -F.col("source_rank"),
            "pit": F.when(~is_lap, F.struct("pit.pit_duration", "t")),
        }
    )
    carried = carry_forward(placed, keys, ("at", "pits_first", "seq"), "pit", "seen", max_group_rows)
    duration = F.when(F.col("seen.t") >= F.col("t"), F.col("seen.pit_duration"))
    return project(carried.where(is_lap).withColumn("pit_duration", duration), "seq")


def enrich_complete(
    laps: DataFrame,
    pits: DataFrame,
    keys: Sequence[str] = KEYS,
    max_lap: str | None = None,
    max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
) -> DataFrame:
    """One row per lap, with the latest pit stop of its key; with ``max_lap``, of those from its start to so much later.

    Without ``max_lap`` the latest pit stops are aggregated and written first, which tells their number. If they surely
    take no more than ``max_broadcast_bytes`` they are sent to the laps, which then are not shuffled at all. Beyond, both sides
    are joined by key: one of them has a single row per key, so rows never multiply, and adaptive execution splits the laps of a
    crowded key over several tasks.
    """
    if max_lap is not None:
        return look_ahead(tag(laps, pits, keys), keys, max_lap)
    latest = written(latest_pits(pits, keys), "latest-pit-stops")
    # Fixed-width columns take eight bytes at most; others tell their longest value.
    fixed = ("tinyint", "smallint", "int", "bigint", "float", "double", "boolean", "date", "timestamp")
    wide = [F.max(F.octet_length(F.col(c).cast("string"))) for c, kind in latest.dtypes if kind not in fixed]
    rows, *longest = latest.agg(F.count(F.lit(1)), *wide).first()
    row_bytes = 16 + 8 * len(latest.columns) + sum(length or 0 for length in longest)
    if rows * row_bytes <= max_broadcast_bytes:
        latest = F.broadcast(latest)
    return project(laps.join(latest, list(keys), "left"), "seq")


def enriched_json(enriched: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The published form, explicit nulls included."""
    return enriched.select(*keep, encode(*schemas.LAPS_ENRICHED.names).alias("value"))
