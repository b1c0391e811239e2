"""Laps with the latest pit stop seen so far, over micro-batches.

What has been seen is a table in a shared folder. Every micro-batch appends the latest pit stop of each of its
keys, and reads back what earlier batches left for the keys of its own laps. The lookup is the one batch
queries use, so a key with a large part of the rows is split over many tasks, where a state-store operator
would bind it to one.

Every ``FOLD_EVERY`` batches the table is folded to one row per key, so a batch reads the last fold and at most
as many appends as were made since. Folds and appends are named by the number of their batch, in turn, and
overwritten once nothing can read them any more: the folder stays bounded, and a batch that is repeated after a
failure finds its input untouched and writes the same results again.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from racestream import settings
from racestream.operators.carry_forward import MAX_GROUP_ROWS, carry_forward
from racestream.operators.enrichment import ARRIVAL_ORDER, KEYS, LAP_RANK, PIT_RANK, project, tag
from racestream.streaming.progress import watermark_of

FOLD_EVERY = 32

# The micro-batch a row arrived in comes before its event time.
_ORDER = ("batch_id", *ARRIVAL_ORDER)


def _append_path(folder: str, batch_id: int, every: int) -> str:
    return f"{folder}/append-{batch_id % (2 * every)}"


def _fold_path(folder: str, batch_id: int, every: int) -> str:
    return f"{folder}/fold-{batch_id // every % 2}"


def _seen_before(batch: DataFrame, folder: str, batch_id: int, every: int) -> DataFrame:
    """Pit stops left by the batches before ``batch_id``: from the last fold, and from the appends since."""
    fold = max(batch_id - 1, 0) // every * every
    paths = [_fold_path(folder, fold, every)] if fold else []
    paths += [_append_path(folder, b, every) for b in range(fold, batch_id)]
    if not paths:
        return batch.sparkSession.createDataFrame([], batch.schema)
    return batch.sparkSession.read.schema(batch.schema).parquet(*paths)


def _latest(pits: DataFrame, keys: Sequence[str], columns: list[str]) -> DataFrame:
    newest = F.max_by(F.struct(*columns), F.struct(*_ORDER)).alias("latest")
    return pits.groupBy(*keys).agg(newest).select("latest.*")


def _of_keys_in(seen: DataFrame, laps: DataFrame, keys: Sequence[str]) -> DataFrame:
    wanted = laps.select(*[F.col(k).alias(f"_wanted_{k}") for k in keys]).distinct()
    return seen.join(wanted, reduce(and_, [F.col(k).eqNullSafe(F.col(f"_wanted_{k}")) for k in keys]), "left_semi")


def enrich_arrival_stream(
    laps: DataFrame,
    pits: DataFrame,
    state_folder: str,
    write: Callable[[DataFrame, int], None],
    keys: Sequence[str] = KEYS,
    keep_for: str | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
    fold_every: int | None = None,
    keep_by: str = "event_time",
    watermark: str = settings.OUT_OF_ORDERNESS,
    checkpoint: str | None = None,
) -> DataStreamWriter:
    """A writer that passes the enriched laps of each micro-batch to ``write(rows, batch_id)``.

    Within a micro-batch rows are ordered by ``(t, laps first, seq)``, across micro-batches by arrival.
    ``write`` may be called again for a batch after a failure. ``keep_for`` (such as ``'2 hours'``) forgets
    pit stops older than that; by default nothing is forgotten. ``state_folder`` must be shared by all executors and belong to one checkpoint.

    With ``keep_by='event_time'`` age is measured from the newest event time of a batch. With ``'ingest_time'`` both inputs carry that
    column, and age is measured from the watermark on it: ``watermark`` behind the newest of the slower input in earlier batches. Spark keeps
    that watermark in the query's ``checkpoint``, so a repeated batch forgets the same, and bad event times forget nothing.
    """
    if keep_by not in ("event_time", "ingest_time"):
        raise ValueError(f"keep_by must be 'event_time' or 'ingest_time', got {keep_by!r}")
    by_ingest = keep_by == "ingest_time"
    if by_ingest and checkpoint is None:
        raise ValueError("keep_by='ingest_time' needs the checkpoint")
    extra = ["ingest_time"] if by_ingest else []
    if by_ingest:
        laps, pits = (rows.withWatermark("ingest_time", watermark) for rows in (laps, pits))
    columns = [*keys, *_ORDER, "pit", *extra]
    every = fold_every or FOLD_EVERY

    def forgetting(seen: DataFrame, rows: DataFrame, batch_id: int) -> DataFrame:
        if keep_for is None:
            return seen
        if by_ingest:
            newest = watermark_of(rows.sparkSession, checkpoint, batch_id)
        else:
            newest = rows.agg(F.max("t")).scalar()
        recent = F.col(keep_by if by_ingest else "t") >= newest - F.expr(f"INTERVAL {keep_for}")
        return seen.where(F.coalesce(recent, F.lit(True)))

    def step(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("bigint")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            lap_rows, pit_rows = (rows.where(F.col("source_rank") == rank) for rank in (LAP_RANK, PIT_RANK))
            seen = forgetting(_seen_before(rows.select(*columns), state_folder, batch_id, every), rows, batch_id)

            _latest(pit_rows, keys, columns).write.mode("overwrite").parquet(_append_path(state_folder, batch_id, every))
            if batch_id and batch_id % every == 0:
                _latest(seen, keys, columns).write.mode("overwrite").parquet(_fold_path(state_folder, batch_id, every))

            together = rows.unionByName(_of_keys_in(seen, lap_rows, keys), allowMissingColumns=True)
            together = together.withColumn("cut", F.when(F.col("batch_id") == batch_id, F.col("t")))
            # A key has no more rows than the batch, and one from the fold and from each append.
            small = max_group_rows is not None and rows.count() + 2 * every <= max_group_rows
            carried = carry_forward(together, keys, _ORDER, "pit", "seen", None if small else max_group_rows, cut="cut")
            carried = carried.drop("cut")
            enriched = carried.where(F.col("source_rank") == LAP_RANK)
            write(project(enriched.withColumn("pit_duration", F.col("seen.pit_duration")), "seq"), batch_id)
        finally:
            rows.unpersist()

    return tag(laps, pits, keys, extra).writeStream.foreachBatch(step)


def to_folder(folder: str) -> Callable[[DataFrame, int], None]:
    """Writes each batch to its own sub-folder, so that a repeated batch replaces itself."""
    def write(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    return write
