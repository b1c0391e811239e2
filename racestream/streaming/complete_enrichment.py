"""Laps with their pit stop, settled as the streams move on.

A lap waits until no pit stop can follow it any more, then leaves with the latest one since its start. A
stream-stream join would put out every pair of a lap and a pit stop of its key before reducing them; here the rows of a
settled stretch of time are looked at once, by the same look-ahead that batch queries use, so the work stays proportional to
the rows and a crowded key is split over many tasks.

The rows waited for are a table in a shared folder, by micro-batch and by bucket of event time. A micro-batch appends its own
rows and reads the buckets that fall due; nothing is rewritten. Buckets are removed one micro-batch after they were settled, so a
batch that is repeated after a failure finds its input untouched.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from racestream import settings
from racestream.operators.carry_forward import MAX_GROUP_ROWS
from racestream.operators.enrichment import KEYS, LAP_RANK, PIT_RANK, look_ahead, tag
from racestream.session import remove
from racestream.sources.topics import is_path_missing

# Laps are settled by buckets of this length.
BUCKET_SECONDS = 60

_MARKS = T.StructType([T.StructField(name, T.LongType()) for name in ("lap", "pit", "rows")])


@dataclass(frozen=True)
class Settling:
    """When laps are settled. All times are microseconds.

    The mark is ``delay`` behind the newest event time of the slower input. An input more than ``idle`` behind the other is taken to be
    silent and does not hold it back; before its first row it counts as of the beginning of time.
    """

    max_lap: int
    delay: int
    idle: int

    def mark(self, lap: int | None, pit: int | None) -> int | None:
        known = [t for t in (lap, pit) if t is not None]
        if not known:
            return None
        slower = min(known) if len(known) == 2 else max(known) - self.idle
        return max(slower, max(known) - self.idle) - self.delay

    def settled_through(self, mark: int | None) -> int | None:
        """The last bucket whose laps no pit stop can follow any more."""
        return None if mark is None else (mark - self.max_lap) // (BUCKET_SECONDS * 1_000_000) - 1

    @property
    def buckets_ahead(self) -> int:
        """How many buckets after its own a lap's pit stop can lie in."""
        return -(-self.max_lap // (BUCKET_SECONDS * 1_000_000))


def _micros(spark: SparkSession, interval: str) -> int:
    return spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {interval}"))).first()[0]


@dataclass(frozen=True)
class Marks:
    """The newest event times of both inputs through a micro-batch, and how many rows have come until then."""

    lap: int | None = None
    pit: int | None = None
    rows: int = 0

    @classmethod
    def read(cls, spark: SparkSession, folder: str, batch_id: int) -> "Marks":
        return cls() if batch_id < 0 else cls(*spark.read.schema(_MARKS).parquet(f"{folder}/marks/batch={batch_id}").first())

    def write(self, spark: SparkSession, folder: str, batch_id: int) -> None:
        frame = spark.createDataFrame([(self.lap, self.pit, self.rows)], _MARKS)
        frame.coalesce(1).write.mode("overwrite").parquet(f"{folder}/marks/batch={batch_id}")

    def after(self, rows: DataFrame, late: Column) -> tuple["Marks", int]:
        """The marks after some more rows, and how many of those are late, in one pass."""
        newest = [F.unix_micros(F.max(F.when(F.col("source_rank") == r, F.col("t")))) for r in (LAP_RANK, PIT_RANK)]
        lap, pit, count, n_late = rows.agg(*newest, F.count(F.lit(1)), F.count_if(late)).first()
        latest = lambda a, b: max((t for t in (a, b) if t is not None), default=None)
        return Marks(latest(self.lap, lap), latest(self.pit, pit), self.rows + count), n_late


def _bucketed(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bucket", F.floor(F.unix_seconds("t") / BUCKET_SECONDS))


def _stored(spark: SparkSession, folder: str, schema: T.StructType, through_batch: int | None = None) -> DataFrame:
    """Rows waited for. A repeated batch may find its own, which are in ``schema`` order like all."""
    partitions = [T.StructField("batch", T.LongType()), T.StructField("bucket", T.LongType())]
    whole = T.StructType([*schema.fields, *partitions])
    try:
        stored = spark.read.schema(whole).parquet(f"{folder}/rows")
    except AnalysisException as error:
        if not is_path_missing(error):
            raise
        return spark.createDataFrame([], whole)
    return stored if through_batch is None else stored.where(F.col("batch") <= through_batch)


def _due(stored: DataFrame, first: int | None, last: int | None, ahead: int) -> DataFrame:
    """The laps of the buckets from ``first`` to ``last``, and the pit stops that may belong to them."""
    is_lap = F.col("source_rank") == LAP_RANK
    rows = stored if first is None else stored.where(F.col("bucket") >= first)
    if last is None:
        return rows
    return rows.where(F.col("bucket") <= last + ahead).where(~is_lap | (F.col("bucket") <= last))


def _forget(spark: SparkSession, folder: str, first_open: int | None) -> None:
    """Removes the buckets before ``first_open``: no lap of theirs waits, and no later lap looks back."""
    if first_open is not None:
        remove(spark, f"{folder}/rows/batch=*/bucket=*", lambda name: int(name.partition("=")[2]) < first_open)


def _limit(found: DataFrame, marks: Marks, max_group_rows: int | None) -> int | None:
    """The limit beyond which keys are cut; none is needed if there are no more rows than that, and their keys need not be counted."""
    if max_group_rows is None or marks.rows <= max_group_rows or found.count() <= max_group_rows:
        return None
    return max_group_rows


def enrich_complete_stream(
    laps: DataFrame,
    pits: DataFrame,
    state_folder: str,
    write: Callable[[DataFrame, int], None],
    keys: Sequence[str] = KEYS,
    max_lap: str = "10 minutes",
    watermark: str = settings.OUT_OF_ORDERNESS,
    idle: str = "30 minutes",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataStreamWriter:
    """A writer that passes the laps settled by each micro-batch to ``write(rows, batch_id)``.

    A lap is given out once: when the watermark is ``max_lap`` past the end of its bucket, matched or not. The watermark is that of the
    slower input, but never more than ``idle`` behind the faster one, so that an input that falls silent does not stop the
    other. Laps that come after their bucket was settled, or have no time, are not given out, as their pit stops may be gone; they
    are kept in ``<state_folder>/late``, where a micro-batch that has any adds a folder, and the first one always. What still waits when the input ends is given out by ``release``.

    ``write`` may be called again for a batch after a failure, and is not called if nothing fell due; ``state_folder`` must be
    shared by all executors and belong to one checkpoint.
    """
    spark = laps.sparkSession
    settling = Settling(*(_micros(spark, interval) for interval in (max_lap, watermark, idle)))

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = _bucketed(batch).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            before = Marks.read(session, state_folder, batch_id - 1)
            done = settling.settled_through(settling.mark(before.lap, before.pit))
            in_time = F.col("bucket") > F.lit(done) if done is not None else F.col("bucket").isNotNull()
            in_time = F.coalesce(in_time, F.lit(False))
            is_late = ~in_time & (F.col("source_rank") == LAP_RANK)
            after, n_late = before.after(rows, is_late)
            after.write(session, state_folder, batch_id)
            due = settling.settled_through(settling.mark(after.lap, after.pit))
            if done is not None:
                _forget(session, state_folder, done + 1)
            remove(session, f"{state_folder}/marks/batch=*", lambda name: int(name.partition("=")[2]) < batch_id - 1)
            if n_late or batch_id == 0:
                rows.where(is_late).drop("bucket").write.mode("overwrite").parquet(f"{state_folder}/late/batch={batch_id}")
            target = f"{state_folder}/rows/batch={batch_id}"
            rows.where(in_time).hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(target)
            if due is not None and (done is None or due > done):
                stored = _stored(session, state_folder, batch.schema, batch_id)
                found = _due(stored, None if done is None else done + 1, due, settling.buckets_ahead)
                write(look_ahead(found, keys, max_lap, _limit(found, after, max_group_rows)), batch_id)
        finally:
            rows.unpersist()

    return tag(laps, pits, keys).writeStream.foreachBatch(step)


def release(
    spark: SparkSession,
    state_folder: str,
    schema: T.StructType,
    write: Callable[[DataFrame, int], None],
    keys: Sequence[str] = KEYS,
    max_lap: str = "10 minutes",
    watermark: str = settings.OUT_OF_ORDERNESS,
    idle: str = "30 minutes",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> None:
    """Gives out all laps that still wait after a stopped stream, as one more batch; for the end of the input.

    The options are those of the stream, and ``schema`` that of its tagged rows. The state is removed, so it is the end of its checkpoint, too.
    """
    settling = Settling(*(_micros(spark, interval) for interval in (max_lap, watermark, idle)))
    batches = spark.read.schema(T.StructType([*_MARKS.fields, T.StructField("batch", T.LongType())]))
    batch_id = batches.parquet(f"{state_folder}/marks").agg(F.max("batch")).first()[0]
    marks = Marks.read(spark, state_folder, batch_id)
    done = settling.settled_through(settling.mark(marks.lap, marks.pit))
    waiting = _due(_stored(spark, state_folder, schema), None if done is None else done + 1, None, 0)
    write(look_ahead(waiting, keys, max_lap, _limit(waiting, marks, max_group_rows)), batch_id + 1)
    remove(spark, f"{state_folder}/rows")
    remove(spark, f"{state_folder}/marks")
