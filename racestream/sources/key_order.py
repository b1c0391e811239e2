"""Publishing so that the records of each key follow their order, whatever the number of writers.

A broker keeps the order in which it receives the records of a partition, so a key whose records are sent by several tasks
side by side loses its order. Here the keys of a topic are dealt to lanes, and each lane is one sequence:

* all records are sorted by topic, lane and order, and cut into parts of about ``part_rows`` records. The parts are ranges of that order,
  so a key with a third of all records is spread over many parts, and a crowd of equal times is too. A task sorts a range of many parts
  where these are small, as each task costs the driver a sample of its range, a result and a file;
* the place of a record in its lane is what the lane's earlier parts hold, plus its place in its own part. Only the counts
  per part are gathered for that.

File topics take the places as offsets, and are written in one go. A broker hands out offsets itself, so there the parts are sent in
waves: a wave holds the nth part of each lane, one task per lane, and begins when the wave before has ended. Lanes are written side
by side, and a lane is never longer in a task than a part.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from racestream.session import written

#: Lanes per topic, and records of a part.
LANES, PART_ROWS = 64, 1_000_000

#: Records that a task sorts, where parts are smaller.
TASK_ROWS = 100_000

_ROW_BITS = 33


def arranged(
    records: DataFrame,
    order: Sequence[str],
    encode: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    lanes: int = LANES,
    part_rows: int = PART_ROWS,
    observe: Callable[[DataFrame], DataFrame] = lambda rows: rows,
) -> DataFrame:
    """A written table of ``records(topic, key, ...)`` with ``lane``, ``nth`` (the part's place in its lane) and ``place`` (the record's).

    ``order`` must be total within a key. ``encode`` makes the payload; it runs behind the sort, as finding the ranges runs everything
    before it a second time, and ``observe`` sees the rows as they are written. Records without a key are one more lane of their topic.
    """
    if lanes < 1 or part_rows < 1:
        raise ValueError("lanes and part_rows must be positive")
    laned = records.withColumn("lane", F.when(F.col("key").isNull(), F.lit(lanes)).otherwise(F.pmod(F.xxhash64("key"), F.lit(lanes))).cast("int"))
    parts_per_task = max(1, TASK_ROWS // part_rows)
    tasks = max(1, -(-records.count() // (parts_per_task * part_rows)))
    by = ("topic", "lane", *order)
    numbered = laned.repartitionByRange(tasks, *by).sortWithinPartitions(*by).withColumn("row", F.monotonically_increasing_id())
    numbered = numbered.withColumns({"task": F.shiftright("row", _ROW_BITS), "row": F.col("row").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))})
    # A task with a single part keeps it whole, though its range is not exactly that long.
    part = F.floor(F.col("row") / part_rows) if parts_per_task > 1 else F.lit(0)
    numbered = numbered.withColumn("part", F.shiftleft("task", _ROW_BITS) + part).drop("task")
    table = written(observe(encode(numbered)), "published")
    parts_of = table.groupBy("topic", "lane", "part").agg(F.count(F.lit(1)).alias("records"), F.min("row").alias("first"))
    in_lane = Window.partitionBy("topic", "lane").orderBy("part")
    before = F.coalesce(F.sum("records").over(in_lane.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts_of = parts_of.select("topic", "lane", "part", "first", before.alias("before"), (F.row_number().over(in_lane) - 1).alias("nth"))
    placed = table.join(written(parts_of, "published-parts"), ["topic", "lane", "part"])
    return placed.withColumn("place", F.col("before") + F.col("row") - F.col("first")).drop("row", "first", "before", "part")


def waves(table: DataFrame) -> Iterator[DataFrame]:
    """The records of an arranged table, part by part of the lanes; each lane of a wave lies in one task, in order."""
    last = table.agg(F.max("nth")).first()[0]
    for nth in range(0 if last is None else last + 1):
        yield table.where(F.col("nth") == nth).repartition("topic", "lane").sortWithinPartitions("topic", "lane", "place")


def end_offsets(log: DataFrame) -> DataFrame:
    """Where each lane of a log of ``(topic, partition, offset)`` ends."""
    return log.groupBy("topic", F.col("partition").alias("lane")).agg((F.max("offset") + 1).alias("end"))
