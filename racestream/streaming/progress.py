"""What a streaming job has done, read from its checkpoint: micro-batches, the records of each, and those that came too late.

Spark writes down the end of every input and the watermark before it runs a micro-batch, and a commit when it is done. So the tables here
also tell about jobs that have stopped, failed or been restarted, and about every batch that the checkpoint still holds
(``spark.sql.streaming.minBatchesToRetain``, 100 by default; older ones are gone).

A record is too late in a micro-batch if its window ended at or before the watermark of the micro-batch before; it is then dropped by the
windowed aggregation. Spark's own counter (``counters``) is of what reaches the aggregation: groups of window and driver, not records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from racestream import settings

_COUNTERS = "batch_id BIGINT, input_rows BIGINT, dropped_groups BIGINT, open_groups BIGINT"


def _entries(spark: SparkSession, folder: str) -> DataFrame:
    """The numbered files of a log of the checkpoint: their numbers and lines."""
    files = spark.read.text(f"{folder}/[0-9]*", wholetext=True)
    return files.select(
        F.regexp_extract(F.col("_metadata.file_path"), r"/(\d+)(\.compact)?$", 1).cast("bigint").alias("number"),
        F.split("value", "\n").alias("lines"),
    )


def micro_batches(spark: SparkSession, checkpoint: str) -> DataFrame:
    """``batch_id, watermark, late_before, ends, committed``, a row per micro-batch that was begun.

    ``watermark`` is that of the batch (1970 before there is one); records whose window ended at or before ``late_before`` were dropped,
    which is the watermark of the batch before, and null if that is not known any more. ``ends`` holds the end of each source as JSON.
    """
    begun = _entries(spark, f"{checkpoint}/offsets").select(
        F.col("number").alias("batch_id"),
        F.timestamp_millis(F.get_json_object(F.col("lines")[1], "$.batchWatermarkMs").cast("bigint")).alias("watermark"),
        F.slice("lines", F.lit(3), F.size("lines")).alias("ends"),
    )
    done = _entries(spark, f"{checkpoint}/commits").select(F.col("number").alias("batch_id"), F.lit(True).alias("committed"))
    before = begun.select((F.col("batch_id") + 1).alias("batch_id"), F.col("watermark").alias("late_before"))
    first = F.when(F.col("batch_id") == 0, F.timestamp_millis(F.lit(0)))
    return (
        begun.join(before, "batch_id", "left")
        .join(done, "batch_id", "left")
        .select("batch_id", "watermark", F.coalesce("late_before", first).alias("late_before"), "ends", F.coalesce("committed", F.lit(False)).alias("committed"))
    )


def watermark_of(spark: SparkSession, checkpoint: str, batch_id: int) -> Column:
    """The watermark of one micro-batch, for use inside it: Spark has written it down before the batch runs."""
    text = "\n".join(r.value for r in spark.read.text(f"{checkpoint}/offsets/{batch_id}").collect())
    return F.timestamp_millis(F.get_json_object(F.lit(text.split("\n")[1]), "$.batchWatermarkMs").cast("bigint"))


def _ranges(batches: DataFrame, source: int, kind: str) -> DataFrame:
    """The end of a source per batch, and that of the batch before, as parsed JSON."""
    ends = batches.select("batch_id", F.from_json(F.get("ends", F.lit(source)), kind).alias("end"))
    starts = ends.select((F.col("batch_id") + 1).alias("batch_id"), F.col("end").alias("start"))
    return ends.join(starts, "batch_id", "left")


def _same_form(path: Column) -> Column:
    """Paths are written with one or three slashes behind their scheme, depending on who writes them."""
    return F.regexp_replace(path, "^([A-Za-z0-9+.-]+):/+", "$1:/")


def files_of(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """``batch_id, path`` of the files that a file source has read."""
    log = _entries(spark, f"{checkpoint}/sources/{source}").select(F.explode(F.slice("lines", F.lit(2), F.size("lines"))).alias("line"))
    files = log.select(F.from_json("line", "path STRING, batchId BIGINT").alias("f")).select("f.*").distinct()
    ranges = _ranges(micro_batches(spark, checkpoint), source, "logOffset BIGINT")
    ranges = ranges.select("batch_id", F.col("end.logOffset").alias("last"), F.coalesce("start.logOffset", F.lit(-1)).alias("before"))
    # A batch reads a stretch of the source's own log, none if there was nothing new.
    logged = ranges.where("last > before").select("batch_id", F.explode(F.sequence(F.col("before") + 1, F.col("last"))).alias("batchId"))
    return files.join(logged, "batchId").select("batch_id", _same_form(F.col("path")).alias("path"))


def of_files(records: DataFrame, files: DataFrame) -> DataFrame:
    """The records of a batch DataFrame over files, with the micro-batch that read their file."""
    return records.withColumn("path", _same_form(F.col("_metadata.file_path"))).join(files, "path").drop("path")


def of_offsets(records: DataFrame, batches: DataFrame, topic: str, source: int = 0) -> DataFrame:
    """The records ``(partition, offset, ...)`` of a broker's topic, with the micro-batch that read them."""
    ranges = _ranges(batches, source, "MAP<STRING, MAP<STRING, BIGINT>>")
    by_partition = ranges.select("batch_id", F.explode(F.col("end")[topic]).alias("number", "last"), F.col("start")[topic].alias("firsts"))
    by_partition = by_partition.select(
        "batch_id", F.col("number").cast("int").alias("in_partition"), "last", F.coalesce(F.col("firsts")[F.col("number")], F.lit(0)).alias("first")
    )
    inside = (F.col("partition") == F.col("in_partition")) & (F.col("offset") >= F.col("first")) & (F.col("offset") < F.col("last"))
    return records.join(F.broadcast(by_partition), inside).drop("in_partition", "first", "last")


def late(records: DataFrame, batches: DataFrame, window: str = settings.LEADERBOARD_WINDOW) -> DataFrame:
    """Those of the records ``(batch_id, t, ...)`` that a windowed aggregation has dropped, with their ``window``."""
    marks = F.broadcast(batches.select("batch_id", "late_before"))
    windowed = records.withColumn("window", F.window("t", window)).join(marks, "batch_id")
    return windowed.where(F.col("window.end") <= F.col("late_before"))


def counters(query: StreamingQuery) -> DataFrame:
    """Spark's counters of a query in this application, a row per micro-batch: rows read, groups dropped as late, groups in state.

    For a chain of stateful operators the state is that of the first. The session keeps the last
    ``spark.sql.streaming.numRecentProgressUpdates`` (100 by default).
    """
    rows = []
    for progress in query.recentProgress:
        operators = progress["stateOperators"]
        dropped = sum(op["numRowsDroppedByWatermark"] for op in operators)
        rows.append((progress["batchId"], progress["numInputRows"], dropped, operators[-1]["numRowsTotal"] if operators else 0))
    return SparkSession.active().createDataFrame(rows, T.StructType.fromDDL(_COUNTERS))


def state(spark: SparkSession, checkpoint: str, operator: int, batch_id: int | None = None) -> DataFrame:
    """The keys and values that a stateful operator keeps after a micro-batch, the last one by default; 0 is the operator closest to the sink."""
    reader = spark.read.format("statestore").option("operatorId", operator)
    return (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
