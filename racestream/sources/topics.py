"""Topics: a Kafka broker, or directories of files standing in for one.

Both give and take the same records, so a job runs on either by configuration. The Kafka form needs the
Spark Kafka connector on the class path. File topics live in ``<root>/topic=<name>/`` and hold the columns
of ``schemas.TOPIC_RECORD``.

Delivery is at least once: a failed task is retried, and a failed batch repeated from its checkpoint,
where a plain producer would log the error and lose the record.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from racestream import schemas, settings
from racestream.functions.event_time import event_time
from racestream.functions.json_codec import MALFORMED, decode
from racestream.schemas import RAW_TABLES
from racestream.sources.key_order import end_offsets, waves


def is_path_missing(error: AnalysisException) -> bool:
    return error.getCondition() == "PATH_NOT_FOUND"


@dataclass(frozen=True)
class KafkaTopics:
    """Topics of a broker. ``options`` are passed on to reader and writer (security, rate limits, ...)."""

    bootstrap_servers: str = settings.DEFAULT_BOOTSTRAP_SERVERS
    group_prefix: str = "racestream"
    options: Mapping[str, str] = field(default_factory=dict)

    def read_options(self, topic: str) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "subscribe": topic,
            "startingOffsets": "earliest",
            "groupIdPrefix": f"{self.group_prefix}-{topic}",
            **self.options,
        }

    def write_options(self, in_order: bool = False) -> dict[str, str]:
        """With ``in_order`` a batch of records is sent when the one before is acknowledged, so that retries cannot overtake."""
        one_by_one = {"kafka.max.in.flight.requests.per.connection": "1"} if in_order else {}
        return {
            "kafka.bootstrap.servers": self.bootstrap_servers,
            "kafka.acks": settings.PRODUCER_ACKS,
            "kafka.retries": settings.PRODUCER_RETRIES,
            "kafka.linger.ms": settings.PRODUCER_LINGER_MS,
            **one_by_one,
            **self.options,
        }

    @staticmethod
    def _records(rows: DataFrame) -> DataFrame:
        return rows.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("ingest_time"),
            "partition",
            "offset",
        )

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        return self._records(spark.read.format("kafka").options(**self.read_options(topic)).load())

    def read_stream(self, spark: SparkSession, topic: str) -> DataFrame:
        return self._records(spark.readStream.format("kafka").options(**self.read_options(topic)).load())

    def write(self, messages: DataFrame) -> None:
        """One write for all topics: ``messages`` has ``topic, key, value``."""
        messages.select("topic", "key", "value").write.format("kafka").options(**self.write_options()).save()

    def write_in_order(self, arranged: DataFrame) -> None:
        """An arranged table (see ``sources.key_order``), wave by wave.

        A task that is retried sends its records again from the first, so a consumer can see a stretch of a key twice, but
        the last record of a key is the newest.
        """
        for wave in waves(arranged):
            wave.select("topic", "key", "value").write.format("kafka").options(**self.write_options(in_order=True)).save()

    def write_stream(self, messages: DataFrame, topic: str, checkpoint: str) -> DataStreamWriter:
        """Values only; as there is no key, records of a driver are spread over the topic's partitions."""
        writer = messages.select("value").writeStream.format("kafka").options(**self.write_options())
        return writer.option("topic", topic).option("checkpointLocation", checkpoint).outputMode("append")


@dataclass(frozen=True)
class FileTopics:
    """Topics in the folders of ``root``; ``options`` go to the streaming reader (``maxFilesPerTrigger``, ...)."""

    root: str
    format: str = "parquet"
    options: Mapping[str, str] = field(default_factory=dict)

    def path(self, topic: str) -> str:
        return f"{self.root}/topic={topic}"

    def read(self, spark: SparkSession, topic: str) -> DataFrame:
        try:
            records = spark.read.schema(schemas.TOPIC_RECORD).format(self.format).load(self.path(topic))
            return records.select(*schemas.TOPIC_RECORD.names)
        except AnalysisException as error:
            if not is_path_missing(error):
                raise
            return spark.createDataFrame([], schemas.TOPIC_RECORD)

    def read_stream(self, spark: SparkSession, topic: str) -> DataFrame:
        reader = spark.readStream.schema(schemas.TOPIC_RECORD).format(self.format).options(**self.options)
        return reader.load(self.path(topic))

    def write(self, messages: DataFrame) -> None:
        """``messages`` has ``topic, key, value``; ``time`` and ``seq``, where present, become ingest time and offset."""
        def optional(name: str, target: str) -> Column:
            found = F.col(name) if name in messages.columns else F.lit(None)
            return found.cast(schemas.TOPIC_RECORD[target].dataType).alias(target)

        records = messages.select(
            "topic", "key", "value", optional("time", "ingest_time"), F.lit(0).alias("partition"), optional("seq", "offset")
        )
        ordered = records.sortWithinPartitions("topic", "ingest_time", "offset")
        ordered.write.mode("append").partitionBy("topic").format(self.format).save(self.root)

    def write_in_order(self, arranged: DataFrame) -> None:
        """An arranged table (see ``sources.key_order``): lanes become partitions, whose offsets go on from what is there."""
        try:
            log = T.StructType([*schemas.TOPIC_RECORD.fields, T.StructField("topic", T.StringType())])
            ends = end_offsets(arranged.sparkSession.read.schema(log).format(self.format).load(self.root))
            joined = arranged.join(ends, ["topic", "lane"], "left").withColumn("place", F.col("place") + F.coalesce("end", F.lit(0)))
        except AnalysisException as error:
            if not is_path_missing(error):
                raise
            joined = arranged
        records = joined.select(
            "topic", "key", "value", F.col("time").alias("ingest_time"), F.col("lane").alias("partition"), F.col("place").alias("offset")
        )
        records.write.mode("append").partitionBy("topic").format(self.format).save(self.root)

    def write_stream(self, messages: DataFrame, topic: str, checkpoint: str) -> DataStreamWriter:
        writer = messages.select("value").writeStream.format(self.format).option("path", self.path(topic))
        return writer.option("checkpointLocation", checkpoint).outputMode("append")


Topics = KafkaTopics | FileTopics


def typed(records: DataFrame, name: str, on_malformed: str = "fail", time_fallback: str = "ingest") -> DataFrame:
    """Records of a raw topic as rows of its table, with ``t`` and ``seq``; for batch and streaming DataFrames.

    ``time_fallback`` is ``'ingest'``, ``'epoch'`` or ``'null'``, see ``functions.event_time``.
    """
    raw = RAW_TABLES[name]
    fallback = F.col("ingest_time") if time_fallback == "ingest" else time_fallback
    decoded = decode(records, raw.schema, on_malformed)
    kept = [c for c in ("value", MALFORMED) if c in decoded.columns]
    return decoded.select(
        *raw.schema.names,
        event_time(F.col(raw.time_field), fallback).alias("t"),
        F.struct("ingest_time", "partition", "offset").alias("seq"),
        *kept,
    )
