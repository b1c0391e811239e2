"""Landed session data: one folder of JSON or parquet files per raw table."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from racestream.functions.event_time import event_time
from racestream.functions.json_codec import STRICT_JSON, apply_policy, coerce, text_schema
from racestream.schemas import RAW_TABLES
from racestream.sources.topics import is_path_missing

# The folder of each table below a landing root.
FOLDERS = {"positions": "position", "laps": "laps", "pit_stops": "pit", "race_control": "race_control"}


def _json_rows(spark: SparkSession, path: str, name: str, on_malformed: str, multi_line: bool, tolerant: bool) -> DataFrame:
    raw = RAW_TABLES[name]
    reader = spark.read.schema(text_schema(raw.schema)).options(**STRICT_JSON).option("multiLine", multi_line)
    reader = reader.option("ignoreCorruptFiles", tolerant)
    documents = reader.json(path).select(F.struct("*").alias("_document"), F.col("_corrupt").alias("text"))
    rows = coerce(documents, raw.schema, ["text"])
    return apply_policy(rows, on_malformed, F.col("text")).drop("text")


def _stored_rows(spark: SparkSession, path: str, name: str, format: str, session_key: int | None, tolerant: bool) -> DataFrame:
    """Typed files. A required field that is absent takes its default, as it does in JSON."""
    raw = RAW_TABLES[name]
    rows = spark.read.schema(raw.schema).format(format).option("ignoreCorruptFiles", tolerant).load(path)
    if session_key is not None:
        key = F.col("session_key")
        rows = rows.where((key == session_key) | key.isNull() if session_key == 0 else key == session_key)
    return rows.select(
        *[F.col(f.name) if f.nullable else F.coalesce(f.name, F.lit(0).cast(f.dataType)).alias(f.name) for f in raw.schema.fields]
    )


def read_landed(
    spark: SparkSession,
    path: str,
    name: str,
    session_key: int | None = None,
    format: str = "json",
    on_malformed: str = "fail",
    multi_line: bool = False,
    on_unreadable: str = "fail",
) -> DataFrame:
    """A raw table, reduced to the fields of its schema, with ``t`` and ``seq``.

    ``session_key`` keeps one session; on parquet the filter is pushed into the scan. JSON files hold one
    document per line, or with ``multi_line`` one array per file. A path that does not exist is an empty
    table. A file that cannot be read, such as one cut off, ends the job, or with ``on_unreadable='skip'`` is left out; ``files_without_rows``
    names those. ``seq`` follows the order within a file; where order across files matters, rely on ``t``.
    """
    if on_unreadable not in ("fail", "skip"):
        raise ValueError(f"on_unreadable must be 'fail' or 'skip', got {on_unreadable!r}")
    raw, tolerant = RAW_TABLES[name], on_unreadable == "skip"
    try:
        if format == "json":
            rows = _json_rows(spark, path, name, on_malformed, multi_line, tolerant)
        else:
            rows = _stored_rows(spark, path, name, format, session_key, tolerant)
    except AnalysisException as error:
        if not is_path_missing(error):
            raise
        rows = spark.createDataFrame([], raw.schema)
    return with_time_and_seq(in_session(rows, session_key), name)


def files_without_rows(spark: SparkSession, path: str, name: str, format: str = "json") -> DataFrame:
    """``path, length`` of the files of a table that give no row when unreadable files are skipped: those, and empty ones.

    Files are listed without their contents; of each that can be read, one column is scanned.
    """
    listed = spark.read.format("binaryFile").load(path).select("path", "length")
    schema = RAW_TABLES[name].schema[:1]
    read = spark.read.schema(schema).format(format).option("ignoreCorruptFiles", True).load(path)
    # Reading a column makes the reader open the data, not just count rows.
    opened = read.select(F.col("_metadata.file_path").alias("path"), F.col(schema.names[0]).alias("_value")).groupBy("path").agg(F.count("*").alias("n"), F.max("_value"))
    plain = lambda c: F.regexp_replace(c, "^([A-Za-z0-9+.-]+):/+", "$1:/")
    good = opened.select(plain(F.col("path")).alias("plain"))
    return listed.join(good, plain(listed["path"]) == F.col("plain"), "left_anti")


def in_session(rows: DataFrame, session_key: int | None) -> DataFrame:
    return rows if session_key is None else rows.where(F.col("session_key") == session_key)


def with_time_and_seq(rows: DataFrame, name: str) -> DataFrame:
    return rows.withColumns(
        {"t": event_time(F.col(RAW_TABLES[name].time_field), "epoch"), "seq": F.monotonically_increasing_id()}
    )


def read_session(spark: SparkSession, root: str, session_key: int | None = None, **options) -> dict[str, DataFrame]:
    """All four raw tables of a landing root."""
    return {name: read_landed(spark, f"{root}/{folder}", name, session_key, **options) for name, folder in FOLDERS.items()}
