"""What the operators share: reading tables, words, and mapping over Arrow batches."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

# ASCII white space, the separators of words in every contract here. bytes.split() uses the same six.
SPACE = r"[ \t\n\u000B\f\r]+"


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def doc_texts(documents: DataFrame) -> DataFrame:
    """Two columns only, so that further columns of any name are harmless; a null text is an empty one."""
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def n_words(text: Column) -> Column:
    """Words between ASCII white space; null and empty texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), SPACE)
    return F.size(F.filter(parts, lambda w: w != ""))


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of as many rows as are worked on at a time, unless the session sets their size.

    By default they have ten thousand, which JVM and Python hold several times over.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(ROWS))


def ship(spark: SparkSession) -> None:
    """Sends the package to the Python workers, as ``--py-files`` would; once per application."""
    context = spark.sparkContext
    if context in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="racestream-")) / "racestream.zip"
    with zipfile.ZipFile(archive, "w") as target:
        for file in sorted(package.rglob("*.py")):
            target.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.append(context)


_shipped: list = []


#: Rows of a batch that are Python objects at a time.
ROWS = 1_000


def _slices(batch: pa.RecordBatch, rows: int | None) -> Iterator[pa.RecordBatch]:
    step = rows or max(batch.num_rows, 1)
    for at in range(0, batch.num_rows, step):
        yield batch.slice(at, step)


def map_rows(
    df: DataFrame, function: Callable[[dict[str, list]], dict[str, list]], schema: str, rows: int | None = ROWS
) -> DataFrame:
    """Applies a function from columns to columns (as lists) to every ``rows`` rows, or with None to whole batches."""
    ship(df.sparkSession)
    names = StructType.fromDDL(schema).names

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in _slices(batch, rows):
                out = function(part.to_pydict())
                yield pa.RecordBatch.from_pydict({name: out[name] for name in names}, target)

    target = to_arrow_schema(StructType.fromDDL(schema))
    return df.mapInArrow(batches, schema)


def fresh(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def with_arrow_columns(df: DataFrame, text: str, function: Callable[[list], dict[str, list]], columns: dict[str, str]) -> DataFrame:
    """Adds columns that a function makes from the list of a batch's texts; all other columns pass unchanged.

    ``columns`` maps new names to Spark types; the names must be new to the table.
    """
    ship(df.sparkSession)
    added = StructType.fromDDL(", ".join(f"`{name}` {kind}" for name, kind in columns.items()))
    fields = list(to_arrow_schema(added))

    def batches(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in source:
            for part in _slices(batch, ROWS):
                made = function(part.column(position).to_pylist())
                arrays = [pa.array(made[field.name], field.type) for field in fields]
                yield pa.RecordBatch.from_arrays([*part.columns, *arrays], schema=pa.schema([*part.schema, *fields]))

    position = df.columns.index(text)
    return df.mapInArrow(batches, StructType(df.schema.fields + added.fields))


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Regroups sorted batches so that no group of equal keys is torn; the last group of a batch waits for the next one."""
    waiting: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        if not table.num_rows:
            continue
        if waiting is not None:
            table = pa.concat_tables([waiting, table])
        same = np.ones(table.num_rows, bool)
        for key in keys:
            column = table.column(key).to_numpy()
            same &= column == column[-1]
        cut = 0 if same.all() else int(np.flatnonzero(~same)[-1]) + 1
        if cut:
            yield table.slice(0, cut).combine_chunks()
        waiting = table.slice(cut).combine_chunks()
    if waiting is not None:
        yield waiting


def group_starts(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Where groups of equal keys begin."""
    begins = np.zeros(table.num_rows, bool)
    begins[:1] = True
    for key in keys:
        column = table.column(key).to_numpy()
        begins[1:] |= column[1:] != column[:-1]
    return np.flatnonzero(begins)
