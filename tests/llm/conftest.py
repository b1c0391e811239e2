import sys
from pathlib import Path

import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
    ]
)

sys.path.insert(0, str(Path(__file__).parent))


@pytest.fixture(scope="session")
def documents(spark):
    """Makes a documents table of ``(doc_id, text)`` or ``(doc_id, text, lang, source)`` rows."""

    def make(rows, **more):
        full = []
        for row in rows:
            doc_id, text, *others = row
            lang, source = (*others, "en", "host")[:2] if len(others) < 2 else others
            full.append((doc_id, text, lang, source, None if text is None else len(text)))
        df = spark.createDataFrame(full, DOCUMENTS)
        from pyspark.sql import functions as F

        for name, value in more.items():
            df = df.withColumn(name, F.lit(value))
        return df

    return make
