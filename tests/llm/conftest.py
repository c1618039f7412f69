import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCUMENT = StructType([StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()), StructField("source", StringType()), StructField("n_chars", LongType())])


@pytest.fixture
def documents(spark):
    """A documents table of (doc_id, text) or (doc_id, text, source) tuples."""

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1]) if r[1] is not None else None) for r in rows]
        return spark.createDataFrame(full, DOCUMENT)

    return make


@pytest.fixture
def save(tmp_path):
    """Write named frames as the tables of a data folder."""

    def write(**tables):
        for name, df in tables.items():
            df.write.parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write
