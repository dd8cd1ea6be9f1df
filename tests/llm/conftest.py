import pytest
from pyspark.sql import functions as F

LONG = " ".join(f"w{i % 977}x{i // 977}" for i in range(30_000))


@pytest.fixture(scope="session")
def frame(spark):
    """Rows of (doc_id, text), with extra columns whose names clash with those that operators make."""

    def make(rows):
        df = spark.createDataFrame(rows, "doc_id long, text string")
        for name in ("score", "kept", "node", "_text", "windows", "n", "word", "hub", "spans", "next_text", "_bucket"):
            df = df.withColumn(name, F.lit("x"))
        return df

    return make
