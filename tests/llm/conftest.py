import os
import tempfile

import pytest
from pyspark.sql import SparkSession

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark():
    session = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.sql.session.timeZone", "UTC").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp")).getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture
def tables(spark, tmp_path):
    """Writes small tables as a data folder and returns its path."""

    def write(**frames):
        for name, df in frames.items():
            df.write.mode("overwrite").parquet(f"{tmp_path}/{name}.parquet")
        return str(tmp_path)

    return write


def documents(spark, texts, **more):
    """A documents table; texts is a list of texts or of (doc_id, text)."""
    rows = [(i, t) if not isinstance(t, tuple) else t for i, t in enumerate(texts)]
    rows = [(i, t, "en", f"src{(i or 0) % 3}", len(t or "")) for i, t in rows]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")


def sample(spark, n=120):
    return spark.read.parquet(os.path.join(DATA, "sf0.001", "documents.parquet")).limit(n)
