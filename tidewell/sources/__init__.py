"""Reading the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One Parquet table of a data folder; filters and columns are pushed down to its scan."""
    if name not in TABLES:
        raise ValueError(f"no table {name}")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
