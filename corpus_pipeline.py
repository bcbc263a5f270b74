"""A training corpus from raw documents, in five stages; each is written as Parquet and read by the next.

Edge cases: null and empty texts go through all stages; as they are equal to each other (null counts as empty), one of
them stays. Rows of equal id and text are one document and come out once. Null ids are kept. Without usable labels
nothing is rejected, without items nothing is contaminated; an empty table gives an empty result. All stages but the last
return the columns that they were given, extra ones of any name included; tokens returns doc_id, n_tokens, ids and
decoded. Near copies whose common lines the second stage has removed are no near duplicates to the third.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidewell.llm.bpe import encode_decode
from tidewell.llm.common import durable
from tidewell.llm.decontaminate import drop_contaminated
from tidewell.llm.linededup import without_repeated_lines
from tidewell.llm.neardup import drop_near_duplicates
from tidewell.llm.quality import keep_good


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of alike lines one occurrence stays; documents that are left without words go."""
    return without_repeated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of least id stays."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids and decoded text of each document that is left."""
    return encode_decode(docs, digests=False)


STAGES = [("quality", quality), ("lines", lines), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("tokens", tokens)]

#: SQL can't express the classifier, edit distances under connected components, or the merges; tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = durable(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
