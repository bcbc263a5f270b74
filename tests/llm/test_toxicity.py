"""Operator 9 rejects toxic documents whatever their quality, on documents whose labels it was not given."""

from pyspark.sql import functions as F

from tests.llm.conftest import DATA
from tidewell.llm.quality import keep_good, op9


def test_held_out_toxic_documents_are_rejected(spark, tables):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string")) % 2
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    folder = tables(documents=docs, labels=labels.where(half == 0))
    truth = {r.doc_id: r.toxic for r in labels.where((half == 1) & (F.col("quality") == 1)).collect()}
    keep = {r.doc_id: r.keep for r in op9(spark, folder).collect()}
    toxic, clean = ([keep[i] for i, t in truth.items() if t == x] for x in (1, 0))
    print("held out: toxic kept", sum(toxic), "of", len(toxic), "clean kept", sum(clean), "of", len(clean))
    assert sum(toxic) < 0.3 * len(toxic) and sum(clean) > 0.97 * len(clean)


def test_labels_without_toxic_documents_reject_none_for_it(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    none = labels.withColumn("toxic", F.lit(0))
    without, given = keep_good(docs, none), keep_good(docs, labels)
    assert given.columns == without.columns == docs.columns and given.count() < without.count()
