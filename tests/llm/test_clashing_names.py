"""Extra columns keep their names and values, whatever the operators use on their way."""

import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DATA, documents
from tidewell.llm import queries
from tidewell.llm.bpe import encode_decode
from tidewell.llm.decontaminate import drop_contaminated
from tidewell.llm.linededup import without_repeated_lines
from tidewell.llm.neardup import drop_near_duplicates
from tidewell.llm.quality import keep_good

NAMES = ["_p", "_host", "_path", "_p_toxic", "_score", "_keep", "_toxic", "_site", "_h", "_t", "_pn", "_hn", "_row", "__row", "_digest", "_salt", "_n_lines", "_n_dropped", "_numbers", "rest", "row", "node", "bucket", "label", "part", "place", "d", "shard", "digest", "group", "score"]
LINE = "a line of quite a few words that are the same in every one of these documents today"


def given(spark):
    texts = [(i, f"{LINE}\nnumber {i} has its own line with words like {'abcdefgh'[i % 8] * 9} in it, and others") for i in range(12)] + [(20, None), (21, "")]
    out = documents(spark, texts)
    return out.select("*", *[(F.col("doc_id") * 100 + k).alias(n) for k, n in enumerate(NAMES)])


@pytest.mark.parametrize("stage", ["quality", "lines", "near_duplicates", "decontamination"])
def test_stages_carry_columns_of_any_name(spark, stage):
    docs = given(spark)
    labels = spark.createDataFrame([(i, i % 2, i % 3 == 0) for i in range(12)], "doc_id bigint, quality int, toxic boolean").withColumn("toxic", F.col("toxic").cast("int"))
    benchmark = spark.createDataFrame([(1, "number 3 has its own line with words like dddddddddd in it")], "item_id bigint, text string")
    out = {"quality": lambda: keep_good(docs, labels), "lines": lambda: without_repeated_lines(docs), "near_duplicates": lambda: drop_near_duplicates(docs), "decontamination": lambda: drop_contaminated(docs, benchmark)}[stage]()
    assert out.columns == docs.columns
    rows = out.collect()
    assert rows and all(r[n] == r.doc_id * 100 + k for r in rows for k, n in enumerate(NAMES))


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_queries_read_no_column_of_another_name(spark, tables, name):
    docs, labels = given(spark), spark.read.parquet(f"{DATA}/sf0.001/labels.parquet")
    benchmark = spark.createDataFrame([(1, LINE)], "item_id bigint, text string")
    results = []
    for table in (docs.select("doc_id", "text", "lang", "source", "n_chars"), docs):
        out = queries.QUERIES[name](spark, tables(documents=table, labels=labels, benchmark=benchmark))
        results.append(sorted(map(str, out.select(sorted(out.columns)).collect())))
    assert results[0] == results[1] and len(results[0]) == 14


def test_encoding_reads_no_other_column(spark):
    docs = given(spark)
    assert encode_decode(docs, digests=False).count() == docs.count()
