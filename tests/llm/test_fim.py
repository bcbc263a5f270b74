"""Operator 11 against its definition one text at a time, and against its SQL."""

import hashlib
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tests.llm.conftest import DATA, documents
from tidewell.llm.fim import OP11_SQL, check_marks, fill_in_middle, op11, places, restored


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def brute(doc_id, text):
    text = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", text)
    n = len(units)
    digest = hashlib.sha256(f"7:{'null' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, _, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    if not text or re.search("<[PSM]>", text):
        return n, "plain", None, None, sha(text), sha(text)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    form = "spm" if h4 % 100 < 50 else "psm"
    out = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), sha(out), sha(text)


def rows(df):
    return sorted(((r.doc_id, (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256, r.restored_sha256)) for r in df.collect()), key=str)


def test_op11_equals_definition_and_sql(spark):
    given = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()
    got = rows(op11(spark, f"{DATA}/sf0.001"))
    assert got == sorted(((r.doc_id, brute(r.doc_id, r.text)) for r in given), key=str)
    assert {f[1] for _, f in got} >= {"psm", "spm"}
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{DATA}/sf0.001/documents.parquet'")
    columns = "doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256"
    assert sorted(((r[0], r[1:]) for r in con.sql(OP11_SQL).select(columns).fetchall()), key=str) == got


EDGES = [(1, None), (2, ""), (3, "\n"), (4, "\n\n\n"), (5, "no line feed"), (6, "a\nb"), (7, "ends\n"), (8, "with <S> in it\nand more\n"), (9, "<P"), (10, "a<\nS>\n<\nP>\nM>"), (11, "naïve 𝒳\nÉté \U0001f600\n" * 5), (None, "x\ny\nz\n"), (12, "same\nrow"), (12, "same\nrow"), (13, "w " * 300_000 + "\n" + "y\n" * 100_000), (14, "\r\n\r \x0b\x85\n"), (15, "x\x00y\n\x00")]


def test_edge_cases(spark, tables):
    docs = documents(spark, EDGES).selectExpr("*", "doc_id as raw", "text as _raw", "1 as form2")
    got = rows(op11(spark, tables(documents=docs)))
    assert got == sorted(((i, brute(i, t)) for i, t in EDGES), key=str)
    assert op11(spark, tables(documents=docs.limit(0))).count() == 0


def test_many_ids_draw_every_place(spark):
    text = "a\nb\nc"
    out = fill_in_middle(documents(spark, [text] * 400)).withColumn("back", restored(F.col("output"), F.col("form"))).collect()
    assert all(r.back == text for r in out)
    assert {(r.prefix_chars, r.middle_chars) for r in out} == {(p, q - p) for p in (0, 2, 4, 5) for q in (0, 2, 4, 5) if p <= q}
    assert 120 < sum(r.form == "psm" for r in out) < 280


def test_other_units_marks_and_rates(spark):
    marks = ("[[pre]]", "{suf}", "|mid>")
    docs = documents(spark, [f"one two three {i} four" for i in range(300)]).selectExpr("*", "7 as extra")
    out = fill_in_middle(docs, unit=r"\S+\s*", marks=marks, seed=3, rate=40, suffix_first=0)
    kept = out.withColumn("back", restored(F.col("output"), F.col("form"), marks)).collect()
    assert out.columns == [*docs.columns, "n", "form", "prefix_chars", "middle_chars", "output"] and all(r.back == r.text and r.extra == 7 and r.n == 5 for r in kept)
    assert {r.form for r in kept} == {"plain", "psm"} and 60 < sum(r.form == "psm" for r in kept) < 180
    with pytest.raises(ValueError):
        fill_in_middle(documents(spark, ["x"]).withColumn("Form", F.lit(1)))


def test_marks_that_can_be_misread():
    check_marks(("<P>", "<S>", "<M>"))
    for bad in (("", "b", "c"), ("<a", "a>", "c"), ("ab", "abc", "d"), ("aba", "x", "y"), ("x", "x", "y")):
        with pytest.raises(ValueError):
            check_marks(bad)


def test_places_reads_no_match_beyond_the_upper_rank():
    read = []

    def lazy():
        for m in re.finditer("x", "xxxxxxxx"):
            read.append(m.end())
            yield m

    assert places(lazy(), 2, 5) == (2, 5) and read == [1, 2, 3, 4, 5]
    assert places(lazy(), 0, 0) == (0, 0) and places(lazy(), 0, 1) == (0, 1) and places(lazy(), 3, 3) == (3, 3) and places(lazy(), 8, 8) == (8, 8)
