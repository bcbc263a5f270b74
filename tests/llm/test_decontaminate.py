"""Operator 1 against brute force on texts made for it."""

import hashlib
import random
import re

import duckdb

from tests.llm.conftest import DATA, documents
from tidewell.llm import common, decontaminate
from tidewell.llm.decontaminate import OP1_SQL, drop_contaminated, op1

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def brute(text, items):
    w = words_of(text)
    hit, ids = set(), set()
    for item, t in items:
        v = words_of(t)
        size = min(10, len(v))
        for win in {tuple(v[i : i + size]) for i in range(len(v) - size + 1)} if size and item is not None else ():
            for i in range(len(w) - size + 1):
                if tuple(w[i : i + size]) == win:
                    hit |= set(range(i, i + size))
                    ids.add(str(item))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), bool(hit)


def made():
    rnd = random.Random(4)
    vocab = [f"w{i}" for i in range(30)] + ["Été", "naïve", "x9"]
    pick = lambda n: " ".join(rnd.choice(vocab) for _ in range(n))
    items = [(i, pick(rnd.choice([1, 2, 3, 4, 5, 8, 10, 12, 25]))) for i in range(25)] + [(3, pick(12)), (None, pick(3)), (90, None), (91, ""), (92, "..."), (93, "rare " * 12)]
    texts = []
    for k in range(120):
        t = pick(rnd.randint(0, 40))
        if k % 3 == 0:
            t += ". " + rnd.choice([x[1] or "" for x in items]).upper() + "! " + pick(5)
        texts.append((k, t))
    texts += [(200, None), (201, ""), (202, "RARE, " * 5000), (203, pick(3000)), (5, texts[5][1]), (None, texts[0][1])]
    return items, texts


def test_op1_equals_brute_force(spark, tables, monkeypatch):
    items, texts = made()
    folder = tables(documents=documents(spark, texts).selectExpr("*", "1 as row", "2 as pos", "3 as win"), benchmark=spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as doc_id", "2 as gram"))
    want = sorted(((i, *brute(t, items)) for i, t in texts), key=str)
    assert sorted((tuple(r) for r in op1(spark, folder).collect()), key=str) == want
    monkeypatch.setattr(common.sized_join, "__defaults__", ("inner", 0, None))  # the way beyond the broadcast limit
    assert sorted((tuple(r) for r in op1(spark, folder).collect()), key=str) == want


def test_op1_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{DATA}/sf0.001/{t}.parquet'")
    names = ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(tuple(r[n] for n in names) for r in op1(spark, f"{DATA}/sf0.001").collect()) == sorted(con.sql(OP1_SQL).select(*names).fetchall())


def test_nothing_in_and_contaminated_documents_go(spark):
    items, texts = made()
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")
    assert decontaminate.decontaminate(docs.limit(0), bench).count() == 0
    assert decontaminate.decontaminate(docs, bench.limit(0)).where("contaminated").count() == 0
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted((str(r.doc_id) for r in kept.collect())) == sorted(str(i) for i, t in texts if not brute(t, items)[-1])
