"""Operators 5 and 9: held-out accuracy, gradients and sums by hand, and edge cases."""

import zlib

import numpy as np
from pyspark.sql import functions as F

from tests.llm.conftest import DATA, documents
from tidewell.llm.langid import Network, held_out, op5, predict, segments, train
from tidewell.llm.quality import Regression, features, keep_good, op9, score


def test_language_accuracy_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.01/documents.parquet")
    rows = op5(spark, f"{DATA}/sf0.01").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in rows)
    assert np.mean([r.lang == r.lang_pred for r in rows if r.held_out]) > 0.95


def test_backpropagation_through_time_is_the_gradient():
    net = Network(["a", "b", "c"], hidden=3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 101, (5, 6)).astype(np.uint8), rng.integers(0, 3, 5)

    def loss():
        p = net.probabilities(x)
        return -np.log(p[:, np.arange(5), y]).mean()

    gradient = net._gradient(x, y)
    for name in net.p:
        for at in list(np.ndindex(net.p[name].shape))[: 400 if "table" in name else 8]:
            if "table" in name and not 97 <= at[0] <= 100:
                continue
            old, h = net.p[name][at], 1e-4
            net.p[name][at] = old + h
            up = loss()
            net.p[name][at] = old - h
            down = loss()
            net.p[name][at] = old
            assert abs((up - down) / 2 / h - gradient[name][at]) < 2e-3, (name, at)


def test_segments_cover_every_byte():
    raw = np.arange(1, 151, dtype=np.uint8)
    x, row = segments(raw, np.array([0, 0, 70, 150]), 64)
    assert row.tolist() == [1, 1, 2, 2] and x.sum() == raw.sum()


def test_language_edge_cases(spark, tables):
    given = documents(spark, [(1, None), (2, ""), (3, "12 34"), (None, "the word"), (4, "the word"), (4, "the word"), (5, "the " * 40000)]).selectExpr("*", "1 as score", "2 as bucket")
    got = op5(spark, tables(documents=given)).collect()
    assert len(got) == 7 and {r.doc_id: (r.lang_pred, r.score) for r in got if r.doc_id in (1, 2, 3)} == {i: ("und", 0.0) for i in (1, 2, 3)}
    assert {r.lang_pred for r in got if r.doc_id in (4, 5, None)} == {"en"}
    none = given.withColumn("lang", given.lang.substr(9, 9)).limit(0)
    assert train(none) is None and predict(given.limit(2), None).count() == 2
    assert given.where(held_out(given.doc_id)).count() == sum(zlib.crc32(str(i).encode()) % 4 == 2 for i in (1, 2, 3, 4, 4, 5))


def test_quality_follows_held_out_labels(spark, tables):
    # keep says that a document is good and not toxic; half of the labels are not given
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    half = F.crc32(F.col("doc_id").cast("string")) % 2
    folder = tables(documents=docs.join(labels.select("doc_id"), "doc_id", "left_semi"), labels=labels.where(half == 0))
    truth = {r.doc_id: r.quality and not r.toxic for r in labels.where(half == 1).collect()}
    keep = {r.doc_id: r.keep for r in op9(spark, folder).collect()}
    assert len(truth) > 1500 and np.mean([keep[i] == bool(t) for i, t in truth.items()]) > 0.97


def test_rates_are_those_of_the_formulas(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    rows = score(docs, labels).collect()
    total = sum(r._p for r in rows) / len(rows)
    by_host, by_path = {}, {}
    for r in rows:
        by_host.setdefault(r._host, []).append(r._p)
        by_path.setdefault(r._path, []).append(r._p)

    def weight(groups):
        spread = np.mean([(np.mean(g) - total) ** 2 for g in groups.values()])
        chance = np.mean([1 / len(g) for g in groups.values()])
        inner = total * (1 - total)
        return min(max(inner / max(spread - inner * chance, inner / (1e6 + 1)) - 1, 1), 1e6)

    up, low = weight(by_host), weight(by_path)
    for r in rows:
        host, path = by_host[r._host], by_path[r._path]
        at_host = (up * total + sum(host) - r._p) / (up + len(host) - 1)
        at_path = (low * at_host + sum(path) - r._p) / (low + len(path) - 1)
        z = np.log(r._p / (1 - r._p)) + np.log(at_path / (1 - at_path)) - np.log(total / (1 - total))
        assert abs(r._score - 1 / (1 + np.exp(-z))) < 1e-6 and r._keep == (r._score >= 0.5)


def test_pooled_prediction_by_hand(spark):
    # one text at a time, position by position, from the network's weights
    rng = np.random.default_rng(4)
    net = Network(["a", "b", "c"], hidden=3)
    net.p = {k: rng.normal(size=v.shape) for k, v in net.p.items()}
    texts = [b"Hello you", b"1 x", b"", b"42", bytes(rng.integers(97, 123, 150).astype(np.uint8))]
    got = net.pooled(np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    squash = lambda v: 1 / (1 + np.exp(-v))

    def states(row, d):
        table, gates, state = net.p[f"table_{d}"], net.p[f"gates_{d}"], net.p[f"state_{d}"]
        h, out = np.zeros(3), []
        for c in row if d == "f" else row[::-1]:
            z, r = np.split(squash(table[c][:6] + h @ gates), 2)
            h = z * h + (1 - z) * np.tanh(table[c][6:] + (r * h) @ state)
            out.append(h)
        return out if d == "f" else out[::-1]

    for text, pooled in zip(texts, got):
        sums, n = np.zeros(3), 0
        for i in range(0, len(text), 64):
            row = list(text[i : i + 64].ljust(64, b"\0"))
            for c, f, b in zip(row, states(row, "f"), states(row, "b")):
                if bytes([c]).isalpha():
                    e = np.exp(f @ net.p["out_f"] + b @ net.p["out_b"] + net.p["bias"])
                    sums, n = sums + e / e.sum(), n + 1
        assert np.abs(pooled - sums / max(n, 1)).max() < 1e-5


def test_features_by_hand():
    text = "The CAT sat; the the cat\n12 #tags! été"
    raw = np.frombuffer(text.encode(), np.uint8)
    x, n = features(raw, np.array([0, len(raw)]))
    w = ["the", "cat", "sat", "the", "the", "cat", "12", "tags", "été"]
    rate = lambda kind: np.log1p(100 * sum(map(kind, raw.tolist())) / len(raw))
    kinds = [lambda c: 65 <= c < 91, lambda c: 65 <= c < 91 or 97 <= c < 123 or c > 127, lambda c: 48 <= c < 58, lambda c: c in b" \t\n\r", lambda c: c == 10, lambda c: c == 33, lambda c: c == 124, lambda c: c in b"#$%&*+<=>@[\\]^_`{}~"]
    want = [*map(rate, kinds), np.log1p(9), len(set(w)) / 9, 1 / 9, np.log1p(sum(len(v.encode()) for v in w) / 9)]
    assert n.tolist() == [9] and np.abs(x[0] - want).max() < 1e-9


def test_regression_is_where_its_gradient_is_zero():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(300, 3))
    y = (x[:, 0] + rng.normal(size=300) > 0).astype(float)
    model = Regression(x, y)
    z = np.concatenate([np.ones((300, 1)), (x - x.mean(0)) / x.std(0)], 1)
    gradient = z.T @ (y - 1 / (1 + np.exp(-z @ model.w)))
    assert np.abs(gradient - np.append(0, model.w[1:])).max() < 1e-4


def test_quality_edge_cases(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/sf0.001/labels.parquet")
    odd = docs.limit(3).selectExpr("doc_id + 900 as doc_id", "cast(null as string) as text", "cast(null as string) as lang", "cast(null as string) as source", "n_chars").unionByName(docs).unionByName(docs.limit(2)).selectExpr("*", "1 as n", "2 as quality", "3 as p")
    kept = keep_good(odd, labels.selectExpr("*", "1 as text").unionByName(labels.limit(1).selectExpr("cast(null as bigint) as doc_id", "1 as quality", "0 as toxic", "1 as text")))
    assert kept.columns == odd.columns and kept.where("doc_id >= 900").count() == 3
    assert keep_good(docs, labels.limit(0)).count() == docs.count() and keep_good(docs.limit(0), labels).count() == 0
