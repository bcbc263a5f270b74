"""Operator 10 against definitions applied one text at a time."""

import hashlib

import numpy as np
import pyarrow as pa

from tests.llm.conftest import documents, sample
from tidewell.llm.common import seeded, utf8
from tidewell.llm.fingerprint import K, S, anchors, fingerprints, likeness, op10, read, spell, syncmers, with_successors

ODD = ["", None, "a", "same text " * 30, "same text " * 30, "é" * 200, "x" * 5000, "word " * 3000, "short", "ab"]


def brute_likeness(f, g):
    def marks(x):
        out, at, seen = {}, 0, {}
        for i in range(0, len(x), 5):
            at += "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz~".index(x[i])
            h = x[i + 1 : i + 5]
            seen[h] = seen.get(h, -1) + 1
            out[h, seen[h]] = at
        return out

    a, b = marks(f), marks(g)
    if not a and not b:
        return 1.0
    met = np.array([y for _, y in sorted((a[key], b[key]) for key in a.keys() & b.keys())], np.int64)
    best = np.ones(len(met), np.int64)  # of the chain that ends here
    for i in range(1, len(met)):
        best[i] = 1 + (best[:i] * (met[:i] < met[i])).max()
    return 2 * int(best.max(initial=0)) / (len(a) + len(b))


def test_syncmers_depend_on_their_own_bytes_and_leave_no_wide_gap():
    rng = np.random.default_rng(0)
    raw = rng.integers(97, 101, 4000).astype(np.uint8)
    at = syncmers(raw, np.array([0, 4000]))
    assert np.diff(at).max() <= K - S and at[0] < K - S
    chosen = set(at.tolist())
    for i in range(0, 4000 - K + 1, 7):  # each k bytes alone give the same answer
        assert (len(syncmers(raw[i : i + K], np.array([0, K]))) == 1) == (i in chosen)


def test_spelling_reads_back():
    raw, at = utf8(pa.array(["".join(chr(97 + (i * i) % 23) for i in range(500)), "", "tiny", "x" * 300]))
    marks = anchors(raw, at)
    assert all((x == y).all() for x, y in zip(read(spell(*marks)), marks))
    assert likeness(marks, marks).tolist() == [1.0] * 4


def test_op10_against_brute_force(spark, tables):
    given = documents(spark, ODD).selectExpr("doc_id + 5000 as doc_id", "text", "lang", "source", "n_chars").unionByName(sample(spark))
    rows = sorted(given.collect(), key=lambda r: -r.doc_id)
    got = {r.doc_id: r for r in op10(spark, tables(documents=given)).collect()}
    assert len(got) == len(rows)
    prints = {r.doc_id: r.fingerprint for r in fingerprints(given).collect()}
    for r, following in zip(rows, [*rows[1:], rows[0]]):
        t, u = r.text or "", following.text or ""
        n = len(t) // 3
        edited = t[: len(t) - n] + u[:n]
        g = got[r.doc_id]
        raw, at = utf8(pa.array([edited]))
        assert g.n_chars == len(t) and g.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert g.fingerprint == prints[r.doc_id] and g.edited_fingerprint == spell(*anchors(raw, at))[0]
        assert abs(g.near_edited - brute_likeness(g.fingerprint, g.edited_fingerprint)) < 1e-9
        assert abs(g.near_next - brute_likeness(g.fingerprint, prints[following.doc_id])) < 1e-9
    long = [r for r in got.values() if r.n_chars > 600 and r.doc_id < 5000]
    assert np.mean([r.near_edited > 0.4 for r in long]) > 0.95 and np.mean([r.near_next < 0.3 for r in long]) > 0.9


def test_op10_one_none_ties_and_clashing_names(spark, tables):
    one = documents(spark, [(7, "abc" * 40)])
    assert op10(spark, tables(documents=one)).collect()[0].near_next == 1.0
    assert op10(spark, tables(documents=one.limit(0))).count() == 0
    ties = documents(spark, [(1, "b"), (1, "b"), (1, None), (None, "z")]).selectExpr("*", "1 as part", "2 as place")
    assert sorted(r.n_chars for r in op10(spark, tables(documents=ties)).collect()) == [0, 1, 1, 1]


def test_successors_do_not_depend_on_exchange_reuse(spark):
    given = documents(spark, [(i * 37 % 1009, f"text {i} " * (i % 40)) for i in range(1009)] + [(None, "last")]).repartition(7)
    asked = {"spark.sql.exchange.reuse": "false", "spark.sql.shuffle.partitions": "61"}
    was = {k: spark.conf.get(k) for k in asked}
    rows = sorted(given.collect(), key=lambda r: (r.doc_id is None, -(r.doc_id or 0)))
    try:
        for k, v in asked.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r for r in with_successors(given).collect()}
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert len(got) == len(rows)
    for r, following in zip(rows, [*rows[1:], rows[0]]):
        t, n = r.text, len(r.text) // 3
        assert got[r.doc_id].edited_sha256 == hashlib.sha256((t[: len(t) - n] + following.text[:n]).encode()).hexdigest()


def test_a_text_of_very_many_equal_anchors_is_like_itself():
    raw = np.full((1 << 20) + 70_000, 120, np.uint8)  # more than one block, and more than 2**20 anchors
    marks = anchors(raw, np.array([0, len(raw)]))
    assert marks[2][0] == len(raw) - K + 1 and likeness(marks, marks).tolist() == [1.0]


def test_anchors_are_closed_syncmers_by_definition():
    # inner strings in the order of a hash that is worked out here byte by byte
    base, word = 0xD6E8FEB86659FD93, [int(x) for x in seeded(256, 37)]
    full = (1 << 64) - 1
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 100, 1500).astype(np.uint8)

    def order(inner):
        h = sum(word[c] * pow(base, i, 1 << 64) for i, c in enumerate(inner)) & full
        return (h ^ h >> 32) * base & full

    small = [order(raw[i : i + S].tolist()) for i in range(len(raw) - S + 1)]
    windows = [small[i : i + K - S + 1] for i in range(len(raw) - K + 1)]
    assert syncmers(raw, np.array([0, len(raw)])).tolist() == [i for i, w in enumerate(windows) if min(w) in (w[0], w[-1])]


def _alike(t, u):
    sides = [anchors(*utf8(pa.array([x]))) for x in (t, u)]
    return likeness(*sides)[0]


def test_insertions_deletions_and_moved_passages():
    rng = np.random.default_rng(9)
    words = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(2000)]
    text = " ".join(words)
    assert _alike(text, " ".join([*words[:1000], "inserted", *words[1000:]])) > 0.97
    assert _alike(text, " ".join([*words[:667], "one", *words[667:1333], "two", *words[1333:]])) > 0.95
    assert _alike(text, " ".join([*words[:500], *words[520:]])) > 0.95
    assert _alike(text, " ".join(w for i, w in enumerate(words) if i % 100)) > 0.7  # twenty places
    # halves that change places keep one of them in order
    assert 0.45 < _alike(text, " ".join([*words[1000:], *words[:1000]])) < 0.55
    others = ["".join(map(chr, rng.integers(97, 123, rng.integers(2, 9)))) for _ in range(2000)]
    assert _alike(text, " ".join(others)) < 0.05 and _alike(text, "") == 0.0


def test_likeness_of_shuffled_anchors_equals_brute_force():
    rng = np.random.default_rng(10)
    for _ in range(40):
        prints = []
        for _ in range(2):
            n = int(rng.integers(0, 40))
            prints.append(spell(np.cumsum(rng.integers(1, 40, n)), rng.integers(0, 12, n), np.array([n])))
        f, g = prints[0][0], prints[1][0]
        assert abs(likeness(read([f]), read([g]))[0] - brute_likeness(f, g)) < 1e-12
    both = read([f, g, f]), read([g, f, f])
    assert np.allclose(likeness(*both), [brute_likeness(f, g), brute_likeness(g, f), 1.0])
