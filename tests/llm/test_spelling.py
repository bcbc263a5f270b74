"""Operator 13 against its definition by brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tests.llm.conftest import DATA, documents
from tidewell.llm import spelling
from tidewell.llm.spelling import deletion_keys, near_words, op13, roots, slipped, spelling_groups


def is_near(a, b):
    """One code point inserted, deleted or replaced."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def counted(rows):
    out = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'null' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            out[run] += 1
    return {w: n for w, n in out.items() if len(w) >= 6 and n >= 5}


def brute(words):
    near = {w: [] for w in words}
    by_size = {}
    for w in words:
        by_size.setdefault(len(w), []).append(w)
    for size, own in by_size.items():
        for other in (by_size[size], by_size.get(size + 1, [])):
            for a in own:
                for b in other:
                    if a != b and (len(b) > size or a < b) and is_near(a, b):
                        near[a].append(b)
                        near[b].append(a)
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 5 * n else None
    out = []
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words[form[w]] if form[w] is not None else None))
    return sorted(out)


def rows(df):
    return sorted((r.word, r.form, r.root, r.n, r.n_near, r.form_n) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect())


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_op13_equals_brute_force(spark, size):
    given = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/{size}/documents.parquet").select("doc_id", "text").collect()]
    want = brute(counted(given))
    got = rows(op13(spark, f"{DATA}/{size}"))
    assert got == want and len(got) > 100
    if size == "sf0.01":
        assert any(r[1] for r in got) and any(r[4] for r in got)


def test_slips_are_those_of_the_definition():
    seen = 0
    for i in range(4000):
        run = "abcdefgh"[: 3 + i % 6]
        h = zlib.crc32(f"{i}:{run}".encode())
        want = run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run
        assert slipped(i, run) == want
        seen += want != run
    assert seen > 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text("abé", min_size=1, max_size=9), min_size=1, max_size=12))
def test_keys_are_equal_where_words_are(words):
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    own, word, without, replaced = deletion_keys(codes, np.array([len(w) for w in words]))
    strings, places = {}, {}
    at = 0
    for i, w in enumerate(words):
        strings.setdefault(w, set()).add(int(own[i]))
        for k in range(len(w)):
            assert word[at] == i
            strings.setdefault(w[:k] + w[k + 1 :], set()).add(int(without[at]))
            places.setdefault((len(w), k, w[:k] + w[k + 1 :]), set()).add(int(replaced[at]))
            at += 1
    keys = [*strings.values(), *places.values()]
    assert all(len(k) == 1 for k in keys) and len(set().union(*keys)) == len(keys)


def table(spark, words):
    return spark.createDataFrame(sorted(words.items()), "word string, n bigint")


def near(spark, words):
    return sorted((r.word, r.n_near, r.best_n, r.best) for r in near_words(table(spark, words)).collect())


def wanted(words):
    out = []
    for w in words:
        own = [x for x in words if is_near(w, x)]
        if own:
            best = min(own, key=lambda x: (-words[x], x))
            out.append((w, len(own), words[best], best))
    return sorted(out)


def test_near_words_with_ties_repeats_and_full_groups(spark):
    rnd = random.Random(13)
    words = {"".join(rnd.choice("aab") for _ in range(rnd.randint(1, 7))): rnd.randint(5, 9) for _ in range(400)}
    assert near(spark, words) == wanted(words)
    letters = "abcdefghijklmnopqrstuvwxyz" + "".join(map(chr, range(0xC0, 0x100)))
    full = {f"word{c}end": 5 + i % 3 for i, c in enumerate(letters)} | {"wordend": 7} | {f"wordend{c}": 9 for c in letters}
    assert near(spark, full) == wanted(full) and dict((w, n) for w, n, *_ in near(spark, full))["wordend"] == 2 * len(letters)
    assert near(spark, {"single": 5}) == [] and near(spark, {}) == []


def test_collisions_are_told_by_the_strings(spark, monkeypatch):
    # with keys of a few bits nearly all words meet, and still only near ones count
    exact = spelling.deletion_keys
    low = np.uint64(7)
    monkeypatch.setattr(spelling, "deletion_keys", lambda c, n: tuple(x & low if x.dtype == np.uint64 else x for x in exact(c, n)))
    rnd = random.Random(5)
    words = {"".join(rnd.choice("abc") for _ in range(rnd.randint(3, 6))): rnd.randint(5, 50) for _ in range(60)}
    batch = lambda cols: __import__("pyarrow").RecordBatch.from_pydict(cols)
    pa = __import__("pyarrow")
    given = pa.RecordBatch.from_arrays([pa.array(list(words)), pa.array(np.arange(len(words)))], ["word", "node"])
    keys = pa.Table.from_batches(list(spelling._keys(given))).sort_by("key").to_batches()
    found = pa.Table.from_batches(list(spelling._candidates(iter(keys)))).to_pydict()
    names = list(words)
    full = batch({"key": found["key"], "kind": pa.array(found["kind"], pa.int32()), "word": [names[i] for i in found["node"]], "n": [words[names[i]] for i in found["node"]]})
    total, best = Counter(), {}
    for out in spelling._near(iter([full])):
        for w, n, bn, b in zip(*(c.to_pylist() for c in out.columns)):
            total[w] += n
            best[w] = min(best.get(w, (0, "")), (-bn, b))
    assert sorted((w, n, -best[w][0], best[w][1]) for w, n in total.items()) == wanted(words)


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{i:03}", f"w{i + 1:03}") for i in range(40)] + [(f"v{i}", "w010") for i in range(50)], "word string, form string")
    got = {r.word: r.root for r in roots(forms).collect()}
    assert len(got) == 90 and set(got.values()) == {"w040"}
    assert roots(forms.limit(0)).count() == 0


def test_edge_cases(spark, tables):
    long = "q" * 50_000
    texts = [(1, None), (2, ""), (3, "12 !!"), (None, "receive " * 7), (4, "Receive RECEIVE receive, recieve " * 4), (5, "receivé receive" * 5), (6, "receive " * 300_000), (7, "same words here words"), (7, "same words here words")]
    texts += [(10 + i, f"{long} {long}z {long[:-1]}x") for i in range(6)] + [(20 + i, "ÀÉÎÕÜ×÷ àéîõü×÷ naïvetés naivetés ſtraße Kelvins") for i in range(6)]
    docs = documents(spark, texts).selectExpr("*", "text as word", "doc_id as n", "doc_id as node", "doc_id as key")
    got = rows(op13(spark, tables(documents=docs)))
    assert got == brute(counted(texts))
    assert {w for w, *_ in got} >= {"receive", long, long + "z", "naïvetés", "naivetés"}
    assert spelling_groups(docs.limit(0)).count() == 0
    assert spelling_groups(docs.where("doc_id in (1, 2, 3)")).count() == 0


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    monkeypatch.setattr(spelling, "COUNTED", 3)
    texts = [(i, "separate seperate separate definitely definitly colour colours") for i in range(40)]
    got = rows(spelling_groups(documents(spark, texts)))
    assert got == brute(counted(texts))
