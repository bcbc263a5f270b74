"""Operator 3 against a dictionary of all 100-byte strings."""

import hashlib
import random

import numpy as np

from tests.llm.conftest import documents, sample
from tidewell.llm import substrings
from tidewell.llm.substrings import LENGTH, dedup_substrings, merge, op3, transform


def brute(rows):
    """rows in order: (doc_id, text), each a document of its own."""
    seen, out = {}, []
    for place, (i, t) in enumerate(rows):
        b = (t or "").encode()
        for j in range(len(b) - LENGTH + 1):
            seen.setdefault(b[j : j + LENGTH], (place, j))
    for place, (i, t) in enumerate(rows):
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for j in range(len(b) - LENGTH + 1):
            if seen[b[j : j + LENGTH]] != (place, j):
                gone[j : j + LENGTH] = True
        spans = int((gone & ~np.concatenate([[False], gone[:-1]])).sum()) if len(b) else 0
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def test_merged_transforms_are_the_sorted_suffixes():
    rnd = random.Random(1)
    for _ in range(30):
        strings = [bytes(rnd.choice(b"\x01\x02\x03") for _ in range(rnd.randint(1, 30))) for _ in range(rnd.randint(2, 12))]
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
        ends = np.flatnonzero(text == 0)
        cuts = [0, *sorted(set((ends[rnd.sample(range(len(ends)), min(3, len(ends)))] + 1).tolist() + [len(text)]))]
        shards = []
        for a, b in zip(cuts, cuts[1:]):
            order, symbols = transform(text[a:b], 6)
            shards.append((order + a, symbols))
        suffix, new = merge(shards, 6)
        assert sorted(suffix.tolist()) == list(range(len(text)))
        key = [bytes(text[s : s + 6]).split(b"\0")[0] + (b"" if 0 not in text[s : s + 6] else b"\0") for s in suffix.tolist()]
        assert [k.rstrip(b"\0") for k in key] == sorted(k.rstrip(b"\0") for k in key)
        for i in range(1, len(key)):
            assert new[i] == (key[i] != key[i - 1] or key[i].endswith(b"\0")), (key[i - 1], key[i])


def made(rnd):
    piece = lambda n: "".join(rnd.choice("abcdé ") for _ in range(n))
    pool = [piece(rnd.choice([60, 99, 100, 101, 150, 400])) for _ in range(12)]
    texts = []
    for _ in range(60):
        texts.append("".join(rnd.choice([rnd.choice(pool), piece(rnd.randint(0, 120))]) for _ in range(rnd.randint(0, 6))))
    return [*texts, None, "", "x" * 3000, "ab" * 700, "x" * 99, "\x00\x01" * 90, texts[3], texts[3], "y" + texts[7]]


def test_op3_equals_brute_force(spark, tables, monkeypatch):
    rows = [(5 * i, t) for i, t in enumerate(made(random.Random(8)))]
    mixed = list(rows)
    random.Random(1).shuffle(mixed)
    folder = tables(documents=documents(spark, mixed).selectExpr("*", "1 as d", "2 as db", "3 as kind"))
    want = brute(rows)
    assert sorted(tuple(r) for r in op3(spark, folder).collect()) == want
    monkeypatch.setattr(substrings, "HOT", 1)  # every syncmer that different units share counts as frequent
    assert sorted(tuple(r) for r in op3(spark, folder).collect()) == want


def test_op3_on_the_tables(spark, tables):
    given = sample(spark, 200)
    rows = sorted((r.doc_id, r.text) for r in given.collect())
    assert sorted(tuple(r) for r in op3(spark, tables(documents=given)).collect()) == brute(rows)


def test_repeated_and_null_ids(spark):
    rnd = random.Random(3)
    a, b = ("".join(rnd.choice("abcdef ") for _ in range(300)) for _ in range(2))
    given = documents(spark, [(1, a), (1, a), (1, b), (None, a + b), (0, b[:150])])
    got = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans) for r in dedup_substrings(given).collect())
    assert got == [("0", 150, 0, 0), ("1", 300, 0, 0), ("1", 300, 0, 0), ("1", 300, 150, 1), ("None", 600, 600, 1)]
    assert dedup_substrings(given.limit(0)).count() == 0
