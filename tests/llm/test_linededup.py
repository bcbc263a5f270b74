"""Operator 6 against brute force over all pairs of lines."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa

from tests.llm.conftest import DATA, documents
from tidewell.llm.editdistance import similar
from tidewell.llm.linededup import MASKS, _pack, _unpack, dedup_lines, dropped_lines, op6, simhash, without_repeated_lines

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def normal(line):
    return " ".join(WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), line)))


def levenshtein(a, b, most):
    if abs(len(a) - len(b)) > most:
        return most + 1
    row = np.arange(len(b) + 1)
    other = np.frombuffer(b.encode("utf-32-le"), np.uint32)
    for i, c in enumerate(a):
        best = np.minimum(row[1:] + 1, row[:-1] + (other != ord(c)))
        new = np.concatenate([[i + 1], best])
        new = np.minimum.accumulate(new - np.arange(len(new))) + np.arange(len(new))
        row = new
    return int(row[-1])


def brute(rows):
    """(doc_id, text) -> kept text, by all pairs of distinct lines."""
    forms = sorted({normal(x) for _, t in rows if t is not None for x in t.split("\n")} - {""})
    parent = {f: f for f in forms}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    size = np.array([len(f) for f in forms])
    for i in range(len(forms)):
        near = i + 1 + np.flatnonzero(np.minimum(size[i + 1 :], size[i]) >= 0.8 * np.maximum(size[i + 1 :], size[i]) - 1e-6)
        for j in near[similar([forms[i]] * len(near), [forms[j] for j in near], 0.8)].tolist():
            longer = max(len(forms[i]), len(forms[j]))
            assert levenshtein(forms[i], forms[j], longer) <= 0.2 * longer + 1e-9
            parent[find(forms[i])] = find(forms[j])
    first = {}
    order = sorted(((i is None, i or 0, hashlib.md5((t or "").encode()).digest(), k), find(normal(x))) for i, t in rows if t is not None for k, x in enumerate(t.split("\n")) if normal(x))
    for place, group in order:
        first.setdefault(group, place)
    out = []
    for i, t in rows:
        if t is None:
            out.append((i, None))
            continue
        digest = hashlib.md5(t.encode()).digest()
        out.append((i, "\n".join(x for k, x in enumerate(t.split("\n")) if not normal(x) or first[find(normal(x))] == (i is None, i or 0, digest, k))))
    return out


def test_every_pair_within_three_bits_shares_a_bucket():
    rng = np.random.default_rng(0)
    for _ in range(3000):
        flip = sum({1 << int(b) for b in rng.choice(64, 3, replace=False)})
        assert any(m & flip == 0 for m in MASKS)


def test_simhash_is_the_majority_of_each_bit():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 1 << 63, 70000 + 13).astype(np.uint64) * np.uint64(2) + rng.integers(0, 2, 70013).astype(np.uint64)
    got = simhash(h, np.array([5, 8, 0, 70000]))
    for value, own in zip(got.tolist(), (h[:5], h[5:13], h[:0], h[13:])):
        assert value == sum(1 << b for b in range(64) if 2 * sum((x >> b) & 1 for x in own.tolist()) > len(own))


def test_op6_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()]
    want = {i: hashlib.sha256(t.encode()).hexdigest() for i, t in brute(rows)}
    got = op6(spark, f"{DATA}/sf0.001").collect()
    assert {r.doc_id: r.kept_sha256 for r in got} == want and sum(r.n_dropped for r in got) > 0


def test_fuzzy_lines_and_edge_cases(spark):
    line = "the quick brown fox jumps over the lazy dog while a small cat watches from behind the old wooden fence near river bank number "
    texts = [(0, None), (1, ""), (2, "\n\n!!\n"), (3, line + "seven today"), (4, line.upper() + "seven  today!"), (5, line + "sevens today\nnew one here"), (6, "alone\n" + line + "seven today"), (7, "x " * 70000 + "\nalone"), (8, "x " * 70000), (9, "same\nsame"), (9, "same\nsame"), (None, "same\nlast words")]
    given = documents(spark, texts).selectExpr("*", "1 as line", "2 as number", "3 as label")
    got = sorted(((r.doc_id, r.text) for r in dedup_lines(given).collect()), key=str)
    assert got == sorted(brute(texts), key=str)
    kept = without_repeated_lines(given)
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == given.columns and {0, 1, 2, 3, 6, 7, None} <= set(ids) and not {4, 8} & set(ids)
    assert dedup_lines(given.limit(0)).count() == 0


def test_large_group_of_line_variants(spark):
    rnd = random.Random(6)
    base = [f"w{rnd.randrange(10**5)}" for _ in range(60)]
    texts = []
    for i in range(25):
        line = list(base)
        for _ in range(rnd.choice([0, 1, 1, 2, 20])):
            line[rnd.randrange(60)] = f"v{rnd.randrange(10**5)}"
        texts.append((i, " ".join(line)))
    got = sorted(((r.doc_id, r.text) for r in dedup_lines(documents(spark, texts)).collect()))
    assert got == sorted(brute(texts))


def test_large_buckets_are_split_or_led(spark):
    rnd = random.Random(9)
    base = [f"w{rnd.randrange(10**5)}" for _ in range(40)]
    texts = []
    for i in range(30):
        line = list(base)
        for _ in range(rnd.choice([0, 1, 2, 4, 30])):
            line[rnd.randrange(40)] = f"v{rnd.randrange(10**5)}"
        texts.append((i, " ".join(line)))
    texts += [(100 + i, "ha " * i) for i in range(40, 60)]  # lines that no hash of their word pairs tells apart
    given = documents(spark, texts)
    numbers = lambda rows: sorted((r.row, r.numbers) for r in rows.collect())
    assert numbers(dropped_lines(given, large=2)) == numbers(dropped_lines(given))
    kept = {i for i, t in brute(texts) if t}
    assert {r.doc_id for r in without_repeated_lines(given).collect()} == kept


def test_texts_of_more_than_a_block(spark):
    rnd = random.Random(3)
    lines = ["".join(rnd.choice("abcdefghijklmnop ") for _ in range(60)).strip() for _ in range(24_000)]
    big = "\n".join(lines)
    assert len(big) > 1_300_000 and len(set(map(normal, lines))) == len(lines)
    got = {r.doc_id: (r._n_lines, r._n_dropped, r.text) for r in dedup_lines(documents(spark, [(1, big), (2, lines[7]), (3, big[:-1] + "\n")])).collect()}
    assert got[1] == (24_000, 0, big) and got[2] == (1, 1, "") and got[3][:2] == (24_001, 24_000)


def test_hot_buckets_are_dealt_by_line():
    # what a flush deals out by line comes back whole, with the flagged key in its own part
    n, parts = 500, 7
    rng = np.random.default_rng(4)
    own = rng.integers(-(1 << 62), 1 << 62, (n, 12))
    own[:, 0] = 5
    own[::7, 1] = 9 << 40
    batch = pa.RecordBatch.from_arrays([pa.array((np.arange(n) * 3) + (2 << 40)), pa.array(np.arange(n)), pa.array([f"line {i}" for i in range(n)])], ["place", "node", "normal"])
    keys = lambda normal: (own.ravel(), np.repeat(np.arange(n), 12))
    members = {}
    for most in (100, 10**6):
        found = {}
        for packed in _pack(parts, most, keys)(iter([batch])):
            for row in pa.Table.from_batches([packed]).to_pylist():
                out = _unpack([pa.scalar(row["part"])], pa.Table.from_pylist([row], packed.schema))
                for bucket, a, b in zip(*(out.column(c).to_pylist() for c in ("bucket", "a", "b"))):
                    found.setdefault(bucket, set()).update({b} if a is None else {a, b})
        members[most] = {k: v for k, v in found.items() if len(v) > 1}
    assert members[100] == members[10**6] and sorted(map(len, members[100].values())) == [-(-n // 7), n]
    assert max(members[100].values(), key=len) == set(((np.arange(n) * 3) + (2 << 40)).tolist())


def test_packing_goes_on_over_tasks_rows():
    batch = pa.RecordBatch.from_arrays([pa.array([(2 << 40) + 5, (2 << 40) + 9, 1 << 40, (1 << 40) + (1 << 25)]), pa.array([1, 2, 3, 4]), pa.array(["alpha beta", "gamma delta", "alpha beta gamma", "gamma delta"])], ["place", "node", "normal"])
    bases = [b for packed in _pack(3, 100)(iter([batch])) for b in packed.column(1).to_pylist()]
    assert set(bases) == {(2 << 40) + 5, 1 << 40, (1 << 40) + (1 << 25)} or set(bases) == {(2 << 40) + 5, 1 << 40}
