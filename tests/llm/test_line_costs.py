"""What comparing and dealing lines of operator 6 costs, and that the bands which are kept of distance tables are wide enough."""

import random
import time

import numpy as np
import pyarrow as pa

from tests.llm.test_editdistance import levenshtein
from tidewell.llm import editdistance
from tidewell.llm.linededup import _pack, _unpack

SYLLABLES = ["er", "th", "and", "on", "tion", "ly", "ha", "st", "ea", "ti", "in", "the", "wh", "ble", "ou", "re"]


def prose(rnd, size):
    """Words of few syllables, so that unlike lines share most of their runs of letters."""
    out = ""
    while len(out) < size:
        out += "".join(rnd.choice(SYLLABLES) for _ in range(rnd.randint(1, 4))) + " "
    return out[:size]


def test_bands_hold_every_way_within_the_limit(monkeypatch):
    rnd = random.Random(11)
    pairs = [("a" * 90, "a" * 70), ("ab" * 60, "ba" * 60), ("x" + "ab" * 70, "ab" * 70 + "x"), ("é漢" * 40, "漢é" * 41)]
    for size in (30, 64, 130, 330, 420):
        for _ in range(30):
            a = prose(rnd, size)
            b = list(a)
            for _ in range(rnd.randint(0, size // 3)):
                z = rnd.randrange(len(b))
                b[z : z + rnd.randint(0, 2)] = rnd.choice(["", "x", "th", b[z]])
            pairs.append((a, "".join(b)) if rnd.random() < 0.5 else ("".join(b), a))
        # what is left out at one end is put in at the other, so the way leaves the middle as far as it can
        a = prose(rnd, size)
        for k in (1, size // 11, size // 7):
            pairs += [(a, a[k:] + prose(rnd, k)), (a, prose(rnd, k) + a[:-k]), (a, a[k:])]
    a, b = map(list, zip(*pairs))
    distance = np.array([levenshtein(x, y) for x, y in pairs])
    for few in (0, 24, 10**9):
        monkeypatch.setattr(editdistance, "FEW", few)
        for more in (-1, 0, 1, 40):
            most = np.maximum(distance + more, 0)
            assert (editdistance.within(a, b, most) == (distance <= most)).all()


def test_unlike_lines_of_the_same_syllables_take_little():
    rnd = random.Random(12)
    lines = [prose(rnd, rnd.randint(520, 580)) for _ in range(400)]
    x, y = zip(*(rnd.sample(range(400), 2) for _ in range(20_000)))
    began = time.process_time()
    assert not editdistance.similar([lines[i] for i in x], [lines[i] for i in y], 0.8).any()
    assert time.process_time() - began < 2


def test_a_bucket_key_takes_less_than_ten_bytes():
    rng, n, keys = np.random.default_rng(5), 1 << 13, 60
    own = rng.integers(-(1 << 63), 1 << 63, n * keys)
    own[:keys] = own[-keys:]  # the first line and the last one meet in all their buckets
    lines = [f"line {i} " + "x" * int(k) for i, k in enumerate(rng.integers(20, 600, n))]
    lines[-1] = lines[0][:-1]
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n) + (3 << 40)), pa.array(rng.integers(-(1 << 63), 1 << 63, n)), pa.array(lines)], ["place", "node", "normal"])
    packed = list(_pack(50, 10**6, lambda normal: (own, np.repeat(np.arange(n), keys)))(iter([batch])))
    assert sum(p.nbytes for p in packed) < 10 * n * keys
    found = []
    for row in pa.Table.from_batches(packed).to_pylist():
        out = _unpack([pa.scalar(row["part"])], pa.Table.from_pylist([row], packed[0].schema))
        found += zip(out.column("a").to_pylist(), out.column("b").to_pylist())
    assert found == [(3 << 40, (3 << 40) + n - 1)] * keys
