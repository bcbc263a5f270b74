"""Buckets of unlike lengths are cut before they are compared, and no alike pair is lost by it."""

import random

import numpy as np
import pyarrow as pa

from tests.llm.test_editdistance import levenshtein
from tidewell.llm import editdistance
from tidewell.llm.linededup import STEP, _pack, _unpack, widest


def unpacked(texts):
    n = len(texts)
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(n)), pa.array(np.arange(n) * 7919), pa.array(texts)], ["place", "node", "normal"])
    keys = lambda normal: (np.full(n, 5), np.arange(n))
    out = []
    for packed in _pack(1, 10**6, keys)(iter([batch])):
        for row in pa.Table.from_batches([packed]).to_pylist():
            got = _unpack([pa.scalar(row["part"])], pa.Table.from_pylist([row], packed.schema))
            out += zip(*(got.column(c).to_pylist() for c in ("bucket", "a", "b")))
    return out


def test_lines_of_unlike_lengths_share_no_bucket():
    texts = ["x" * 100, "y" * 95, "z" * 300, "u" * 310, "v" * 2000]
    got = unpacked(texts)
    assert {(a, b) for _, a, b in got} == {(0, 1), (2, 3)} and len({k for k, _, _ in got}) == 2


def test_lengths_that_alike_lines_can_have_are_not_cut():
    step = widest(0.8)
    for longer in range(1, 3000):
        shorter = longer - int(0.2 * longer + 1e-9)
        assert int(np.log(longer) / STEP) - int(np.log(shorter) / STEP) <= step


def test_pairs_of_several_numbers_of_words_go_together():
    rnd = random.Random(5)
    a = ["".join(rnd.choice("abc ") for _ in range(rnd.choice([300, 350, 380, 280]))) for _ in range(60)]
    b = ["".join(rnd.choice("abc ") if rnd.random() < 0.2 else c for c in t) for t in a]
    distance = np.array([levenshtein(x, y) for x, y in zip(a, b)])
    for more in (-1, 0, 1):
        assert (editdistance.within(a, b, distance + more) == (more >= 0)).all()
