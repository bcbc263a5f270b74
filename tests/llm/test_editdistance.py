"""Edit distances against the textbook's table."""

import random

import numpy as np

from tidewell.llm import editdistance
from tidewell.llm.editdistance import similar, within


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for i, c in enumerate(a):
        new = [i + 1]
        for j, d in enumerate(b):
            new.append(min(row[j + 1] + 1, new[-1] + 1, row[j] + (c != d)))
        row = new
    return row[-1]


def made(rnd):
    words = [f"w{i}" for i in range(30)] + ["é漢", "x"]
    out = [("", ""), ("", "a"), ("same", "same"), ("a" * 64, "a" * 65), ("ab" * 40, "ba" * 40)]
    for k in range(900):
        n = rnd.choice([3, 12, 63, 64, 65, 100, 130])
        a = "".join(rnd.choice("abé漢") for _ in range(rnd.randint(0, n)))
        b = "".join(rnd.choice("abé漢") for _ in range(rnd.randint(0, n))) if k % 3 == 0 else "".join(c if rnd.random() < 0.85 else rnd.choice(["", "x", "ab"]) for c in a)
        out.append((a, b))
    for _ in range(300):  # words replaced, left out, put in, turned round
        a = [rnd.choice(words) for _ in range(rnd.randint(10, 30))]
        b = list(a)
        for _ in range(rnd.randint(0, 6)):
            z, c = rnd.randrange(len(b)), rnd.random()
            if c < 0.4:
                b[z] = rnd.choice(words)
            elif c < 0.6:
                b.insert(z, rnd.choice(words))
            elif c < 0.8 and len(b) > 3:
                del b[z]
            else:
                b[z : z + 3] = b[z : z + 3][::-1]
        out.append((" ".join(a), " ".join(b)))
    return [x for x, _ in out], [y for _, y in out]


def test_within_is_the_levenshtein_distance(monkeypatch):
    a, b = made(random.Random(1))
    distance = np.array([levenshtein(x, y) for x, y in zip(a, b)])
    for few in (24, 10**9):  # together, and one by one
        monkeypatch.setattr(editdistance, "FEW", few)
        for more in (-4, -1, 0, 1, 5):
            most = np.maximum(distance + more, 0)
            assert (within(a, b, most) == (distance <= most)).all()


def test_similarity_is_one_less_distance_by_length():
    a, b = made(random.Random(2))
    want = [levenshtein(x, y) <= 0.2 * max(len(x), len(y)) + 1e-9 for x, y in zip(a, b)]
    assert similar(a, b, 0.8).tolist() == want and 0 < sum(want) < len(want)


def test_long_texts():
    rnd = random.Random(3)
    a = "".join(rnd.choice("abcdefgh ") for _ in range(3000))
    b = a[:1000] + "x" * 300 + a[1300:]
    d = levenshtein(a[990:1310], b[990:1310])
    assert within([a, a], [b, b], np.array([d, d - 1])).tolist() == [True, False]
