"""Operator 12: ids by the tokenizers library, valid packings, and counts of sequences against bounds and exact search."""

import random
import zlib
from collections import Counter, defaultdict
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import DATA, documents
from tidewell.llm.bytesplit import ByteLevel
from tidewell.llm.packing import CAPACITY, assemble, best_fit, dominating, least_sequences, op12, pack_documents, plan, placed, reduced

SPEC = open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8").read()


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_str(SPEC)


OWN = ByteLevel(SPEC)


def encoded(texts):
    raw = [t.encode() for t in texts]
    at = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, counts = OWN.encode(np.frombuffer(b"".join(raw), np.uint8), at)
    ends = np.cumsum(counts)
    return [ids[e - n : e].tolist() for e, n in zip(ends.tolist(), counts.tolist())]


def test_ids_are_the_library_s(library):
    rnd = random.Random(12)
    bits = ["'s", "'t", "'re", "'ve", "'m", "'ll", "'d", "'", "''", " ", "  ", "\n", "\t", "\r\n", " ", "　", "\u0085", "​", "a", "Z", "é", "ß", "中文", "привет", "́", "😀", "9", "²", "½", "٣", "!", "...", "<|", "|>", "endoftext", "<|endoftext|>", "<|endoftext|", "re", "ll", "s", "\x00", "�", "𝒳"]
    texts = ["", " ", "'s", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "x<|endoftext", "|>y", "it's we'll they've 'twas ''s 'sabc 'llx \n's", "a" * 5000, " " * 3000 + "x", "x" + "\n" * 500]
    texts += ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(4000)]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert encoded(texts) == want
    assert encoded(["<|endof", "text|>"]) == [e.ids for e in library.encode_batch(["<|endof", "text|>"], add_special_tokens=False)]
    assert [encoded([t])[0] for t in texts[:300]] == want[:300]


def test_other_tokenizers_are_left_to_the_library():
    other = Tokenizer.from_str(SPEC)
    from tokenizers import normalizers

    other.normalizer = normalizers.Lowercase()
    raw = "Some TEXT".encode()
    ids, counts = ByteLevel(other.to_str()).encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    assert ids.tolist() == other.encode("Some TEXT", add_special_tokens=False).ids and counts.tolist() == [len(ids)]


def counted(sizes, capacity):
    return np.bincount(np.array(sizes, np.int64), minlength=capacity + 1)


def fewest(sizes, capacity):
    """By exact search."""

    @lru_cache(None)
    def search(rest):
        if not rest:
            return 0
        best = len(rest)

        def fill(room, chosen, at):
            nonlocal best
            left = list(rest[1:])
            for x in chosen:
                left.remove(x)
            best = min(best, 1 + search(tuple(left)))
            for i in range(at, len(rest)):
                if rest[i] <= room:
                    fill(room - rest[i], [*chosen, rest[i]], i + 1)

        fill(capacity - rest[0], [], 1)
        return best

    return search(tuple(sorted(sizes, reverse=True)))


def sequences(patterns):
    return sum(times for _, times in patterns)


def test_reduction_keeps_an_optimum():
    rnd = random.Random(1)
    hits = 0
    for _ in range(400):
        capacity = rnd.randint(5, 30)
        sizes = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 8))]
        fixed, left = reduced(counted(sizes, capacity), capacity)
        rest = np.repeat(np.arange(capacity + 1), left).tolist()
        used = Counter()
        for pattern, times in fixed:
            assert sum(length * n for length, n in pattern) <= capacity and sum(n for _, n in pattern) <= 3
            for length, n in pattern:
                used[length] += n * times
        assert used + Counter(rest) == Counter(sizes)
        assert sequences(fixed) + fewest(rest, capacity) == fewest(sizes, capacity)
        hits += len(rest) < len(sizes)
        assert least_sequences(counted(sizes, capacity), capacity) <= fewest(sizes, capacity)
    assert hits > 300


def test_each_proof():
    left = lambda *sizes: counted(sizes, 100)
    assert dominating(left(90, 20), 90, 100) == [90]
    assert dominating(left(60, 40, 39, 1), 60, 100) == [60, 40]
    assert dominating(left(60, 35, 21, 20), 60, 100) == [60, 35]
    assert dominating(left(60, 35, 16, 15, 15), 60, 100) == [60, 35]
    assert dominating(left(60, 30, 10, 9, 25), 60, 100) == [60, 30, 10]
    assert dominating(left(60, 22, 20, 19, 16), 60, 100) is None
    assert dominating(left(50, 50, 7), 50, 100) == [50, 50]


def sequential_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [r for r in rooms if r >= s]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - s)
        else:
            rooms.append(capacity - s)
    return sorted(rooms)


def test_best_fit_of_counts_is_best_fit_piece_by_piece():
    rnd = random.Random(2)
    for _ in range(300):
        capacity = rnd.randint(4, 60)
        few = [rnd.randint(1, capacity) for _ in range(rnd.randint(1, 6))]
        sizes = [rnd.choice(few) for _ in range(rnd.randint(1, 80))]
        patterns = best_fit(counted(sizes, capacity), capacity)
        rooms = sorted(capacity - sum(length * n for length, n in p) for p, times in patterns for _ in range(times))
        assert rooms == sequential_best_fit(sizes, capacity)


def test_plan_places_every_piece_once():
    rnd = random.Random(3)
    for n in (0, 1, 50, 3000):
        capacity = 40
        sizes = np.array([rnd.choice([rnd.randint(1, capacity), 7, 13]) for _ in range(n)], np.int64)
        runs = plan(counted(sizes, capacity), capacity)
        rank, had = [], Counter()
        for s in sizes.tolist():
            rank.append(had[s])
            had[s] += 1
        sequence, offset = placed(runs, sizes, np.array(rank, np.int64))
        check_packing(zip(sequence.tolist(), offset.tolist(), sizes.tolist()), capacity)


def check_packing(rows, capacity):
    own = defaultdict(list)
    for sequence, offset, length in rows:
        own[sequence].append((offset, length))
    for held in own.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(own)


def expected(library, doc_id, text):
    ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
    n = -(-len(ids) // CAPACITY)
    edges = [0, *[len(ids) - CAPACITY * k for k in range(n - 1, -1, -1)]]
    return [(doc_id, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for k, (a, b) in enumerate(zip(edges, edges[1:]))]


def test_op12_on_the_smallest_tables(spark, library):
    given = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet").collect()
    got = op12(spark, f"{DATA}/sf0.001").collect()
    want = sorted(x for r in given for x in expected(library, r.doc_id, r.text))
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    n = check_packing([(r.sequence_id, r.offset, r.length) for r in got], CAPACITY)
    assert n <= 1 + least_sequences(counted([r.length for r in got], CAPACITY), CAPACITY)


def test_edge_cases_and_sequences_of_ids(spark, library):
    texts = [(1, None), (2, ""), (3, "x " * 2047), (4, "x " * 2048), (5, "word " * 40_000), (6, "a<|endoftext|>b"), (7, "same"), (7, "same"), (None, "no id"), (None, None)] + [(100 + i, "copy of a short text") for i in range(300)]
    docs = documents(spark, texts).repartition(5).selectExpr("*", "doc_id as part", "doc_id as length", "text as ids", "doc_id as rank")
    packed = pack_documents(docs, ids=True)
    rows = packed.collect()
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows), key=key) == sorted((x for i, t in texts for x in expected(library, i, t)), key=key)
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in rows)
    n = check_packing([(r.sequence_id, r.offset, r.length) for r in rows], CAPACITY)
    whole = assemble(packed).collect()
    assert len(whole) == n and sum(r.n_ids for r in whole) == sum(r.length for r in rows) and max(r.n_ids for r in whole) <= CAPACITY
    by = {r.sequence_id: r.ids for r in whole}
    assert all(by[r.sequence_id][r.offset : r.offset + r.length] == r.ids for r in rows)
    assert pack_documents(docs.limit(0)).count() == 0


def test_ranks_go_on_over_tasks_without_a_broadcast(spark, monkeypatch):
    from tidewell.llm import packing

    docs = documents(spark, ["the same text", "another one of them"] * 200).repartition(7)
    counts = []
    for rows in (10**6, 0):
        monkeypatch.setattr(packing, "BROADCAST_ROWS", rows)
        got = pack_documents(docs, capacity=16).collect()
        counts.append(check_packing([(r.sequence_id, r.offset, r.length) for r in got], 16))
        assert len(got) == 400
    assert counts[0] == counts[1]
