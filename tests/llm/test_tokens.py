"""Operators 2 and 8 against the tokenizers library on whole texts."""

import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tests.llm.conftest import documents, sample
from tidewell.llm.bpe import Automaton, coder, encode_decode, op8, tokenizer_spec
from tidewell.llm.common import utf8
from tidewell.llm.presplit import Presplit
from tidewell.llm.tokenfile import Block, compress, op2, pack, packed, read_tokens, unpacked, write_tokens

ODD = ["", None, " ", "'s", "it's ''s 'sound 'll'VE", "<|endoftext|> a <|startoftext|>x", "é é", "ΣΣ ΑΣ", "日本語 text", "ﬁ İ", "a b\u0085c\x1fd", "same", "same", "x" * 30000, "ab " * 20000, "\U0001f600 1١²"]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_str(tokenizer_spec())
    tok.no_truncation()
    tok.no_padding()
    return tok


def expected(tok, text):
    return tok.encode(text or "", add_special_tokens=False).ids


def test_code_points_split_as_in_the_library(library):
    rnd = random.Random(5)
    auto, split = coder(tokenizer_spec())
    points = [c for c in [*range(1, 0x3400), *range(0xA000, 0xAC10), *range(0xF900, 0x10100), *range(0x1D100, 0x1D800, 3), *range(0x1F300, 0x1F700)] if not 0xD800 <= c < 0xE000]
    texts = ["".join(chr(rnd.choice(points)) for _ in range(60)) for _ in range(600)]
    texts += ["".join(rnd.choice("''strevmdlA 1.’“é\u0301ñ") for _ in range(30)) for _ in range(300)] + ["a" + chr(c) + "b" for c in points[::5]]
    texts += ["각각", "क़ि क़", "Å Å Ω", "ǅ ŉ ẞ ΐ", "ﬀ ΑΣ Σ", "it’s “quoted” — dash… Привет Мир ΕΛΛΑΔΑ 日本語"]
    for t in texts:
        pieces = [w for w, _ in library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(t))]
        raw, at = utf8(pa.array([t]))
        numbers, counts = split.pieces(raw, at)
        assert counts[0] == len(pieces), repr(t)
        assert split.ids.gather(numbers)[0].tolist() == expected(library, t), repr(t)


def test_odd_texts_among_plain_ones(library):
    split = coder(tokenizer_spec())[1]
    texts = ["plain one", "e\u0301 odd", "", "İ", "plain two’s", "x\u0301"]
    raw, at = utf8(pa.array(texts))
    numbers, counts = split.pieces(raw, at)
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert split.ids.gather(numbers[a:b])[0].tolist() == expected(library, t), repr(t)


def test_special_tokens_and_their_beginnings_stay_on_the_arrays(library, monkeypatch):
    def never(*_):
        raise AssertionError("the slow steps")

    monkeypatch.setattr(Presplit, "other", never)
    split = coder(tokenizer_spec())[1]
    rnd = random.Random(6)
    bits = ["<|endoftext|>", "<|startoftext|>", "<|endoftext|", "<|", "|>", "<|ENDOFTEXT|>", "<|x|>", "'", "s", "e", "\u0301", " ", "\n", "9", "word", "é", "日"]
    texts = ["", "<|endoftext|>", "", "<|endoftext|><|endoftext|>", "<|endof", "text|>", "|> <|"] + ["".join(rnd.choices(bits, k=rnd.randrange(12))) for _ in range(3000)]
    raw, at = utf8(pa.array(texts))
    numbers, counts = split.pieces(raw, at)
    ends = np.cumsum(counts)
    for t, a, b in zip(texts, ends - counts, ends):
        assert split.ids.gather(numbers[a:b])[0].tolist() == expected(library, t), repr(t)
        assert [x for n in numbers[a:b].tolist() for x in split.noted[n][0].split()] == list(map(str, expected(library, t)))
    split.reset()
    assert [split.ids.gather(split.pieces(*utf8(pa.array([t])))[0])[0].tolist() for t in texts[:9]] == [expected(library, t) for t in texts[:9]]


def test_long_pieces_encode_as_in_the_library(library):
    auto = coder(tokenizer_spec())[0]
    rnd = random.Random(8)
    for t in ("x" * 3000, "".join(rnd.choice("etaoinshrdlu") for _ in range(5000)), "!?" * 900, "日本語" * 500):
        assert auto.encode([t, "short"])[0].tolist() == expected(library, t) + expected(library, "short")


def test_op8_equals_the_library(spark, tables, library):
    given = documents(spark, ODD).unionByName(sample(spark))
    got = {}
    for r in op8(spark, tables(documents=given)).collect():
        got.setdefault(r.doc_id, []).append((r.n_tokens, r.ids_sha256, r.decoded_sha256))
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = {}
    for r in given.collect():
        ids = expected(library, r.text)
        want.setdefault(r.doc_id, []).append((len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert {k: sorted(v) for k, v in got.items()} == {k: sorted(v) for k, v in want.items()}


def test_op8_texts_extra_columns_and_empty(spark):
    given = documents(spark, ["a b", None]).selectExpr("*", "1 as ids", "2 as n_tokens", "3 as decoded")
    rows = {r.doc_id: r for r in encode_decode(given, digests=False).collect()}
    assert rows[1].ids == [] and rows[1].decoded == "" and rows[0].decoded.split() == ["a</w>", "b</w>"]
    assert encode_decode(given.limit(0)).count() == 0


def test_gadgets_forbid_what_merges_would_join():
    auto = coder(tokenizer_spec())[0]
    assert isinstance(auto, Automaton)
    by_label = {t: i for i, t in enumerate(auto.labels)}
    start = np.array([len(auto.alive)])
    assert auto.follows(start, np.array([by_label["the</w>"]]))[0]
    assert not auto.follows(np.array([by_label["t"]]), np.array([by_label["h"]]))[0]


def test_blocks_round_trip_and_random_access():
    rng = np.random.default_rng(1)
    for size in (1, 2, 50, 40000):
        ids = (rng.zipf(1.4, size) % 300).astype(np.int32)
        cuts = np.unique(np.concatenate([rng.integers(1, size + 1, max(1, size // 40)), [size]]))
        counts = np.diff(np.concatenate([[0], cuts]))
        block = Block(pack(ids, counts))
        assert (block.ids() == ids).all()
        for i in range(len(counts)):
            assert (block.document(i) == ids[cuts[i] - counts[i] : cuts[i]]).all()
        for _ in range(50):
            a, b = sorted(rng.integers(0, size + 1, 2))
            assert (block.range(a, b) == ids[a:b]).all()


def test_op2_reads_back_what_the_library_gives(spark, tables, library):
    given = documents(spark, ODD).withColumn("doc_id", 1000 + (documents(spark, []).limit(0).count()) + __import__("pyspark.sql.functions", fromlist=["col"]).col("doc_id") * 3).unionByName(sample(spark))
    rows = sorted(given.collect(), key=lambda r: r.doc_id)
    want, start = [], 0
    for r in rows:
        ids = [*expected(library, r.text), 2]
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got = [tuple(r) for r in op2(spark, tables(documents=given)).orderBy("doc_id").collect()]
    assert got == want


def test_op2_ids_empty_and_repeated_rows(spark, tmp_path):
    given = documents(spark, [(5, "b"), (5, "b"), (None, "a"), (2, None)])
    write_tokens(given, f"{tmp_path}/t")
    got = sorted([(r.start, r.doc_id, r.n_tokens, r.ids[-1]) for r in read_tokens(spark, f"{tmp_path}/t", ids=True).collect()])
    assert got == [(0, None, 2, 2), (2, 2, 1, 2), (3, 5, 2, 2), (5, 5, 2, 2)]
    write_tokens(given.limit(0), f"{tmp_path}/e")
    assert read_tokens(spark, f"{tmp_path}/e").count() == 0


def test_no_pair_repeats_and_all_rules_are_used():
    rng = np.random.default_rng(0)
    for trial in range(150):
        n = int(rng.integers(1, 500))
        ids = rng.integers(0, rng.integers(1, 12), n).astype(np.int32) * (trial % 5 > 0)
        ends = np.zeros(n, bool)
        ends[np.append(rng.integers(0, n, 3), n - 1)] = True
        base, rules, lengths, symbols, last = compress(ids, ends)
        seen, places = {}, {}
        for i, (a, b) in enumerate(zip(symbols.tolist(), symbols[1:].tolist())):
            if not last[i] and places.get((a, b), -2) < i - 1:
                seen[a, b], places[a, b] = seen.get((a, b), 0) + 1, i
        assert max(seen.values(), default=0) <= 1
        used = np.bincount(np.concatenate([symbols, rules.ravel()]).astype(int), minlength=base + len(rules))[base:]
        assert (used > 0).all()
        assert lengths.tolist() == [len(expand(base + i, base, rules)) for i in range(len(rules))]


def expand(symbol, base, rules):
    return [symbol] if symbol < base else [x for part in rules[symbol - base] for x in expand(int(part), base, rules)]


def test_packed_numbers_are_read_from_any_place():
    rng = np.random.default_rng(3)
    for bits in (1, 5, 8, 17, 31):
        values = rng.integers(0, 1 << bits, 300)
        data = b"xyz" + packed(values, bits)
        for _ in range(30):
            a, b = sorted(rng.integers(0, 301, 2).tolist())
            assert (unpacked(data, 3, bits, a, b) == values[a:b]).all()


def test_several_blocks_in_a_shard(spark, tmp_path, library):
    texts = [(i, f"text {i} " * (i % 9)) for i in range(5000)]
    given = documents(spark, texts).selectExpr("*", "1 as shard", "2 as block", "3 as begin", "4 as payload")
    write_tokens(given, f"{tmp_path}/t", block_ids=40)
    assert spark.read.parquet(f"{tmp_path}/t").groupBy("shard").count().agg({"count": "max"}).first()[0] >= 2
    start = 0
    for r in read_tokens(spark, f"{tmp_path}/t", ids=True).orderBy("doc_id").collect():
        ids = [*expected(library, texts[r.doc_id][1]), 2]
        assert (r.start, r.n_tokens, list(r.ids)) == (start, len(ids), ids)
        start += len(ids)
