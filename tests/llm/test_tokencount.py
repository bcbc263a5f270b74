"""Operator 7 against the tokenizers library's Unigram model."""

import random

import pyarrow as pa
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from tests.llm.conftest import documents, sample
from tidewell.llm.common import utf8
from tidewell.llm.tokencount import Counter, count_tokens, op7, vocabulary

ODD = ["", None, " ", "  ", "a", " a", "a ", "  a  b ", "▁a", "x▁▁y ", "hello\nworld", "日本x", "<0x0A>", "<unk> a<unk>b<unk>丂", "丂七", "same a", "same a", "word " * 20000, "x" * 20000]


@pytest.fixture(scope="module")
def library():
    pieces, unknown = vocabulary()
    tok = Tokenizer(models.Unigram(pieces, unk_id=unknown, byte_fallback=True))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return tok


def test_counts_of_random_texts(library):
    counter, rnd = Counter(*vocabulary()), random.Random(3)
    pool = [*"abcdetinors  ", "▁", "the", "丂", "七", "<unk>", "\n", "\t", "é", "\U0001f600", "<0x41>"]
    texts = ["".join(rnd.choice(pool) for _ in range(rnd.randint(0, 25))) for _ in range(3000)]
    raw, at = utf8(pa.array([t.replace("▁", " ") for t in texts]))
    got, _ = counter.totals(raw, at)
    assert got.tolist() == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_tied_scores_keep_the_longest_last_piece():
    pieces = [("<unk>", 0.0), *((f"<0x{b:02X}>", -9.0) for b in range(256)), ("▁", -1.0), ("a", -1.0), ("aa", -2.0), ("aaa", -3.0), ("b", -1.0), ("ab", -2.0)]
    tok = Tokenizer(models.Unigram(pieces, unk_id=0, byte_fallback=True))
    counter = Counter(pieces, 0)
    for word in ("aaaaa", "abab", "aab", "baaaab", "cab", "accaa"):
        assert counter.count("▁" + word) == len(tok.encode("▁" + word).ids), word


def test_op7_equals_the_library(spark, tables, library):
    given = documents(spark, ODD).selectExpr("doc_id + 10000 as doc_id", "text", "1 as n_words", "2 as counts").unionByName(sample(spark), allowMissingColumns=True)
    want = sorted((r.doc_id, len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in given.collect())
    assert sorted((r.doc_id, r.n_tokens) for r in op7(spark, tables(documents=given)).collect()) == want
    assert count_tokens(given.limit(0)).count() == 0
