"""Long pieces of two letters that sums of powers modulo 2**64 cannot tell apart."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.llm.conftest import documents
from tidewell.llm.packing import pack_documents
from tidewell.llm.queries import QUERIES


def thue_morse(n, letters):
    return "".join(letters[i.bit_count() & 1] for i in range(n))


TEXTS = [thue_morse(n, letters) for n in (1024, 2048, 16384) for letters in ("ab", "ba", "!?", "?!")] + [None, "ab"]


def library(name):
    made = Tokenizer.from_file(public_tokenizers.path(name))
    made.no_truncation()
    made.no_padding()
    return [made.encode(t or "", add_special_tokens=False).ids for t in TEXTS]


def test_packing_tells_thue_morse_words_apart(spark):
    want = set()
    for i, ids in enumerate(library("byte_bpe_50k.json")):
        ids = [*ids, 0]
        edges = [0, *range(len(ids) - (len(ids) - 1) // 2048 * 2048, len(ids) + 1, 2048)]
        want |= {(i, p, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())) for p, (a, b) in enumerate(zip(edges, edges[1:]))}
    got = [tuple(r)[:5] for r in pack_documents(documents(spark, TEXTS).coalesce(1)).collect()]
    assert len(got) == len(want) and set(got) == want


def test_word_ids_tell_thue_morse_words_apart(spark, tables):
    folder = tables(documents=documents(spark, TEXTS).coalesce(1))
    want = [len(ids) for ids in library("word_bpe_49k.json")]
    assert [r.n_tokens for r in QUERIES["op8_bpe"](spark, folder).orderBy("doc_id").collect()] == want
    crc = [r.ids_crc32 for r in QUERIES["op2_token_file"](spark, folder).orderBy("doc_id").collect()]
    assert crc == [zlib.crc32(np.array([*ids, 2], "<u4").tobytes()) for ids in library("word_bpe_49k.json")]


def test_long_pieces_are_told_apart_wherever_they_stand():
    from tidewell.llm.common import piece_hashes

    codes = np.frombuffer("".join(TEXTS[:2] * 2).encode(), np.uint8)
    at = np.arange(0, 4097, 1024)
    a, b, c, d = piece_hashes(codes, at[:-1], at[1:]).tolist()
    assert a == c and b == d and a != b
