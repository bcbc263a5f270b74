"""Encoding with a public byte-level tokenizer, each distinct piece of text once a process.

The pieces are those of the tokenizer's own pattern below, cut on arrays of code points, for which a table says what each
is; the table is filled by the tokenizers library as code points occur. Special tokens are cut out first, as the library
does. The ids of a piece come from the library and are kept under a 64-bit hash of the piece. A tokenizer that is put
together in another way is left to the library, text by text.

A null text counts as empty; empty texts have no ids. Texts may be of any length.
"""

from __future__ import annotations

import json
import os
import re

import numpy as np
from tokenizers import Tokenizer, pre_tokenizers

from .common import Flat, Seen, piece_hashes
from .presplit import _CODES, LETTER, NUMBER, OTHER, POINTS, SPACE, UNKNOWN, _code_points, _edges

#: Fixed value: the pattern that the library's byte-level step has.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pieces that a process remembers at most, about 100 MB; beyond that it starts anew, which changes no result.
REMEMBERED = 1_000_000
_ONE = np.frombuffer("stmd".encode("utf-32-le"), np.uint32)
_TWO = [ord(a) << 32 | ord(b) for a, b in ("re", "ve", "ll")]


def piece_starts(codes: np.ndarray, kind: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin; each goes on to the next one's start. ``edges`` has each text's start, and the end."""
    n = len(codes)
    edge = np.zeros(n + 3, bool)
    edge[edges] = edge[n:] = True
    start = edge[:n].copy()
    start[1:] |= kind[1:] != kind[:-1]
    # of white space before something else in its text, the last character stands alone, or, as a blank, with what follows
    before = np.flatnonzero((kind[:-1] == SPACE) & (kind[1:] != SPACE) & ~edge[1:n])
    start[before] = True
    start[before[codes[before] == 32] + 1] = False
    quote = np.flatnonzero((codes == 39) & start)
    quote = quote[~edge[quote + 1]]
    one = quote[np.isin(codes[quote + 1], _ONE)]
    two = quote[~edge[quote + 2]]
    two = two[np.isin(codes[two + 1].astype(np.int64) << 32 | codes[two + 2], _TWO)]
    for at, size in ((one, 2), (two, 3)):
        start[at + 1] = False
        rest = at + size
        rest = rest[~edge[rest]]
        start[rest] |= kind[rest] == LETTER
    return np.flatnonzero(start)


class ByteLevel:
    """Ids of texts, as the tokenizers library's encode gives them without added special tokens."""

    def __init__(self, spec: str):
        read = json.loads(spec)
        self.library, self.whole = Tokenizer.from_str(spec), Tokenizer.from_str(spec)
        for t in (self.library, self.whole):
            t.no_truncation()
            t.no_padding()
        self.whole.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        step, added = read.get("pre_tokenizer") or {}, read.get("added_tokens", [])
        self.known = step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space") and not read.get("normalizer") and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in added)
        self.special = {t["content"].encode(): t["id"] for t in added}
        self.cut = re.compile(b"|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.kind = np.full(POINTS, UNKNOWN, np.uint8)
        self.reset()

    def reset(self) -> None:
        self.seen, self.ids = Seen(), Flat(np.int32)

    def _learn(self, codes: np.ndarray) -> None:
        for c in np.unique(codes[self.kind[codes] == UNKNOWN]).tolist():
            pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(f"a{chr(c)}!")]
            if c == 32:
                self.kind[c] = SPACE
            elif pieces[0] != "a":
                self.kind[c] = LETTER
            elif len(pieces) == 2:
                self.kind[c] = OTHER
            else:
                self.kind[c] = NUMBER if len(self.library.pre_tokenizer.pre_tokenize_str(f"1{chr(c)}1")) == 1 else SPACE

    def _specials(self, raw: np.ndarray, at: np.ndarray) -> list[tuple[int, int, int]]:
        """(start, end, id) of the special tokens that stand inside one text."""
        found, data, place = [], raw.tobytes(), 0
        while self.cut and (m := self.cut.search(data, place)):
            inside = m.end() <= at[np.searchsorted(at, m.start(), "right")]
            if inside:
                found.append((m.start(), m.end(), self.special[m[0]]))
            place = m.end() if inside else m.start() + 1
        return found

    def _numbers(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if self.seen.n > REMEMBERED:
            self.reset()
        hashes = piece_hashes(codes, starts, ends, _CODES)
        found = self.seen.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unique, at = np.unique(hashes[new], return_index=True)
            pieces = [codes[starts[i] : ends[i]].tobytes().decode("utf-32-le") for i in new[at].tolist()]
            made = [e.ids for e in self.whole.encode_batch_fast(pieces, add_special_tokens=False)]
            self.ids.extend(np.array([x for e in made for x in e], np.int32), np.array([len(e) for e in made], np.int64))
            self.seen.add(unique)
            found[new] = self.seen.find(hashes[new])
        return found

    def encode(self, raw: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the texts end to end, how many each has), for texts of the bytes ``raw`` that begin at ``at``."""
        if not self.known:
            made = [np.array(self.library.encode(raw[a:b].tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids, np.int32) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            return np.concatenate([np.zeros(0, np.int32), *made]), np.array([len(x) for x in made], np.int64)
        special = self._specials(raw, at)
        cuts = np.unique(np.concatenate([at, np.array([x[:2] for x in special], np.int64).ravel()]))
        codes = _code_points(raw)
        if not len(codes):
            return np.zeros(0, np.int32), np.zeros(len(at) - 1, np.int64)
        self._learn(codes)
        places = _edges(raw, cuts)
        starts = piece_starts(codes, self.kind[codes], places)
        ids, lengths = self.ids.gather(self._numbers(codes, starts, np.append(starts[1:], len(codes))))
        first = np.concatenate([[0], np.cumsum(lengths)])
        text = places[np.searchsorted(cuts, at)]
        begin = first[np.searchsorted(starts, text)]
        if special:
            # a special token's own ids stand where its pieces' would
            spans = [first[np.searchsorted(starts, places[np.searchsorted(cuts, x[:2])])] for x in special]
            keep, gone = np.ones(len(ids), bool), np.zeros(len(ids) + 1, np.int64)
            for (a, b), (_, _, token) in zip(spans, special):
                ids[a], keep[a + 1 : b] = token, False
            gone[1:] = np.cumsum(~keep)
            ids, begin = ids[keep], begin - gone[begin]
        return ids, np.diff(begin)


_MADE: dict[int, ByteLevel] = {}


def encoder(spec: str) -> ByteLevel:
    """The encoder of a tokenizer file's text, made once in a process."""
    key = hash(spec)
    if key not in _MADE:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        _MADE[key] = ByteLevel(spec)
    return _MADE[key]
