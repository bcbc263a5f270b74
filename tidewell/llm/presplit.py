"""Splitting texts into the pieces that a word tokenizer's merges stay within, many texts at a time.

The pieces are those of the public word tokenizer's own normaliser and pre-tokenizer: NFC, white space to a space, lower
case, then the pattern below. Texts are split on arrays of code points, for which a table says what each is. The table
is filled by the tokenizers library, one code point at a time as they occur. In most texts each code point is normalised
by itself, by the same table; a text with one that is not (a combining mark, one that becomes several) goes through the
library's normaliser first. Special tokens are cut out of texts first and are pieces of their own. The result is that
of the library. A tokenizer file with other rules goes through the library's own steps. Pieces are told apart by 64-bit hashes.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Callable

import numpy as np
from tokenizers import Tokenizer

from .common import Flat, Seen, piece_hashes, seeded

#: Fixed value: the pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: All code points.
POINTS = 0x110000
#: Pieces that a process remembers at most; beyond that it starts anew, which changes no result.
REMEMBERED = 1_500_000

SPACE, LETTER, NUMBER, OTHER, UNKNOWN = range(5)
_CODES = seeded(POINTS, 23)


class Points:
    """What each code point is, its normal form, and whether it is normalised by itself in any text."""

    def __init__(self, library: Tokenizer):
        self.library = library
        self.kind = np.full(POINTS, UNKNOWN, np.uint8)
        self.lower = np.arange(POINTS, dtype=np.uint32)
        self.alone = np.zeros(POINTS, bool)
        self.joins: set[int] | None = None

    def learn(self, codes: np.ndarray) -> None:
        """Fills the table for code points that it lacks."""
        new = codes[self.kind[codes] == UNKNOWN]
        if len(new):
            if self.joins is None:
                self.joins = _joining()
            for c in np.unique(new).tolist():
                self._learn(c)

    def _learn(self, c: int) -> None:
        # between a letter and a sign, a letter clings to the one, a sign to the other, white space is dropped
        pieces = [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(f"a{chr(c)}!")]
        if len(pieces) == 3:
            self.kind[c] = NUMBER
        elif pieces[0] != "a":
            self.kind[c] = LETTER
        else:
            self.kind[c] = SPACE if pieces[1] == "!" else OTHER
        normal = self.library.normalizer.normalize_str(chr(c))
        if len(normal) == 1 and c not in self.joins and not unicodedata.combining(chr(c)):
            self.alone[c], self.lower[c] = True, ord(normal)
            if ord(normal) != c:
                self._learn(ord(normal))


def _joining() -> set[int]:
    """Code points that a composition joins to the one before: seconds of canonical pairs, and the vowels and finals of Hangul."""
    out = {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}
    for c in range(POINTS):
        parts = unicodedata.decomposition(chr(c)).split()
        if len(parts) == 2 and parts[0][0] != "<":
            out.add(int(parts[1], 16))
    return out


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    moved = iter(range(256, 512))
    return [chr(b) if b in kept else chr(next(moved)) for b in range(256)]


def _code_points(raw: np.ndarray) -> np.ndarray:
    return np.frombuffer(raw.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)


def _edges(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where each text begins, in code points."""
    chars = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=chars[1:])
    return chars[offsets]


def split_plain(raw: np.ndarray, offsets: np.ndarray, points: Points) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised code points, start and end of each piece among them, and the number of pieces of each text."""
    codes = _code_points(raw)
    points.learn(codes)
    edges = _edges(raw, offsets)
    odd = np.flatnonzero(~points.alone[codes])
    if len(odd):
        parts = np.split(codes, edges[1:-1])
        for r in np.unique(np.searchsorted(edges, odd, "right") - 1).tolist():
            normal = points.library.normalizer.normalize_str(raw[offsets[r] : offsets[r + 1]].tobytes().decode("utf-8", "replace"))
            parts[r] = np.frombuffer(normal.encode("utf-32-le"), np.uint32)
        edges = np.concatenate([[0], np.cumsum([len(p) for p in parts])])
        codes = np.concatenate(parts)
        points.learn(codes)
    codes = points.lower[codes]
    n = len(codes)
    if not n:
        none = np.zeros(0, np.int64)
        return codes, none, none, np.zeros(len(offsets) - 1, np.int64)
    kind = points.kind[codes]
    edge = np.zeros(n + 1, bool)
    edge[edges] = True
    edge[n] = True
    start = np.ones(n + 1, bool)
    start[1:n] = kind[1:] != kind[:-1]
    start[:n] |= (kind == NUMBER) | edge[:n]
    start[:n] &= kind != SPACE
    # a piece begins anew after a contraction, and one that is an apostrophe alone takes the letters in
    quote = np.flatnonzero((codes == 39) & start[:n])
    quote = quote[(quote + 1 < n)]
    quote = quote[~edge[quote + 1]]
    one = quote[np.isin(codes[quote + 1], np.frombuffer("stmd".encode("utf-32-le"), np.uint32))]
    two = quote[quote + 2 < n]
    two = two[~edge[two + 2]]
    pair = codes[two + 1].astype(np.int64) * 65536 + codes[two + 2]
    two = two[np.isin(pair, [ord(a) * 65536 + ord(b) for a, b in ("re", "ve", "ll")])]
    for at, size in ((one, 2), (two, 3)):
        start[at + 1] = False
        rest = at + size
        rest = rest[rest < n]
        start[rest] |= (kind[rest] == LETTER) & ~edge[rest]
    starts = np.flatnonzero(start[:n])
    stop = start.copy()
    stop[:n] |= (kind == SPACE) | edge[:n]
    stops = np.flatnonzero(stop)
    ends = stops[np.searchsorted(stops, starts, "right")]
    return codes, starts, ends, np.diff(np.searchsorted(starts, edges))


class Presplit:
    """Numbers the distinct pieces of texts and keeps, for each, what ``encode`` makes of it.

    ``encode`` takes a list of distinct pieces and returns (ids end to end, number of ids of each).
    """

    def __init__(self, spec: str, encode: Callable, notes: Callable | None = None):
        self.spec, self.encode, self.notes = spec, encode, notes
        self.library = Tokenizer.from_str(spec)
        self.points = Points(self.library)
        read = json.loads(spec)
        own = read.get("pre_tokenizer") or {}
        first = (own.get("pretokenizers") or [{}])[0]
        self.known = first.get("pattern", {}).get("Regex") == PATTERN and read["model"].get("end_of_word_suffix") == "</w>"
        added = read.get("added_tokens", [])
        self.special = {t["content"]: t["id"] for t in added}
        # cut out as they stand: none that swallows spaces, wants word edges or is looked for in normalised text
        self.known &= not any(t.get("lstrip") or t.get("rstrip") or t.get("single_word") or t.get("normalized") for t in added)
        self.cut = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None
        names = sorted(self.special, key=len, reverse=True)
        self.marks = {t.encode(): h for t, h in zip(names, seeded(len(names), 97))}
        self.find_marks = re.compile(b"|".join(map(re.escape, self.marks))) if names else None
        letters = byte_letters()
        self.to_byte = {c: b for b, c in enumerate(letters)}
        self.reset()

    def reset(self) -> None:
        self.seen, self.ids = Seen(), Flat(np.int32)
        self.noted: list = []
        if self.marks:
            names = [t.decode() for t in self.marks]
            self.seen.add(np.array(list(self.marks.values()), np.uint64))
            self.ids.extend(np.array([self.special[t] for t in names], np.int32), np.ones(len(names), np.int64))
            if self.notes:
                self.noted.extend((str(self.special[t]), t) for t in names)

    def number(self, hashes: np.ndarray, piece: Callable[[int], str]) -> np.ndarray:
        """Numbers of the pieces; piece(i) is the text of the i-th."""
        if self.seen.n > REMEMBERED:
            self.reset()
        found = self.seen.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unique, at = np.unique(hashes[new], return_index=True)
            pieces = [piece(i) for i in new[at].tolist()]
            ids, counts = self.encode(pieces)
            if self.notes:
                self.noted.extend(self.notes(ids, counts))
            self.ids.extend(ids, counts)
            self.seen.add(unique)
            found[new] = self.seen.find(hashes[new])
        return found

    def _cut(self, raw: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int, np.uint64]]:
        """Start, end and hash of the special tokens in the texts; none reaches over a text's end."""
        if self.find_marks is None:
            return []
        data = raw.tobytes()
        if not self.find_marks.search(data):
            return []
        edges, out = offsets.tolist(), []
        for a, b in zip(edges, edges[1:]):
            out += [(m.start(), m.end(), self.marks[m.group()]) for m in self.find_marks.finditer(data, a, b)]
        return out

    def pieces(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pieces of texts, and how many each text has."""
        found = self._cut(raw, offsets)
        edges = offsets
        if found:
            # texts fall into parts at the tokens, each a part of its own that is blank
            begins, ends = (np.array([f[i] for f in found], np.int64) for i in (0, 1))
            raw = raw.copy()
            for a, b, _ in found:
                raw[a:b] = 32
            edges = np.unique(np.concatenate([offsets, begins, ends]))
        codes, starts, ends_of, counts = split_plain(raw, edges, self.points)
        hashes = piece_hashes(codes, starts, ends_of, _CODES)
        if not found:
            return self.number(hashes, lambda i: codes[starts[i] : ends_of[i]].tobytes().decode("utf-32-le")), counts
        part = np.searchsorted(edges, begins)
        places = np.concatenate([[0], np.cumsum(counts)])[part]
        hashes = np.insert(hashes, places, np.array([f[2] for f in found], np.uint64))
        own = np.insert(np.arange(len(starts)), places, -1)  # tokens are known, so their text is never asked for
        counts[part] += 1
        total = np.concatenate([[0], np.cumsum(counts)])
        return self.number(hashes, lambda i: codes[starts[own[i]] : ends_of[own[i]]].tobytes().decode("utf-32-le")), np.diff(total[np.searchsorted(edges, offsets)])

    def other(self, text: str) -> list[str | int]:
        """Pieces of any text by the library's own steps; a special token is its id."""
        out: list[str | int] = []
        for part in self.cut.split(text) if self.cut else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                for letters, _ in self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(part)):
                    out.append(bytes(self.to_byte[c] for c in letters).decode("utf-8", "surrogateescape"))
        return out
