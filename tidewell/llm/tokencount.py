"""Operator 7, token counts by a Viterbi pass that keeps counts only.

The vocabulary is that of a public sentencepiece model, its scores read as unigram scores, with bytes for
what it lacks. Texts are split before each space (written U+2581 in the vocabulary, and put before a text that does
not begin with one). In each distinct word an Aho-Corasick automaton enumerates all vocabulary matches;
for every position the best score and the number of pieces on the way to it are kept, nothing else.
The rules are those of the tokenizers library's Unigram model: a score must be larger to win, so of equal ones the longest last
piece stays; a character that is no piece costs 10 more than the lowest score and counts as its UTF-8 bytes.

Each process remembers the counts of the words it has met, up to a number, and a block's words are looked up
at once, so repeated words cost an array read.

Edge cases: null and empty texts have no tokens. A text of one space has one. Words of any length are taken
whole. Repeated rows are returned once each. Only doc_id and text are read.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Seen, map_arrow, piece_hashes, prepare, text_slices

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNKNOWN_PENALTY = 10.0
REMEMBERED = 3_000_000
_MARK = np.frombuffer(SPACE.encode(), np.uint8)


def vocabulary(path: str | None = None) -> tuple[list[tuple[str, float]], int]:
    """(pieces with scores by id, id of the unknown piece), read on the driver."""
    import sentencepiece

    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(MODEL)
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())], model.unk_id()


class Counter:
    """Counts the pieces of words."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int):
        names = {p for p, _ in pieces}
        if not all(f"<0x{b:02X}>" in names for b in range(256)):
            raise ValueError("the vocabulary must have a piece for each byte")
        self.automaton = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece:
                self.automaton.add_word(piece, (len(piece), score))
        self.automaton.make_automaton()
        self.unknown_piece = pieces[unknown][0]
        self.unknown_score = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.reset()

    def reset(self) -> None:
        self.seen, self.counts = Seen(), np.zeros(1 << 12, np.int64)

    def count(self, word: str) -> int:
        """Pieces of one word, its space included."""
        n = len(word)
        best, number = [0.0] * (n + 1), [0] * (n + 1)
        before = [-1] * (n + 1)
        done = 0  # positions up to here are final
        single = False

        def close(upto: int) -> None:
            # a character that is no piece of its own may stand as bytes; it is the latest start, so ties go against it
            nonlocal done, single
            while done < upto:
                done += 1
                if not single or before[done] < 0:
                    at = done - 1
                    score = best[at] + self.unknown_score
                    if before[done] < 0 or score > best[done]:
                        best[done], before[done] = score, at
                        number[done] = number[at] + len(word[at].encode())
                single = False

        for last, (size, score) in self.automaton.iter(word):
            end = last + 1
            if done < last:
                close(last)
            start = end - size
            got = best[start] + score
            if before[end] < 0 or got > best[end] or (got == best[end] and start < before[end]):
                best[end], before[end], number[end] = got, start, number[start] + 1
            single |= size == 1
        close(n)
        return number[n] if self.unknown_piece not in word else self._fused(word, before)

    def _fused(self, word: str, before: list[int]) -> int:
        """The unknown piece's own string is joined with unknown characters beside it, which then count as bytes."""
        total, run, end = 0, "", len(word)
        known = self.automaton
        while end > 0:
            part = word[before[end] : end]
            if part == self.unknown_piece or part not in known:
                run = part + run
            else:
                total += 1 + self._run(run)
                run = ""
            end = before[end]
        return total + self._run(run)

    def _run(self, run: str) -> int:
        return 0 if not run else 1 if run in self.automaton else len(run.encode())

    def totals(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(tokens, words) of each text."""
        spaces = np.flatnonzero(raw == 32)
        filled = np.flatnonzero(np.diff(offsets) > 0)
        filled = filled[raw[offsets[filled]] != 32]
        row = np.concatenate([np.searchsorted(offsets, spaces, "right") - 1, filled])
        starts = np.concatenate([spaces + 1, offsets[filled]])
        order = np.lexsort((starts, row))
        row, starts = row[order], starts[order]
        stops = np.minimum(np.append(spaces, len(raw))[np.searchsorted(spaces, starts, "left")], offsets[row + 1])
        hashes = piece_hashes(raw, starts, stops)
        if self.seen.n > REMEMBERED:
            self.reset()
        found = self.seen.find(hashes)
        new = np.flatnonzero(found < 0)
        if len(new):
            unique, at = np.unique(hashes[new], return_index=True)
            counts = [self.count(SPACE + raw[starts[i] : stops[i]].tobytes().decode("utf-8", "replace")) for i in new[at].tolist()]
            while self.seen.n + len(counts) > len(self.counts):
                self.counts = np.concatenate([self.counts, np.zeros_like(self.counts)])
            self.counts[self.seen.n : self.seen.n + len(counts)] = counts
            self.seen.add(unique)
            found[new] = self.seen.find(hashes[new])
        n = len(offsets) - 1
        return np.bincount(row, self.counts[found], minlength=n).astype(np.int64), np.bincount(row, minlength=n)


_MADE: list[Counter] = []


def count_tokens(documents: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens and n_words (pieces between spaces) of each document."""
    spark = documents.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(vocabulary(path))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch):
        if not _MADE or _MADE[0][0] != sent.value:
            _MADE[:] = [(sent.value, Counter(*sent.value))]
        counter = _MADE[0][1]
        for part, raw, at in text_slices(batch):
            if b"\xe2\x96\x81" in raw.tobytes():
                texts = [raw[a:b].tobytes().replace(b"\xe2\x96\x81", b" ") for a, b in zip(at[:-1], at[1:])]
                raw, at = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            tokens, n = counter.totals(raw, at)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(tokens), pa.array(n)], ["doc_id", "n_tokens", "n_words"])

    return map_arrow(documents.select("doc_id", "text"), run, f"doc_id {kind}, n_tokens bigint, n_words bigint")


def op7(spark, sf_dir: str) -> DataFrame:
    return count_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"))
