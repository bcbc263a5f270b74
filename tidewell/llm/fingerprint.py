"""Operator 10, document fingerprints from closed syncmers.

A k-byte substring is an anchor if the smallest of its inner s-byte substrings (by a fixed hash) stands at its
first or last place. Whether it is depends on those k bytes alone, so a copied passage keeps its anchors
wherever it stands; and of any k-s neighbouring substrings one is an anchor, so gaps are at most k-s.
A fingerprint is the anchors in order, five characters each: the gap to the one before, then 24 bits of the
anchor's hash. A text of fewer than k bytes, but not none, has one anchor, itself. The likeness of two
fingerprints is positional: the n-th occurrence of a hash in one is matched with the n-th in the other, and of the
matches the longest chain is taken that runs forwards in both, so that what is inserted or left out costs the anchors
over it and no others. Twice the chain's length is divided by the number of anchors of both. Two empty fingerprints have a likeness of 1.

How it runs: a pass over the ids alone cuts them into stated ranges, so that a row's range is the same in every plan
that asks for it. Documents are dealt by range and sorted by descending doc_id; each task streams its rows and sees every
row's successor but the last one's. The first and last rows of each range, two a range whatever the input, are paired in
a small second branch.

Edge cases: null is the empty text, with an empty fingerprint. Null ids come last; rows with equal ids are ordered by text,
null first; equal rows are returned once each. A lone document is its own successor. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK_BYTES, changes, map_arrow, powers, prepare, seeded, sliding_min, span_hashes, text_slices, utf8

K = 48
S = 16
_TABLE = seeded(256, 37)
_LETTERS = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ_abcdefghijklmnopqrstuvwxyz~", np.uint8)
_VALUES = np.zeros(256, np.int64)
_VALUES[_LETTERS] = np.arange(64)


def syncmers(raw: np.ndarray, offsets: np.ndarray, k: int = K, s: int = S) -> np.ndarray:
    """Positions in ``raw`` of the closed syncmers of each text; none crosses a text's end."""
    found = []
    for lo in range(0, max(0, len(raw) - k + 1), BLOCK_BYTES):
        piece = raw[lo : lo + BLOCK_BYTES + k - 1]
        forth, back = powers(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_TABLE[piece] * forth[: len(piece)], out=sums[1:])
        small = (sums[s:] - sums[:-s]) * back[: len(piece) - s + 1]
        small ^= small >> np.uint64(32)
        small *= np.uint64(0xD6E8FEB86659FD93)
        least = sliding_min(small, k - s + 1)
        found.append(np.flatnonzero((small[: len(least)] == least) | (small[k - s :] == least)) + lo)
    at = np.concatenate(found) if found else np.zeros(0, np.int64)
    return at[at + k <= offsets[np.searchsorted(offsets, at, "right")]] if len(at) else at


def anchors(raw: np.ndarray, offsets: np.ndarray, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position in its text and 24-bit hash of each anchor, and the number of anchors of each text."""
    at = syncmers(raw, offsets, k, s)
    size = np.diff(offsets)
    tiny = offsets[:-1][(size > 0) & (size < k)]
    ends = np.concatenate([at + k, offsets[1:][(size > 0) & (size < k)]])
    at = np.concatenate([at, tiny])
    if len(tiny):
        order = np.argsort(at, kind="stable")
        at, ends = at[order], ends[order]
    hashes = (span_hashes(raw, at, ends) >> np.uint64(40)).astype(np.int64)
    row = np.searchsorted(offsets, at, "right") - 1
    return at - offsets[row], hashes, np.bincount(row, minlength=len(size))


def spell(position: np.ndarray, hashes: np.ndarray, counts: np.ndarray) -> list[str]:
    """The fingerprints as text."""
    gap = np.diff(position, prepend=0)
    first = (np.cumsum(counts) - counts)[counts > 0]
    gap[first] = position[first]
    digits = np.stack([gap, *(hashes >> b & 63 for b in (18, 12, 6, 0))], 1)
    text = _LETTERS[digits].tobytes().decode("ascii")
    ends = 5 * np.cumsum(counts)
    return [text[a:b] for a, b in zip((ends - 5 * counts).tolist(), ends.tolist())]


def read(fingerprints: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Position, hash and number of the anchors of fingerprints."""
    counts = np.array([len(f) // 5 for f in fingerprints], np.int64)
    digits = _VALUES[np.frombuffer("".join(fingerprints).encode(), np.uint8)].reshape(-1, 5)
    total = np.cumsum(digits[:, 0]) if len(digits) else np.zeros(0, np.int64)
    begun = np.concatenate([[0], total])[np.cumsum(counts) - counts]
    return total - np.repeat(begun, counts), digits[:, 1] << 18 | digits[:, 2] << 12 | digits[:, 3] << 6 | digits[:, 4], counts


def _keyed(side: tuple, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys of (row, hash, occurrence), the last of ``width`` bits, and their positions."""
    position, hashes, counts = side
    key = np.repeat(np.arange(len(counts)), counts) << 24 | hashes
    order = np.argsort(key, kind="stable")
    key = key[order]
    index = np.arange(len(key))
    nth = index - np.maximum.accumulate(np.where(changes(key), index, 0))
    return key << width | nth, position[order]


def likeness(a: tuple, b: tuple) -> np.ndarray:
    """Of each row's two fingerprints, each side as (position, hash, counts)."""
    # an occurrence number is less than the longer side's anchors; with the 24 bits of a hash that leaves enough for the rows of a batch
    width = max([1, *a[2].tolist(), *b[2].tolist()]).bit_length()
    if len(a[2]).bit_length() + 24 + width > 63:
        half = len(a[2]) // 2
        return np.concatenate([likeness(_take(a, r), _take(b, r)) for r in (slice(0, half), slice(half, len(a[2])))])
    (ka, pa_), (kb, pb) = _keyed(a, width), _keyed(b, width)
    at = np.searchsorted(ka, kb)
    ok = np.flatnonzero(at < len(ka))
    ok = ok[ka[at[ok]] == kb[ok]]
    both = a[2] + b[2]
    most = np.zeros(len(both), np.int64)
    if len(ok):
        row, x, y = kb[ok] >> (24 + width), pa_[at[ok]], pb[ok]
        order = np.lexsort((x, row))
        row, y = row[order], y[order]
        first = np.flatnonzero(changes(row))
        ends = np.append(first[1:], len(row))
        back = np.zeros(len(row), np.int64)
        back[1:] = (y[1:] < y[:-1]) & (row[1:] == row[:-1])
        most[row[first]] = ends - first
        for i in np.flatnonzero(np.add.reduceat(back, first)).tolist():  # the others run forwards as they are
            most[row[first[i]]] = _chain(y[first[i] : ends[i]])
    return np.where(both > 0, 2 * most / np.maximum(both, 1), 1.0)


def _chain(places: np.ndarray) -> int:
    """The length of the longest ascending subsequence."""
    tails: list[int] = []
    for v in places.tolist():
        if not tails or v > tails[-1]:
            tails.append(v)
        else:
            tails[bisect_left(tails, v)] = v
    return len(tails)


def _take(side: tuple, rows: slice) -> tuple:
    position, hashes, counts = side
    ends = np.concatenate([[0], np.cumsum(counts)])
    a, b = ends[rows.start], ends[rows.stop]
    return position[a:b], hashes[a:b], counts[rows]


def _join(a: tuple, b: tuple) -> tuple:
    return tuple(np.concatenate([x, y]) for x, y in zip(a, b))


NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _pairs(ids: pa.Array, texts: list[str], marks: tuple) -> pa.RecordBatch:
    """The rows of all texts but the last, each with the one after it as its successor."""
    n = len(texts) - 1
    edited = [t[: len(t) - len(t) // 3] + u[: len(t) // 3] for t, u in zip(texts, texts[1:])]
    raw, at = utf8(pa.array(edited, pa.large_string()))
    changed = anchors(raw, at)
    own, following = _take(marks, slice(0, n)), _take(marks, slice(1, n + 1))
    return pa.RecordBatch.from_arrays(
        [ids.slice(0, n), pa.array([len(t) for t in texts[:n]], pa.int64()), pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited], pa.string()), pa.array(spell(*own), pa.string()), pa.array(spell(*changed), pa.string()), pa.array(likeness(own, changed)), pa.array(likeness(own, following))],
        NAMES,
    )


def _texts(part: pa.RecordBatch) -> list[str]:
    return ["" if t is None else t for t in part.column(1).to_pylist()]


def fingerprints(documents: DataFrame) -> DataFrame:
    """doc_id and fingerprint of each document, without a shuffle."""
    prepare(documents.sparkSession)
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch):
        for part, raw, at in text_slices(batch):
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spell(*anchors(raw, at)), pa.string())], ["doc_id", "fingerprint"])

    return map_arrow(documents.select("doc_id", "text"), run, f"doc_id {kind}, fingerprint string")


def _ranges(documents: DataFrame) -> Column:
    """The number of the range of ids that a row falls in, by descending doc_id, null last; there are as many as shuffle partitions.

    The driver gets one id for each.
    """
    parts = int(documents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = documents.select("doc_id").where("doc_id is not null").repartitionByRange(parts, F.desc("doc_id"))
    least = sorted(r.least for r in ids.groupBy(F.spark_partition_id()).agg(F.min("doc_id").alias("least")).collect())
    if not least:
        return F.lit(0)
    bounds = np.array(least[1:], None if isinstance(least[0], int) else object)

    @F.pandas_udf("int")
    def number(ids: pd.Series) -> pd.Series:
        return pd.Series(len(bounds) - np.searchsorted(bounds, ids.to_numpy(), "right"))

    return F.when(F.col("doc_id").isNull(), F.lit(len(bounds))).otherwise(number(F.coalesce(F.col("doc_id"), F.lit(least[0]).cast(documents.schema["doc_id"].dataType))))


def with_successors(documents: DataFrame) -> DataFrame:
    """Fingerprints of each document, of its edited text, and its likeness to that and to the next document."""
    spark = documents.sparkSession
    prepare(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = documents.select("doc_id", "text", _ranges(documents).alias("part")).repartitionById(parts, "part")
    dealt = dealt.sortWithinPartitions("part", F.desc_nulls_last("doc_id"), F.asc_nulls_first("text"))

    def runs(batches):
        """Slices of batches, none over two ranges, with the range's number."""
        for batch in batches:
            part = batch.column(2).to_numpy()
            edges = np.append(np.flatnonzero(changes(part)), len(part)).tolist()
            for a, b in zip(edges, edges[1:]):
                yield int(part[a]), batch.slice(a, b - a)

    def inner(batches):
        held, last = None, None  # the last row so far: ids, text, anchors; and its range
        for number, run in runs(batches):
            if number != last:
                held, last = None, number
            for part, raw, at in text_slices(run):
                ids, texts, marks = part.column(0), _texts(part), anchors(raw, at)
                if held:
                    ids, texts, marks = pa.concat_arrays([held[0], ids]), [held[1], *texts], _join(held[2], marks)
                if len(texts) > 1:
                    yield _pairs(ids, texts, marks)
                n = len(texts) - 1
                held = ids.slice(n, 1), texts[n], _take(marks, slice(n, n + 1))

    def edges(batches):
        first = last = now = None

        def give():
            for place, row in ((0, first), (1, last)):
                yield pa.RecordBatch.from_arrays([*row.columns, pa.array([place], pa.int32())], ["doc_id", "text", "part", "place"])

        for number, run in runs(batches):
            if number != now:
                if now is not None:
                    yield from give()
                first, now = run.slice(0, 1), number
            last = run.slice(run.num_rows - 1, 1)
        if now is not None:
            yield from give()

    def outer(batches):
        begun = ended = None
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                begun = begun or row
                if row.column(3)[0].as_py() == 1:
                    ended = row
                elif ended is not None:
                    yield pair(ended, row)
        if ended is not None:
            yield pair(ended, begun)

    def pair(a, b):
        ids, texts = pa.concat_arrays([a.column(0), b.column(0)]), [*_texts(a), *_texts(b)]
        raw, at = utf8(pa.array(texts, pa.large_string()))
        return _pairs(ids, texts, anchors(raw, at))

    schema = f"doc_id {kind}, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    ends = dealt.mapInArrow(edges, f"doc_id {kind}, text string, part int, place int")
    return dealt.mapInArrow(inner, schema).unionAll(ends.repartition(1).sortWithinPartitions("part", "place").mapInArrow(outer, schema))


def op10(spark, sf_dir: str) -> DataFrame:
    return with_successors(spark.read.parquet(f"{sf_dir}/documents.parquet"))
