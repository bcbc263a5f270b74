"""Operator 12, packing token sequences: dominance reduction on the counts of lengths, then best fit.

A document's ids and an end id are cut into pieces of at most ``CAPACITY`` ids, only where it is longer; the first piece is
the shorter one. Pieces of one length are alike to a packing, so the problem is how many there are of each length: at most
``CAPACITY`` counts, whatever the size of the corpus. These alone reach the driver, which makes a plan:

1. Dominance reduction (Martello and Toth): for a longest piece, a set of at most three pieces that fills a sequence is
   fixed for good if it dominates every other set with that piece, so that some best packing holds it. Proofs that are
   used: nothing fits beside it; a pair fills the sequence; only one more piece fits, then the longest that does; two more
   fit, and the longest one is no shorter than any two together, or the longest one and the longest beside it are no shorter,
   one by one, than the two of any other set. Equal sets are fixed as often as their pieces last, and passes go on until
   none fixes more.
2. Best fit, longest first, of what is left: each piece goes where it leaves the least room. Equal sequences are
   filled together, so the steps grow with the number of lengths and not of pieces.

The plan is a list of runs: of the pieces of one length, those with ranks from r on go to the sequences from s on, so many
to each, from an offset on. A pattern is fixed only where a length's pieces run out, so there are under 7 patterns a length
of the capacity and under 64 lengths a pattern: under a million runs of 40 bytes at ``CAPACITY``, in practice some
thousands. A piece's rank is its number within its task plus how many of its length the tasks before hold, which is a
window over counts of tasks. Texts are read once, and no text or id is shuffled.

Edge cases: a null or empty text is the end id alone. Rows with equal or null ids are documents of their own. Only doc_id
and text are read. An empty table gives an empty result. Pieces of text are told apart by 64-bit hashes (see bytesplit).
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .bpe import tokenizer_spec
from .bytesplit import encoder
from .common import BROADCAST_ROWS, durable, map_arrow, prepare, text_slices

CAPACITY = 2048
END_ID = 0
TOKENIZER = "byte_bpe_50k.json"

#: How often a set of lengths is packed: (((length, copies), ...), times).
Pattern = tuple[tuple[tuple[int, int], ...], int]


# The plan --------------------------------------------------------------------------------------


def dominating(left: np.ndarray, j: int, capacity: int) -> list[int] | None:
    """Lengths of a set with j that dominates all sets with j, or None if no proof is found. left[l] pieces of length l are there."""
    room = capacity - j
    others = left[: room + 1].copy()
    if j <= room:
        others[j] -= 1
    others[0] = 0
    have = np.flatnonzero(others > 0)
    if not len(have):
        return [j]
    best = int(have[-1])
    small = np.repeat(have[:3], np.minimum(others[have[:3]], 3))[:3]
    two, three = int(small[:2].sum()), int(small.sum())
    if best == room or len(small) < 2 or two > room:
        return [j, best]
    if len(small) == 3 and three <= room:
        return None
    # of pairs that fit beside j: the longest partner of each, and the shortest that is no shorter
    twice = others[have] > 1
    partner = np.searchsorted(have, room - have, "right") - 1
    partner -= (partner == np.arange(len(have))) & ~twice
    ok = partner >= 0
    if int((have[ok] + have[partner[ok]]).max()) <= best:
        return [j, best]
    others[best] -= 1
    beside = np.flatnonzero(others[: room - best + 1] > 0)
    if len(beside):
        after = np.arange(len(have)) + ~twice
        ok = after < len(have)
        ok[ok] = have[ok] + have[after[ok]] <= room
        if int(have[ok].max(initial=0)) <= beside[-1]:
            return [j, best, int(beside[-1])]
    return None


def reduced(counts: np.ndarray, capacity: int) -> tuple[list[Pattern], np.ndarray]:
    """(sets that are fixed for good, what is left of the counts)."""
    left, fixed = counts.astype(np.int64).copy(), []
    while True:
        before = len(fixed)
        for j in np.flatnonzero(left)[::-1].tolist():
            while left[j] > 0 and (chosen := dominating(left, j, capacity)):
                copies = sorted(Counter(chosen).items(), reverse=True)
                times = min(int(left[length]) // n for length, n in copies)
                for length, n in copies:
                    left[length] -= n * times
                fixed.append((tuple(copies), times))
        if len(fixed) == before:
            return fixed, left


def best_fit(counts: np.ndarray, capacity: int) -> list[Pattern]:
    """Best fit by falling length: each piece goes to the sequence with the least room that still holds it."""
    #: by room: [pattern, sequences]
    filled: dict[int, list[list]] = {}
    done: list[Pattern] = []

    def put(room: int, pattern: tuple, times: int) -> None:
        if times and room:
            filled.setdefault(room, []).append([pattern, times])
        elif times:
            done.append((pattern, times))

    for length in np.flatnonzero(counts)[::-1].tolist():
        n = int(counts[length])
        for room in sorted(r for r in filled if r >= length):
            if not n:
                break
            most = room // length
            for pattern, times in filled.pop(room):
                full = min(times, n // most)
                put(room - most * length, (*pattern, (length, most)), full)
                n -= full * most
                times -= full
                if times and n:  # fewer than one sequence would take
                    put(room - n * length, (*pattern, (length, n)), 1)
                    n, times = 0, times - 1
                put(room, pattern, times)
        most = capacity // length
        put(capacity - most * length, ((length, most),), n // most)
        if n % most:
            put(capacity - n % most * length, ((length, n % most),), 1)
    return done + [(pattern, times) for own in filled.values() for pattern, times in own]


def least_sequences(counts: np.ndarray, capacity: int) -> int:
    """A lower bound of any packing's sequences (Martello and Toth's second bound): long pieces need their own, others the room left."""
    sizes, n = np.flatnonzero(counts), counts[np.flatnonzero(counts)].astype(np.int64)
    out = -(-int((sizes * n).sum()) // capacity)
    for cut in [c for c in sizes.tolist() if 2 * c <= capacity]:
        long, mid, small = sizes > capacity - cut, (sizes <= capacity - cut) & (2 * sizes > capacity), (2 * sizes <= capacity) & (sizes >= cut)
        room = int(n[mid].sum()) * capacity - int((sizes * n)[mid].sum())
        out = max(out, int(n[long].sum() + n[mid].sum()) + max(0, -(-(int((sizes * n)[small].sum()) - room) // capacity)))
    return out


def plan(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Runs (length, first rank, first sequence, offset, pieces a sequence), by length and rank."""
    fixed, left = reduced(counts, capacity)
    ranks, rows, sequence = np.zeros(capacity + 1, np.int64), [], 0
    for pattern, times in [*fixed, *best_fit(left, capacity)]:
        offset = 0
        for length, n in pattern:
            rows.append((length, ranks[length], sequence, offset, n))
            ranks[length] += n * times
            offset += n * length
        sequence += times
    if (ranks != counts).any():
        raise AssertionError("the plan misses pieces")
    rows = np.array(rows, np.int64).reshape(-1, 5)
    return rows[np.lexsort((rows[:, 1], rows[:, 0]))]


def placed(runs: np.ndarray, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of pieces by their lengths and ranks."""
    # within a length, ranks ascend; two searches, as ranks have no bound
    first, last = np.searchsorted(runs[:, 0], length, "left"), np.searchsorted(runs[:, 0], length, "right")
    while (wide := last - first > 1).any():
        middle = (first + last) // 2
        up = wide & (runs[np.minimum(middle, len(runs) - 1), 1] <= rank)
        first, last = np.where(up, middle, first), np.where(wide & ~up, middle, last)
    own = runs[first]
    nth = rank - own[:, 1]
    return own[:, 2] + nth // own[:, 4], own[:, 3] + nth % own[:, 4] * length


# The tables ------------------------------------------------------------------------------------


def token_pieces(documents: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, ids: bool = False) -> DataFrame:
    """part, nth, doc_id, piece, start, length, ids_crc32 (and ids) of all pieces; nth counts those of one length in a part."""
    spark = documents.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(tokenizer_spec(path or _default()))
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batches):
        split, had = encoder(sent.value), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            for rows, raw, at in text_slices(batch):
                flat, counts = split.encode(raw, at)
                flat = np.insert(flat, np.cumsum(counts), end_id).astype("<u4")
                counts = counts + 1
                n = -(-counts // capacity)
                row, piece = np.repeat(np.arange(len(counts)), n), np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
                short = counts - (n - 1) * capacity
                start = np.where(piece > 0, short[row] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, short[row])
                begin = (np.cumsum(counts) - counts)[row] + start
                order = np.argsort(length, kind="stable")
                nth = np.empty(len(length), np.int64)
                new = np.append(True, np.diff(length[order]) != 0)
                nth[order] = np.arange(len(order)) - np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
                nth += had[length]
                had += np.bincount(length, minlength=capacity + 1)
                view = memoryview(flat).cast("B")
                crc = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(begin.tolist(), (begin + length).tolist())]
                take = pa.array(row)
                columns = [rows.column(2).take(take), pa.array(nth), rows.column(0).take(take), pa.array(piece, pa.int32()), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                if ids:
                    columns.append(pa.ListArray.from_arrays(pa.array(np.append(begin, len(flat)), pa.int32()), pa.array(flat.astype(np.int32))))
                yield pa.RecordBatch.from_arrays(columns, ["part", "nth", "doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids])

    given = documents.select("doc_id", "text", F.spark_partition_id().alias("part"))
    return given.mapInArrow(run, f"part int, nth bigint, doc_id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint" + ", ids array<int>" * ids)


def _default() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def pack_documents(documents: DataFrame, capacity: int = CAPACITY, end_id: int = END_ID, path: str | None = None, ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 (and ids), sequence_id and offset of each piece."""
    spark = documents.sparkSession
    pieces = durable(token_pieces(documents, capacity, end_id, path, ids), "pieces")
    by_part = durable(pieces.groupBy("part", "length").agg(F.count("*").alias("n")), "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for r in by_part.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most one row a length
        counts[r["length"]] = r["n"]
    sent = spark.sparkContext.broadcast(plan(counts, capacity))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each task and length
    bases = by_part.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    bases = durable(bases, "ranks")
    # a part and length is as hot as one task's pieces; counted before it is broadcast
    small = bases.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    ranked = pieces.join(F.broadcast(bases) if small else bases, ["part", "length"]).withColumn("rank", F.col("nth") + F.col("base"))
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *["ids"] * ids]
    kinds = ", ".join(f"{n} {pieces.schema[n].dataType.simpleString()}" for n in names)

    def run(batch: pa.RecordBatch):
        sequence, offset = placed(sent.value, batch.column(3).to_numpy(), batch.column(len(names)).to_numpy())
        yield pa.RecordBatch.from_arrays([*batch.columns[: len(names)], pa.array(sequence), pa.array(offset)], [*names, "sequence_id", "offset"])

    return map_arrow(ranked.select(*names, "rank"), run, f"{kinds}, sequence_id bigint, offset bigint")


def assemble(packed: DataFrame) -> DataFrame:
    """sequence_id, n_ids and ids of each sequence, of pieces packed with their ids; a sequence is no longer than the capacity."""
    own = packed.groupBy("sequence_id").agg(F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("own"))
    whole = F.flatten(F.transform("own", lambda x: x["ids"]))
    return own.select("sequence_id", F.size(whole).cast("bigint").alias("n_ids"), whole.alias("ids"))


def op12(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
