"""What the operators of this package share: durable tables, size-checked joins, Arrow text blocks, hashing.

Nulls, empty texts and repeated rows are the callers' matter; a null text reaches the numpy helpers as
an empty one. All hashing here is of fixed constants, so results do not depend on the process.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows an Arrow batch holds at most; texts can be long.
BATCH_ROWS = 512
#: Bytes of text that one numpy pass takes at a time.
BLOCK_BYTES = (1 << 20) - 4096
#: Rows up to which a counted side is broadcast.
BROADCAST_ROWS = 200_000
#: Folders of applications that have been made.
_MADE: set[str] = set()


def prepare(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows, as texts can be long; the session keeps a smaller setting."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def shared_dir(spark: SparkSession) -> str:
    """The folder that all machines share, from spark.checkpoint.dir; a folder of this machine only where there is no other machine."""
    at = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not at:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        at = "file://" + tempfile.mkdtemp(prefix="spark-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", at)
    return at.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path below the application's folder in the shared one, which goes when the application's JVM ends."""
    at = f"{shared_dir(spark)}/tidewell-{spark.sparkContext.applicationId}"
    if at not in _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(at)
        files = path.getFileSystem(spark._jsc.hadoopConfiguration())
        files.mkdirs(path)
        files.deleteOnExit(path)
        _MADE.add(at)
    return f"{at}/{name}-{uuid.uuid4().hex}"


def durable(df: DataFrame, name: str) -> DataFrame:
    """Writes df as Parquet in the shared folder and reads it back: lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have, whatever its case."""
    held = {c.lower() for c in df.columns}
    while f"_{name}".lower() in held:
        name = f"_{name}"
    return f"_{name}"


def sized_join(big: DataFrame, small: DataFrame, on: str, how: str = "inner", limit: int = BROADCAST_ROWS, cost: Column | None = None, *, skewed: bool = True) -> DataFrame:
    """Joins on a key of which big may hold very many equal rows, unless it is not ``skewed``.

    small is measured, in rows or in the sum of ``cost``: up to ``limit`` it is broadcast. Beyond that both are shuffled,
    and keys of big that fill more than a partition, which are fewer than the partitions, are salted by big's rows, as
    many ways as they fill partitions, with small's rows repeated for these alone. For inner, left, semi and anti joins.
    """
    size = small.limit(limit + 1).count() if cost is None else small.agg(F.sum(cost)).first()[0] or 0
    if size <= limit:
        return big.join(F.broadcast(small), on, how)
    if not skewed:
        return big.join(small, on, how)
    salt, ways = fresh(big, "salt"), fresh(big, "ways")
    parts = int(big.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = durable(big.groupBy(on).agg(F.count("*").alias(ways)), "key-counts")
    share = -(-(counts.agg(F.sum(ways)).first()[0] or 0) // parts) or 1
    hot = durable(counts.where((F.col(ways) > share) & F.col(on).isNotNull()).select(on, F.ceil(F.col(ways) / share).cast("int").alias(ways)), "hot-keys")
    ways_of = F.coalesce(ways, F.lit(1))
    salted = big.join(F.broadcast(hot), on, "left").withColumn(salt, F.pmod(F.xxhash64(*big.columns), ways_of).cast("int")).drop(ways)
    spread = small.join(F.broadcast(hot), on, "left").withColumn(salt, F.explode(F.sequence(F.lit(0), ways_of - 1))).drop(ways)
    return salted.join(spread, [on, salt], how).drop(salt)


# Arrow text blocks -----------------------------------------------------------------------------


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()) if column.type != pa.large_binary() else column
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if offsets and len(column) else np.zeros(len(column) + 1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and len(at) and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - (at[0] if len(at) else 0)


def row_slices(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows with at most ``limit`` bytes each, or one row."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = j


def text_slices(batch: pa.RecordBatch, name: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """The batch in slices, each with its text's bytes and offsets."""
    raw, at = utf8(batch.column(batch.schema.get_field_index(name)))
    for i, j in row_slices(at, limit):
        yield batch.slice(i, j - i), raw[at[i] : at[j]], at[i : j + 1] - at[i]


def map_arrow(df: DataFrame, f: Callable, schema: str) -> DataFrame:
    """mapInArrow with f: (record batch) -> iterator of record batches."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                yield from f(batch)

    return df.mapInArrow(run, schema)


def whole_groups(batches, key: str) -> Iterator[pa.Table]:
    """Tables of whole groups from batches in the order of a whole-number key; for groups of bounded size."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(batch.schema.get_field_index(key)).to_numpy()
        at = int(np.searchsorted(keys, keys[-1], "left"))
        if last != keys[-1] and (held or at):
            cut = at if at else 0
            yield pa.Table.from_batches([*held, *([batch.slice(0, cut)] if cut else [])])
            held = []
            batch = batch.slice(cut)
        held.append(batch)
        last = keys[-1]
    if held:
        yield pa.Table.from_batches(held)


def changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before; true in the first row."""
    n = len(columns[0])
    out = np.ones(n, bool)
    if n:
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from flat values and the length of each list."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


# Hashing ---------------------------------------------------------------------------------------

_M64 = (1 << 64) - 1
_ODD = 0x9E3779B97F4A7C15


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words whose every output bit depends on every input bit (public MurmurHash3 finaliser)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def seeded(n: int, seed: int) -> np.ndarray:
    """n fixed 64-bit words."""
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD) + np.uint64(seed))


_POWERS: list[tuple[np.ndarray, np.ndarray]] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2**64, n of each at least; those of a block's size are kept."""
    if _POWERS and len(_POWERS[0][0]) >= n:
        return _POWERS[0]
    size = 1 << max(12, (n - 1).bit_length())
    base = 0xD6E8FEB86659FD93
    out = []
    for b in (base, pow(base, -1, 1 << 64)):
        p = np.ones(size, np.uint64)
        k, step = 1, b
        while k < size:
            p[k : 2 * k] = p[:k] * np.uint64(step)
            step = step * step & _M64
            k *= 2
        out.append(p)
    if size <= 2 * BLOCK_BYTES:
        _POWERS[:] = [(out[0], out[1])]
    return out[0], out[1]


_BYTES = seeded(256, 11)


def span_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray | None = _BYTES) -> np.ndarray:
    """64-bit hashes of spans of symbols; equal contents have equal hashes wherever they stand.

    Starts and ends ascend; spans may overlap. ``table`` gives a word for each symbol; None if the
    symbols are 64-bit words themselves. Long inputs are taken piece by piece.
    """
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(starts, starts[i] + BLOCK_BYTES)))
        lo, hi = int(starts[i]), int(ends[j - 1])
        piece = symbols[lo:hi]
        forth, back = powers(hi - lo + 1)
        sums = np.zeros(hi - lo + 1, np.uint64)
        np.cumsum((piece if table is None else table[piece]) * forth[: hi - lo], out=sums[1:])
        s, e = starts[i:j] - lo, ends[i:j] - lo
        out[i:j] = mix((sums[e] - sums[s]) * back[s] + (e - s).astype(np.uint64))
        i = j
    return out


#: Symbols up to which sums of powers tell pieces of text apart.
PLAIN = 64


def piece_hashes(symbols: np.ndarray, starts: np.ndarray, ends: np.ndarray, table: np.ndarray = _BYTES) -> np.ndarray:
    """span_hashes for pieces whose ids are kept: those of over ``PLAIN`` symbols are hashed by BLAKE2.

    Modulo 2**64 sums of powers are equal for some different texts whatever the base and the table, as for the Thue-Morse
    word of 1024 letters and its complement.
    """
    out = span_hashes(symbols, starts, ends, table)
    for i in np.flatnonzero(ends - starts > PLAIN).tolist():
        out[i] = int.from_bytes(blake2b(symbols[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return out


# Words -----------------------------------------------------------------------------------------

#: Words are runs of [0-9a-z] and of what lies beyond ASCII, after A-Z are lower-cased.
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def lowered(raw: np.ndarray) -> np.ndarray:
    return _LOWER[raw]


def words(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of the texts, and the number of words of each text.

    Starts and ends are positions in ``raw``.
    """
    low = _LOWER[raw]
    inside = _IS_WORD[low]
    n = len(low)
    if not n:
        none = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), none, none, np.zeros(len(offsets) - 1, np.int64)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    before = np.empty(n, bool)
    before[0] = False
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.empty(n, bool)
    after[-1] = False
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return span_hashes(low, starts, ends), starts, ends, counts


def shingles(hashes: np.ndarray, counts: np.ndarray, k: int, short: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-word shingles of each text, and how many each text has.

    A text of fewer than k words, but not none, has one shingle of all its words where ``short``.
    """
    ends = np.cumsum(counts)
    full = np.maximum(counts - k + 1, 0)
    tiny = short & (counts > 0) & (counts < k)
    number = full + tiny
    total = int(number.sum())
    first = ends - counts
    at = np.arange(total) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)
    length = np.repeat(np.where(tiny, counts, k), number)
    return span_hashes(hashes, at, at + length, None), number


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minima of all windows of the width."""
    if len(values) < width:
        return values[:0]
    out, have = values, 1
    while have * 2 <= width:
        out = np.minimum(out[:-have], out[have:])
        have *= 2
    if have < width:
        rest = width - have
        out = np.minimum(out[: len(out) - rest], out[rest:])
    return out


class Seen:
    """Numbers 64-bit keys in the order in which they are added; a lookup is a few array reads."""

    def __init__(self, bits: int = 16):
        self.n = 0
        self._make(bits)

    def _make(self, bits: int) -> None:
        self.mask = np.uint64((1 << bits) - 1)
        self.keys = np.zeros(1 << bits, np.uint64)
        self.numbers = np.full(1 << bits, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, or -1."""
        slot = (keys & self.mask).astype(np.int64)
        out = self.numbers[slot]
        todo = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & int(self.mask)
            got = self.numbers[slot[todo]]
            out[todo] = got
            todo = todo[(got >= 0) & (self.keys[slot[todo]] != keys[todo])]
        return out

    def add(self, keys: np.ndarray) -> None:
        """Numbers distinct keys that are not there yet."""
        if (self.n + len(keys)) * 2 > len(self.keys):
            held = self.numbers >= 0
            old = self.keys[held][np.argsort(self.numbers[held])]
            self._make(int(4 * (self.n + len(keys))).bit_length())
            self.n = 0
            self._put(old)
        self._put(keys)

    def _put(self, keys: np.ndarray) -> None:
        number = np.arange(self.n, self.n + len(keys), dtype=np.int32)
        slot = (keys & self.mask).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):
            free = todo[self.numbers[slot[todo]] < 0]
            self.numbers[slot[free]] = number[free]
            self.keys[slot[free]] = keys[free]
            todo = todo[self.numbers[slot[todo]] != number[todo]]
            slot[todo] = (slot[todo] + 1) & int(self.mask)
        self.n += len(keys)


class Flat:
    """Growing lists of numbers, each of which is got by its number."""

    def __init__(self, kind):
        self.data = np.zeros(1 << 12, kind)
        self.used = 0
        self.starts = np.zeros(1 << 10, np.int64)
        self.lengths = np.zeros(1 << 10, np.int64)
        self.n = 0

    def extend(self, values: np.ndarray, counts: np.ndarray) -> None:
        m, k = len(values), len(counts)
        while self.used + m > len(self.data):
            self.data = np.concatenate([self.data, np.zeros_like(self.data)])
        while self.n + k > len(self.starts):
            self.starts = np.concatenate([self.starts, np.zeros_like(self.starts)])
            self.lengths = np.concatenate([self.lengths, np.zeros_like(self.lengths)])
        self.data[self.used : self.used + m] = values
        self.lengths[self.n : self.n + k] = counts
        self.starts[self.n : self.n + k] = self.used + np.cumsum(counts) - counts
        self.used += m
        self.n += k

    def gather(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists end to end, and their lengths."""
        lengths = self.lengths[numbers]
        ends = np.cumsum(lengths)
        at = np.repeat(self.starts[numbers] - ends + lengths, lengths)
        at += np.arange(len(at))
        return self.data[at], lengths
