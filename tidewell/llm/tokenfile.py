"""Operator 2, token-id output: shards of ids under a Re-Pair grammar, with random access.

Documents are range-partitioned and sorted by id; each task encodes its texts with the tokenizers library (every distinct
piece of text once a process), ends each document with ``end_id`` and cuts its documents into shards of at most
``BLOCK_IDS`` ids, or one document, each a block of the file. In each shard frequent pairs of neighbouring symbols become
nonterminals, round after round: a round takes the pairs that occur at least so many times, the more frequent first where
two overlap, and the next round asks for an eighth of that, down to two. It ends when no pair occurs twice without
overlapping itself; pairs never cross a document's end. A block holds the rules, the number of ids each expands to, where
each document starts in symbols and ids, and the symbols, so that any range of ids is decoded without the rest. Blocks
are rows of a Parquet table in the shared folder: Spark's own commit makes lost or repeated tasks harmless.

Block layout, little-endian: 4 bytes "RPG2"; six unsigned 32-bit numbers: first nonterminal, rules, symbols, documents,
bits a symbol, bits a length; the symbol and the id at which each document starts, and the totals (64 bits each); then
packed, each from a whole byte on: the two symbols of each rule, the rules' expansion lengths, the symbols.

Edge cases: a null or empty text is the end id alone. Null ids come first. Rows with equal ids are ordered by text, and
equal rows come out once each. Only doc_id and text are read. An empty table gives an empty result. Pieces of texts are
told apart by 64-bit hashes (see presplit).
"""

from __future__ import annotations

import json
import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window
from tokenizers import Tokenizer, normalizers, pre_tokenizers

from .bpe import END, tokenizer_spec
from .common import changes, map_arrow, new_path, prepare, text_slices
from .presplit import Presplit

END_ID = 2
BLOCK_IDS = 1 << 20
#: Each round asks for pairs that occur this much less often.
LESS = 8
_MAGIC = b"RPG2"


def compress(ids: np.ndarray, ends: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first nonterminal, rules, expansion lengths, symbols, last symbol of each document marked).

    ``ends`` marks the last id of each document.
    """
    base = int(ids.max()) + 1 if len(ids) else 1
    symbols, ends, lengths, rules = ids.astype(np.uint32), ends.copy(), np.ones(base, np.int64), [np.zeros((0, 2), np.int64)]
    # where a pair that may repeat starts: one that occurs once will not occur again, unless it has a new symbol
    live, floor = np.ones(len(symbols), bool), 0
    while len(symbols) > 1:
        keys, where, shift = _pairs(symbols, np.flatnonzero(live[:-1] & ~ends[:-1]), len(lengths))
        first = np.flatnonzero(changes(keys))
        counts = np.diff(np.append(first, len(keys)))
        live[where[np.repeat(counts == 1, counts)]] = False
        apart = _apart(keys, where, first, counts, shift)
        most = int(apart.max(initial=0))
        if most < 2:
            break
        floor = max(2, min(most, floor or most) // LESS)
        chosen = np.flatnonzero(apart >= floor)
        chosen = chosen[np.argsort(-apart[chosen], kind="stable")]
        at, rank, taken = _places(where, first, counts, chosen, len(symbols))
        pairs = keys[first[chosen[taken]]]
        pairs = np.stack([pairs >> shift, pairs & ((np.uint64(1) << shift) - np.uint64(1))], 1).astype(np.int64)
        number = np.cumsum(taken) - 1 + len(lengths)
        symbols[at] = number[rank]
        rules.append(pairs)
        lengths = np.concatenate([lengths, lengths[pairs].sum(1)])
        ends[at] = ends[at + 1]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, ends, live = symbols[stay], ends[stay], live[stay]
        now = at - np.arange(len(at))
        live[now] = True
        live[np.maximum(now - 1, 0)] = True
    return base, np.concatenate(rules), lengths[base:], symbols, ends


def _pairs(symbols: np.ndarray, inner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.uint64]:
    """(sorted keys of the pairs that start at ``inner``, where each starts, the bits of the right symbol); symbols are less than n."""
    shift, width = np.uint64(n.bit_length()), np.uint64(len(symbols).bit_length())
    keys = (symbols[inner].astype(np.uint64) << shift) | symbols[inner + 1]
    if int(2 * shift + width) > 64:
        order = np.argsort(keys, kind="stable")
        return keys[order], inner[order], shift
    keys <<= width  # key and place sort as one word
    keys |= inner.astype(np.uint64)
    keys.sort()
    where = (keys & ((np.uint64(1) << width) - np.uint64(1))).astype(np.int64)
    keys >>= width
    return keys, where, shift


def _apart(keys: np.ndarray, where: np.ndarray, first: np.ndarray, counts: np.ndarray, shift: np.uint64) -> np.ndarray:
    """How often each pair occurs without overlapping itself; only a pair of equal symbols can."""
    out = counts.copy()
    left = keys[first] >> shift
    equal = np.flatnonzero(left == keys[first] & ((np.uint64(1) << shift) - np.uint64(1)))
    if len(equal):
        n = counts[equal]
        place = np.repeat(first[equal] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        pair, at = np.repeat(equal, n), where[place]
        run = np.flatnonzero(changes(pair) | np.append(True, at[1:] != at[:-1] + 1))
        halves = (np.diff(np.append(run, len(at))) + 1) // 2
        out[equal] = 0
        np.add.at(out, pair[run], halves)
    return out


def _places(where: np.ndarray, first: np.ndarray, counts: np.ndarray, chosen: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending places at which chosen pairs are replaced, the rank of the pair at each, which of the chosen are).

    ``where`` holds the places of all pairs, pair after pair; chosen pairs come in the order of their ranks. Of pairs
    that overlap the one of lower rank is replaced, so the first always is; each that is replaced is so twice or more.
    """
    none = len(chosen)
    group = np.full(len(first), none, np.int32)
    group[chosen] = np.arange(none)
    rank = np.full(n + 1, none, np.int32)
    rank[where] = np.repeat(group, counts)
    here = rank[:-1]
    at = np.flatnonzero((here < none) & (here <= np.append(np.int32(none), rank[:-2])) & (here <= rank[1:]))
    index = np.arange(len(at))
    new = np.append(True, at[1:] != at[:-1] + 1)[: len(at)]
    at = at[(index - np.maximum.accumulate(np.where(new, index, 0))) % 2 == 0]
    taken = np.bincount(rank[at], minlength=none + 1)[:none] >= 2
    at = at[taken[rank[at]]]
    return at, rank[at], taken


def packed(values: np.ndarray, bits: int) -> bytes:
    """The values with so many bits each, the lowest first."""
    values = values.astype(np.uint64).ravel()
    out = np.empty((len(values), bits), np.uint8)
    for b in range(bits):
        out[:, b] = (values >> np.uint64(b)) & np.uint64(1)
    return np.packbits(out.ravel(), bitorder="little").tobytes()


def unpacked(data: bytes, at: int, bits: int, first: int, last: int) -> np.ndarray:
    """Values from ``first`` up to ``last`` of those packed from byte ``at`` on; only their bytes are read."""
    lo, hi = first * bits, last * bits
    held = np.unpackbits(np.frombuffer(data, np.uint8, (hi + 7) // 8 - lo // 8, at + lo // 8), bitorder="little")
    held = held[lo % 8 : lo % 8 + hi - lo].reshape(last - first, bits)
    out = np.zeros(last - first, np.int64)
    for b in range(bits):
        out |= held[:, b].astype(np.int64) << b
    return out


def pack(ids: np.ndarray, counts: np.ndarray) -> bytes:
    """The block of documents of so many ids each; each has one at least."""
    ends = np.zeros(len(ids), bool)
    ends[np.cumsum(counts) - 1] = True
    base, rules, lengths, symbols, ends = compress(ids, ends)
    bits, wide = (base + len(rules)).bit_length(), int(lengths.max(initial=1)).bit_length()
    starts = np.concatenate([[0], np.flatnonzero(ends) + 1])
    index = np.stack([starts, np.concatenate([[0], np.cumsum(counts)])], 1).astype("<u8")
    head = _MAGIC + struct.pack("<6I", base, len(rules), len(symbols), len(counts), bits, wide)
    return b"".join([head, index.tobytes(), packed(rules, bits), packed(lengths, wide), packed(symbols, bits)])


class Block:
    """A block for reading."""

    def __init__(self, data: bytes):
        if data[:4] != _MAGIC:
            raise ValueError("not a block of token ids")
        self.data = data
        self.base, rules, self.n_symbols, docs, self.bits, wide = struct.unpack_from("<6I", data, 4)
        index = np.frombuffer(data, "<u8", 2 * (docs + 1), 28).reshape(-1, 2).astype(np.int64)
        self.symbol_at, self.id_at = index[:, 0], index[:, 1]
        at = 28 + 16 * (docs + 1)
        self.rules = unpacked(data, at, self.bits, 0, 2 * rules).reshape(-1, 2)
        at += (2 * rules * self.bits + 7) // 8
        self.lengths = np.concatenate([np.ones(self.base, np.int64), unpacked(data, at, wide, 0, rules)])
        self.begin = at + (rules * wide + 7) // 8

    def symbols(self, first: int, last: int) -> np.ndarray:
        return unpacked(self.data, self.begin, self.bits, first, last)

    def _expand(self, symbols: np.ndarray) -> np.ndarray:
        """The ids; each pass replaces nonterminals by their two parts, and a rule's parts are of earlier rounds."""
        while True:
            long = symbols >= self.base
            if not long.any():
                return symbols.astype(np.uint32)
            at = np.flatnonzero(long)
            parts = self.rules[symbols[at] - self.base]
            place = at + np.arange(len(at))
            out = np.repeat(symbols, 1 + long)
            out[place], out[place + 1] = parts[:, 0], parts[:, 1]
            symbols = out

    def ids(self) -> np.ndarray:
        return self._expand(self.symbols(0, self.n_symbols))

    def document(self, i: int) -> np.ndarray:
        return self._expand(self.symbols(int(self.symbol_at[i]), int(self.symbol_at[i + 1])))

    def range(self, first: int, last: int) -> np.ndarray:
        """The ids from ``first`` up to ``last``; only the symbols that they stand in are expanded."""
        doc = int(np.searchsorted(self.id_at, first, "right")) - 1
        stop = int(np.searchsorted(self.id_at, last, "left"))
        symbols = self.symbols(int(self.symbol_at[doc]), int(self.symbol_at[min(stop, len(self.id_at) - 1)]))
        ends = self.id_at[doc] + np.cumsum(self.lengths[symbols])
        lo, hi = int(np.searchsorted(ends, first, "right")), int(np.searchsorted(ends, last, "left")) + 1
        begun = ends[lo - 1] if lo else self.id_at[doc]
        return self._expand(symbols[lo:hi])[first - begun : last - begun]


_MADE: dict[int, Presplit] = {}


def _library(spec: str) -> Presplit:
    """Pieces encoded by the tokenizers library, many to a call; the ids that end a word tell them apart."""
    key = hash(spec)
    if key not in _MADE:
        vocab = json.loads(spec)["model"]["vocab"]
        final = np.zeros(max(vocab.values()) + 1, bool)
        final[[i for t, i in vocab.items() if t.endswith(END)]] = True
        tok = Tokenizer.from_str(spec)
        tok.no_truncation()
        tok.no_padding()
        tok.normalizer = normalizers.Sequence([])
        tok.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])

        def encode(pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
            joined = [" ".join(pieces[i : i + 200]) for i in range(0, len(pieces), 200)]
            ids = np.array([x for e in tok.encode_batch_fast(joined, add_special_tokens=False) for x in e.ids], np.int32)
            counts = np.diff(np.concatenate([[-1], np.flatnonzero(final[ids])]))
            if len(counts) != len(pieces):
                raise ValueError("a piece has no single word end")
            return ids, counts

        _MADE[key] = Presplit(spec, encode)
    return _MADE[key]


def _encoded(raw: np.ndarray, at: np.ndarray, split: Presplit, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the texts end to end, each with its end id, and their numbers."""
    if split.known:
        numbers, pieces = split.pieces(raw, at)
        ids, lengths = split.ids.gather(numbers)
        counts = np.diff(np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], np.cumsum(pieces)])])
    else:
        own = [split.library.encode(raw[a:b].tobytes().decode("utf-8", "replace"), add_special_tokens=False).ids for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        counts = np.array([len(x) for x in own], np.int64)
        ids = np.array([i for x in own for i in x], np.int32)
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def write_tokens(documents: DataFrame, target: str, path: str | None = None, end_id: int = END_ID, block_ids: int = BLOCK_IDS) -> None:
    """Writes the blocks of all documents, in ascending order of doc_id by shard and block, to ``target``."""
    spark = documents.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(tokenizer_spec(path))
    kind = documents.schema["doc_id"].dataType.simpleString()
    ordered = documents.select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text").withColumn("shard", F.spark_partition_id())
    names = ["shard", "block", "begin", "n_ids", "doc_ids", "n_tokens", "payload"]

    def run(batches):
        split = _library(sent.value)
        held: list = []
        size, block, begin = 0, 0, 0

        def flush():
            nonlocal held, size, block, begin
            counts = np.concatenate([x[1] for x in held])
            row = [pa.array([held[0][3]], pa.int32()), pa.array([block], pa.int32()), pa.array([begin], pa.int64()), pa.array([size], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(counts)], pa.int32()), pa.concat_arrays([x[2] for x in held])), pa.array([counts], pa.list_(pa.int64())), pa.array([pack(np.concatenate([x[0] for x in held]), counts)], pa.binary())]
            held, size, block, begin = [], 0, block + 1, begin + size
            return pa.RecordBatch.from_arrays(row, names)

        for batch in batches:
            for part, raw, at in text_slices(batch):
                ids, counts = _encoded(raw, at, split, end_id)
                if held and size + len(ids) > block_ids:
                    yield flush()
                held.append((ids, counts, part.column(0), part.column(2)[0].as_py()))
                size += len(ids)
        if held:
            yield flush()

    ordered.mapInArrow(run, f"shard int, block int, begin bigint, n_ids bigint, doc_ids array<{kind}>, n_tokens array<bigint>, payload binary").write.parquet(target)


def read_tokens(spark, target: str, ids: bool = False) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document, from the written blocks."""
    prepare(spark)
    blocks = spark.read.parquet(target)
    # a row for each shard, however many documents: the only window over all shards
    before = F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = blocks.groupBy("shard").agg(F.sum("n_ids").alias("n")).select("shard", before.alias("shard_start"))
    rows = blocks.join(F.broadcast(shards), "shard").select((F.col("begin") + F.col("shard_start")).cast("bigint").alias("begin"), "doc_ids", "payload")
    kind = blocks.schema["doc_ids"].dataType.elementType

    def decode(batch):
        for begin, doc_ids, payload in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
            block = Block(payload.as_py())
            flat = block.ids().astype("<u4")
            at = block.id_at
            view = memoryview(flat).cast("B")
            crcs = [zlib.crc32(view[4 * a : 4 * b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
            columns = [doc_ids.values, pa.array(begin + at[:-1]), pa.array(np.diff(at)), pa.array(crcs, pa.int64())]
            if ids:
                columns.append(pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(flat.astype(np.int64))))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids_crc32", *["ids"] * ids])

    return map_arrow(rows, decode, f"doc_id {kind.simpleString()}, start bigint, n_tokens bigint, ids_crc32 bigint" + ", ids array<bigint>" * ids)


def op2(spark, sf_dir: str) -> DataFrame:
    target = new_path(spark, "tokens")
    write_tokens(spark.read.parquet(f"{sf_dir}/documents.parquet"), target)
    return read_tokens(spark, target)
