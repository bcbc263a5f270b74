"""Operator 3, exact substring deduplication by merging Burrows-Wheeler transforms.

Every byte goes that is covered by a string of ``LENGTH`` bytes which also starts earlier: in a document of smaller
doc_id, or earlier in the same one. Strings are judged on the input; they never cross documents.

How it runs
  1. Units. Every string of 100 bytes holds a closed syncmer of ``K`` bytes (see fingerprint), and its first one depends on the string alone.
     Neighbouring strings with the same first syncmer make a unit of 100 to 144 bytes. Units are keyed by the hash of their
     syncmer, so equal strings meet. Equal units within a task are combined before the shuffle: all but the first
     of them are known to go.
  2. In a bucket of syncmer hashes, units with a syncmer that occurs once are done; of equal units all but the first
     go; what is left are different units round the same syncmer.
  3. Only these get their bytes, from the documents' one shuffle. Units round a syncmer that more than
     ``HOT`` different units share are cut into their single strings, keyed by their own hashes, so that a frequent
     syncmer spreads over all tasks; equal ones of a task are combined first.
  4. All strings of a unit hold its syncmer, which becomes one symbol: a string then has 45 symbols.
     The units of a few syncmers make a collection that is cut into shards. Each shard's suffixes are sorted once
     into its Burrows-Wheeler transform. The transforms are merged by refining their interleave: each pass deals the
     suffixes out, in the order so far, by the symbol before them, and a suffix starts a new block where its symbol or the block it
     came from changes. After as many passes as the strings are long, suffixes in a block share that many bytes:
     blocks of several are the repeated intervals. No suffix is sorted again.
  5. The strings of a block but the first, and the units that go, cover the bytes that go.
Syncmers, and equal units of one syncmer, are told by 64-bit hashes; the merged transforms compare the bytes round it.

Edge cases: null is the empty text; texts under 100 bytes lose nothing. If ids repeat, are null or are not whole
numbers, documents are ordered by id, null last, and text digest; rows of equal id and text are one document
and come out alike. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import durable, prepare, seeded, sized_join, span_hashes, text_slices, utf8
from .fingerprint import syncmers

LENGTH = 100
#: With these every 100 bytes hold a closed syncmer: 100 - K + 1 >= K - S.
K, S = 56, 12
HOT = 4096
#: Units that a task holds before it combines and sends them.
FLUSH = 1 << 19
#: Bytes of units that are merged at a time; whole syncmers are kept together.
COLLECTION = 1 << 20
SHARDS = 8
#: Symbols of a string of ``LENGTH`` bytes whose syncmer is one symbol, a byte that UTF-8 never has.
DEPTH = LENGTH - K + 1
MARK = b"\xff"
_CONTENT = seeded(256, 53)


def units(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, start in it, number of strings, place of the syncmer, its hash, hash of the bytes) of each unit."""
    at = syncmers(raw, offsets, K, S)
    row = np.searchsorted(offsets, at, "right") - 1
    begin, end = offsets[row], offsets[row + 1]
    before = np.empty(len(at), np.int64)
    if len(at):
        before[0] = -1
        before[1:] = at[:-1]
    first = np.maximum(np.maximum(before + 1, begin), at + K - LENGTH)
    last = np.minimum(at, end - LENGTH)
    ok = last >= first
    at, row, first, last, begin = at[ok], row[ok], first[ok], last[ok], begin[ok]
    return row, first - begin, last - first + 1, at - first, span_hashes(raw, at, at + K), span_hashes(raw, first, last + LENGTH, _CONTENT)


def _blobs(key: np.ndarray, columns: list[np.ndarray], kinds: list, names: list[str]) -> pa.Table:
    """A row for each key, with the columns' values as lists."""
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    offsets = pa.array(np.append(first, len(key)), pa.int32())
    return pa.Table.from_arrays([pa.array(key[first], pa.int32()), *(pa.ListArray.from_arrays(offsets, pa.array(c[order], k)) for c, k in zip(columns, kinds))], names)


def _flat(table: pa.Table, name: str) -> np.ndarray:
    return np.concatenate([np.zeros(0, np.int64), *(c.flatten().to_numpy(zero_copy_only=False) for c in table.column(name).chunks)]).astype(np.int64)


_UNITS = ["b", "a", "u", "d", "p", "m"]
_KINDS = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int16()]  # m: number of strings, and 64 times the syncmer's place; both are under 64
_DECISIONS = ["db", "kind", "d", "p", "m", "q", "key"]
_DECISION_KINDS = [pa.int8(), pa.int64(), pa.int32(), pa.int32(), pa.int16(), pa.int64()]
GOES, COMPARE, SPREAD = 0, 1, 2


def _not_first(same: np.ndarray, d: np.ndarray, p: np.ndarray) -> np.ndarray:
    """Of sorted rows, those of a run whose place is not that of the run's first row."""
    start = np.maximum.accumulate(np.where(same, 0, np.arange(len(same))))
    return (d != d[start]) | (p != p[start])


def _changes(*columns: np.ndarray) -> np.ndarray:
    """Where any of the columns differs from the row before; true in the first row."""
    n = len(columns[0])
    out = np.ones(n, bool)
    if n:
        out[1:] = False
        for c in columns:
            out[1:] |= c[1:] != c[:-1]
    return out


def _send(buckets: int):
    """Units of a task's documents, combined, by bucket; those that are known to go have negative buckets, by document."""

    def flush(held):
        d, p, m, a, u = (np.concatenate([h[i] for h in held]) for i in range(5))
        order = np.lexsort((p, d, u))
        d, p, m, a, u = (c[order] for c in (d, p, m, a, u))
        new = _changes(u)
        goes = _not_first(~new, d, p)
        bucket = ((a >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        bucket[goes] = -1 - np.mod(d[goes], buckets)
        keep = new | goes
        bucket, d, p, m, a, u = (c[keep] for c in (bucket, d, p, m, a, u))
        return _blobs(bucket, [a.view(np.int64), u.view(np.int64), d, p, m], _KINDS, _UNITS).to_batches()

    def run(batches):
        held, n = [], 0
        for batch in batches:
            for part, raw, at in text_slices(batch):
                row, p, m, q, a, u = units(raw, at)
                held.append((part.column(0).to_numpy(zero_copy_only=False)[row], p, m + 64 * q, a, u))
                n += len(row)
                if n >= FLUSH:
                    yield from flush(held)
                    held, n = [], 0
        if n:
            yield from flush(held)

    return run


def _resolve(groups: int):
    def run(key, table):
        a, u, d, p, m = (_flat(table, x) for x in _UNITS[1:])
        if key[0].as_py() < 0:
            kind = np.full(len(d), GOES)
            a = np.zeros(len(d), np.int64)
        else:
            order = np.lexsort((p, d, u, a))
            a, u, d, p, m = (c[order] for c in (a, u, d, p, m))
            new_u = _changes(a, u)
            goes = _not_first(~new_u, d, p)
            group = np.cumsum(_changes(a)) - 1
            different = np.bincount(group, new_u)[group] if len(group) else np.zeros(0)
            kind = np.where(goes, GOES, np.where(new_u & (different > 1), np.where(different > HOT, SPREAD, COMPARE), -1))
            keep = kind >= 0
            kind, d, p, m, a = (c[keep] for c in (kind, d, p, m, a))
        return _blobs(np.mod(d, groups), [kind, d, p, m & 63, m >> 6, a], _DECISION_KINDS, _DECISIONS)

    return run


def _meet(docs: pa.Table, d: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, offsets of the documents, document, decision) of all that belong together."""
    raw, at = utf8(docs.column("text"))
    own = docs.column("d").to_numpy()
    order = np.argsort(own, kind="stable")
    lo, hi = np.searchsorted(own[order], d, "left"), np.searchsorted(own[order], d, "right")
    n = hi - lo
    which = np.repeat(np.arange(len(d)), n)
    return raw, at, order[np.repeat(lo, n) + np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)], which


_STRINGS = pa.schema([("key", pa.int64()), ("bytes", pa.binary()), ("d", pa.int64()), ("p", pa.int32()), ("m", pa.int16())])


def _fetch(docs, decisions):
    """The bytes of the units that are to be compared; without bytes: strings that are known to go."""
    kind, d, p, m, q, key = (_flat(decisions, x) for x in _DECISIONS[1:])
    raw, at, row, which = _meet(docs, d)
    kind, d, p, m, q, key = (c[which] for c in (kind, d, p, m, q, key))
    order = np.lexsort((p, d))
    order = order[_changes(d[order], p[order])]  # rows of one document hold the same bytes
    row, kind, d, p, m, q, key = (c[order] for c in (row, kind, d, p, m, q, key))
    whole = kind == COMPARE
    parts = [(key[whole], row[whole], d[whole], p[whole], m[whole], q[whole])]
    if (~whole).any():
        n = m[~whole]
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        r, e, start, place = np.repeat(row[~whole], n), np.repeat(d[~whole], n), np.repeat(p[~whole], n) + step, np.repeat(q[~whole], n) - step
        order = np.lexsort((start, r))
        r, e, start, place = r[order], e[order], start[order], place[order]
        h = span_hashes(raw, at[r] + start, at[r] + start + LENGTH, _CONTENT).view(np.int64)
        order = np.lexsort((start, e, h))
        h, r, e, start, place = (c[order] for c in (h, r, e, start, place))
        parts.append((h, np.where(_changes(h), r, -1), e, start, np.ones(len(e), np.int64), place))
    key, row, d, p, m, q = (np.concatenate([x[i] for x in parts]) for i in range(6))
    blob = raw.tobytes()
    begin = at[row] + p
    texts = [blob[b : b + o] + MARK + blob[b + o + K : b + n + LENGTH - 1] if r >= 0 else None for r, b, n, o in zip(row.tolist(), begin.tolist(), m.tolist(), q.tolist())]
    return pa.Table.from_arrays([pa.array(key), pa.array(texts, pa.binary()), pa.array(d), pa.array(p, pa.int32()), pa.array(m, pa.int16())], schema=_STRINGS)


# The merge of transforms ------------------------------------------------------------------------


def transform(text: np.ndarray, depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """(suffix array, Burrows-Wheeler transform) of strings that each end with 0.

    Terminators come first, in their strings' order; each differs from every other. Suffixes are told apart up to
    the terminator or ``depth`` symbols at least.
    """
    n = len(text)
    ends = text == 0
    rank = text.astype(np.int64) + np.count_nonzero(ends)
    rank[ends] = np.arange(np.count_nonzero(ends))
    h = 1
    order = np.argsort(rank, kind="stable")
    while h < depth:
        follow = np.zeros(n, np.int64)
        follow[: n - h] = rank[h:] + 1
        key = rank * (n + 300) + follow  # a terminator is alone in its rank, so what follows it decides nothing
        order = np.argsort(key, kind="stable")
        new = _changes(key[order])
        rank[order] = np.cumsum(new) - 1
        if new.all():
            break
        h *= 2
    return order, text[order - 1]


def merge(shards: list[tuple[np.ndarray, np.ndarray]], depth: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Merges (suffixes, transform) pairs by interleave refinement.

    Returns the suffixes in merged order and where a suffix differs from the one before within ``depth`` symbols.
    """
    suffix = np.concatenate([s for s, _ in shards])
    symbol = np.concatenate([b for _, b in shards])
    sizes = [len(s) for s, _ in shards]
    home = np.repeat(np.arange(len(shards), dtype=np.uint8), sizes)
    n, ends = len(symbol), int(np.count_nonzero(symbol == 0))
    heads = np.repeat(np.arange(len(shards), dtype=np.uint8), [int(np.count_nonzero(b == 0)) for _, b in shards])
    leaf = home
    block = np.zeros(n, np.int32)
    before = np.empty(n, np.uint8)
    for _ in range(depth):
        before[np.argsort(leaf, kind="stable")] = symbol  # each shard's symbols in its own order
        dealt = np.argsort(before, kind="stable")
        leaf, held, first = leaf[dealt], block[dealt], before[dealt]
        new = np.ones(n, bool)
        np.not_equal(first[1:], first[:-1], out=new[1:])
        new[1:] |= held[1:] != held[:-1]
        leaf[:ends] = heads  # terminators keep their order, each a block of its own
        new[:ends] = True
        block = np.cumsum(new, dtype=np.int32)
        if block[-1] == n:
            break
    out = np.empty(n, np.int64)
    out[np.argsort(leaf, kind="stable")] = suffix
    return out, new


def repeated(strings: list[bytes], key: np.ndarray, d: np.ndarray, p: np.ndarray, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(unit, string in it) of the strings that start earlier in another place, among units of the same key."""
    lengths = np.fromiter(map(len, strings), np.int64, len(strings))
    unit_at = np.concatenate([[0], np.cumsum(lengths + 1)])
    raw = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    # the bytes become symbols from 1 up, so that 0 is the terminator whatever the texts hold
    present = np.unique(np.concatenate([np.frombuffer(b"".join(strings), np.uint8), np.zeros(0, np.uint8)]))
    if len(present) > 255:
        raise ValueError("UTF-8 never has all 256 byte values")
    code = np.zeros(256, np.uint8)
    code[present] = np.arange(1, len(present) + 1)
    text = code[raw]
    text[unit_at[1:] - 1] = 0
    cuts = np.unique(np.searchsorted(unit_at, np.linspace(0, len(text), SHARDS + 1)[1:-1]))
    edges = unit_at[np.unique(np.concatenate([[0], cuts, [len(strings)]]))]
    shards = []
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        suffix, symbols = transform(text[a:b], DEPTH)
        shards.append((suffix + a, symbols))
    suffix, new = merge(shards, DEPTH)
    unit = np.searchsorted(unit_at, suffix, "right") - 1
    nth = suffix - unit_at[unit]
    group = np.cumsum(new)
    full = nth < m[unit]
    unit, nth, group = unit[full], nth[full], group[full]
    order = np.lexsort((p[unit] + nth, d[unit], key[unit], group))
    unit, nth, group = unit[order], nth[order], group[order]
    goes = _not_first(~_changes(group, key[unit]), d[unit], p[unit] + nth)
    return unit[goes], nth[goes]


def _compare(groups: int):
    """Streams units in the order of their keys; gives the strings that go, by group of documents."""

    def flush(strings, *columns):
        key, d, p, m = (np.array(c, np.int64) for c in columns)
        unit, nth = repeated(strings, key, d, p, m)
        return d[unit], p[unit] + nth

    def give(parts):
        d, p = np.concatenate([x[0] for x in parts]), np.concatenate([x[1] for x in parts])
        order = np.lexsort((p, d))
        d, p = d[order], p[order]
        first = np.flatnonzero(np.append(True, (d[1:] != d[:-1]) | (p[1:] != p[:-1] + 1))[: len(d)])
        m = np.diff(np.append(first, len(d)))
        # runs of neighbouring strings as one decision
        n = len(first)
        return _blobs(np.mod(d[first], groups), [np.zeros(n, np.int64), d[first], p[first], m, np.zeros(n, np.int64), np.zeros(n, np.int64)], _DECISION_KINDS, _DECISIONS).to_batches()

    def run(batches):
        strings, keys, d, p, m, size, last, found = [], [], [], [], [], 0, None, []
        for batch in batches:
            for key, text, e, q, n in zip(*(c.to_pylist() for c in batch.columns)):
                if text is None:
                    found.append((np.array([e]), np.array([q])))
                    continue
                if size >= COLLECTION and key != last:
                    found.append(flush(strings, keys, d, p, m))
                    strings, keys, d, p, m, size = [], [], [], [], [], 0
                    yield from give(found)
                    found = []
                strings.append(text)
                keys.append(key)
                d.append(e)
                p.append(q)
                m.append(n)
                size += len(text) + 1
                last = key
        if strings:
            found.append(flush(strings, keys, d, p, m))
        if found:
            yield from give(found)

    return run


_DECISION_SCHEMA = "db int, kind array<tinyint>, d array<bigint>, p array<int>, m array<int>, q array<smallint>, key array<bigint>"


def _remove(kind) -> object:
    def run(docs, decisions):
        what, d, p, m = (_flat(decisions, x) for x in ("kind", "d", "p", "m"))
        goes = what == GOES
        d, p, m = d[goes], p[goes], m[goes]
        raw, at, row, which = _meet(docs, d)
        edge = np.zeros(len(raw) + 1, np.int64)
        begin = at[row] + p[which]
        np.add.at(edge, begin, 1)
        np.add.at(edge, begin + m[which] + LENGTH - 1, -1)
        gone = np.cumsum(edge)[:-1] > 0
        starts = np.zeros(len(raw) + 1, bool)
        starts[at] = True
        run_start = gone.copy()
        run_start[1:] &= ~gone[:-1] | starts[1:-1]
        count = lambda mask: np.diff(np.concatenate([[0], np.cumsum(mask)])[at])
        kept = raw[~gone].tobytes()
        ends = np.cumsum(count(~gone)).tolist()
        texts = [kept[a:b] for a, b in zip([0, *ends], ends)]
        return pa.Table.from_arrays([docs.column("doc_id").combine_chunks(), pa.array(np.diff(at)), pa.array(count(gone).astype(np.int64)), pa.array(count(run_start).astype(np.int64)), pa.array(texts, pa.binary())], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept"])

    return run


def _prime(least: int) -> int:
    n = max(3, least) | 1
    while any(n % k == 0 for k in range(3, int(n**0.5) + 1, 2)):
        n += 2
    return n


def _numbered(documents: DataFrame) -> DataFrame:
    """doc_id, text and d, a number in the documents' order."""
    given = documents.select("doc_id", "text")
    if documents.schema["doc_id"].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint"):
        if not given.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count():
            return given.withColumn("d", F.col("doc_id").cast("bigint"))
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))
    named = given.withColumn("_row", row)
    order = [F.asc_nulls_last("doc_id"), F.asc("_row")]
    # partition number and place in it: ascending over the range partitions
    places = durable(named.select("doc_id", "_row").distinct().repartitionByRange(*order).sortWithinPartitions(*order).select("_row", F.monotonically_increasing_id().alias("d")), "places")
    return sized_join(named, places, "_row").select("doc_id", "text", "d")


def dedup_substrings(documents: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept (the bytes that stay) of each document."""
    spark = documents.sparkSession
    prepare(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    groups = _prime(4 * parts)
    docs = _numbered(documents)
    sent = docs.select("d", "text").mapInArrow(_send(groups), "b int, a array<bigint>, u array<bigint>, d array<bigint>, p array<int>, m array<smallint>")
    decisions = durable(sent.groupBy("b").applyInArrow(_resolve(groups), _DECISION_SCHEMA), "decisions")
    dealt = docs.withColumn("db", F.pmod("d", F.lit(groups)).cast("int"))

    def still_open(name):
        return F.transform(F.filter(F.arrays_zip("kind", name), lambda z: z["kind"] > GOES), lambda z: z[name]).alias(name)

    unsettled = decisions.where(F.exists("kind", lambda k: k > GOES)).select("db", F.filter("kind", lambda k: k > GOES).alias("kind"), *map(still_open, _DECISIONS[2:]))
    strings = dealt.groupBy("db").cogroup(unsettled.groupBy("db")).applyInArrow(_fetch, "key bigint, bytes binary, d bigint, p int, m smallint")
    found = strings.repartition(parts, "key").sortWithinPartitions("key").mapInArrow(_compare(groups), _DECISION_SCHEMA)
    kind = documents.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("db").cogroup(decisions.unionByName(found).groupBy("db")).applyInArrow(_remove(kind), f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")


def op3(spark, sf_dir: str) -> DataFrame:
    out = dedup_substrings(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
