"""Operator 6, fuzzy line deduplication: SimHash, pigeonhole blocks, MinHash bands, edit similarity, one occurrence a group.

A line is what stands between line feeds; its normal form is its words (runs of [0-9a-z] and non-ASCII after
A-Z are lower-cased) joined by single spaces. Lines of equal normal form are the same line. Two different ones are
linked if they are candidates and their edit similarity, 1 - Levenshtein distance / length of the longer in code
points, is ``SIMILARITY`` or more. Of each connected group the first occurrence, by doc_id, text digest and line
number, stays; all others are removed from their documents.

Candidates: the 64 bits of a SimHash over pairs of neighbouring words are cut into six blocks. Hashes that differ in
three bits agree in three whole blocks at least, so every choice of three blocks, some 32 bits, is a bucket, and no
pair within the distance is missed. One changed word moves the SimHash of most lines further than that, so there are
``BANDS`` buckets more by the minima of ``ROWS`` hash functions over the set of word pairs of ``LONG`` bytes or more
(all pairs if there are not three such; pairs of short words are common to lines that are not alike): lines that share a
part J of these meet in one with probability 1 - (1 - J^3)^28. Lines of up to ``SHORT`` words have ``FINE_BANDS``
buckets by the minima of ``FINE_ROWS`` hash functions over their runs of ``GRAM`` bytes. Longer lines that are alike only by
single characters changed all over can still be missed (see README).

How it runs: one pass over the texts writes a row for each line. A second one over those rows deals bucket keys out
in packed arrays, so that buckets with one line, nearly all of them, are dropped by sorting arrays. A bucket that is
hot in a task is dealt by line instead. Other buckets are cut where lengths leave a gap that no alike pair has. Bucket mates are compared as in linking, without all pairs of a group and
whatever the size of a bucket. Before edit distances of lines of ``EXTENDED`` code points or more are worked out, pairs are ruled out by
lengths, by counts of their runs of ``TRIPLE`` code points and by how many of these stand at about the same places; no alike pair is. Lines
are told apart by the MD5 of their normal form.

Edge cases: lines without words always stay; null texts have no lines and stay null. Rows of equal id and text are one
document and come out alike. Null ids come last in the order. Lines may be of any length. Columns other than doc_id
and text are carried, not read, whatever their names; n_chars is set anew where it is there.
"""

from __future__ import annotations

import hashlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  as pa.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructType

from .common import _IS_WORD, _LOWER, changes, durable, fresh, lists, map_arrow, mix, prepare, row_slices, seeded, shingles, sized_join, span_hashes, text_slices, utf8, whole_groups, words
from .decontaminate import passes, shingle_filter
from .editdistance import similar
from .linking import link, starred, with_homes

DISTANCE = 3
SIMILARITY = 0.8
_EDGES = [0, 11, 22, 33, 44, 54, 64]
MASKS = [sum(((1 << _EDGES[i + 1]) - (1 << _EDGES[i])) for i in chosen) for chosen in combinations(range(6), 3)]
BANDS, ROWS, LONG = 28, 3, 8
#: Words up to which a line is also looked up by its runs of ``GRAM`` bytes.
SHORT, GRAM = 10, 5
FINE_BANDS, FINE_ROWS = 64, 4
_FACTORS = seeded(BANDS * ROWS, 6) | np.uint64(1)
_FINE_FACTORS = seeded(FINE_BANDS * FINE_ROWS, 7) | np.uint64(1)
#: Members of a bucket up to which they are compared in one task; larger buckets are dealt out in blocks.
LARGE = 1000
#: Lines whose bucket keys a task packs at a time, and bytes of them whose keys are worked out together.
PACKED, KEYED = 1 << 14, 1 << 19
#: Bytes of texts that are compared at a time, and pairs of these, but for one bucket's.
COMPARED, PAIRS = 4 << 20, 1 << 20
#: Code points of the runs whose counts rule pairs out, counters a line, and code points from which on that is cheaper than to compare.
TRIPLE, COUNTERS, EXTENDED = 3, 2048, 1280
#: Pairs that a task remembers as not alike.
REMEMBERED = 1 << 20
#: Bucket keys in a part, about; and the bits of a bucket within its part.
PART, LOW = 1 << 19, (1 << 32) - 1
#: A line's length goes with its bucket keys as the whole steps in its logarithm, up to a byte.
STEP = 0.0625
#: Code points whose runs are counted at a time.
BLOCK = 1 << 20
#: A byte as eight lanes of 8 bits, so that eight counters are summed in one word.
_LANES = np.array([sum(((n >> b) & 1) << (8 * b) for b in range(8)) for n in range(256)], np.uint64)
_BITS = np.arange(256)[:, None] >> np.arange(8) & 1


def line_offsets(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end without the line feed, text) of each line; a text has one more line than line feeds, an empty one has one."""
    feeds = np.flatnonzero(raw == 10)
    row = np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, feeds, "right") - 1])
    starts = np.concatenate([offsets[:-1], feeds + 1])
    order = np.lexsort((starts, row))
    row, starts = row[order], starts[order]
    ends = np.append(starts[1:] - 1, len(raw))
    last = np.append(row[1:] != row[:-1], True)
    ends[last] = offsets[row[last] + 1]
    return starts, ends, row


def simhash(hashes: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Of each group of feature hashes, the word whose bits are set where more than half of the features' are."""
    ends = np.cumsum(counts)
    out = np.zeros(len(counts), np.uint64)
    some = np.flatnonzero(counts)
    if not len(some):
        return out
    raw, number = hashes.astype("<u8").view(np.uint8).reshape(-1, 8), counts[some].astype(np.uint64)
    for k in range(8):
        lanes = np.add.reduceat(_LANES[raw[:, k]], ends[some] - counts[some])  # exact while a line has under 256 features
        for b in range(8):
            ones = (lanes >> np.uint64(8 * b)) & np.uint64(0xFF)
            out[some] |= (2 * ones > number).astype(np.uint64) << np.uint64(8 * k + b)
    for i in np.flatnonzero(counts >= 256).tolist():
        own = raw[ends[i] - counts[i] : ends[i]]
        ones = np.concatenate([np.bincount(own[:, k], minlength=256) @ _BITS for k in range(8)])
        out[i] = sum(1 << b for b, n in enumerate(ones.tolist()) if 2 * n > len(own))
    return out


def bands(hashes: np.ndarray, counts: np.ndarray, factors: np.ndarray = _FACTORS, rows: int = ROWS) -> np.ndarray:
    """Of each group of feature hashes, none of them empty, a 32-bit word for each band: equal if all minima of its rows are."""
    if not len(counts):
        return np.zeros((0, len(factors) // rows), np.int32)
    starts = np.cumsum(counts) - counts
    out = np.zeros((len(counts), len(factors) // rows), np.uint64)
    for i, factor in enumerate(factors):
        out[:, i // rows] = mix(out[:, i // rows] + np.minimum.reduceat(hashes * factor, starts))
    return (out >> np.uint64(32)).astype(np.uint32).view(np.int32)


def byte_grams(texts: list[bytes], size: int = GRAM) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the runs of ``size`` bytes of each text, and how many it has; a shorter text has itself."""
    sizes = np.array([len(t) for t in texts], np.int64)
    number = np.maximum(sizes - size + 1, 1)
    raw = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum(sizes) - sizes
    at = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number, number) + np.repeat(first, number)
    return span_hashes(raw, at, at + np.repeat(np.minimum(sizes, size), number)), number


def telling(starts: np.ndarray, ends: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Which word pairs of lines, as shingles gives them, the bands are made of."""
    number = np.maximum(counts - 1, 0) + (counts == 1)
    at = np.arange(int(number.sum())) - np.repeat(np.cumsum(number) - number - np.cumsum(counts) + counts, number)
    long = ends[at + np.repeat(counts > 1, number)] - starts[at] >= LONG
    sums = np.concatenate([[0], np.cumsum(long)])
    last = np.cumsum(number)
    return long | np.repeat(sums[last] - sums[last - number] < 3, number)


def line_bands(hashes: np.ndarray, counts: np.ndarray, normal: list[bytes], n_words: np.ndarray) -> pa.Array:
    """A list for each line: its bands by word pairs and, if it is short, those by runs of bytes."""
    wide = bands(hashes, counts)
    short = np.flatnonzero(n_words <= SHORT)
    fine = bands(*byte_grams([normal[i] for i in short.tolist()]), _FINE_FACTORS, FINE_ROWS)
    lengths = np.full(len(counts), BANDS)
    lengths[short] += FINE_BANDS
    at = np.cumsum(lengths) - lengths
    out = np.empty(int(lengths.sum()), np.int32)
    out[at[:, None] + np.arange(BANDS)] = wide
    out[at[short][:, None] + BANDS + np.arange(FINE_BANDS)] = fine
    return lists(out, lengths, pa.int32())


def normal_lines(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The normal forms of lines."""
    if not len(raw):
        return [b""] * len(starts)
    low = _LOWER[raw]
    inside = _IS_WORD[low]
    keep = inside.copy()
    keep[1:] |= inside[:-1]
    text = np.where(inside, low, 32)[keep].astype(np.uint8).tobytes()
    at = np.concatenate([[0], np.cumsum(keep)])
    return [text[a:b].strip(b" ") for a, b in zip(at[starts].tolist(), at[ends].tolist())]


_LINE = "digest binary, number int, line binary, node bigint, normal string"


def _lines(batch: pa.RecordBatch):
    """A row for each line with words; of equal lines of a block the first has the normal form."""
    for part, raw, at in text_slices(batch):
        starts, ends, row = line_offsets(raw, at)
        normal = normal_lines(raw, starts, ends)
        some = np.flatnonzero([len(x) > 0 for x in normal])
        own = [normal[i] for i in some.tolist()]
        digests = [hashlib.md5(x).digest() for x in own]
        node = np.frombuffer(b"".join(digests), "<i8")[::2]
        first = np.zeros(len(node), bool)
        first[np.unique(node, return_index=True)[1]] = True
        texts = [x.decode("utf-8", "replace") if f else None for x, f in zip(own, first.tolist())]
        nth = np.arange(len(row)) - np.searchsorted(row, row, "left")
        pick = pa.array(row[some])
        columns = [part.column(0).take(pick), part.column(2).take(pick), pa.array(nth[some], pa.int32()), pa.array(digests, pa.binary()), pa.array(node), pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "digest", "number", "line", "node", "normal"])


def line_keys(normal: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(key, line) of all buckets of lines, by their normal forms."""
    raw, at = utf8(normal)
    keys, lines = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i, j in row_slices(at, KEYED):
        piece, edges = raw[at[i] : at[j]], at[i : j + 1] - at[i]
        hashes, begin, end, counts = words(piece, edges)
        grams, number = shingles(hashes, counts, 2)
        kept = telling(begin, end, counts)
        sums = np.concatenate([[0], np.cumsum(kept)])
        held = sums[np.cumsum(number)] - sums[np.cumsum(number) - number]
        data = piece.tobytes()
        own = [data[a:b] for a, b in zip(edges[:-1].tolist(), edges[1:].tolist())]
        band = line_bands(grams[kept], held, own, counts)
        key, line = bucket_keys(simhash(grams, number), band.flatten().to_numpy(), np.asarray(band.value_lengths()).astype(np.int64))
        keys.append(key)
        lines.append(line + i)
    return np.concatenate(keys), np.concatenate(lines)


def _held(batch: pa.RecordBatch, filter_words: np.ndarray):
    """The rows whose node, the first column, passes a filter."""
    yield batch.filter(pa.array(passes(filter_words, batch.column(0).to_numpy().view(np.uint64))))


def _with_digest(documents: DataFrame) -> DataFrame:
    return documents.select("doc_id", "text", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))).alias("digest"))


# Candidates ------------------------------------------------------------------------------------


def bucket_keys(sim: np.ndarray, band: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(key, line) of all buckets of lines, from their SimHashes and the lists of their bands end to end."""
    n = len(sim)
    blocks = [mix((sim & np.uint64(m)) ^ np.uint64(i + 1)) for i, m in enumerate(MASKS)]
    nth = np.arange(len(band)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    banded = mix((band.view(np.uint32).astype(np.uint64) << np.uint64(16)) + (nth + len(MASKS) + 1).astype(np.uint64))
    return np.concatenate([*blocks, banded]).view(np.int64), np.concatenate([np.tile(np.arange(n), len(MASKS)), np.repeat(np.arange(n), lengths)])


def _pack(parts: int, most: int, keys_of=line_keys):
    """Rows (part, base, keys, places, hot, n): n bucket keys of a task's lines, dealt by key; the lines of a hot bucket by line.

    Rows come in the order of their places. A bucket is hot if ``most`` lines that are packed together, or more, are in it.
    A part of its lines is negative. The bucket's own part gets its key, as hot, and its first line. Places are three bytes above the base,
    and go with a byte for the line's length and three of its digest. Keys of a part ascend and are sent as differences; keys and places are
    compressed byte by byte of all of them, as the upper ones say little.
    """

    def flush(held):
        table = pa.Table.from_batches(held).combine_chunks()
        at = np.sort(np.unique(table.column("node").to_numpy(), return_index=True)[1])
        table = table.take(pa.array(at)).combine_chunks()
        place = table.column("place").to_numpy()
        base = int(place[0])
        normal = table.column("normal").combine_chunks()
        key, line = keys_of(normal)
        # parts are ranges of keys; within its part a bucket is 32 bits, of which only these are sent
        key = ((key >> 32) + (1 << 31)) * parts >> 32 << 32 | key & LOW
        order = np.argsort(key)
        # with a place, the line's length, and three bytes of its digest, by which equal lines of other tasks are told
        length = np.minimum(np.log(np.maximum(pa.compute.utf8_length(normal).to_numpy(), 1)) / STEP, 255).astype(np.int64)
        mark = (place - base) | length << 24 | (table.column("node").to_numpy() & 0xFFFFFF) << 32
        key, member = key[order], mark[line[order]]
        first = np.flatnonzero(changes(key))
        size = np.diff(np.append(first, len(key)))
        rows = []
        if (size >= most).any():
            hot = np.repeat(size >= most, size)
            lead = np.zeros(len(key), bool)
            lead[first] = True
            away = -1 - np.mod(member[hot], parts)
            order = np.argsort(away, kind="stable")
            rows += spread(base, away[order], key[hot][order], member[hot][order], None)
            key, member, shared = key[lead | ~hot], member[lead | ~hot], hot[lead | ~hot]
        else:
            shared = np.zeros(len(key), bool)
        rows += spread(base, key >> 32, key, member, shared)
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.int32()))], ["part", "base", "keys", "places", "hot", "n"])

    def spread(base, part, key, member, shared):
        edges = np.append(np.flatnonzero(changes(part)), len(part)).tolist()
        places = member.astype("<i8").view(np.uint8).reshape(-1, 8)[:, :7]
        if shared is None:
            return [(int(part[a]), base, _squeezed(key[a:b]), _squeezed(places[a:b]), b"", b - a) for a, b in zip(edges, edges[1:])]
        low = (key & LOW).astype("<u4")
        return [(int(part[a]), base, _squeezed(np.diff(low[a:b], prepend=low[:1] * 0)), _squeezed(places[a:b]), key[a:b][shared[a:b]].tobytes(), b - a) for a, b in zip(edges, edges[1:])]

    def run(batches):
        held, n, start = [], 0, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            place = batch.column(0).to_numpy()
            # a batch may go on in another task's rows
            for a, b in zip([0, *(np.flatnonzero(np.diff(place >> 40)) + 1).tolist()], [*(np.flatnonzero(np.diff(place >> 40)) + 1).tolist(), len(place)]):
                if held and (n >= PACKED or int(place[b - 1]) - start >= 1 << 24 or int(place[a]) < start):
                    yield flush(held)
                    held, n = [], 0
                start = start if held else int(place[a])
                held.append(batch.slice(a, b - a))
                n += b - a
        if held:
            yield flush(held)

    return run


def _squeezed(values: np.ndarray) -> bytes:
    """Numbers, or rows of bytes, all first bytes first, compressed."""
    return pa.compress(np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes(), codec="zstd", asbytes=True)


def _widened(data: bytes, n: int, width: int) -> np.ndarray:
    """The n rows of ``width`` bytes that _squeezed has compressed."""
    return np.ascontiguousarray(np.frombuffer(pa.decompress(data, decompressed_size=n * width, codec="zstd", asbytes=True), np.uint8).reshape(width, n).T)


def _alone(keys: np.ndarray) -> np.ndarray:
    """Which of ascending keys stand once."""
    new = changes(keys)
    return new & np.append(new[1:], True)[: len(new)]


def _unpack(key, table, least: float = SIMILARITY):
    """(bucket, first place, place) for the lines of buckets of two or more; (bucket, null, place) for those of hot buckets.

    A bucket is cut in two where its lines' lengths leave a gap that no alike pair has.
    """
    hot = np.frombuffer(b"".join(table.column("hot").to_pylist()), np.int64)
    part, each = key[0].as_py(), table.column("n").to_pylist()
    wide = np.zeros((sum(each), 8), np.uint8)
    wide[:, :7] = np.concatenate([_widened(x, n, 7) for x, n in zip(table.column("places").to_pylist(), each)])
    mark = wide.view("<i8").ravel()
    place = (mark & 0xFFFFFF) + np.repeat(table.column("base").to_numpy(), each)
    width = 8 if part < 0 else 4
    keys = [_widened(x, n, width).view(f"<u{width}").ravel() for x, n in zip(table.column("keys").to_pylist(), each)]
    if part < 0:
        keys = np.concatenate(keys).view(np.int64)
        return pa.Table.from_arrays([pa.array(keys), pa.nulls(len(keys), pa.int64()), pa.array(place)], ["bucket", "a", "b"])
    # a word holds a bucket's 32 bits, then a line's digest and length
    word = np.concatenate([np.cumsum(k, dtype=np.uint64) for k in keys]) << np.uint64(32) | (mark >> 24).view(np.uint64)
    order = np.argsort(word)
    word = word[order]
    hot = np.unique(hot) & LOW
    lit = np.isin(word >> np.uint64(32), hot.view(np.uint64)) if len(hot) else np.zeros(len(word), bool)
    # nearly all buckets have one line, and go before the rest is looked at
    kept = ~_alone(word >> np.uint64(32)) | lit
    word, place, lit = word[kept], place[order[kept]], lit[kept]
    # of equal lines the first stands for all; unlike lines of a bucket and a length are taken for equal with probability 2**-24
    first = np.flatnonzero(changes(word))
    place = np.minimum.reduceat(place, first) if len(word) else place
    word, lit = word[first], lit[first]
    kept = ~_alone(word >> np.uint64(32)) | lit
    place, lit = place[kept], lit[kept]
    keys, mark = (word[kept] >> np.uint64(32)).view(np.int64) | part << 32, (word[kept] & np.uint64(LOW)).view(np.int64)
    length = np.where(lit, 0, mark & 0xFF)
    order = np.lexsort((place, length, keys))
    keys, place, length, lit = (c[order] for c in (keys, place, length, lit))
    whole = changes(keys)
    new = whole | (np.diff(length, prepend=length[:1]) > widest(least))
    # the cuts of a bucket are numbered above its 32 bits and its part
    nth = np.cumsum(new) - 1
    nth -= np.maximum.accumulate(np.where(whole, nth, 0))
    first = np.minimum.reduceat(place, np.flatnonzero(new)) if len(keys) else place
    first = np.repeat(first, np.diff(np.append(np.flatnonzero(new), len(keys)))) if len(keys) else place
    kept = (place != first) | lit
    return pa.Table.from_arrays([pa.array((keys | nth << 55)[kept]), pa.array(first[kept], mask=lit[kept]), pa.array(place[kept])], ["bucket", "a", "b"])


def widest(least: float) -> int:
    """Steps between the lengths of two alike lines at most; both are rounded down."""
    return int(-np.log(max(least, 1e-9)) / STEP + 1e-6) + 1


# Comparing -------------------------------------------------------------------------------------


def _linked(batches, least: float):
    """Of rows (a, b, x, y), the pairs (a, b) whose texts x and y are alike; many rows at a time."""

    def flush(held):
        a, b, x, y = (pa.concat_arrays([h.column(i) for h in held]) for i in range(4))
        texts = pa.concat_arrays([x, y]).dictionary_encode()
        own, place = texts.dictionary.to_pylist(), texts.indices.to_numpy().reshape(2, -1)
        keep = worth(own, np.array([len(t) for t in own], np.int64), *place, least)
        keep = pa.array(keep[similar([own[i] for i in place[0][keep].tolist()], [own[i] for i in place[1][keep].tolist()], least)])
        return pa.RecordBatch.from_arrays([a.take(keep), b.take(keep)], ["a", "b"])

    held, size, rows = [], 0, 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size, rows = size + batch.nbytes, rows + batch.num_rows
        if size > COMPARED or rows > 1 << 14:
            yield flush(held)
            held, size, rows = [], 0, 0
            pa.default_memory_pool().release_unused()
    if held:
        yield flush(held)


class Groups:
    """Which groups of a task's lines are linked by now."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def of(self, group: int) -> int:
        parent = self.parent
        while (up := parent.get(group, group)) != group:
            parent[group] = group = parent.get(up, up)
        return group


def run_counts(texts: list[str]) -> np.ndarray:
    """Counters of each text's runs of ``TRIPLE`` code points, by their hashes, up to 255 each."""
    out = np.zeros((len(texts), COUNTERS), np.uint8)
    sizes = np.array([len(t) for t in texts], np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(texts):
        j = max(i + 1, min(i + 1024, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BLOCK))))
        codes = np.frombuffer("".join(texts[i:j]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        if len(codes) >= TRIPLE:
            n = len(codes) - TRIPLE + 1
            run = np.zeros(n, np.uint64)
            for k in range(TRIPLE):
                run = run * np.uint64(0x9E3779B97F4A7C15) + codes[k : n + k]
            slot = (mix(run) % np.uint64(COUNTERS)).astype(np.int64)
            row = np.repeat(np.arange(j - i), sizes[i:j])[:n]
            inside = ends[i:j][row] - (ends[i - 1] if i else 0) - np.arange(n) >= TRIPLE
            own = np.bincount(row[inside] * COUNTERS + slot[inside], minlength=(j - i) * COUNTERS).reshape(j - i, COUNTERS)
            out[i:j] = np.minimum(own, 255)
        i = j
    return out


def plausible(text: list[str], a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of lines may be alike: an edit changes at most ``2 * TRIPLE`` counts by one, and sums of counts no more."""
    size, counts = np.array([len(t) for t in text], np.int64), run_counts(text)
    longer = np.maximum(size[a], size[b])
    most = ((1 - least) * longer + 1e-9).astype(np.int64)
    kept = np.flatnonzero(longer - np.minimum(size[a], size[b]) <= most)
    for own in (counts.reshape(len(counts), 8, -1).sum(1, dtype=np.int16), counts.astype(np.int16)):
        good = []
        for i in range(0, len(kept), 4096):
            part = kept[i : i + 4096]
            apart = np.abs(own[a[part]] - own[b[part]]).sum(1, dtype=np.int64)
            good.append(part[apart <= 2 * TRIPLE * most[part]])
        kept = np.concatenate([kept[:0], *good])
    return kept[in_place(text, a[kept], b[kept], least)]


def worth(text: list[str], size: np.ndarray, a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs of lines of these sizes to compare: long ones must be plausible, of others the comparison costs no more than to ask."""
    long = np.maximum(size[a], size[b]) >= EXTENDED
    kept = ~long
    some = np.flatnonzero(long)
    if len(some):
        used, place = np.unique(np.concatenate([a[some], b[some]]), return_inverse=True)
        kept[some[plausible([text[i] for i in used.tolist()], place[: len(some)], place[len(some) :], least)]] = True
    return np.flatnonzero(kept)


def placed_runs(text: str) -> np.ndarray:
    """Sorted words of the hash and the place of each run of ``TRIPLE`` code points."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(len(codes) - TRIPLE + 1, 0)
    run = np.zeros(n, np.uint64)
    for k in range(TRIPLE):
        run = run * np.uint64(0x9E3779B97F4A7C15) + codes[k : n + k]
    return np.sort((mix(run) >> np.uint64(29) << np.uint64(28)).view(np.int64) | np.arange(n))


def in_place(text: list[str], a: np.ndarray, b: np.ndarray, least: float) -> np.ndarray:
    """Which pairs have enough runs at about the same places: an edit touches ``TRIPLE`` runs, and moves none further than the limit."""
    known: dict[int, np.ndarray] = {}
    kept, held = [], 0
    for k, (i, j) in enumerate(zip(a.tolist(), b.tolist())):
        if len(text[i]) < len(text[j]):
            i, j = j, i
        most = int((1 - least) * len(text[i]) + 1e-9)
        for x in (i, j):
            if x not in known:
                if held > COMPARED:
                    known, held = {}, 0
                known[x] = placed_runs(text[x])
                held += len(text[x])
        own = known[i] if i in known else placed_runs(text[i])
        other = known[j]
        if len(own) > TRIPLE * most and len(other):
            at = np.searchsorted(other, own - most)
            found = other[np.minimum(at, len(other) - 1)]
            met = int(((found >= own - most) & (found <= own + most)).sum())
        else:
            met = 0
        if met >= len(own) - TRIPLE * most:
            kept.append(k)
    return np.array(kept, np.int64)


def mate_pairs(line: np.ndarray, bucket: np.ndarray, side: np.ndarray, size: np.ndarray, group: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of lines of different groups that share a bucket and may be alike by their lengths; each pair once.

    Members come bucket by bucket, ascending by ``size`` of their lines; ``group`` is a line's.
    """
    place = np.cumsum(changes(bucket)) << 40
    last = np.searchsorted(place + size[line], place + (size[line] / least + 1e-6).astype(np.int64), "right")
    later = np.maximum(last - np.arange(len(line)) - 1, 0)
    first = np.repeat(np.arange(len(line)), later)
    second = first + 1 + np.arange(len(first)) - np.repeat(np.cumsum(later) - later, later)
    other = (group[line[first]] != group[line[second]]) & ((side[first] < 0) | (side[first] != side[second]))
    a, b = line[first[other]], line[second[other]]
    key = np.unique(np.minimum(a, b) * len(size) + np.maximum(a, b))
    return key // max(len(size), 1), key % max(len(size), 1)


class Apart:
    """Pairs that a task has compared and found not alike, by 64-bit hashes; emptied beyond ``most``, which costs time and nothing else."""

    def __init__(self, most: int = REMEMBERED):
        self.most, self.keys = most, np.zeros(0, np.uint64)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, keys)
        return self.keys[np.minimum(at, len(self.keys) - 1)] == keys if len(self.keys) else np.zeros(len(keys), bool)

    def add(self, keys: np.ndarray) -> None:
        keys = np.sort(np.concatenate([self.keys, keys] if len(self.keys) + len(keys) <= self.most else [keys[-self.most :]]), kind="stable")
        self.keys = keys[changes(keys)]


def compared(text: list[str], line: np.ndarray, bucket: np.ndarray, side: np.ndarray, group: np.ndarray, least: float, names: np.ndarray, apart: Apart) -> list[tuple[int, int]]:
    """Pairs of alike lines that join all groups of lines that alike bucket mates join, each pair once; see ``mate_pairs``.

    ``names`` are 64-bit names of the lines, by which pairs are remembered.
    """
    size = np.array([len(t) for t in text], np.int64)
    a, b = mate_pairs(line, bucket, side, size, group, least)
    pair = mix(names[a].view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15) + mix(names[b].view(np.uint64))
    new = ~apart.has(pair)
    a, b, pair = a[new], b[new], pair[new]
    kept = worth(text, size, a, b, least)
    a, b, pair = a[kept], b[kept], pair[kept]
    groups, links, unlike = Groups(), [], [pair[:0]]
    step = 1 << 13
    while len(a):
        # in small steps at first, as what they join need not be compared any more, but enough at a time to go together
        x, y = a[:step].tolist(), b[:step].tolist()
        alike = similar([text[i] for i in x], [text[i] for i in y], least)
        unlike.append(pair[:step][~alike])
        for i in np.flatnonzero(alike).tolist():
            u, v = groups.of(int(group[x[i]])), groups.of(int(group[y[i]]))
            if u != v:
                groups.parent[u] = v
                links.append((x[i], y[i]))
        a, b, pair = a[step:], b[step:], pair[step:]
        root = np.array([groups.of(g) for g in group.tolist()], np.int64)
        open_ = root[a] != root[b]
        a, b, pair = a[open_], b[open_], pair[open_]
        step = min(2 * step, 1 << 14)
    apart.add(np.concatenate(unlike))
    return links


def _alike(least: float):
    """Of rows (home, bucket, node, group, side, normal) in the homes' order, links that join all groups of a bucket that any links join."""

    def run(batches):
        tables: list[pa.Table] = []
        apart = Apart()
        held = pairs = 0

        def flush():
            table = pa.concat_tables(tables)
            nodes, first, line = np.unique(table.column("node").to_numpy(), return_index=True, return_inverse=True)
            text = table.column("normal").take(pa.array(first)).to_pylist()
            group = np.unique(table.column("group").to_numpy()[first], return_inverse=True)[1]
            bucket, size = table.column("bucket").to_numpy(), np.array([len(t) for t in text])[line]
            order = np.lexsort((line, size, bucket))
            links = compared(text, line[order], bucket[order], table.column("side").to_numpy()[order], group, least, nodes, apart)
            a, b = (nodes[[x[i] for x in links]] for i in (0, 1)) if links else (nodes[:0], nodes[:0])
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        for table in whole_groups(batches, "home"):
            # a table may hold many homes; all buckets of one go together, so that pairs that meet in several are compared once
            table = table.sort_by([("home", "ascending"), ("bucket", "ascending")]).combine_chunks()
            home, bucket = table.column("home").to_numpy(), table.column("bucket").to_numpy()
            edges = np.append(np.flatnonzero(changes(home, bucket)), len(home))
            last = np.append(home[edges[:-1]][1:] != home[edges[:-1]][:-1], True).tolist()
            weight = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.binary_length(table.column("normal"))))])[edges].tolist()
            start, edges = 0, edges.tolist()
            for k, (a, b) in enumerate(zip(edges, edges[1:])):
                held, pairs = held + weight[k + 1] - weight[k], pairs + (b - a) * (b - a - 1) // 2
                if pairs > PAIRS or held > COMPARED and last[k]:
                    tables.append(table.slice(start, b - start))
                    yield flush()
                    tables, held, pairs, start = [], 0, 0, b
            if start < len(home):
                tables.append(table.slice(start))
        if tables:
            yield flush()

    return run


def line_groups(documents: DataFrame, least: float = SIMILARITY, large: int = LARGE) -> tuple[DataFrame, DataFrame]:
    """(a row for each occurrence: doc_id, digest, number, line, ...; labels of linked lines: line, label)."""
    spark = documents.sparkSession
    prepare(spark)
    kind = documents.schema["doc_id"].dataType.simpleString()
    # a line's place is its task's number and, below 2**40, its own
    numbered = map_arrow(_with_digest(documents), _lines, f"doc_id {kind}, {_LINE}").withColumn("place", F.shiftleft(F.spark_partition_id().cast("bigint"), 40) + F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1))
    seen = durable(numbered, "lines")
    n = seen.count()
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), n * (len(MASKS) + BANDS) // PART)
    # a part that gets one key from every flush stays as small as others
    hot = max(2, PART // (2 * (n // PACKED + parts)))
    packed = seen.where("normal is not null").select("place", "node", "normal").mapInArrow(_pack(parts, hot), "part int, base bigint, keys binary, places binary, hot binary, n int")
    stars = durable(packed.groupBy("part").applyInArrow(lambda key, table: _unpack(key, table, least), "bucket bigint, a bigint, b bigint"), "stars")
    common = durable(stars.where("a is null").select("bucket", F.col("b").alias("node")).distinct(), "hot-members")
    if common.limit(1).count():
        stars = durable(stars.where("a is not null").union(starred(common)), "stars")
    # pairs, which are far fewer than the buckets that hold them, go by the lines' digests from here on
    pairs = durable(stars.select("a", "b").distinct(), "place-pairs")
    known = durable(pairs.select("a").union(pairs.select("b")).distinct().toDF("place"), "wanted-places")
    known = durable(sized_join(seen.where("normal is not null").select("place", "node"), known, "place", "left_semi", skewed=False), "wanted-nodes")
    named = pairs.select(F.struct("a", "b").alias("at"), "a", "b")
    for c in ("a", "b"):
        named = sized_join(named, known.toDF(c, f"{c}_node"), c, skewed=c == "a")
    named = durable(named.select("at", F.col("a_node").alias("a"), F.col("b_node").alias("b")).where("a <> b"), "pairs")
    wanted = durable(known.select("node").distinct(), "wanted-lines")
    # nodes are 64 bits of a line's digest; should two candidates share one, the least stands for it and the other stays as it is
    # a filter of bounded size keeps most others' texts out of the shuffle
    sent = spark.sparkContext.broadcast(shingle_filter(wanted.select(F.col("node").alias("gram"))))
    texts = map_arrow(seen.where("normal is not null").select("node", "normal", "line"), lambda batch: _held(batch, sent.value), "node bigint, normal string, line binary")
    texts = sized_join(texts, wanted, "node", "left_semi", skewed=False)
    texts = durable(texts.groupBy("node").agg(F.min(F.struct("normal", "line")).alias("m")).select("node", "m.normal", "m.line"), "line-texts")

    # texts count by their bytes where it is asked whether they can be broadcast
    weight = 1 + F.length("normal") / 64
    # given as numbers, so that few bytes that take long to compare are not put in few tasks
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def verify(pairs: DataFrame) -> DataFrame:
        sides = pairs.repartition(tasks, "a", "b")
        for c, name in (("a", "x"), ("b", "y")):
            # the first of many buckets' lines is an a in all of them; a b is one in each of its own at most
            sides = sized_join(sides, texts.select(F.col("node").alias(c), F.col("normal").alias(name)), c, cost=1 + F.length(name) / 64, skewed=c == "a")
        return sides.select("a", "b", "x", "y").mapInArrow(lambda batches: _linked(batches, least), "a bigint, b bigint")

    def mates(rows: DataFrame) -> DataFrame:
        known = sized_join(with_homes(rows), texts.select("node", "normal"), "node", cost=weight).select("home", "bucket", "node", "group", "side", "normal")
        return known.repartition(tasks, "home").sortWithinPartitions("home").mapInArrow(_alike(least), "a bigint, b bigint")

    def members(apart: DataFrame) -> DataFrame:
        at = durable(sized_join(named.select("at", F.struct("a", "b").alias("pair")), apart, "pair", "left_semi").select("at"), "apart-places")
        buckets = durable(sized_join(stars.select("bucket", F.struct("a", "b").alias("at")), at, "at", "left_semi").select("bucket").distinct(), "open-buckets")
        rows = sized_join(stars.select("bucket", F.col("b").alias("place")), buckets, "bucket", "left_semi")
        return sized_join(rows, known, "place").select("bucket", "node").distinct()

    labels = link(named, verify, mates, large, members=members)
    return seen, labels.join(texts, "node").select("line", "label")


def _row_key() -> Column:
    """A document's row as text: its id and its text's digest."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.md5(F.coalesce("text", F.lit("")).cast("binary")))


def dropped_lines(documents: DataFrame, least: float = SIMILARITY, large: int = LARGE) -> DataFrame:
    """(row: the document's id and digest as text, numbers: its lines that go)."""
    seen, labels = line_groups(documents, least, large)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "digest", "number")
    # the labels of linked lines, far fewer than lines, and a line may be very common
    named = sized_join(seen.select("doc_id", "digest", "number", "line"), labels, "line", "left")
    named = durable(named.select("doc_id", "digest", "number", F.coalesce(F.unhex(F.hex("label")), "line").alias("label")), "named-lines")
    firsts = durable(named.groupBy("label").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select("label", "first"), "first-lines")
    goes = sized_join(named, firsts, "label").where(place != F.col("first"))
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.lower(F.hex("digest")))
    return durable(goes.groupBy(row.alias("row")).agg(F.sort_array(F.collect_set("number")).alias("numbers")), "dropped-lines")


def dedup_lines(documents: DataFrame, total: str = "_n_lines", lost: str = "_n_dropped") -> DataFrame:
    """documents with their remaining lines as text, and the numbers of lines and of dropped lines in two more columns."""
    names = documents.columns
    row, numbers = fresh(documents, "row"), fresh(documents, "numbers")
    gone = dropped_lines(documents).toDF(row, numbers)
    joined = sized_join(documents.withColumn(row, _row_key()), gone, row, "left", cost=1 + F.size(numbers) / 8, skewed=False).drop(row)
    at, length = names.index("text"), names.index("n_chars") if "n_chars" in names else None

    def run(batch):
        texts, all_lines, dropped = [], [], []
        for text, own in zip(batch.column(at).to_pylist(), batch.column(len(names)).to_pylist()):
            lines = text.split("\n") if text is not None else []
            drop = set(own or ())
            texts.append("\n".join([x for i, x in enumerate(lines) if i not in drop]) if drop else text)
            all_lines.append(len(lines))
            dropped.append(len(drop))
        columns = list(batch.columns[: len(names)])
        columns[at] = pa.array(texts, columns[at].type)
        if length is not None:
            columns[length] = pa.array([None if t is None else len(t) for t in texts], columns[length].type)
        yield pa.RecordBatch.from_arrays([*columns, pa.array(all_lines, pa.int32()), pa.array(dropped, pa.int32())], [*names, total, lost])

    return map_arrow(joined, run, StructType(list(documents.schema.fields)).add(total, IntegerType()).add(lost, IntegerType()))


def without_repeated_lines(documents: DataFrame) -> DataFrame:
    """The documents without repeated lines; one that had words and has none left goes."""
    total, lost = fresh(documents, "n_lines"), fresh(documents, "n_dropped")
    out = dedup_lines(documents, total, lost)
    return out.where((F.col(lost) == 0) | F.col("text").rlike(r"[0-9A-Za-z]|[^\x00-\x7F]")).select(*documents.columns)


def op6(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    kept = F.sha2(F.coalesce(F.col("text").cast(StringType()), F.lit("")), 256)
    return out.select("doc_id", F.col("_n_lines").cast("bigint").alias("n_lines"), F.col("_n_dropped").cast("bigint").alias("n_dropped"), kept.alias("kept_sha256"))
