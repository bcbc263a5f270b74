"""Operator 4, near duplicates by BagMinHash signatures of weighted shingles.

A text is the multiset of its ``SHINGLE``-word shingles (all its words if it has fewer); two texts are linked if
the weighted Jaccard similarity of their multisets, sum of minima over sum of maxima, is ``SIMILARITY`` or more. Groups are
the connected components of all links; texts that are equal are in one group whatever they hold.

Signatures: weights are discretised at the whole numbers, and the range [0, w) of a shingle of weight w is
covered by [0, 1), [1, 2), [2, 4), ... Each of these has a Poisson process of points in time, fixed by the shingle's hash, with
the rate of its width. Its first point is drawn; only if that comes before the text's time limit is the
range halved, the point goes to one half and the other draws its own next point, down to unit ranges, whose points follow one by
one. So heavy shingles cost what their few early points cost. Each point falls on one of ``REGISTERS`` registers, which keep
their earliest: two registers agree with the probability of the weighted Jaccard similarity. A text whose registers are not
all filled doubles its time limit.

Every ``BAND`` registers make a bucket. At a similarity of 0.8 all 21 bands miss with probability 3e-7. Bucket mates
are compared by exact multiset overlap (see linking: no pairs within groups of copies, and no link is lost for the
groups). Texts are told apart by their MD5; shingles by 64-bit hashes.

Edge cases: null counts as the empty text; texts without words are grouped with equal texts only. Repeated rows are
returned once each. The group's id is its least doc_id, null only if all are. Only doc_id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import changes, durable, fresh, lists, map_arrow, mix, prepare, seeded, shingles, sized_join, text_slices, whole_groups, words
from .linking import link, starred

SHINGLE = 5
SIMILARITY = 0.8
REGISTERS = 63
BAND = 3
#: Members of a bucket up to which they are compared in one task, by products of ``COLUMNS`` shingles at a time; larger
#: buckets are dealt out in blocks.
LARGE = 1000
COLUMNS = 2048
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_U = np.uint64


def weights(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, 44-bit hash, weight) of the distinct shingles of each text, for fewer than 2**20 texts."""
    row = np.repeat(np.arange(len(counts), dtype=np.uint64), counts)
    key = np.sort((row << _U(44)) | (hashes >> _U(20)))
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])
    return (key[first] >> _U(44)).astype(np.int64), key[first] & _U((1 << 44) - 1), np.diff(np.append(first, len(key)))


def _draw(h: np.ndarray) -> np.ndarray:
    """Exponential with rate one."""
    return -np.log(((h >> _U(11)).astype(np.float64) + 1) * 2.0**-53)


def signatures(row: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, registers: int = REGISTERS) -> np.ndarray:
    """The registers of n texts from their weighted elements; 2**64-1 in all of a text without elements."""
    out = np.full(n * registers, _EMPTY, np.uint64)
    total = np.bincount(row, weight, minlength=n)
    limit = np.where(total > 0, registers * (np.log(registers) + 4) / np.maximum(total, 1), 0)

    def keep(r, x, point):
        mark = mix(point ^ _U(0x5851F42D4C957F2D))
        slot = r * registers + ((mark >> _U(32)) % _U(registers)).astype(np.int64)
        np.minimum.at(out, slot, (x.astype(np.float32).view(np.uint32).astype(np.uint64) << _U(32)) | (mark & _U(0xFFFFFFFF)))

    chosen = np.arange(len(row))
    while len(chosen):
        _points(row[chosen], element[chosen], weight[chosen], limit, keep)
        short = (out.reshape(n, registers) == _EMPTY).any(1) & (total > 0)
        limit = np.where(short, 2 * limit, 0)
        chosen = np.flatnonzero(short[row])
    return out.reshape(n, registers)


def _points(row, element, weight, limit, keep) -> None:
    """Gives keep all points before the limit of each element's ranges below its weight."""
    leaves = [(row, mix(element * _U(2) + _U(1)), np.zeros(len(row)))]
    b = 1
    nodes = []
    while True:
        lower, own = 1 << (b - 1), np.flatnonzero(weight > 1 << (b - 1))
        if not len(own):
            break
        seed = mix(mix(element[own] * _U(2) + _U(1)) + _U(b))
        if lower == 1:
            leaves.append((row[own], seed, np.zeros(len(own))))
        else:
            point = mix(seed + _U(1))
            nodes.append((row[own], seed, _draw(point) / lower, point, np.full(len(own), lower), np.full(len(own), lower), weight[own]))
        b += 1
    while nodes:
        r, seed, x, point, low, width, w = (np.concatenate(c) for c in zip(*nodes))
        nodes = []
        ok = np.flatnonzero((x < limit[r]) & (low < w))
        r, seed, x, point, low, width, w = (c[ok] for c in (r, seed, x, point, low, width, w))
        if not len(r):
            break
        single = width == 1
        keep(r[single], x[single], point[single])
        leaves.append((r[single], seed[single], x[single]))
        r, seed, x, point, low, width, w = (c[~single] for c in (r, seed, x, point, low, width, w))
        whole = low + width <= w
        keep(r[whole], x[whole], point[whole])
        half = width // 2
        side = (mix(point + _U(3)) & _U(1)).astype(np.int64)  # which half the point falls in
        for s in (0, 1):
            own = mix(seed * _U(2) + _U(5 + s))
            fresh = mix(own + _U(1))
            has = side == s
            nodes.append((r, own, np.where(has, x, x + _draw(fresh) / half), np.where(has, point, fresh), low + s * half, half, w))
    r, seed, x = (np.concatenate(c) for c in zip(*leaves))
    done, step = 0, 1
    while len(r):
        at = np.arange(done, done + step, dtype=np.uint64)
        point = mix(seed[:, None] + (at + _U(7)) * _U(0x9E3779B97F4A7C15))
        times = x[:, None] + np.cumsum(_draw(point), 1)
        i, j = np.nonzero(times < limit[r][:, None])
        keep(r[i], times[i, j], point[i, j])
        x = times[:, -1]
        go = np.flatnonzero(x < limit[r])
        r, seed, x = r[go], seed[go], x[go]
        done, step = done + step, min(64, step * 2)


def _buckets(batch: pa.RecordBatch, k: int):
    for part, raw, at in text_slices(batch):
        hashes, _, _, counts = words(raw, at)
        grams, number = shingles(hashes, counts, k)
        n = part.num_rows
        marks = signatures(*weights(grams, number), n)
        some = np.flatnonzero(number > 0)
        marks = marks[some].reshape(len(some), REGISTERS // BAND, BAND)
        bucket = np.zeros(marks.shape[:2], np.uint64) + mix(np.arange(marks.shape[1], dtype=np.uint64) + _U(99))
        for i in range(BAND):
            bucket = mix(bucket ^ marks[:, :, i]) + _U(1)
        yield pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64).ravel()), part.column(1).take(pa.array(np.repeat(some, bucket.shape[1])))], ["bucket", "node"])


def _multisets(batch: pa.RecordBatch, k: int):
    """(node, keys) with a key for each shingle and occurrence, in order."""
    for part, raw, at in text_slices(batch):
        hashes, _, _, counts = words(raw, at)
        grams, number = shingles(hashes, counts, k)
        row = np.repeat(np.arange(len(number)), number)
        order = np.lexsort((grams, row))
        grams = grams[order]
        index = np.arange(len(grams))
        new = np.append(True, (grams[1:] != grams[:-1]) | (row[1:] != row[:-1]))[: len(grams)]
        nth = (index - np.maximum.accumulate(np.where(new, index, 0))).astype(np.uint64)
        keys = mix(grams + nth * _U(0x9E3779B97F4A7C15))
        keys = keys[np.lexsort((keys, row))]
        yield pa.RecordBatch.from_arrays([part.column(1), lists(keys.view(np.int64), number, pa.int64())], ["node", "keys"])


def _similar(batch: pa.RecordBatch, least: float):
    a, b, x, y = (batch.column(i) for i in range(4))
    ok = []
    for i in range(batch.num_rows):
        u, v = x[i].values.to_numpy(), y[i].values.to_numpy()
        n, m = len(u), len(v)
        both = 0
        if min(n, m) >= least * max(n, m):
            merged = np.sort(np.concatenate([u, v]))
            both = int((merged[1:] == merged[:-1]).sum())
        ok.append(both >= least * (n + m - both) and both > 0)
    keep = pa.array(np.flatnonzero(ok))
    yield pa.RecordBatch.from_arrays([a.take(keep), b.take(keep)], ["a", "b"])


def _alike(least: float):
    """Of rows (bucket, node, group, side, keys) in the buckets' order, a similar pair for each two groups that have one."""

    def run(batches):
        for table in whole_groups(batches, "bucket"):
            bucket = table.column("bucket").to_numpy()
            first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            a, b = [], []
            for lo, hi in zip(first.tolist(), [*first[1:].tolist(), len(bucket)]):
                part = table.slice(lo, hi - lo).combine_chunks()
                keys, size = part.column("keys").combine_chunks(), np.asarray(part.column("keys").combine_chunks().value_lengths())
                value, inverse, count = np.unique(keys.flatten().to_numpy(), return_inverse=True, return_counts=True)
                shared = np.flatnonzero(count > 1)
                column = np.full(len(value), -1)
                column[shared] = np.arange(len(shared))
                row, column = np.repeat(np.arange(len(size)), size), column[inverse]
                both = np.zeros((len(size), len(size)), np.float32)
                order = np.argsort(column, kind="stable")
                row, column = row[order], column[order]
                for at in range(0, len(shared), COLUMNS):
                    i, j = np.searchsorted(column, [at, at + COLUMNS])
                    block = np.zeros((len(size), COLUMNS), np.float32)
                    block[row[i:j], column[i:j] - at] = 1
                    both += block @ block.T
                group = part.column("group").combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
                similar = (both >= least * (size[:, None] + size[None, :] - both)) & (both > 0) & (group[:, None] < group[None, :])
                side = part.column("side").to_numpy()
                similar &= (side[:, None] != side[None, :]) | (side[:, None] < 0)
                i, j = np.nonzero(similar)
                _, once = np.unique(group[i] << 32 | group[j], return_index=True)
                node = part.column("node").to_pylist()
                for x, y in zip(i[once].tolist(), j[once].tolist()):
                    a.append(min(node[x], node[y]))
                    b.append(max(node[x], node[y]))
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])

    return run


def text_nodes(documents: DataFrame) -> DataFrame:
    """documents with ``node``, the MD5 of the text, null as empty."""
    return documents.withColumn("node", F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary"))))


def near_groups(documents: DataFrame, k: int = SHINGLE, least: float = SIMILARITY, large: int = LARGE) -> DataFrame:
    """(node, label) of the texts that are linked with a different one."""
    prepare(documents.sparkSession)
    texts = text_nodes(documents.select("text"))
    members = map_arrow(texts, lambda b: _buckets(b, k), "bucket bigint, node binary").distinct()

    def multisets(wanted: DataFrame) -> DataFrame:
        wanted = durable(wanted.distinct(), "wanted")
        own = sized_join(texts, wanted, "node", "left_semi").dropDuplicates(["node"]).select("text", "node")
        return durable(map_arrow(own, lambda b: _multisets(b, k), "node binary, keys array<bigint>"), "multisets")

    def verify(pairs: DataFrame) -> DataFrame:
        sets = multisets(pairs.select("a").union(pairs.select("b")).toDF("node"))
        sides = pairs
        for c, name in (("a", "x"), ("b", "y")):  # a leader has all its mates
            sides = sized_join(sides, sets.toDF(c, name), c, cost=1 + F.size(name) / 8)
        return map_arrow(sides.select("a", "b", "x", "y"), lambda b: _similar(b, least), "a binary, b binary")

    def prune(rows: DataFrame) -> DataFrame:
        # two texts share no more than what either shares with any; the rest of both is in the union
        sets = multisets(rows.select("node"))
        # a key is once in a node, so one that is there once is its node's alone: no join of all keys
        keys = sets.select("node", F.explode("keys").alias("key"))
        alone = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1").groupBy("node").agg(F.count("*").alias("alone"))
        shared = sets.select("node", F.size("keys").alias("n")).join(alone, "node", "left").select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("c"))
        known = durable(shared.where((F.col("c") > 0) & (F.col("c") >= F.lit(least - 1e-9) * F.col("n"))), "shares")
        sized = durable(rows.join(known, "node"), "members")
        smallest = sized.groupBy("bucket").agg(F.min("n").alias("s"))
        union = F.col("n") + F.greatest("c", "s") - F.col("c")
        return sized_join(sized, smallest, "bucket").where(F.col("c") >= F.lit(least - 1e-9) * union).select("bucket", "node")

    def mates(rows: DataFrame) -> DataFrame:
        sets = multisets(rows.select("node"))
        held = sized_join(rows, sets, "node", cost=1 + F.size("keys") / 8).select("bucket", "node", "group", "side", "keys")
        return held.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_alike(least), "a binary, b binary")

    return link(durable(starred(durable(members, "bands")), "stars"), verify, mates, large, prune, merge=True)


def group_documents(documents: DataFrame, k: int = SHINGLE, least: float = SIMILARITY, large: int = LARGE) -> DataFrame:
    """doc_id, node (digest of the text), label (the group's), group_id (its least doc_id) and group_size of each document."""
    labels = near_groups(documents, k, least, large)
    rows = text_nodes(documents.select("doc_id", "text")).select("doc_id", "node")
    # a text may have very many rows, and a group very many texts
    rows = durable(sized_join(rows, labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label")), "labelled")
    groups = durable(rows.groupBy("label").agg(F.min("doc_id").alias("group_id"), F.count("*").alias("group_size")).where("group_size > 1"), "text-groups")
    return sized_join(rows, groups, "label", "left").select("doc_id", "node", "label", F.coalesce("group_id", "doc_id").alias("group_id"), F.coalesce("group_size", F.lit(1).cast("bigint")).alias("group_size"))


def drop_near_duplicates(documents: DataFrame) -> DataFrame:
    """The documents without all but one of each group, with their columns; the one of least doc_id stays, null ids last."""
    rows = group_documents(documents)
    place = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")
    # a row is told by its id and its text; where several stay alike, one is taken
    first = durable(rows.where("group_size > 1").groupBy("label").agg(F.min(place).alias("first")), "first-rows")
    marked = sized_join(rows.select("doc_id", "node", "label"), first, "label")
    marked = durable(marked.select("doc_id", "node", place.eqNullSafe(F.col("first")).alias("stays")), "marked")
    name = fresh(documents, "row")
    row = lambda node: F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.hex(node))
    given = documents.withColumn(name, row(F.unhex(F.md5(F.coalesce("text", F.lit("")).cast("binary")))))
    named = marked.select(row(F.col("node")).alias(name), "stays")
    goes = durable(named.where("not stays").select(name).distinct(), "gone")
    kept = sized_join(given, goes, name, "left_anti")
    alike = durable(named.where("stays").groupBy(name).count().where("count > 1").select(name), "alike")
    if alike.limit(1).count():
        kept = sized_join(kept, alike, name, "left_anti").unionByName(sized_join(kept, alike, name, "left_semi").dropDuplicates([name]))
    return kept.select(*documents.columns)


def op4(spark, sf_dir: str) -> DataFrame:
    return group_documents(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", F.col("group_id").alias("class_id"), F.col("group_size").alias("class_size"))
