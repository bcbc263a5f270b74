"""Operator 1, benchmark decontamination: a prefix-filtered set join between item windows and documents.

Words are maximal runs of [0-9a-z] and of non-ASCII code points after A-Z are lower-cased. A window is
``window`` consecutive words of an item; an item of fewer words, but not none, is one window. A document
word is hit if it stands inside an occurrence of a window.

How it runs
  1. Each window becomes the set of its word shingles (``SHINGLE`` words; all its words if it has fewer).
  2. One pass over the documents keeps the stretches of words round shingles that a Bloom filter of all
     benchmark shingles lets through. The filter has 2**27 bits at most, so the broadcast is bounded; a
     false positive costs work, never a result.
  3. The kept shingles are counted over all documents. A window can only be contained where all its
     shingles are, so a prefix of one shingle is enough: its rarest one by those counts.
  4. Kept shingles join the prefixes by hash, the windows' side broadcast if it is counted to be small,
     else both sides salted. Positional bounds (the window must lie inside the document) and the exact
     comparison of all words of the window follow.

Edge cases: a null or empty text has no words, and is returned with zeros. Items with a null id or
no words have no windows. Item ids that occur twice are one item with the windows of both rows. Repeated
document rows are returned once each. An empty benchmark leaves all documents clean; empty documents give
an empty result. Only the named columns are read, so further columns of any name are harmless.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import durable, fresh, lists, lowered, map_arrow, prepare, shingles, sized_join, text_slices, words

WINDOW = 10
SHINGLE = 5
MAX_FILTER_BITS = 1 << 27
#: Shingle positions that one stretch holds at most; a longer one is cut into overlapping stretches.
STRETCH = 128


def _windows(batch: pa.RecordBatch, window: int):
    """Rows (item_id, window_words, shingle) of each item; shingle is a list of hashes by offset."""
    for part, raw, at in text_slices(batch):
        hashes, starts, ends, counts = words(raw, at)
        low = lowered(raw)
        ids, out = part.column(0).to_pylist(), []
        first = np.cumsum(counts) - counts
        for row, (n, f) in enumerate(zip(counts.tolist(), first.tolist())):
            texts = [low[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(starts[f : f + n], ends[f : f + n])]
            size = min(window, n)
            k = min(SHINGLE, size)
            if not n:
                continue
            grams, _ = shingles(hashes[f : f + n], np.array([n]), k)
            grams = grams.view(np.int64)
            for i in range(n - size + 1):
                out.append((ids[row], texts[i : i + size], grams[i : i + size - k + 1].tolist()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], part.schema.field(0).type), pa.array([x[1] for x in out], pa.list_(pa.string())), pa.array([x[2] for x in out], pa.list_(pa.int64()))], ["item", "win", "grams"])


def benchmark_windows(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(item, win: words, grams: shingle hashes by offset, wid: digest of the words) of all windows."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).alias("text")).where("item is not null and text is not null")
    rows = map_arrow(items, lambda b: _windows(b, window), "item string, win array<string>, grams array<bigint>")
    return rows.withColumn("wid", F.md5(F.concat_ws(" ", "win"))).dropDuplicates(["item", "wid"])


def shingle_filter(grams: DataFrame) -> np.ndarray:
    """A Bloom filter of the column ``gram`` with two bits a shingle, as 64-bit words; at most 2**27 bits."""
    n = grams.limit(MAX_FILTER_BITS // 16).count()
    bits = min(MAX_FILTER_BITS, 1 << max(16, (16 * n).bit_length()))
    slot = F.explode(F.array(F.col("gram").bitwiseAND(bits - 1), F.shiftrightunsigned("gram", 32).bitwiseAND(bits - 1)))
    rows = grams.select(slot.alias("slot")).groupBy(F.shiftright("slot", 6).alias("at")).agg(F.expr("bit_or(shiftleft(1L, cast(slot % 64 as int)))").alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[rows.column("at").to_numpy()] = rows.column("bits").to_numpy()
    return out.view(np.uint64)


def passes(filter_words: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Which 64-bit words a filter of ``shingle_filter`` may hold."""
    mask = np.uint64(64 * len(filter_words) - 1)
    ok = np.ones(len(grams), bool)
    for slot in (grams & mask, (grams >> np.uint64(32)) & mask):
        ok &= ((filter_words[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63))) & np.uint64(1)).astype(bool)
    return ok


def _stretches(batch: pa.RecordBatch, filter_words: np.ndarray, lengths: list[int], window: int):
    """Rows (row, doc_id, n_words, stretches) of each document."""
    for part, raw, at in text_slices(batch):
        hashes, starts, ends, counts = words(raw, at)
        first = np.cumsum(counts) - counts
        found = []
        for k in lengths:
            grams, number = shingles(hashes, counts, k, short=False)
            hit = np.flatnonzero(passes(filter_words, grams))
            row = np.searchsorted(np.cumsum(number), hit, "right")
            found.append((row, hit - (np.cumsum(number) - number)[row], grams[hit].view(np.int64)))
        row, pos, gram = (np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64) for i in range(3))
        order = np.lexsort((pos, row))
        row, pos, gram = row[order], pos[order], gram[order]
        # a stretch ends where the text does, where the next shingle is far off, or where it is long enough
        cut = np.ones(len(row), bool)
        cut[1:] = (row[1:] != row[:-1]) | (pos[1:] - pos[:-1] > 2 * window)
        run = np.arange(len(row)) - np.maximum.accumulate(np.where(cut, np.arange(len(row)), 0))
        cut |= run % STRETCH == 0
        begin = np.flatnonzero(cut)
        size = np.diff(np.append(begin, len(row)))
        low = lowered(raw)
        lefts, texts = [], []
        for b, n in zip(begin.tolist(), size.tolist()):
            r = row[b]
            lo, hi = max(0, int(pos[b]) - window), min(int(counts[r]), int(pos[b + n - 1]) + window)
            lefts.append(lo)
            texts.append([low[x:y].tobytes().decode("utf-8", "replace") for x, y in zip(starts[first[r] + lo : first[r] + hi], ends[first[r] + lo : first[r] + hi])])
        offsets = np.zeros(len(size) + 1, np.int32)
        np.cumsum(size, out=offsets[1:])
        stretch = pa.StructArray.from_arrays([pa.array(lefts, pa.int32()), pa.array(texts, pa.list_(pa.string())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(pos, pa.int32())), pa.ListArray.from_arrays(pa.array(offsets), pa.array(gram, pa.int64()))], ["left", "words", "pos", "gram"])
        per_row = np.bincount(row[begin], minlength=part.num_rows)
        listed = np.zeros(part.num_rows + 1, np.int32)
        np.cumsum(per_row, out=listed[1:])
        yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(listed), stretch)], ["row", "doc_id", "n_words", "stretches"])


def find_windows(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with row and n_words; occurrences: row, first, size, wid; windows: wid, item)."""
    spark = documents.sparkSession
    prepare(spark)
    windows = durable(benchmark_windows(benchmark, window=window), "windows")
    grams = windows.select(F.explode("grams").alias("gram"), F.least(F.size("win"), F.lit(SHINGLE)).alias("k"))
    lengths = sorted(r.k for r in grams.select("k").distinct().collect())  # of at most SHINGLE values
    sent = spark.sparkContext.broadcast(shingle_filter(grams.select("gram").distinct()))
    docs = documents.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    kind = documents.schema["doc_id"].dataType.simpleString()
    scanned = durable(map_arrow(docs, lambda b: _stretches(b, sent.value, lengths, window), f"row bigint, doc_id {kind}, n_words bigint, stretches array<struct<left:int,words:array<string>,pos:array<int>,gram:array<bigint>>>"), "stretches")

    stretches = scanned.where(F.size("stretches") > 0).select("row", "n_words", F.explode("stretches").alias("s"))
    rarity = stretches.select(F.explode("s.gram").alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    offered = windows.dropDuplicates(["wid"]).select("wid", "win", F.posexplode("grams").alias("offset", "gram"))
    # a shingle that no document has rules its window out, so the left join keeps it as the rarest of all
    prefixes = offered.join(rarity, "gram", "left").groupBy("wid").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "gram", "offset")).alias("p"), F.first("win").alias("win")).where("p.n > 0").select("wid", "win", "p.gram", "p.offset")
    prefixes = durable(prefixes, "prefixes")
    at = stretches.select("row", "n_words", F.col("s.left").alias("left"), F.col("s.words").alias("words"), F.explode(F.arrays_zip("s.pos", "s.gram")).alias("z")).select("row", "n_words", "left", "words", F.col("z.pos").alias("pos"), F.col("z.gram").alias("gram"))
    near = sized_join(at, prefixes, "gram").withColumn("first", F.col("pos") - F.col("offset")).withColumn("size", F.size("win"))
    inside = near.where("first >= 0 and first + size <= n_words and first >= left and first - left + size <= size(words)")
    exact = inside.where(F.slice("words", F.col("first") - F.col("left") + 1, F.col("size")) == F.col("win"))
    return scanned.select("row", "doc_id", "n_words"), exact.select("row", "first", "size", "wid").distinct(), windows.select("wid", "item")


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items (sorted item ids), contaminated and row of each document."""
    docs, found, windows = find_windows(documents, benchmark, window)
    found = durable(found, "occurrences")
    before = F.max(F.col("first") + F.col("size")).over(Window.partitionBy("row").orderBy("first", "size", "wid").rowsBetween(Window.unboundedPreceding, -1))
    hit = found.withColumn("seen", F.coalesce(before, F.lit(0))).groupBy("row").agg(F.sum(F.greatest(F.lit(0), F.col("first") + F.col("size") - F.greatest("first", "seen"))).cast("bigint").alias("n_hit"))
    items = sized_join(found.select("row", "wid").distinct(), windows, "wid").select("row", "item").distinct().groupBy("row").agg(F.sort_array(F.collect_list("item")).alias("items"))
    out = docs.join(hit, "row", "left").join(items, "row", "left")
    return out.select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"), F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated"), "row")


def op1(spark, sf_dir: str) -> DataFrame:
    out = decontaminate(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return out.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


OP1_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL AND item_id IS NOT NULL),
wins AS (SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM wins),
doc_wins AS (SELECT doc_id, size, i, array_to_string(w[i : i + size - 1], ' ') AS win FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
found AS (SELECT doc_id, item_id, i, wins.size FROM doc_wins AS d JOIN wins ON d.win = wins.win AND d.size = wins.size),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + size)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hits USING (doc_id) LEFT JOIN ids USING (doc_id)
"""


def drop_contaminated(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents in which no window occurs, with their columns."""
    digest, name = F.md5(F.coalesce("text", F.lit("")).cast("binary")), fresh(documents, "digest")
    judged = decontaminate(documents.select(digest.alias("doc_id"), "text"), benchmark, window)
    found = durable(judged.where("contaminated").select(F.col("doc_id").alias(name)).distinct(), "contaminated")
    return sized_join(documents.withColumn(name, digest), found, name, "left_anti").select(*documents.columns)
