"""Operator 13, spelling variants: words one edit apart, found by rolling-hash deletion keys.

Words are maximal runs of letters of the texts, counted over all of them. Two are near if one code point inserted, deleted or
replaced makes one of the other. They then agree in a deletion key: a replacement leaves both equal when the code
point at its place is taken out; an insertion leaves the longer one, without it, equal to the shorter one as it is.

Keys are numbers. Polynomial hashes of all prefixes and suffixes of a word give the hash of the word without any one code
point by a product and a sum, so that a word of L code points has its L keys in O(L), for many words at a time on arrays;
no shortened string is made. A replacement's key also holds the place and the length. A row is a key and a word's number; rows
are dealt by the top bits of their keys and sorted by key within a task, where neighbours with equal keys are candidates. Only these few
get their strings, by a join, and are verified on them.

No pairs are made: words equal but for one place are all near each other, so each gets the size of its group less one and the
best of the others, of the group's first two. Of a group with one shorter word the longer ones each get that one, and it
gets their number and best. A group holds at most a letter's choices times a length of distinct words, as words are distinct.

A word's form is its near word of the largest count, ties to the smallest in code-point order, if it has ``TIMES`` times the
word's count or more. Counts grow along forms, so there are no cycles, and the root is found by joining forms with
themselves, doubling each time: at most six joins for any counts.

Edge cases: null and empty texts hold no words. A null doc_id is hashed as ``null``. Repeated rows count each. Words may be of any length:
keys are rows of 28 bytes, whatever the length. A text and a word that recur in very many documents are summed within tasks before they
move. Only doc_id and text are read. Without words the result is empty. Between the joins a 64-bit hash stands for a word; words that
share one get each other's rows too, which their strings then rule out.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import changes, durable, map_arrow, mix, prepare, seeded, sized_join, text_slices, whole_groups

#: Letters of a run, the modulus of a slip, the least code points and occurrences of a word, and what a form has.
LETTERS = "A-Za-zÀ-ÿ"
SLIP = 199
LEAST_CHARS, LEAST_COUNT, TIMES = 6, 5, 5
#: Distinct words that a task counts before it hands their sums on.
COUNTED = 200_000
#: Code points of words whose keys are made at a time, and deletion keys in a part, about.
BLOCK, PART = 1 << 18, 1 << 21
#: Top bits of a key by which rows are dealt.
RADIX = 20

_U = np.uint64
_BASE = _U(0x9E3779B97F4A7C15 | 1)


# Words -----------------------------------------------------------------------------------------


def slipped(doc_id, run: str) -> str:
    """The run, or the run without one code point, as its hash with the document's id says."""
    h = zlib.crc32(run.encode(), zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode()))
    if h % SLIP:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def _count(batches, least: int):
    """Rows (word, n): sums of words of ``least`` code points or more, as they stand after slips."""
    # a run shorter than a word cannot become one, as slips only shorten
    runs = re.compile(f"[{LETTERS}]{{{least},}}")
    counts: Counter = Counter()

    def flush():
        words, n = list(counts), list(counts.values())
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(n, pa.int64())], ["word", "n"])

    for batch in batches:
        for part, raw, at in text_slices(batch):
            for i, doc_id in enumerate(part.column(0).to_pylist()):
                # of bytes, so that only A-Z are lower-cased
                text = raw[at[i] : at[i + 1]].tobytes().lower().decode("utf-8", "replace")
                start = zlib.crc32(f"{'null' if doc_id is None else doc_id}:".encode())
                for run, n in Counter(runs.findall(text)).items():
                    h = zlib.crc32(run.encode(), start)
                    if h % SLIP == 0:
                        place = h % len(run)
                        run = run[:place] + run[place + 1 :]
                        if len(run) < least:
                            continue
                    counts[run] += n
                if len(counts) >= COUNTED:
                    yield flush()
    if counts:
        yield flush()


def word_counts(documents: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT) -> DataFrame:
    """word, n of the words with so many code points and occurrences."""
    prepare(documents.sparkSession)
    given = documents.select("doc_id", F.col("text").cast("binary").alias("text"))
    partial = given.mapInArrow(lambda batches: _count(batches, least_chars), "word string, n bigint")
    return partial.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


# Keys ------------------------------------------------------------------------------------------


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE)
    out[0] = 1
    return np.multiply.accumulate(out)


def _sums(values: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Sums of each word's values before each of its places, modulo 2**64."""
    before = np.cumsum(values) - values
    return before - np.repeat(before[starts], lengths)


def deletion_keys(codes: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word, key, place, key of the replacement) of every code point taken out, and hash of each whole word.

    codes are the words' code points end to end; the hash of letters c0 c1 ... is the sum of value(ci) times base**i.
    Returns (hash of each word, word of each place, hash of the word without that place, key of a replacement there).
    """
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(codes)) - starts[word]
    value = mix(codes.astype(np.uint64) + _U(0xA0761D6478BD642F))
    power = _powers(int(lengths.max(initial=0)) + 1)
    term = value * power[place]
    prefix = _sums(term, starts, lengths)
    whole = np.add.reduceat(term, starts) if len(starts) else np.zeros(0, np.uint64)
    suffix = whole[word] - prefix - term
    # what follows the place moves down by one: divided by the base, which is odd and has an inverse
    without = prefix + suffix * _U(pow(int(_BASE), -1, 1 << 64))
    size = lengths.astype(np.uint64)
    exact = lambda h, n: mix(h ^ mix(n + _U(0x8EBC6AF09C88C6E3)))
    replaced = mix(exact(without, size[word]) + mix(place.astype(np.uint64) + _U(0x589965CC75374CC3)))
    return exact(whole, size), word, exact(without, size[word] - _U(1)), replaced


#: What a row of keys is: a word itself, one that is a code point longer, one that may have another code point at a place.
ITSELF, LONGER, REPLACED = -2, -1, 0


def _keys(batch: pa.RecordBatch):
    """Rows (key, kind, node) of words: kind is ITSELF, LONGER, or the place of a replacement."""
    words = batch.column(0).to_pylist()
    node = batch.column(1).to_numpy()
    sizes = np.array([len(w) for w in words], np.int64)
    ends = np.cumsum(sizes)
    i = 0
    while i < len(words):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + BLOCK)))
        codes = np.frombuffer("".join(words[i:j]).encode("utf-32-le"), np.uint32)
        own, word, longer, replaced = deletion_keys(codes, sizes[i:j])
        starts = np.cumsum(sizes[i:j]) - sizes[i:j]
        place = np.arange(len(codes)) - starts[word]
        # of equal neighbours taking out either gives the same word
        fresh = np.append(True, codes[1:] != codes[:-1])
        fresh[starts] = True
        key = np.concatenate([own, longer[fresh], replaced])
        kind = np.concatenate([np.full(len(own), ITSELF), np.full(int(fresh.sum()), LONGER), place + REPLACED])
        nodes = node[i:j]
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(kind, pa.int32()), pa.array(np.concatenate([nodes, nodes[word[fresh]], nodes[word]]))], ["key", "kind", "node"])
        i = j


def _candidates(batches):
    """Of rows in the order of their keys, those whose key another word has; of insertions only where the shorter word is there."""
    for table in whole_groups(batches, "key"):
        key, kind = table.column("key").to_numpy(), table.column("kind").to_numpy()
        first = np.flatnonzero(changes(key))
        size = np.diff(np.append(first, len(key)))
        inserted = np.logical_or.reduceat(kind == ITSELF, first) if len(first) else np.zeros(0, bool)
        replaced = np.add.reduceat((kind >= REPLACED).astype(np.int64), first) if len(first) else size
        keep = np.repeat((size > 1) & (inserted | (replaced > 1)), size)
        yield from table.filter(pa.array(keep)).combine_chunks().to_batches()


def _near(batches):
    """Of rows (key, kind, node, word, n) in the order of their keys, rows (word, near, best_n, best): what each group adds to a word."""
    for table in whole_groups(batches, "key"):
        groups: dict[tuple, list[tuple[int, str, int]]] = {}
        for key, kind, word, n in zip(*(table.column(c).to_pylist() for c in ("key", "kind", "word", "n"))):
            # the strings decide, whatever the keys say
            if kind == ITSELF:
                groups.setdefault((key, word), []).append((-n, word, ITSELF))
            elif kind == LONGER:
                for rest in _shorter(word, key):
                    groups.setdefault((key, rest), []).append((-n, word, LONGER))
            else:
                groups.setdefault((key, kind, len(word), word[: kind] + word[kind + 1 :]), []).append((-n, word, REPLACED))
        rows = []
        for own in groups.values():
            own = sorted(set(own))
            if own[0][2] == REPLACED:
                if len(own) > 1:
                    rows += [(word, len(own) - 1, *(own[1] if i == 0 else own[0])[:2]) for i, (_, word, _) in enumerate(own)]
                continue
            short = [x for x in own if x[2] == ITSELF]
            long = [x for x in own if x[2] == LONGER]
            if short and long:
                rows.append((short[0][1], len(long), *long[0][:2]))
                rows += [(word, 1, *short[0][:2]) for _, word, _ in long]
        columns = list(zip(*rows)) or [()] * 4
        yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.string()), pa.array(columns[1], pa.int64()), pa.array([-n for n in columns[2]], pa.int64()), pa.array(columns[3], pa.string())], ["word", "near", "best_n", "best"])


def _shorter(word: str, key: int) -> list[str]:
    """The word without one code point, where that has the key."""
    codes = np.frombuffer(word.encode("utf-32-le"), np.uint32)
    _, _, longer, _ = deletion_keys(codes, np.array([len(codes)]))
    return sorted({word[:i] + word[i + 1 :] for i in np.flatnonzero(longer.view(np.int64) == key).tolist()})


def near_words(words: DataFrame) -> DataFrame:
    """Of rows (word, n) with distinct words: word, n_near, best_n, best of those that have near words."""
    spark = words.sparkSession
    prepare(spark)
    named = words.withColumn("node", F.xxhash64("word"))
    keys = named.agg(F.sum(F.length("word"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * keys // PART)
    dealt = map_arrow(named.select("word", "node"), _keys, "key bigint, kind int, node bigint")
    # sorted by Spark, which sorts whole numbers by radix and spills
    radix = F.shiftrightunsigned("key", 64 - RADIX)
    found = dealt.repartition(parts, radix).sortWithinPartitions("key").mapInArrow(_candidates, "key bigint, kind int, node bigint")
    found = durable(found, "near-candidates")
    # the strings of words with candidates; a word has at most twice its length of rows
    known = found.join(named, "node").select("key", "kind", "word", "n")
    sums = known.repartition(parts, radix).sortWithinPartitions("key").mapInArrow(_near, "word string, near bigint, best_n bigint, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("m"), "best")).alias("b")
    return sums.groupBy("word").agg(F.sum("near").alias("n_near"), best).select("word", "n_near", (-F.col("b.m")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of rows (word, form): forms are followed until there is none. They must not go in circles."""
    ends = forms.select("word", F.col("form").alias("root"))
    while True:
        # what a word points to, many words may
        further = sized_join(ends, ends.toDF("root", "next"), "root", "left")
        further = durable(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        ends = further.select("word", "root")
        if not further.where("moved").limit(1).count():
            return ends


def spelling_groups(documents: DataFrame, least_chars: int = LEAST_CHARS, least_count: int = LEAST_COUNT, times: int = TIMES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of the texts."""
    words = durable(word_counts(documents, least_chars, least_count), "words")
    near = durable(near_words(words), "near-words")
    joined = words.join(near, "word", "left")
    has = F.col("best_n") >= times * F.col("n")
    forms = joined.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(has, F.col("best")).alias("form"), F.when(has, F.col("best_n")).alias("form_n"))
    forms = durable(forms, "forms")
    ends = roots(forms.where("form is not null").select("word", "form"))
    return forms.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
