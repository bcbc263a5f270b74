"""Operator 11, fill-in-the-middle: a text's lines are cut into prefix, middle and suffix, which change places.

Two passes over each text with a lazy iterator of matches, in constant memory beside the text: the first counts the units,
the second goes forward to the lower and then to the upper rank and keeps those two places alone. Which ranks, whether a
text is changed and in which of the two orders come from a hash of a seed and the doc_id, so a row's result depends on
nothing but itself: no shuffle, and lost tasks are run again to the same result.

Forms: ``plain`` is the text as it was; ``psm`` is <P>prefix<S>suffix<M>middle; ``spm`` is <S>suffix<P>prefix<M>middle. A
text that holds a mark stays plain, so that the marks of an output are its own; ``restored`` gives the text back.

Edge cases: a null or empty text has no units and is plain; null counts as empty, and as output is empty. A null doc_id is
hashed as ``null``. Repeated rows come out once each. Texts may be of any length. Extra columns are carried, whatever
their names. Bytes that are no UTF-8 become U+FFFD. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from itertools import islice

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from .common import fresh, map_arrow, prepare, text_slices

#: A unit is a line with its line feed, or what is left after the last one.
LINES = r"[^\n]*\n|[^\n]+"
#: The marks of prefix, suffix and middle.
MARKS = ("<P>", "<S>", "<M>")
SEED = 7
#: Of 100 texts, how many are changed, and of 100 of these, how many have the suffix first.
RATE, SUFFIX_FIRST = 100, 50


def check_marks(marks: tuple[str, str, str]) -> None:
    """Raises ValueError if an end of one mark can begin another one, as then an output may be read in two ways."""
    for i, a in enumerate(marks):
        for k, b in enumerate(marks):
            if not a or (i != k and a in b) or any(a[-n:] == b[:n] for n in range(1, min(len(a), len(b)) + (i != k))):
                raise ValueError(f"marks overlap: {a!r} and {b!r}")


def draws(doc_id, seed: int = SEED) -> tuple[int, int, int, int]:
    """Four numbers below 2**32 from the seed and the id."""
    digest = hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12))


def count_units(text: str, unit: re.Pattern) -> int:
    """First pass: how many units the text has."""
    return sum(1 for _ in unit.finditer(text))


def places(matches: Iterator[re.Match], lower: int, upper: int) -> tuple[int, int]:
    """Second pass: where the unit number ``lower`` and the unit number ``upper`` end, of a lazy iterator of matches; 0 is the start."""
    begin = end = 0
    for m in islice(matches, max(lower - 1, 0), lower):
        begin = end = m.end()
    for m in islice(matches, max(upper - lower - 1, 0), upper - lower):
        end = m.end()
    return begin, end


def rearranged(text: str, doc_id, unit: re.Pattern, marks: tuple[str, str, str], seed: int, rate: int, suffix_first: int) -> tuple[int, str, int | None, int | None, str]:
    """(units, form, code points of the prefix, of the middle, output) of one text."""
    n = count_units(text, unit)
    h1, h2, h3, h4 = draws(doc_id, seed)
    if not text or h3 % 100 >= rate or any(m in text for m in marks):
        return n, "plain", None, None, text
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    begin, end = places(unit.finditer(text), i, j)
    prefix, middle, suffix = text[:begin], text[begin:end], text[end:]
    p, s, m = marks
    if h4 % 100 < suffix_first:
        return n, "spm", begin, end - begin, f"{s}{suffix}{p}{prefix}{m}{middle}"
    return n, "psm", begin, end - begin, f"{p}{prefix}{s}{suffix}{m}{middle}"


def fill_in_middle(documents: DataFrame, unit: str = LINES, marks: tuple[str, str, str] = MARKS, seed: int = SEED, rate: int = RATE, suffix_first: int = SUFFIX_FIRST, names: tuple[str, ...] = ("n", "form", "prefix_chars", "middle_chars", "output")) -> DataFrame:
    """The documents with five columns more, of the given names: units, form, code points of prefix and middle (null if plain), output.

    A pattern's units are counted and cut at their ends; what it leaves between or after them goes to the part in
    which it stands.
    """
    check_marks(marks)
    taken = {c.lower() for c in documents.columns}
    if len(names) != 5 or len({*names}) < 5 or taken & {n.lower() for n in names}:
        raise ValueError("five names that the documents lack are needed")
    prepare(documents.sparkSession)
    pattern, fields = re.compile(unit), documents.columns
    # read as bytes, so that what is no UTF-8 fails no task
    raw = fresh(documents, "raw")
    given = documents.withColumn(raw, F.col("text").cast("binary"))
    at = fields.index("doc_id")

    def run(batch: pa.RecordBatch):
        for part, data, edges in text_slices(batch, raw):
            rows = []
            for i, doc_id in enumerate(part.column(at).to_pylist()):
                text = data[edges[i] : edges[i + 1]].tobytes().decode("utf-8", "replace")
                rows.append(rearranged(text, doc_id, pattern, marks, seed, rate, suffix_first))
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()))]
            yield pa.RecordBatch.from_arrays([*part.columns[: len(fields)], *columns], [*fields, *names])

    schema = StructType(list(documents.schema.fields))
    for name, kind in zip(names, (LongType(), StringType(), LongType(), LongType(), StringType())):
        schema = schema.add(name, kind)
    return map_arrow(given, run, schema)


def restored(output: Column, form: Column, marks: tuple[str, str, str] = MARKS) -> Column:
    """The text from its output and form alone, in generated code; the marks stand where they first occur in their order."""
    p, s, m = (F.lit(x) for x in marks)
    sizes = dict(zip("psm", map(len, marks)))

    def parts(first: Column, a: str, second: Column, b: str) -> tuple[Column, Column, Column]:
        i = F.instr(output, second)
        k = F.instr(output, m)
        return (
            F.substring(output, F.lit(sizes[a] + 1), i - 1 - sizes[a]),
            F.substring(output, i + sizes[b], k - i - sizes[b]),
            F.substring(output, k + sizes["m"], F.length(output)),
        )

    prefix, suffix, middle = parts(p, "p", s, "s")
    psm = F.concat(prefix, middle, suffix)
    suffix, prefix, middle = parts(s, "s", p, "p")
    spm = F.concat(prefix, middle, suffix)
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)


def op11(spark, sf_dir: str) -> DataFrame:
    out = fill_in_middle(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


OP11_SQL = r"""
WITH hashed AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h,
         regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS units
  FROM documents
), drawn AS (
  SELECT doc_id, text, units, len(units) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) % (len(units) + 1) AS a, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (len(units) + 1) AS b,
         CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 < 50 AS suffix_first,
         text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') AS plain
  FROM hashed
), cut AS (
  SELECT *, coalesce(array_to_string(units[1:least(a, b)], ''), '') AS prefix,
         coalesce(array_to_string(units[least(a, b) + 1:greatest(a, b)], ''), '') AS middle,
         coalesce(array_to_string(units[greatest(a, b) + 1:], ''), '') AS suffix
  FROM drawn
)
SELECT doc_id, CAST(n AS BIGINT) AS n, CASE WHEN plain THEN 'plain' WHEN suffix_first THEN 'spm' ELSE 'psm' END AS form,
       CASE WHEN NOT plain THEN CAST(length(prefix) AS BIGINT) END AS prefix_chars, CASE WHEN NOT plain THEN CAST(length(middle) AS BIGINT) END AS middle_chars,
       sha256(CASE WHEN plain THEN text WHEN suffix_first THEN '<S>' || suffix || '<P>' || prefix || '<M>' || middle ELSE '<P>' || prefix || '<S>' || suffix || '<M>' || middle END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM cut
"""
