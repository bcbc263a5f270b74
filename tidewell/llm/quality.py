"""Operator 9, quality classifier with hierarchical empirical Bayes over hosts and paths.

A logistic regression on counts of a text's characters, words and lines gives the probability p that the document
itself is good. A host's rate of good documents is the mean of its documents' p, shrunk towards the global
rate; a path's rate is shrunk towards its host's. How strongly is estimated from the spread of the rates beyond
what chance explains (method of moments), so sparse sites follow the level above. A document's own p is left
out of the rates that judge it. The posterior log-odds are those of p plus the path's less the global ones.

A second logistic regression, on which words a text holds, gives the probability that it is toxic, whatever its quality. Its
words are those that the toxic documents of the sample hold more often than chance explains. A document is kept if its
quality is good and it is not toxic; a site's rates don't speak for or against toxic words.

The regression is fitted on a bounded sample: one labelled document in each of ``LABELLED`` hash buckets. All
sums run over all documents as grouped aggregations, which combine before they shuffle, so a host with a third of
all rows is a few partial sums. The table of paths is broadcast if counted to be small, else joined salted.

Edge cases: a text without words gives no evidence, its p is the global rate. Null hosts and paths are sites
of their own. Without usable labels everything is kept with score 1; without usable labels of toxicity, or words that
tell, nothing is toxic. Labels that are null or of unknown documents are left out; of repeated labels of a document one
counts, and of documents with one id the least text. Repeated rows are returned once each. Texts may be of any length.
keep_good carries columns of any names; score replaces columns that have the names it adds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable, map_arrow, prepare, sized_join, text_slices, words

LABELLED = 16_384
THRESHOLD = 0.5
#: Words of the toxicity model at most, and the standard errors by which their rates in toxic and other documents differ at least.
TELLING, SURE = 512, 5.0
#: The columns that score adds, with those it needs on the way.
ADDED = {"_host", "_path", "_p", "_p_toxic", "_host_rate", "_path_rate", "_score", "_keep", "_toxic", "_site", "_h", "_t", "_pn", "_ps", "_hn", "_hs"}
#: Bounds of the weight of a level above, in documents.
WEIGHTS = (1.0, 1e6)

_UPPER, _LETTER, _DIGIT, _SPACE, _LINE, _BANG, _BAR, _SIGN = (np.zeros(256, bool) for _ in range(8))
_UPPER[65:91] = True
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_DIGIT[48:58] = True
_SPACE[[9, 10, 13, 32]] = True
_LINE[10] = True
_BANG[33] = True
_BAR[124] = True
_SIGN[[35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 125, 126]] = True
_KINDS = np.stack([_UPPER, _LETTER, _DIGIT, _SPACE, _LINE, _BANG, _BAR, _SIGN])
N_FEATURES = 12


def features(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(features of each text, number of its words)."""
    hashes, starts, ends, counts = words(raw, offsets)
    size = np.maximum(np.diff(offsets), 1)
    rates = []
    for kind in _KINDS:
        sums = np.zeros(len(raw) + 1, np.int64)
        np.cumsum(kind[raw], out=sums[1:])
        rates.append(np.diff(sums[offsets]) / size)
    row = np.repeat(np.arange(len(counts)), counts)
    n = np.maximum(counts, 1)
    keys = np.sort((row.astype(np.uint64) << np.uint64(44)) | (hashes >> np.uint64(20)))
    fresh = np.append(True, keys[1:] != keys[:-1])[: len(keys)]
    distinct = np.bincount((keys[fresh] >> np.uint64(44)).astype(np.int64), minlength=len(counts))
    again = np.zeros(len(row), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (row[1:] == row[:-1])
    letters = np.bincount(row, ends - starts, minlength=len(counts))
    out = [np.log1p(100 * r) for r in rates]
    out += [np.log1p(counts), distinct / n, np.bincount(row, again, minlength=len(counts)) / n, np.log1p(letters / n)]
    return np.stack(out, 1), counts


class Regression:
    """Logistic regression with a small penalty, by Newton's steps on standardised features."""

    def __init__(self, x: np.ndarray, y: np.ndarray, penalty: float = 1.0):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-9
        z = self._z(x)
        w = np.zeros(z.shape[1])
        ridge = np.eye(len(w)) * penalty
        ridge[0, 0] = 1e-9
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge, z.T @ (y - p) - ridge @ w)
            w += step
            if np.abs(step).max() < 1e-8:
                break
        self.w, self.rate = w, float(y.mean())

    def _z(self, x: np.ndarray) -> np.ndarray:
        return np.concatenate([np.ones((len(x), 1)), np.clip((x - self.mean) / self.scale, -8, 8)], 1)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self._z(x) @ self.w, -15, 15)))


def fit(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Regression | None:
    """The regression on the sampled labels; None if they do not hold both classes."""
    prepare(documents.sparkSession)
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = usable.select(F.struct(mark.alias("mark"), F.col("doc_id"), F.col("quality")).alias("m")).groupBy(F.pmod("m.mark", F.lit(labelled)).alias("bucket")).agg(F.min("m").alias("m")).select("m.doc_id", "m.quality")
    # at most ``labelled`` rows, whatever ids repeat
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text")).select("doc_id", "text", "quality")

    def run(batch):
        for part, raw, at in text_slices(batch):
            x, n = features(raw, at)
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(n, pa.int64()), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), x.shape[1]).cast(pa.list_(pa.float64()))], ["doc_id", "quality", "n", "x"])

    kind = documents.schema["doc_id"].dataType.simpleString()
    got = map_arrow(rows, run, f"doc_id {kind}, quality int, n bigint, x array<double>").where("n > 0").orderBy("doc_id", "quality", "n").toArrow()
    y = got.column("quality").to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    return Regression(np.array(got.column("x").to_pylist()), y)


class Toxicity:
    """Logistic regression on which of the telling words, ascending hashes, a text holds."""

    def __init__(self, telling: np.ndarray, x: np.ndarray, y: np.ndarray):
        self.telling, self.model = telling, Regression(x, y)

    def __call__(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        return self.model(presence(raw, offsets, self.telling))


def presence(raw: np.ndarray, offsets: np.ndarray, telling: np.ndarray) -> np.ndarray:
    """1 where a text holds a word, 0 elsewhere; one column for each of the ascending hashes."""
    hashes, _, _, counts = words(raw, offsets)
    out = np.zeros((len(counts), len(telling)))
    at = np.minimum(np.searchsorted(telling, hashes), len(telling) - 1)
    hit = telling[at] == hashes
    out[np.repeat(np.arange(len(counts)), counts)[hit], at[hit]] = 1
    return out


def fit_toxicity(documents: DataFrame, labels: DataFrame, labelled: int = LABELLED) -> Toxicity | None:
    """The toxicity model on the sampled labels; None if they do not hold both classes or no word tells them apart.

    Words are counted as grouped sums; the driver gets the telling ones and, of one document a bucket, which it holds.
    """
    if "toxic" not in labels.columns:
        return None
    prepare(documents.sparkSession)
    usable = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    mark = F.xxhash64(F.col("doc_id").cast("string"))
    chosen = usable.select(F.struct(mark.alias("mark"), "doc_id", "toxic").alias("m")).groupBy(F.pmod("m.mark", F.lit(labelled)).alias("bucket")).agg(F.min("m").alias("m")).select("m.doc_id", "m.toxic")
    rows = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "toxic").agg(F.min("text").alias("text"))
    rows = durable(rows.select("toxic", "text"), "toxic-sample")

    def distinct(batch):
        for part, raw, at in text_slices(batch):
            hashes, _, _, counts = words(raw, at)
            row = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((hashes, row))
            hashes, row = hashes[order], row[order]
            fresh = np.append(True, (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1]))[: len(row)]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(row[fresh])), pa.array(hashes[fresh].view(np.int64))], ["toxic", "word"])

    total = rows.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    if not total.t or total.t == total.n:
        return None
    held = map_arrow(rows, distinct, "toxic int, word bigint").groupBy("word").agg(F.count("*").alias("n"), F.sum("toxic").alias("t"))
    rate = F.col("n") / total.n
    error = F.sqrt(rate * (1 - rate) * (1 / total.t + 1 / (total.n - total.t)))
    surplus = F.col("t") / total.t - (F.col("n") - F.col("t")) / (total.n - total.t)
    best = held.where(F.col("n") < total.n).select("word", (surplus / error).alias("z")).where(F.col("z") >= SURE).orderBy(F.desc("z"), "word").limit(TELLING).collect()
    if not best:
        return None
    telling = np.sort(np.array([r.word for r in best], np.int64).view(np.uint64))

    def run(batch):
        for part, raw, at in text_slices(batch):
            x = presence(raw, at, telling) > 0
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([b.tobytes() for b in np.packbits(x, 1)], pa.binary())], ["toxic", "x"])

    got = map_arrow(rows, run, "toxic int, x binary").orderBy("toxic", "x").toArrow()
    packed = np.frombuffer(b"".join(got.column("x").to_pylist()), np.uint8).reshape(got.num_rows, -1)
    x = np.unpackbits(packed, axis=1, count=len(telling)).astype(float)
    return Toxicity(telling, x, got.column("toxic").to_numpy().astype(float))


def _evidence(rows: DataFrame, model: Regression | None, toxic: Toxicity | None = None) -> DataFrame:
    """rows, which hold ``text``, with _p_toxic and _p of the models, in one pass over the texts; null without a model.

    By the regression, a text without words has the rate of the labels.
    """
    if model is None and toxic is None:
        return rows.withColumn("_p_toxic", F.lit(None).cast("double")).withColumn("_p", F.lit(None).cast("double"))
    sent = rows.sparkSession.sparkContext.broadcast((model, toxic))
    names = [*rows.columns, "_p_toxic", "_p"]

    def run(batch):
        model, toxic = sent.value
        for part, raw, at in text_slices(batch):
            nothing = pa.nulls(part.num_rows, pa.float64())
            p = nothing
            if model is not None:
                x, n = features(raw, at)
                p = pa.array(np.where(n > 0, model(x), model.rate))
            yield pa.RecordBatch.from_arrays([*part.columns, nothing if toxic is None else pa.array(toxic(raw, at)), p], names)

    from pyspark.sql.types import DoubleType, StructType

    return map_arrow(rows, run, StructType([*rows.schema.fields]).add("_p_toxic", DoubleType()).add("_p", DoubleType()))


def _exact(x: Column) -> Column:
    """x, between 0 and 1, as a decimal: sums of these don't depend on their order."""
    return x.cast("decimal(20,15)")


def _weight(rates: DataFrame, rate: float) -> float:
    """In documents, the weight of the level above: global variance over what the rates vary beyond chance."""
    sums = rates.select(F.count("*").alias("n"), F.sum(_exact((F.col("s") / F.col("n") - rate) ** 2)).alias("spread"), F.sum(_exact(1 / F.col("n"))).alias("chance")).first()
    if not sums["n"]:
        return WEIGHTS[1]
    spread, chance = float(sums["spread"]) / sums["n"], float(sums["chance"]) / sums["n"]
    inner = rate * (1 - rate)
    between = max(spread - inner * chance, inner / (WEIGHTS[1] + 1))
    return min(max(inner / between - 1, WEIGHTS[0]), WEIGHTS[1]) if inner else WEIGHTS[1]


def score(documents: DataFrame, labels: DataFrame, host: Column | None = None, path: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """documents with _host, _path, _p_toxic, _p (of the document alone), _host_rate, _path_rate, _score, _keep (of good quality) and _toxic.

    host and path are columns of documents; by default the source, and the source with the language below it.
    """
    host = F.col("source") if host is None else host
    path = F.concat_ws("/", "source", "lang") if path is None else path
    given = documents.drop(*(c for c in documents.columns if c.lower() in ADDED)).withColumn("_host", F.coalesce(host.cast("string"), F.lit(""))).withColumn("_path", F.coalesce(path.cast("string"), F.lit("")))
    judge = fit_toxicity(documents, labels)
    toxic = F.coalesce(F.col("_p_toxic") >= threshold, F.lit(False))
    model = fit(documents, labels)
    if model is None:
        nothing = F.lit(None).cast("double")
        return _evidence(given, None, judge).withColumn("_host_rate", nothing).withColumn("_path_rate", nothing).withColumn("_score", F.lit(1.0)).withColumn("_keep", F.lit(True)).withColumn("_toxic", toxic)
    sums = _evidence(given.select("_host", "_path", "text"), model).groupBy("_host", "_path").agg(F.count("*").alias("n"), F.sum(_exact(F.col("_p"))).alias("s"))
    exact = durable(sums, "sites")
    paths = exact.withColumn("s", F.col("s").cast("double"))
    hosts = exact.groupBy("_host").agg(F.sum("n").alias("n"), F.sum("s").cast("double").alias("s"))
    total = exact.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    rate = min(max(float(total.s) / total.n, 1e-4), 1 - 1e-4) if total.n else 0.5
    up, low = _weight(hosts, rate), _weight(paths, rate)
    sites = paths.withColumnsRenamed({"n": "_pn", "s": "_ps"}).join(hosts.withColumnsRenamed({"n": "_hn", "s": "_hs"}), "_host")
    sites = sites.select(F.xxhash64("_host", "_path").alias("_site"), F.col("_host").alias("_h"), F.col("_path").alias("_t"), "_pn", "_ps", "_hn", "_hs")
    judged = sized_join(_evidence(given, model, judge).withColumn("_site", F.xxhash64("_host", "_path")), sites, "_site").where("_host = _h and _path = _t")
    p = F.col("_p")
    at_host = (F.lit(up * rate) + F.col("_hs") - p) / (F.lit(up) + F.col("_hn") - 1)
    at_path = (F.lit(low) * F.col("_host_rate") + F.col("_ps") - p) / (F.lit(low) + F.col("_pn") - 1)
    bound = lambda x: F.least(F.greatest(x, F.lit(1e-6)), F.lit(1 - 1e-6))
    odds = lambda x: F.log(x / (1 - x))
    out = judged.withColumn("_host_rate", bound(at_host)).withColumn("_path_rate", bound(at_path))
    out = out.withColumn("_score", 1 / (1 + F.exp(-(odds(bound(p)) + odds(F.col("_path_rate")) - F.lit(float(np.log(rate / (1 - rate))))))))
    return out.withColumn("_keep", F.col("_score") >= threshold).select(*given.columns, "_p_toxic", "_p", "_host_rate", "_path_rate", "_score", "_keep", toxic.alias("_toxic"))


def keep_good(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with the columns they came with."""
    read, names = ["doc_id", "text", "source", "lang"], documents.columns
    rest = [c for c in names if c not in read]
    given = documents.select(*read, *([F.struct(*rest).alias("rest")] if rest else []))
    kept = score(given, labels).where("_keep and not _toxic")
    return kept.select(*(F.col(c) if c in read else F.col("rest").getField(c).alias(c) for c in names))


def op9(spark, sf_dir: str) -> DataFrame:
    out = score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return out.select("doc_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_p").alias("p_document"), F.col("_host_rate").alias("host_rate"), F.col("_path_rate").alias("path_rate"), F.col("_score").alias("score"), F.expr("_keep and not _toxic").alias("keep"), F.col("_p_toxic").alias("p_toxic"))
