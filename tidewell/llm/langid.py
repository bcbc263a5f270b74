"""Operator 5, language identification with a bidirectional gated recurrent network over bytes.

The network reads segments of ``SEGMENT`` bytes forwards and backwards, each byte through a table of gate
inputs, and gives every position a probability for each language; a document's probabilities are the mean over
all its letter positions. It is trained in numpy by backpropagation through time, on the driver, from a bounded
sample: of each language the whole text of one document in each of ``BUCKETS`` hash buckets, chosen by a grouped
aggregation of hashes that combines before it shuffles. Prediction is a map over whole texts.

Only the text and the non-null language of documents that are not held out are learned from. Held out are those whose
crc32 of doc_id as text leaves 2 on division by 4.

Edge cases: a null text, and one without a letter, is ``und`` with score 0, and so is every text if there is nothing to
learn from. A null id counts as the empty string for the split. Repeated rows are returned once each. Only
doc_id, text and lang are read, lang for training alone.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_arrow, prepare, text_slices

HIDDEN = 8
SEGMENT = 64
BUCKETS = 384
STEPS = 220
BATCH = 256
RATE = 0.02
UNDETERMINED = "und"
#: Rows that run through the network together: enough to fill vector units, few enough for the cache.
ROWS = 4096

_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True


def segments(raw: np.ndarray, offsets: np.ndarray, size: int = SEGMENT) -> tuple[np.ndarray, np.ndarray]:
    """The texts cut into rows of ``size`` bytes, ends filled with zeros, and the text of each row."""
    lengths = np.diff(offsets)
    number = -(-lengths // size)
    row = np.repeat(np.arange(len(lengths)), number)
    first = offsets[row] + (np.arange(len(row)) - np.repeat(np.cumsum(number) - number, number)) * size
    at = first[:, None] + np.arange(size)
    inside = at < offsets[row + 1][:, None]
    out = np.zeros(at.shape, np.uint8)
    out[inside] = raw[at[inside]]
    return out, row


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class Network:
    """Two gated recurrent layers, one a direction, and a softmax of both at each position."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        draw = lambda *shape: (rng.standard_normal(shape) * 0.3).astype(np.float32)
        self.p = {}
        for d in "fb":
            self.p |= {f"table_{d}": draw(256, 3 * hidden), f"gates_{d}": draw(hidden, 2 * hidden), f"state_{d}": draw(hidden, hidden), f"out_{d}": draw(hidden, len(languages))}
        self.p["bias"] = np.zeros(len(languages), np.float32)

    def _run(self, x: np.ndarray, d: str, keep: list | None = None) -> np.ndarray:
        """States at all positions of rows x; keep gets what the backward pass needs."""
        n, size = x.shape
        h, k = np.zeros((n, self.hidden), np.float32), self.hidden
        table, gates, state = (self.p[f"{name}_{d}"] for name in ("table", "gates", "state"))
        out = np.empty((size, n, k), np.float32)
        for t in range(size) if d == "f" else range(size - 1, -1, -1):
            a = table[x[:, t]]
            zr = h @ gates
            zr += a[:, : 2 * k]
            _sigmoid(zr)
            z, r = zr[:, :k], zr[:, k:]
            rh = r * h
            c = rh @ state
            c += a[:, 2 * k :]
            np.tanh(c, out=c)
            before = h
            h = before - c
            h *= z
            h += c
            out[t] = h
            if keep is not None:
                keep.append((t, before, z.copy(), r.copy(), rh, c))
        return out

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Of each language at each position: (positions, rows, languages)."""
        with np.errstate(over="ignore"):
            logits = self._run(x, "f") @ self.p["out_f"]
            logits += self._run(x, "b") @ self.p["out_b"]
            logits += self.p["bias"]
            logits -= logits.max(-1, keepdims=True)
            np.exp(logits, out=logits)
            logits /= logits.sum(-1, keepdims=True)
        return logits

    def _gradient(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Of the mean cross entropy over the letter positions."""
        kept: dict[str, list] = {"f": [], "b": []}
        with np.errstate(over="ignore"):
            states = {d: self._run(x, d, kept[d]) for d in "fb"}
        logits = states["f"] @ self.p["out_f"] + states["b"] @ self.p["out_b"] + self.p["bias"]
        logits -= logits.max(-1, keepdims=True)
        p = np.exp(logits)
        p /= p.sum(-1, keepdims=True)
        mask = _LETTER[x].T
        p[:, np.arange(len(y)), y] -= 1
        p *= (mask / max(1, mask.sum()))[:, :, None].astype(np.float32)
        g = {"bias": p.sum((0, 1))}
        k, c_n = self.hidden, p.shape[-1]
        for d in "fb":
            g[f"out_{d}"] = states[d].reshape(-1, k).T @ p.reshape(-1, c_n)
            into = p @ self.p[f"out_{d}"].T
            gates, state = self.p[f"gates_{d}"], self.p[f"state_{d}"]
            dgates, dstate, dtable = np.zeros_like(gates), np.zeros_like(state), np.zeros_like(self.p[f"table_{d}"])
            carry = np.zeros((len(y), k), np.float32)
            for t, before, z, r, rh, c in reversed(kept[d]):
                dh = into[t] + carry
                dc = dh * (1 - z) * (1 - c * c)
                drh = dc @ state.T
                dzr = np.concatenate([dh * (before - c) * z * (1 - z), drh * before * r * (1 - r)], 1)
                dstate += rh.T @ dc
                dgates += before.T @ dzr
                np.add.at(dtable, x[:, t], np.concatenate([dzr, dc], 1))
                carry = dh * z + drh * r + dzr @ gates.T
            g |= {f"gates_{d}": dgates, f"state_{d}": dstate, f"table_{d}": dtable}
        return g

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = RATE, seed: int = 3) -> Network:
        """Adam with a falling rate; every batch draws the languages evenly."""
        rng = np.random.default_rng(seed)
        groups = [np.flatnonzero(y == i) for i in range(len(self.languages))]
        groups = [g for g in groups if len(g)]
        m = {k: np.zeros_like(v) for k, v in self.p.items()}
        v = {k: np.zeros_like(w) for k, w in self.p.items()}
        for step in range(1, steps + 1):
            chosen = np.concatenate([rng.choice(g, -(-batch // len(groups))) for g in groups])
            for k, g in self._gradient(x[chosen], y[chosen]).items():
                np.clip(g, -1, 1, out=g)
                m[k] = 0.9 * m[k] + 0.1 * g
                v[k] = 0.99 * v[k] + 0.01 * g * g
                self.p[k] -= (rate * (1 - 0.9 * step / steps) * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.99**step)) + 1e-8)).astype(np.float32)
        return self

    def pooled(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """The mean of the letter positions' probabilities of each text; zeros where it has none."""
        x, row = segments(raw, offsets)
        total, number = np.zeros((len(offsets) - 1, len(self.languages))), np.zeros(len(offsets) - 1)
        for i in range(0, len(x), ROWS):
            part = x[i : i + ROWS]
            letters = _LETTER[part]
            sums = np.einsum("tnc,nt->nc", self.probabilities(part), letters.astype(np.float32))
            np.add.at(total, row[i : i + ROWS], sums)
            np.add.at(number, row[i : i + ROWS], letters.sum(1))
        return total / np.maximum(number, 1)[:, None]


def held_out(doc_id):
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def train(documents: DataFrame, buckets: int = BUCKETS) -> Network | None:
    """A network of the languages of the documents that are not held out; None if there are none."""
    mark = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "text")
    rows = documents.select("doc_id", "text", "lang").where(~held_out(F.col("doc_id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    rows = rows.select("lang", "text", mark.alias("mark"))
    chosen = rows.groupBy("lang", F.pmod("mark", F.lit(buckets)).alias("bucket")).agg(F.min("mark").alias("mark"))
    # whole texts, one a bucket
    drawn = rows.join(F.broadcast(chosen), ["lang", "mark"]).groupBy("lang", "bucket").agg(F.min("text").alias("text"))
    sample = drawn.orderBy("lang", "bucket").toArrow()
    if not sample.num_rows:
        return None
    languages = sorted(set(sample.column("lang").to_pylist()))
    blobs = [t.encode() for t in sample.column("text").to_pylist()]
    x, row = segments(np.frombuffer(b"".join(blobs), np.uint8), np.concatenate([[0], np.cumsum([len(b) for b in blobs])]).astype(np.int64))
    y = np.array([languages.index(v) for v in sample.column("lang").to_pylist()])[row]
    return Network(languages).fit(x, y)


def _has_letter(raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    ascii_letters = np.concatenate([[0], np.cumsum(_LETTER[raw] & (raw < 128))])
    out = np.diff(ascii_letters[offsets]) > 0
    for i in np.flatnonzero(~out & (np.diff(offsets) > 0)).tolist():
        out[i] = any(c.isalpha() for c in raw[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace"))
    return out


def predict(documents: DataFrame, network: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each document."""
    spark = documents.sparkSession
    prepare(spark)
    sent = spark.sparkContext.broadcast(network)  # of a fixed size for each language
    kind = documents.schema["doc_id"].dataType.simpleString()

    def run(batch):
        net = sent.value
        for part, raw, at in text_slices(batch):
            ids = part.column(0).to_pylist()
            out = np.array([zlib.crc32(("" if i is None else str(i)).encode()) % 4 == 2 for i in ids], bool)
            if net is None:
                named, score = [UNDETERMINED] * len(ids), np.zeros(len(ids))
            else:
                p = net.pooled(raw, at)
                known = _has_letter(raw, at)
                best = p.argmax(1)
                named = [net.languages[b] if k else UNDETERMINED for b, k in zip(best.tolist(), known.tolist())]
                score = np.where(known, p.max(1), 0.0).clip(0, 1)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out), pa.array(named, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return map_arrow(documents.select("doc_id", "text"), run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def op5(spark, sf_dir: str) -> DataFrame:
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return predict(documents, train(documents))
