"""Operator 8, BPE encoding and decoding with a tokenization automaton.

The merges of a public byte-level BPE with word ends are compiled into a deterministic automaton over
tokens whose paths are exactly the tokenizations that the merges give (the construction published for
BPE automata). It starts with one state that allows every symbol. For each merge (u, v) -> w in order, a
gadget is inserted: the state that u leads to is split off so that v can no longer follow, and w is allowed
wherever u is, leading where v led. Every token leads to one state, so a state is a set of tokens that may
not follow. In preorder of the tree "w hangs below its left part, older ones first", what one gadget forbids
is v and one range, so each state is a short list of ranges, and a transition is a table look-up.

Encoding reads the distinct pieces of a block together. The token that ends each prefix's tokenization is
unique: it is the vocabulary match, found by walking a trie, that the automaton allows after the token that ends
the shorter prefix. Decoding emits the labels of the arcs.

Edge cases: null and empty texts have no tokens and decode to the empty string. Any Unicode text gives what
the tokenizers library gives, and the strings of special tokens become those tokens. Repeated rows are
returned once each. Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import Seen, map_arrow, prepare, text_slices
from .presplit import Presplit, byte_letters

END = "</w>"
TOKENIZER = "word_bpe_49k.json"
_SHIFT = 20
#: Bytes from which on a piece is encoded by itself.
LONG = 1024


class Automaton:
    """The compiled merges: next-token rules, a trie of the vocabulary, and the arcs' labels."""

    def __init__(self, spec: str):
        model = json.loads(spec)["model"]
        if model.get("end_of_word_suffix") != END or model.get("dropout") or model.get("byte_fallback"):
            raise ValueError("a byte-level BPE with word ends is needed")
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        size = max(vocab.values()) + 1
        letters = byte_letters()
        self.symbol = np.array([[vocab[c], vocab[c + END]] for c in letters], np.int64)  # by byte, and whether it ends a word
        self.labels = [""] * size
        for token, i in vocab.items():
            self.labels[i] = token
        self._compile(vocab, merges, size)
        self._trie(letters, vocab)

    def _compile(self, vocab, merges, size) -> None:
        """Inserts the gadgets in order; see the module's text."""
        left, right = np.full(size, -1), np.full(size, -1)
        time = np.full(size, -1)
        alive = np.zeros(size, bool)
        alive[self.symbol.ravel()] = True
        base = {int(x) for x in self.symbol.ravel()}
        forbid: list[dict[int, int]] = [{}]  # of each state: token -> time from which it may not follow
        refs = [len(base) + 1]
        leads = [0] * size
        children: list[list[int]] = [[] for _ in range(size)]

        def may_follow(v: int, rules: dict[int, int]) -> bool:
            until = len(merges)
            while v >= 0:
                if rules.get(v, until) < until:
                    return False
                until, v = int(time[v]), int(left[v])
            return True

        for t, (a, b) in enumerate(merges):
            u, v, w = vocab[a], vocab[b], vocab[a + b]
            if time[w] >= 0 or w in base:
                raise ValueError("a token has two merges")
            left[w], right[w], time[w] = u, v, t
            children[u].append(w)
            state, after = leads[u], leads[v]
            if not (alive[u] and alive[v] and may_follow(v, forbid[state])):
                continue  # the merge can never be made
            alive[w] = True
            leads[w] = after
            refs[after] += 1
            if refs[state] > 1:
                refs[state] -= 1
                forbid.append(dict(forbid[state]))
                refs.append(1)
                state = leads[u] = len(forbid) - 1
            forbid[state][v] = t
        order, last = np.zeros(size, np.int64), np.zeros(size, np.int64)
        n = 0
        for root in sorted(base):
            stack = [(root, 0)]
            while stack:
                x, k = stack.pop()
                if k == 0:
                    order[x] = n
                    n += 1
                if k < len(children[x]):
                    stack += [(x, k + 1), (children[x][k], 0)]
                else:
                    last[x] = n - 1
        lows, highs = [], []
        used = sorted({leads[x] for x in range(size) if alive[x]})
        for state in used:
            ranges = []
            for v, t in forbid[state].items():
                ranges.append((order[v], order[v]))
                later = next((c for c in children[v] if time[c] >= t), None)
                if later is not None:
                    ranges.append((order[later], last[v]))
            end = -2
            for lo, hi in sorted(ranges):
                if lo <= end + 1:
                    if hi > end:
                        highs[-1] = (state << _SHIFT) | int(hi)
                        end = hi
                else:
                    lows.append((state << _SHIFT) | int(lo))
                    highs.append((state << _SHIFT) | int(hi))
                    end = hi
        self.lows, self.highs = np.array(lows, np.int64), np.array(highs, np.int64)
        self.leads, self.order, self.alive = np.array([*leads, 0], np.int64), order, alive  # the last: the start of a word

    def _trie(self, letters, vocab) -> None:
        to_byte = {c: b for b, c in enumerate(letters)}
        nodes: dict[int, int] = {}
        token = [-1]
        self.length = np.zeros(len(self.alive), np.int64)
        for text, i in vocab.items():
            ends = text.endswith(END) and text != END
            body = text[: -len(END)] if ends else text
            if not all(c in to_byte for c in body):
                continue
            at = 0
            for k, c in enumerate(body):
                key = at * 512 + to_byte[c] + 256 * (ends and k == len(body) - 1)
                if key not in nodes:
                    nodes[key] = len(token)
                    token.append(-1)
                at = nodes[key]
            self.length[i] = len(body)
            if self.alive[i]:
                token[at] = i
        self.token = np.array(token, np.int64)
        self.nodes = Seen()
        self.nodes.add(np.fromiter((k * 0x9E3779B97F4A7C15 & (1 << 64) - 1 for k in nodes), np.uint64, len(nodes)))
        self.child = np.fromiter(nodes.values(), np.int64, len(nodes))
        self.arcs: dict[int, int] | None = None  # the trie as a dictionary, for long pieces

    def _step(self, node: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        got = self.nodes.find((node * 512 + symbol).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        return np.where(got >= 0, self.child[got], -1)

    def follows(self, before: np.ndarray, token: np.ndarray) -> np.ndarray:
        """Whether the automaton has an arc for the token in the state after ``before``."""
        key = (self.leads[before] << _SHIFT) | self.order[token]
        at = np.searchsorted(self.lows, key, "right") - 1
        return (at < 0) | (self.highs[at] < key)

    def encode(self, pieces: list[str], block: int = 16384) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the pieces end to end, and how many each has."""
        blobs = [p.encode("utf-8", "surrogateescape") for p in pieces]
        sizes = np.fromiter(map(len, blobs), np.int64, len(blobs))
        order = np.argsort(sizes, kind="stable")
        counts = np.zeros(len(blobs), np.int64)
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        i = 0
        while len(order) and sizes[order[-1]] > LONG:
            k, order = int(order[-1]), order[:-1]
            ids = self._encode_long(blobs[k])
            counts[k] = len(ids)
            parts.append((ids, np.full(len(ids), k)))
        while i < len(order):
            longest = int(sizes[order[min(len(order), i + block) - 1]])
            j = min(len(order), i + max(1, min(block, (block * 64) // max(1, longest))))
            chosen = order[i:j]
            ids, number = self._encode([blobs[k] for k in chosen], sizes[chosen])
            counts[chosen] = number
            parts.append((ids, np.repeat(chosen, number)))
            i = j
        ids = np.concatenate([p[0] for p in parts]) if parts else np.zeros(0, np.int32)
        return ids[np.argsort(np.concatenate([p[1] for p in parts]), kind="stable")] if parts else ids, counts

    def _encode(self, blobs: list[bytes], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n, most = len(blobs), int(sizes[-1])
        symbols = np.frombuffer(b"".join(b.ljust(most, b"\0") for b in blobs), np.uint8).reshape(n, most).astype(np.int64)
        symbols[np.arange(n), sizes - 1] += 256
        last = np.full((n, most + 1), len(self.alive), np.int64)
        for i in range(most):
            rows = np.flatnonzero(sizes > i)
            node = np.zeros(len(rows), np.int64)
            d = 0
            while len(rows):
                node = self._step(node, symbols[rows, i + d])
                d += 1
                keep = node >= 0
                rows, node = rows[keep], node[keep]
                token = self.token[node]
                some = np.flatnonzero(token >= 0)
                some = some[self.follows(last[rows[some], i], token[some])]
                last[rows[some], i + d] = token[some]
                keep = sizes[rows] > i + d
                rows, node = rows[keep], node[keep]
        out = np.full((n, most), -1, np.int32)
        at, rows, k = sizes.copy(), np.arange(n), most
        while len(rows):
            k -= 1
            token = last[rows, at[rows]]
            out[rows, k] = token
            at[rows] -= self.length[token]
            rows = rows[at[rows] > 0]
        kept = out >= 0
        return out[kept], kept.sum(1)

    def _encode_long(self, blob: bytes) -> np.ndarray:
        """One piece, step by step: the same transitions as _encode, without arrays of the steps."""
        if self.arcs is None:
            held = self.nodes.numbers >= 0
            inverse = pow(0x9E3779B97F4A7C15, -1, 1 << 64)
            self.arcs = {k * inverse & (1 << 64) - 1: int(self.child[n]) for k, n in zip(self.nodes.keys[held].tolist(), self.nodes.numbers[held].tolist())}
        arcs, size = self.arcs, len(blob)
        symbols = list(blob)
        symbols[-1] += 256
        last = np.full(size + 1, len(self.alive), np.int64)
        for i in range(size):
            node, found = 0, []
            for j in range(i, size):
                node = arcs.get(node * 512 + symbols[j], -1)
                if node < 0:
                    break
                if self.token[node] >= 0:
                    found.append((j + 1, self.token[node]))
            if found:
                at, token = (np.array(c) for c in zip(*found))
                ok = self.follows(np.full(len(token), last[i]), token)
                last[at[ok]] = token[ok]
        out, at = [], size
        while at:
            out.append(int(last[at]))
            at -= int(self.length[last[at]])
        return np.array(out[::-1], np.int32)

    def labels_of(self, ids: np.ndarray, counts: np.ndarray) -> list[tuple[str, str]]:
        """For each piece, its ids in decimal and its labels, each joined by spaces."""
        names, out, at, ids = self.labels, [], 0, ids.tolist()
        for n in counts.tolist():
            own = ids[at : at + n]
            out.append((" ".join(map(str, own)), " ".join([names[i] for i in own])))
            at += n
        return out


_MADE: dict[int, tuple] = {}


def coder(spec: str, auto: Automaton | None = None) -> tuple[Automaton, Presplit]:
    """The automaton and the pieces it has encoded, made once in a process."""
    key = hash(spec)
    if key not in _MADE:
        auto = auto or Automaton(spec)
        _MADE[key] = (auto, Presplit(spec, auto.encode, auto.labels_of))
    return _MADE[key]


def tokenizer_spec(path: str | None = None) -> str:
    """The tokenizer file's text, read on the driver."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path(TOKENIZER)
    with open(path, encoding="utf-8") as f:
        return f.read()


def _coded(batch: pa.RecordBatch, auto: Automaton, split: Presplit, give):
    for part, raw, at in text_slices(batch):
        rows: list = []
        if split.known:
            numbers, counts = split.pieces(raw, at)
            lengths = split.ids.lengths[numbers]
            ends = np.cumsum(counts)
            total = np.concatenate([[0], np.cumsum(lengths)])[np.concatenate([[0], ends])]
            noted = list(map(split.noted.__getitem__, numbers.tolist()))
            for i, e, n in zip((ends - counts).tolist(), ends.tolist(), np.diff(total).tolist()):
                own = noted[i:e]
                rows.append((n, " ".join([x[0] for x in own]), " ".join([x[1] for x in own])))
        else:
            for r in range(part.num_rows):
                pieces = split.other(raw[at[r] : at[r + 1]].tobytes().decode("utf-8", "replace"))
                words = sorted({p for p in pieces if isinstance(p, str)})
                ids, counts = auto.encode(words)
                made = dict(zip(words, zip(counts.tolist(), auto.labels_of(ids, counts))))
                special = {i: (1, (str(i), name)) for name, i in split.special.items()}
                own = [special[p] if isinstance(p, int) else made[p] for p in pieces]
                rows.append((sum(n for n, _ in own), " ".join(x[0] for _, x in own), " ".join(x[1] for _, x in own)))
        yield give(part, rows)


def encode_decode(documents: DataFrame, path: str | None = None, digests: bool = True) -> DataFrame:
    """doc_id, n_tokens, and ids and decoded text of each document, or their SHA-256 where ``digests``.

    ``ids`` is the list of ids; ``decoded`` is what the tokenizer's decode gives, skipping no special token.
    """
    spark = documents.sparkSession
    prepare(spark)
    spec = tokenizer_spec(path)
    sent = spark.sparkContext.broadcast((spec, coder(spec)[0]))  # both as large as the vocabulary makes them
    kind = documents.schema["doc_id"].dataType.simpleString()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()

    def give(part, rows):
        if digests:
            tail = [pa.array([sha(x[1]) for x in rows], pa.string()), pa.array([sha(x[2]) for x in rows], pa.string())]
        else:
            tail = [pa.array([list(map(int, x[1].split())) for x in rows], pa.list_(pa.int32())), pa.array([x[2] for x in rows], pa.string())]
        names = ["doc_id", "n_tokens", *(("ids_sha256", "decoded_sha256") if digests else ("ids", "decoded"))]
        return pa.RecordBatch.from_arrays([part.column(0), pa.array([x[0] for x in rows], pa.int64()), *tail], names)

    schema = f"doc_id {kind}, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    return map_arrow(documents.select("doc_id", "text"), lambda b: _coded(b, *coder(*sent.value), give), schema)


def op8(spark, sf_dir: str) -> DataFrame:
    return encode_decode(spark.read.parquet(f"{sf_dir}/documents.parquet"))
