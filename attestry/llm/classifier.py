"""Quality classifier: random-indexing vectors, pooled per text, and a two-layer network.

1. Every word is two units: a hash class of the lower-cased word (``WORDS`` of them, so words
   of a large vocabulary share vectors), and its shape (case, length, digits, symbols, closing
   punctuation). Each unit has a sparse ternary index
   vector drawn from a fixed seed. A unit's word vector is the sum of the index vectors of
   the units beside it, over all texts; tasks add up their own words, Spark adds the tasks.
2. A text is pooled to the mean vectors of its words and shapes, their norms and its length.
3. A network with one hidden layer is fitted in numpy to a bounded sample of labelled texts
   (``SAMPLE`` rows, drawn by a hash of the id, none of them held out); a temperature fitted
   on a part that training did not see calibrates its probabilities.

Only texts enter a score. ``WORDS`` and ``DIM`` fix the size of what is collected and sent
to tasks, whatever the input.

Defined cases: a null or empty text pools to zeros and is scored like any other; labels that
are null or without a text are passed over; if the sample has fewer than two classes, all
scores are its share of ones, or 0.5; a score of exactly one half predicts 1; texts of any
length are taken whole; rows that repeat are scored each for itself, and an id that repeats in
documents or labels counts once in the sample, with its least text and label; an empty table
gives an empty result; other columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attestry.llm import words as W

#: Labelled rows that the network is fitted to, in the mean.
SAMPLE = 20_000
WORDS, SHAPES, DIM, NONZERO, HIDDEN = 4096, 384, 32, 4, 24
UNITS = WORDS + SHAPES
INPUTS = 2 * DIM + 3

_rng = np.random.Generator(np.random.PCG64(11))
_AT = np.argsort(_rng.random((UNITS, DIM)), 1)[:, :NONZERO]
_SIGN = _rng.choice([-1, 1], (UNITS, NONZERO))

_CLASS = {name: np.zeros(256, np.int64) for name in ("upper", "letter", "digit", "symbol", "punct", "wide")}
_CLASS["upper"][65:91] = 1
_CLASS["letter"][65:91] = _CLASS["letter"][97:123] = 1
_CLASS["digit"][48:58] = 1
_CLASS["symbol"][np.frombuffer(b"#*$%&|<>=_~^@{}[]\\", np.uint8)] = 1
_CLASS["punct"][np.frombuffer(b".,;:!?", np.uint8)] = 1
_CLASS["wide"][0x80:] = 1


def held_out(id_col: str) -> Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def units(words: W.Words) -> tuple[np.ndarray, np.ndarray]:
    """The word's and the shape's unit of each word."""
    word = (words.hashes(lower=True) % np.uint64(WORDS)).astype(np.int64)
    if not len(word):
        return word, word

    def count(name: str) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(_CLASS[name][words.data])))
        return sums[words.end] - sums[words.start]

    upper, letter = count("upper"), count("letter")
    first, last = words.data[words.start], words.data[words.end - 1]
    case = np.where((upper > 1) & (upper == letter), 2, _CLASS["upper"][first])
    size = np.searchsorted([2, 4, 8, 14], words.end - words.start, "right")
    flags = (count("digit") > 0) * 1 + (count("symbol") > 0) * 2 + (_CLASS["punct"][last]) * 4 + (count("wide") > 0) * 8
    bang = last == 33
    shape = np.where(bang, 240 + case * 5 + size, (case * 5 + size) * 16 + flags)
    return word, WORDS + shape


def context_sums(words: W.Words) -> np.ndarray:
    """Index vectors beside each unit, added up: [UNITS * DIM]."""
    out = np.zeros(UNITS * DIM)
    both = units(words)
    near = np.flatnonzero(words.row[1:] == words.row[:-1])
    for target in both:
        for source in both:
            t = np.concatenate((target[near], target[near + 1])) * DIM
            s = np.concatenate((source[near + 1], source[near]))
            for z in range(NONZERO):
                out += np.bincount(t + _AT[s, z], _SIGN[s, z], UNITS * DIM)
    return out


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(UNITS * DIM)
    for batch in batches:
        for _, _, words in W.blocks(batch.column(0)):
            total += context_sums(words)
    columns = total.reshape(UNITS, DIM)
    some = np.flatnonzero(columns.any(1))
    names = ["unit", *(f"d{k}" for k in range(DIM))]
    yield pa.record_batch([pa.array(some), *(pa.array(columns[some, k]) for k in range(DIM))], names=names)


def word_vectors(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Unit vectors of length one, [UNITS, DIM]; zeros for units that never occur beside another."""
    sums = [f"d{k}" for k in range(DIM)]
    parts = docs.select(F.col(text_col).cast("string")).mapInArrow(_accumulate, "unit long, " + ", ".join(f"{c} double" for c in sums))
    rows = parts.groupBy("unit").agg(*(F.sum(c).alias(c) for c in sums)).toPandas()  # UNITS rows at most
    out = np.zeros((UNITS, DIM), np.float32)
    out[rows["unit"].to_numpy(np.int64)] = rows[sums].to_numpy(np.float32)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1e-9)


def pooled(words: W.Words, vectors: np.ndarray) -> np.ndarray:
    """[rows, INPUTS] of each row's words."""
    n = len(words.count)
    out = np.zeros((n, INPUTS), np.float32)
    full = words.count > 0
    if full.any():
        edges = words.first[:-1][full]
        for k, unit in enumerate(units(words)):
            mean = np.add.reduceat(vectors[unit], edges, axis=0) / words.count[full, None]
            out[full, k * DIM : (k + 1) * DIM] = mean
            out[full, 2 * DIM + k] = np.linalg.norm(mean, axis=1)
        out[full, -1] = np.log1p(words.count[full]) / 10
    return out


class Network:
    def __init__(self, seed: int = 5) -> None:
        rng = np.random.Generator(np.random.PCG64(seed))
        self.shift, self.scale = np.zeros(INPUTS), np.ones(INPUTS)
        self.w = [rng.normal(0, INPUTS**-0.5, (INPUTS, HIDDEN)), np.zeros(HIDDEN), rng.normal(0, HIDDEN**-0.5, HIDDEN), np.zeros(1)]
        self.temperature = 1.0
        self.constant: float | None = None

    def logits(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.w
        return np.tanh((x - self.shift) / self.scale @ a + b) @ c + d[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))

    def fit(self, x: np.ndarray, y: np.ndarray, rounds: int = 40, batch: int = 128) -> Network:
        if len(np.unique(y)) < 2:
            self.constant = float(y.mean()) if len(y) else 0.5
            return self
        x, y = x.astype(float), y.astype(float)
        rng = np.random.Generator(np.random.PCG64(9))
        order = rng.permutation(len(y))
        apart = order[: max(1, len(y) // 5)] if len(y) >= 50 else order  # for the temperature
        own = order[len(apart) :] if len(y) >= 50 else order
        self.shift, self.scale = x[own].mean(0), x[own].std(0) + 1e-6
        m, v, t = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w], 0
        z = (x - self.shift) / self.scale
        for _ in range(rounds):
            for at in np.array_split(rng.permutation(own), max(1, len(own) // batch)):
                a, b, c, d = self.w
                h = np.tanh(z[at] @ a + b)
                err = (1 / (1 + np.exp(-np.clip(h @ c + d[0], -30, 30))) - y[at]) / len(at)
                back = np.outer(err, c) * (1 - h * h)
                grads = [z[at].T @ back + 1e-4 * a, back.sum(0), h.T @ err + 1e-4 * c, err.sum(keepdims=True)]
                t += 1
                for w, g, p, q in zip(self.w, grads, m, v, strict=True):
                    p += 0.1 * (g - p)
                    q += 0.001 * (g * g - q)
                    w -= 0.005 * (p / (1 - 0.9**t)) / (np.sqrt(q / (1 - 0.999**t)) + 1e-8)
        logits, truth = self.logits(x[apart]), y[apart]
        choices = np.exp(np.linspace(-1.5, 2.5, 81))
        loss = [np.logaddexp(0, np.where(truth > 0, -1, 1) * logits / c).mean() for c in choices]
        self.temperature = float(choices[int(np.argmin(loss))])
        return self


def train(docs: DataFrame, labels: DataFrame, vectors: np.ndarray, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Network:
    """Fit to labelled texts that are not held out."""
    rows = labels.select(F.col(id_col), F.col(label_col).alias("label")).where(F.col("label").isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    have = rows.count()
    share = min(1.0, sample / max(have, 1))
    rows = rows.where(F.pmod(F.xxhash64(id_col), F.lit(1_000_000)) < F.lit(round(share * 1_000_000)))
    # about ``sample`` ids, so they can be broadcast
    rows = rows.groupBy(id_col).agg(F.min("label").alias("label"))
    texts = docs.select(id_col, F.col(text_col).cast("string").alias("text")).join(F.broadcast(rows), id_col)
    texts = texts.groupBy(id_col).agg(F.min("text").alias("text"), F.min("label").alias("label")).select("label", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words in W.blocks(batch.column(1)):
                x = pooled(words, vectors)
                yield pa.record_batch([batch.column(0).slice(at, to - at).cast(pa.int64()), pa.array([v.tobytes() for v in x], pa.binary())], names=["label", "x"])

    found = texts.mapInArrow(run, "label long, x binary").toPandas()
    x = np.frombuffer(b"".join(found["x"]), np.float32).reshape(-1, INPUTS)
    y = found["label"].to_numpy(float)
    order = np.lexsort((*x.T[:4], y))  # the fit does not depend on how rows arrive
    return Network().fit(x[order], y[order])


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """``id_col``, held_out, score and predicted of every row."""
    vectors = word_vectors(docs, text_col)
    network = train(docs, labels, vectors, id_col, text_col, label_col, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, to, words in W.blocks(batch.column(1)):
                p = network.score(pooled(words, vectors))
                yield pa.record_batch([batch.column(0).slice(at, to - at), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["key", "score", "predicted"])

    kind = dict(docs.dtypes)[id_col]
    texts = docs.select(F.col(id_col).alias("key"), F.col(text_col).cast("string").alias("text"))
    out = texts.mapInArrow(run, f"key {kind}, score double, predicted int").withColumnRenamed("key", id_col)
    return out.select(id_col, F.coalesce(held_out(id_col), F.lit(False)).alias("held_out"), "score", "predicted")
