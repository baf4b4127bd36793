"""Quality classifier: random-indexing word vectors pooled per document, then a
two-layer numpy network whose probabilities are calibrated by a temperature.

Every word has a sparse ternary index vector, drawn by hash for the word and
for its shape (case, digits and punctuation with runs collapsed). One pass over
all documents adds, for each of ``BUCKETS`` word buckets, the index vectors of
the words next to its words: whole numbers, summed by Spark, so the order of
tasks does not matter. The table has a fixed size whatever the corpus. A word's
vector is its own index vector beside its bucket's normalised context vector.

A document is pooled to the mean and the spread of its word vectors, and the
mean product of each with the next. The network learns from at most
``max_train`` labelled documents (the lowest by a hash of the id).
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, mix, packed, slices, spaced_words, texts, with_field

DIM = 32  # of index vectors and of context vectors
BUCKETS = 1 << 14
SPARSE = 2  # entries that are not 0, for the word and again for its shape
MAX_TRAIN = 20_000
HIDDEN, EPOCHS, BATCH, RATE, DECAY = 32, 40, 256, 2e-3, 1e-4
THRESHOLD = 0.3
SLICE_BYTES = 2 << 20
BLOCK = 1 << 16  # words whose vectors are in memory at once
KNOWN_WORDS = 1 << 18  # whose hashes a task remembers

_CLASS = bytes(65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57 else c for c in range(256))
_RUN = re.compile(rb"(.)\1+", re.S)


class Words(dict):
    """word -> (hash, hash of its shape); bounded."""

    def __missing__(self, word: bytes) -> tuple[int, int]:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        shape = _RUN.sub(rb"\1", word.translate(_CLASS))
        x = self[word] = xxhash.xxh64_intdigest(word), xxhash.xxh64_intdigest(shape, 7)
        return x


def hashed(docs: list[bytes], words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Hash and shape hash of every word (n x 2), and the words per document."""
    pairs = [[words[w] for w in spaced_words(d)] for d in docs]
    n = np.array([len(x) for x in pairs], np.int64)
    flat = np.fromiter((v for x in pairs for p in x for v in p), np.uint64, 2 * int(n.sum()))
    return flat.reshape(-1, 2), n


def _draws(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions and signs of the index vectors: 2 * SPARSE of each word."""
    pos, sign = [], []
    for part in (0, 1):
        for k in range(SPARSE):
            x = mix(h[:, part] + np.uint64(2 * k + part + 1))
            pos.append((x % np.uint64(DIM)).astype(np.int64))
            sign.append(1 - 2 * ((x >> np.uint64(40)) & np.uint64(1)).astype(np.int64))
    return np.stack(pos, 1), np.stack(sign, 1)


def bucket(h: np.ndarray) -> np.ndarray:
    return (mix(h[:, 0]) % np.uint64(BUCKETS)).astype(np.int64)


def add_contexts(sums: np.ndarray, h: np.ndarray, n: np.ndarray) -> None:
    """Adds to each word's bucket the index vectors of the words beside it."""
    doc = np.repeat(np.arange(len(n)), n)
    at = bucket(h) * DIM
    flat = sums.reshape(-1)
    beside = np.flatnonzero(doc[1:] == doc[:-1])
    for start in range(0, len(beside), BLOCK):
        i = beside[start : start + BLOCK]
        for here, there in ((i, i + 1), (i + 1, i)):
            pos, sign = _draws(h[there])
            np.add.at(flat, (at[here, None] + pos).ravel(), sign.ravel())


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums, words = np.zeros((BUCKETS, DIM), np.int64), Words()
    for batch in slices(batches, "text", SLICE_BYTES):
        add_contexts(sums, *hashed(texts(batch.column("text")), words))
    some = np.flatnonzero(sums.any(axis=1))
    if len(some):
        yield pa.RecordBatch.from_arrays(
            [pa.array(some), *(pa.array(sums[some, d]) for d in range(DIM))], names=["bucket", *(f"v{d}" for d in range(DIM))]
        )


def context_table(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Normalised context vectors of all buckets, from all documents. The
    driver gets ``BUCKETS`` rows at most."""
    schema = "bucket bigint, " + ", ".join(f"v{d} bigint" for d in range(DIM))
    parts = map_arrow(docs.select(F.col(text_col).alias("text")), _contexts, schema)
    sums = parts.groupBy("bucket").agg(*[F.sum(f"v{d}").alias(f"v{d}") for d in range(DIM)]).toArrow()
    out = np.zeros((BUCKETS, DIM))
    if sums.num_rows:
        out[sums["bucket"].to_numpy()] = np.stack([sums[f"v{d}"].to_numpy() for d in range(DIM)], 1)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return out / np.maximum(norm, 1)


def vectors(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Index vector beside context vector: n x 2 DIM."""
    own = np.zeros((len(h), DIM))
    pos, sign = _draws(h)
    np.add.at(own.reshape(-1), (np.arange(len(h))[:, None] * DIM + pos).ravel(), sign.ravel())
    return np.concatenate([own, table[bucket(h)]], axis=1)


def pooled(docs: list[bytes], table: np.ndarray, words: Words) -> np.ndarray:
    """One row per document: mean and spread of its word vectors, mean product
    of neighbours, and the logarithm of the word count. No words: zeros."""
    h, n = hashed(docs, words)
    ends = np.cumsum(n)
    width = 2 * DIM
    first, second, beside = (np.zeros((len(n), width)) for _ in range(3))
    d = 0
    for start in range(0, len(h), BLOCK):
        stop = min(start + BLOCK, len(h))
        _, some, back = np.unique(h[start : stop + 1, 0], return_index=True, return_inverse=True)
        table_v = vectors(h[start + some], table)
        while ends[d] <= start:
            d += 1
        for e in range(d, len(n)):  # the documents with words in this block
            a, b = max(start, int(ends[e] - n[e])), min(stop, int(ends[e]))
            if a >= stop:
                break
            if a < b:
                v = table_v[back[a - start : min(b + 1, int(ends[e])) - start]]  # and the word that follows
                own, after = v[: b - a], v[1:]
                first[e] += own.sum(axis=0)
                second[e] += np.einsum("ij,ij->j", own, own)
                beside[e] += np.einsum("ij,ij->j", v[:-1], after)
    m = np.maximum(n, 1)[:, None]
    mean = first / m
    spread = np.sqrt(np.maximum(second / m - mean * mean, 0))
    near = beside / np.maximum(n - 1, 1)[:, None]
    return np.concatenate([mean, spread, near, np.log1p(n)[:, None]], axis=1)


WIDTH = 6 * DIM + 1


@dataclass
class Network:
    """tanh layer and logistic output over standardised inputs."""

    mean: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -500, 500)))


def _loss(logits: np.ndarray, y: np.ndarray) -> float:
    return float(np.mean(np.logaddexp(0, logits) - y * logits))


def fit(x: np.ndarray, y: np.ndarray, seed: int = 11) -> Network:
    """Adam on the log loss over four fifths of the rows; the temperature is
    the one with the least log loss on the others. Without rows of both
    labels the score is the share of label 1 (one half without rows)."""
    rng = np.random.default_rng(seed)
    scale = np.maximum(x.std(axis=0), 1e-3) if len(x) else np.ones(WIDTH)
    mean = x.mean(axis=0) if len(x) else np.zeros(WIDTH)
    net = Network(mean, scale, rng.normal(0, 1 / np.sqrt(WIDTH), (WIDTH, HIDDEN)), np.zeros(HIDDEN), np.zeros(HIDDEN), 0.0)
    if len(np.unique(y)) < 2:
        net.b2 = float(np.clip(np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5)), -5, 5))
        return net
    net.w2 = rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN)
    z = np.clip((x - mean) / scale, -8, 8)
    other = rng.random(len(x)) < 0.2 if len(x) >= 50 else np.zeros(len(x), bool)
    train = np.flatnonzero(~other)
    params = [net.w1, net.b1, net.w2, np.zeros(1)]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        for at in range(0, len(order := rng.permutation(train)), BATCH):
            i = order[at : at + BATCH]
            hidden = np.tanh(z[i] @ params[0] + params[1])
            p = 1 / (1 + np.exp(-np.clip(hidden @ params[2] + params[3], -500, 500)))
            d = (p - y[i]) / len(i)
            dh = np.outer(d, params[2]) * (1 - hidden * hidden)
            grads = [z[i].T @ dh + DECAY * params[0], dh.sum(axis=0), hidden.T @ d + DECAY * params[2], np.array([d.sum()])]
            step += 1
            for p_, g, a, b in zip(params, grads, first, second, strict=True):
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                p_ -= RATE * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.999**step)) + 1e-8)
    net.b2 = float(params[3][0])
    held = np.flatnonzero(other)
    if len(held) and len(np.unique(y[held])) == 2:
        raw = net.logits(x[held])
        net.temperature = float(min(np.geomspace(0.25, 8, 200), key=lambda t: _loss(raw / t, y[held])))
    return net


def _features(table, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = Words()
    for batch in slices(batches, "text", SLICE_BYTES):
        x = pooled(texts(batch.column("text")), table.value, words)
        rows = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), WIDTH).cast(pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("label"), rows], names=["key", "label", "x"])


def _scores(model, text: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    table, net = model.value
    words = Words()
    for batch in slices(with_field(batches, text), "text", SLICE_BYTES):
        score = net.scores(pooled(texts(batch.column("text")), table, words))
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(score)], names=["row", "score"])


def held_out(doc_id: str) -> Column:
    """Whether crc32 of the id's text is a multiple of 5 (null id: no)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_train: int = MAX_TRAIN
) -> tuple[np.ndarray, Network]:
    """Context table (from all of ``docs``) and network (from at most
    ``max_train`` labelled rows that are not held out; contradicting labels of
    one id count as the lower one, rows without id or label are passed over)."""
    table = context_table(docs, text_col)
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("label"))
        .where(F.col("id").isNotNull() & F.col("label").isNotNull() & ~held_out("id"))
        .groupBy("id")
        .agg(F.min("label").alias("label"))
        .withColumn("key", F.xxhash64(F.col("id").cast("string")))
        .orderBy("key", "id")
        .limit(max_train)
    )
    shared = docs.sparkSession.sparkContext.broadcast(table)
    some = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(known), "id")
    got = (
        map_arrow(some.select("key", "label", "text"), partial(_features, shared), "key bigint, label double, x array<double>")
        .orderBy("key")
        .limit(max_train)
        .toArrow()
    )
    x = got["x"].combine_chunks().flatten().to_numpy().reshape(-1, WIDTH)
    y = got["label"].to_numpy()
    order = np.lexsort((*x.T[:3], got["key"].to_numpy()))
    return table, fit(x[order], y[order])


def score(docs: DataFrame, model: tuple[np.ndarray, Network], *, text_col: str = "text") -> DataFrame:
    """``row`` (all columns of ``docs`` as a struct) and ``score``, the
    calibrated probability of label 1 by the text alone. Null and empty texts
    are scored as documents without words; one row out for each row in."""
    inp = packed(docs)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_arrow(inp, partial(_scores, shared, docs.columns.index(text_col)), f"row {inp.schema['row'].dataType.simpleString()}, score double")
