"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes are read in overlapping chunks that cover all of it.  Each byte is a fixed vector (its class
and random codes); learned filters run over the chunk, their rectified responses are pooled by maximum and by mean, and
a small dense layer gives the chunk's logit.  A text's probability combines the mean, the largest and the smallest chunk
logit by a logistic curve fitted on the training sample.

Training draws a bounded sample: at most ``per_class`` rows of each class with at most ``most_chars`` characters each and 8
million together, fetched to the driver.  Scoring reads every whole text.  Defined cases: null text is empty and has one
all-padding chunk; if the sample lacks a class every score is its only label (0 without labels); every row is scored
alone, so ids may repeat or be null; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import only_state, release_memory, text_or_empty
from ledgerline.llm.labelled import logistic, remainder, training_sample
from ledgerline.llm.tokens import slices
from ledgerline.llm.words import encoded

CHUNK, TAPS, STRIDE, FILTERS, HIDDEN = 512, 8, 2, 24, 16
OVERLAP = 16
PLACES = (CHUNK - TAPS) // STRIDE + 1


def _byte_vectors() -> np.ndarray:
    b = np.arange(256)
    classes = [(b >= 65) & (b <= 90), (b >= 97) & (b <= 122), np.isin(b, [9, 10, 13, 32]), (b >= 48) & (b <= 57),
               b >= 128, (b > 32) & (b < 127) & ~np.isin(b, [*range(48, 58), *range(65, 91), *range(97, 123)])]
    codes = np.random.default_rng(7).standard_normal((256, 2)) * 0.7
    out = np.column_stack([*[c.astype(float) for c in classes], codes])
    out[0] = 0
    return out.astype(np.float32)


VECTORS = _byte_vectors()


def chunks(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(chunks as rows of bytes padded with 0, filter places that lie on text, owner of each chunk)."""
    size = np.array([len(t) for t in texts], np.int64)
    step = CHUNK - OVERLAP
    count = np.maximum(1, -(-(size - OVERLAP) // step))
    owner = np.repeat(np.arange(len(texts)), count)
    shift = (np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)) * step
    raw = np.frombuffer(b"".join(texts) + bytes(CHUNK), np.uint8)
    start = np.concatenate([[0], np.cumsum(size)[:-1]])[owner] + shift
    length = np.minimum(CHUNK, size[owner] - shift)
    x = np.empty((len(start), CHUNK), np.uint8)
    for a in range(0, len(start), 1024):  # the index is eight times the bytes
        part = slice(a, a + 1024)
        x[part] = raw[np.minimum(start[part, None] + np.arange(CHUNK), len(raw) - 1)]
        x[part][np.arange(CHUNK) >= length[part, None]] = 0
    return x, np.clip((length - TAPS) // STRIDE + 1, 1, PLACES), owner


@dataclass
class Network:
    filters: np.ndarray  # (TAPS * vector, FILTERS)
    offsets: np.ndarray
    dense: np.ndarray  # (2 * FILTERS, HIDDEN)
    dense_offsets: np.ndarray
    out: np.ndarray  # HIDDEN and the bias
    curve: np.ndarray  # of mean, largest, smallest chunk logit, and bias; alone: the constant score

    def _pooled(self, x: np.ndarray, places: np.ndarray):
        v = VECTORS[x].reshape(len(x), -1)
        n = VECTORS.shape[1]
        cols = np.lib.stride_tricks.as_strided(
            v, (len(x), PLACES, TAPS * n), (v.strides[0], STRIDE * n * v.itemsize, v.itemsize)).reshape(-1, TAPS * n)
        a = (cols @ self.filters).reshape(len(x), PLACES, FILTERS)
        a += self.offsets
        np.maximum(a, 0, out=a)
        short = np.flatnonzero(places < PLACES)
        if len(short):
            a[short] *= (np.arange(PLACES) < places[short, None])[:, :, None]
        return cols, a, np.concatenate([a.max(axis=1), a.sum(axis=1) / places[:, None]], axis=1)

    def logits(self, x: np.ndarray, places: np.ndarray) -> np.ndarray:
        out = np.empty(len(x))
        for i in range(0, len(x), 128):
            pooled = self._pooled(x[i : i + 128], places[i : i + 128])[2]
            out[i : i + 128] = np.maximum(pooled @ self.dense + self.dense_offsets, 0) @ self.out[:-1] + self.out[-1]
        return out

    def features(self, texts: list[bytes]) -> np.ndarray:
        x, places, owner = chunks(texts)
        z = self.logits(x, places)
        first = np.flatnonzero(np.diff(owner, prepend=-1))
        return np.column_stack([np.add.reduceat(z, first) / np.diff(np.append(first, len(z))),
                                np.maximum.reduceat(z, first), np.minimum.reduceat(z, first)])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if not len(texts) or len(self.curve) == 1:
            return np.full(len(texts), float(self.curve[-1]))
        z = self.features(texts) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))

    def step(self, x, places, y, weight) -> dict[str, np.ndarray]:
        """Gradients of the weighted logistic loss over some chunks."""
        cols, a, pooled = self._pooled(x, places)
        h = np.maximum(pooled @ self.dense + self.dense_offsets, 0)
        dz = weight * (1 / (1 + np.exp(-np.clip(h @ self.out[:-1] + self.out[-1], -30, 30))) - y) / len(x)
        dh = np.outer(dz, self.out[:-1]) * (h > 0)
        dp = dh @ self.dense.T
        da = np.repeat((dp[:, FILTERS:] / places[:, None])[:, None, :], PLACES, axis=1)
        top = a.argmax(axis=1)
        i, j = np.indices(top.shape)
        da[i, top, j] += dp[:, :FILTERS]
        da = (da * (a > 0)).reshape(-1, FILTERS).astype(np.float32)
        return {"filters": cols.T @ da, "offsets": da.sum(axis=0), "dense": pooled.T @ dh, "dense_offsets": dh.sum(axis=0),
                "out": np.append(h.T @ dz, dz.sum())}


def train(texts: list[str], y: np.ndarray, chunks_seen: int = 60_000, batch: int = 64, rate: float = 3e-3) -> Network:
    """Adam over random chunks of the sample, classes in balance; then the curve over whole texts."""
    rng = np.random.default_rng(11)
    n = VECTORS.shape[1]
    net = Network((rng.standard_normal((TAPS * n, FILTERS)) * 0.25).astype(np.float32), np.zeros(FILTERS, np.float32),
                  rng.standard_normal((2 * FILTERS, HIDDEN)) * 0.2, np.zeros(HIDDEN), np.append(rng.standard_normal(HIDDEN) * 0.2, 0),
                  np.array([float(y[0]) if len(y) else 0.0]))
    if len(np.unique(y)) < 2:
        return net
    raw = encoded(texts)
    x, places, owner = chunks(raw)
    of_class = [np.flatnonzero(y == c) for c in (0, 1)]
    first = np.searchsorted(owner, np.arange(len(raw)))
    many = np.bincount(owner, minlength=len(raw))
    names = ("filters", "offsets", "dense", "dense_offsets", "out")
    mean, square = ({k: np.zeros_like(getattr(net, k), dtype=np.float64) for k in names} for _ in range(2))
    steps = chunks_seen // batch
    for t in range(1, steps + 1):
        docs = np.concatenate([rng.choice(c, batch // 2) for c in of_class])
        at = first[docs] + (rng.random(len(docs)) * many[docs]).astype(np.int64)
        for k, g in net.step(x[at], places[at], y[docs], np.ones(len(docs))).items():
            mean[k] = 0.9 * mean[k] + 0.1 * g
            square[k] = 0.999 * square[k] + 0.001 * g * g
            move = rate * (1 - t / steps) * (mean[k] / (1 - 0.9**t)) / (np.sqrt(square[k] / (1 - 0.999**t)) + 1e-8)
            setattr(net, k, (getattr(net, k) - move).astype(getattr(net, k).dtype))
    net.curve = logistic(np.concatenate([net.features(raw[i : i + 100]) for i in range(0, len(raw), 100)]), y)
    return net


def fitted(docs: DataFrame, labels: DataFrame, per_class: int = 2500, most_chars: int = 20_000) -> Network:
    return train(*training_sample(docs, labels, "quality", per_class, most_chars))


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    held = spark.sparkContext.broadcast(fitted(docs, labels))

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only_state()
        try:
            for texts in batches:
                out = [held.value.scores(encoded(texts.iloc[a:b])) for a, b in slices(texts)]
                yield pd.Series(np.concatenate(out) if out else np.empty(0))
        finally:
            release_memory()

    return docs.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"),
                       probability(text_or_empty()).alias("score")).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int"))
