"""Toxicity: a support vector machine over a gapped subsequence string kernel, with Nyström landmarks.

Kernel of two words: the common subsequences of three bytes that span at most ``SPAN`` bytes, each weighed by
DECAY**span on both sides, divided by the landmark's norm and the smaller of both norms (1 for equal words, at most 1): letters
that a word has besides the landmark's cost nothing in themselves.  Gaps and inserted characters only lower the weight, and no
value is cut off, so "i.d.i.o.t" and "idxiot" stay near "idiot", and "ixdxixoxt" less so.  ASCII punctuation inside a word is skipped, and a run of three or
more one-letter words also counts as one word.  The kernel of a sentence and a landmark word is the sum over the
sentence's words of the word kernel to the power POWER (a convolution kernel).

Landmarks are the words of the labelled training rows that speak most for either toxic documents; the Nyström
features of a sentence are its kernel values to the landmarks times the inverse root of the landmarks' own kernel.
A linear machine (squared hinge) is trained on labelled sentences: each training document stands for its sentence of
the highest margin, chosen anew each round (a document is toxic if one of its sentences is).  As the kernel sums over
words, a trained machine is one number a word; a document's probability comes from its best sentence and its total
evidence by a logistic curve fitted on the training rows.

Training reads every labelled row outside the held-out remainder, its whole text, in Spark tasks: word counts by class are
added by word, the kernel values of a word are computed once while a task remembers it, the sentences' are written in 16-bit floats, every round's best sentences are a written table, and
each Newton step sends one sum of gradients and curvatures a task to the driver.  In the curve a class weighs at most
CLASS_WEIGHT rows, so the prior of the probabilities does not move with the number of labels.
Scoring reads every whole text.  Defined cases: null text is empty; texts without words, and every text if the training rows
lack a class, get the score of no evidence; every row is scored alone, so ids may repeat or be null; empty
tables give no rows; other columns are kept by ``scored``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import only_state, release_memory, small_batches, text_or_empty, tidied, worker_state, written
from ledgerline.llm.labelled import logistic_of, remainder, training_rows
from ledgerline.llm.tokens import slices
from ledgerline.llm.words import _CODES, _powers, encoded, mixed

SPAN = 9  # three letters and the gaps of a span of 5 still meet with one more letter in every gap
DECAY = 0.9
POWER = 3
WIDTH = 24  # longer words are read in overlapping windows
BLOCK = 1 << 11  # words at a time
REMEMBERED = 1_000_000  # words whose evidence a worker keeps
VECTORS = 1 << 16  # words whose kernel values to all landmarks a training task keeps
RUNS = 4  # rows of the sentences' kernel table, of about a megabyte each, that are stored and read together
SENTENCE = 64  # words; longer sentences are cut
CLASS_WEIGHT = 2500  # rows that a class counts as in the curve, if it has more
PATTERNS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_NONE = 1 << 24  # above every key of 21 bits of code and 3 bits of span
_WEIGHT = DECAY ** np.arange(3, SPAN + 1)  # by the span's number

#: byte -> letter code, 0 for bytes that are skipped, -1 for white space; 7 bits a code
_LETTER = np.zeros(256, np.int16)
for _b in range(256):
    _c = _b + 32 if 65 <= _b <= 90 else _b
    _LETTER[_b] = (_c & 0x7F) or 0x7F if _c >= 0x80 or 97 <= _c <= 122 or 48 <= _c <= 57 else 0
_LETTER[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = -1
_CLOSES = np.zeros(256, bool)
_CLOSES[[0x2E, 0x21, 0x3F, 0x0A]] = True


@dataclass
class Words:
    """The words of some texts: letter codes of all of them, and each word's place, text, sentence and 64-bit hash."""

    letters: np.ndarray
    start: np.ndarray
    size: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    hash: np.ndarray

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """(one word of each hash, shortest first; for each word the place of its hash in that list)."""
        _, at, back = np.unique(self.hash, return_index=True, return_inverse=True)
        order = np.argsort(self.size[at], kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return at[order], place[back]


def split_words(texts: list[bytes]) -> Words:
    raw = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8)
    ends = np.cumsum([len(t) + 1 for t in texts])
    code = _LETTER[raw]
    keep = np.flatnonzero(code > 0)
    letters = code[keep]
    power, unpower = _powers(len(letters) + 1)
    total = np.zeros(len(letters) + 1, np.uint64)
    np.cumsum(_CODES[letters] * power[: len(letters)], out=total[1:])
    word = np.cumsum(code < 0, dtype=np.int32)[keep]  # white space so far tells words apart
    first = np.flatnonzero(np.diff(word, prepend=-1))
    size = np.diff(np.append(first, len(keep)))
    text = np.searchsorted(ends, keep[first], side="right")
    closed = np.cumsum(_CLOSES[raw], dtype=np.int32)[keep[first]]
    # sentences: between closing bytes, of one text, at most SENTENCE words
    new = (np.diff(closed, prepend=-1) != 0) | (np.diff(text, prepend=-1) != 0)
    start = np.flatnonzero(new)
    nth = np.arange(len(first)) - np.repeat(start, np.diff(np.append(start, len(first))))
    sentence = np.cumsum(new | (nth % SENTENCE == 0)) - 1
    # a run of three or more one-letter words of one text is one more word; it counts in the sentence where it begins
    lone = size == 1
    joined = lone[1:] & lone[:-1] & (text[1:] == text[:-1])
    a, b = np.flatnonzero(lone & ~np.append(False, joined)), np.flatnonzero(lone & ~np.append(joined, False)) + 1
    long = b - a >= 3
    a, b = a[long], b[long]
    starts = np.concatenate([first, first[a]])
    sizes = np.concatenate([size, b - a])
    hashes = mixed((total[starts + sizes] - total[starts]) * unpower[starts])
    owner = np.concatenate([np.arange(len(first)), a])
    return Words(letters, starts, sizes, text[owner], sentence[owner], hashes)


def windows(words: Words, which: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(place in ``which``, letters as rows padded with 0) in blocks of at most BLOCK rows; words over WIDTH letters take several."""
    step = WIDTH - SPAN + 1
    for a in range(0, len(which), BLOCK):
        size = words.size[which[a : a + BLOCK]]
        rows = np.maximum(1, -(-(size - SPAN + 1) // step))
        rows = np.repeat(np.arange(len(size)), rows), np.arange(rows.sum()) - np.repeat(np.cumsum(rows) - rows, rows)
        col = np.arange(min(WIDTH, int(size.max())))
        for b in range(0, len(rows[0]), BLOCK):
            row, shift = rows[0][b : b + BLOCK], rows[1][b : b + BLOCK] * step
            at = (words.start[which[a : a + BLOCK]][row] + shift)[:, None] + col
            there = col < (size[row] - shift)[:, None]
            yield a + row, np.where(there, words.letters[np.minimum(at, len(words.letters) - 1)], 0)


def grams(letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, weight) of each row's distinct gapped three-byte subsequences, the weights of equal ones added up."""
    x, width = letters.astype(np.int32), letters.shape[1]
    high, middle, low = x << 17, x << 10, np.where(x > 0, x << 3, _NONE)
    key = np.empty((len(x), sum(max(0, width - b) for _, b in PATTERNS)), np.int32)
    at = 0
    for a, b in PATTERNS:
        if width > b:
            part = key[:, at : at + width - b]
            np.bitwise_or(high[:, : width - b], middle[:, a : width - b + a], out=part)
            part |= low[:, b:] | (b - 2)
            at += width - b
    key.sort(axis=1)
    there = key < _NONE
    many = there.sum(axis=1)
    key = key[there]
    row, code = np.repeat(np.arange(len(x)), many), key >> 3
    new = np.ones(len(key), bool)
    np.not_equal(code[1:], code[:-1], out=new[1:])
    new[(np.cumsum(many) - many)[many > 0]] = True
    first = np.flatnonzero(new)
    weight = np.add.reduceat(_WEIGHT[key & 7], first) if len(first) else np.empty(0)
    return row[first], code[first], weight


def norms(row: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """The root of the kernel of each of ``n`` words with itself, from its ``grams``."""
    return np.sqrt(np.bincount(row, weights=weight * weight, minlength=n))


class Landmarks:
    """Word kernels against a fixed list of landmark words."""

    def __init__(self, letters: np.ndarray):
        self.m = len(letters)
        row, code, weight = grams(letters)
        self.root = norms(row, weight, self.m)
        order = np.argsort(code, kind="stable")
        codes, first = np.unique(code[order], return_index=True)
        self.slot = np.full(1 << 21, -1, np.int32)
        self.slot[codes] = np.arange(len(codes))
        self.first = np.append(first, len(code))  # a code's landmarks and weights, from here to the next code's
        self.mark, self.weight = row[order], (weight / self.root[row])[order]

    def kernel(self, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, values): the rows that share a subsequence with a landmark, and all their values to the power POWER."""
        row, code, weight = grams(letters)
        slot = self.slot[code]
        on = np.flatnonzero(slot >= 0)
        new = np.diff(row[on], prepend=-1) != 0
        some, back = row[on][new], np.cumsum(new) - 1
        if not len(some):
            return some, np.empty((0, self.m), np.float32)
        size = norms(row, weight, len(letters))[some]
        first, many = self.first[slot[on]], self.first[slot[on] + 1] - self.first[slot[on]]
        at = np.repeat(first - (np.cumsum(many) - many), many)  # a subsequence once for each landmark that has it
        at += np.arange(len(at))
        out = np.bincount(np.repeat(back * self.m, many) + self.mark[at], weights=self.weight[at] * np.repeat(weight[on], many),
                          minlength=len(some) * self.m)
        out = out.astype(np.float32).reshape(-1, self.m)
        out /= np.minimum(size.astype(np.float32)[:, None], self.root.astype(np.float32))
        out = np.minimum(out, 1, out=out)
        powers = out.copy()
        for _ in range(POWER - 1):
            powers *= out
        return some, powers


def summed(rows: np.ndarray, place: np.ndarray, n: int) -> np.ndarray:
    """``n`` sums of the rows of each place."""
    order = np.argsort(place, kind="stable")
    first = np.flatnonzero(np.diff(place[order], prepend=-1))
    out = np.zeros((n, rows.shape[1]), rows.dtype)
    if len(first):
        out[place[order][first]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class WordVectors:
    """Kernel values of words to all landmarks; equal words are computed once while they are remembered.

    About ``keep`` words stay known; then all but the first quarter, which are the frequent ones, are forgotten."""

    def __init__(self, marks: Landmarks, keep: int = VECTORS):
        self.marks, self.keep = marks, keep
        self.known, self.place = np.empty(0, np.uint64), np.empty(0, np.int64)  # hashes, sorted; their rows of ``held``
        self.held = np.zeros((keep, marks.m), np.float32)

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """(a row for each distinct word, each word's row)."""
        at, back = words.distinct()
        hashes = words.hash[at]
        out = np.zeros((len(at), self.marks.m), np.float32)
        near = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        old = self.known[near] == hashes if len(self.known) else np.zeros(len(at), bool)
        out[old] = self.held[self.place[near[old]]]
        new = np.flatnonzero(~old)
        for row, letters in windows(words, at[new]):
            hit, k = self.marks.kernel(letters)
            own, place = np.unique(row[hit], return_inverse=True)
            out[new[own]] += k if len(own) == len(k) else summed(k, place, len(own))
        self._remember(hashes[new], out[new])
        return out, back

    def _remember(self, hashes: np.ndarray, vectors: np.ndarray) -> None:
        if len(self.known) + len(hashes) > self.keep:
            first = self.place < self.keep // 4
            self.known, self.place = self.known[first], self.place[first]
        used = len(self.known)
        hashes, vectors = hashes[: self.keep - used], vectors[: self.keep - used]
        self.held[used : used + len(hashes)] = vectors
        order = np.argsort(hashes)
        at = np.searchsorted(self.known, hashes[order])
        self.known, self.place = np.insert(self.known, at, hashes[order]), np.insert(self.place, at, used + order)


@dataclass
class Model:
    landmarks: Landmarks | None
    weights: np.ndarray  # of each landmark's kernel value
    bias: float
    curve: np.ndarray  # logistic weights of (best sentence margin, log of total evidence, share of evidence), and bias
    known: np.ndarray = field(default_factory=lambda: np.empty(0, np.uint64))  # hashes of remembered words, sorted
    values: np.ndarray = field(default_factory=lambda: np.empty(0, np.float32))
    name: str = field(default_factory=lambda: f"toxicity-{uuid.uuid4().hex}")  # of the words' evidence in a worker

    def remembering(self) -> "Model":
        """This model with what the worker has remembered by another copy with these weights, whatever its curve."""
        kept = worker_state(self.name, lambda: self)
        kept.curve = self.curve
        return kept

    def word_values(self, words: Words) -> np.ndarray:
        """The evidence of each word; equal words are computed once, and remembered within bounds."""
        at, back = words.distinct()
        hashes = words.hash[at]
        out = np.zeros(len(at), np.float32)
        place = np.minimum(np.searchsorted(self.known, hashes), max(0, len(self.known) - 1))
        old = self.known[place] == hashes if len(self.known) else np.zeros(len(at), bool)
        out[old] = self.values[place[old]]
        new = np.flatnonzero(~old)
        for row, letters in windows(words, at[new]):
            hit, k = self.landmarks.kernel(letters)
            np.add.at(out, new[row[hit]], k @ self.weights)
        if len(self.known) + len(new) > REMEMBERED:
            self.known, self.values = np.empty(0, np.uint64), np.empty(0, np.float32)
        order = new[np.argsort(hashes[new])]
        place = np.searchsorted(self.known, hashes[order])
        self.known, self.values = np.insert(self.known, place, hashes[order]), np.insert(self.values, place, out[order])
        return out[back]

    def features(self, texts: list[bytes]) -> np.ndarray:
        words = split_words(texts)
        best = np.full(len(texts), self.bias)
        total = np.zeros(len(texts))
        count = np.bincount(words.text, minlength=len(texts))
        if len(words.start):
            u = self.word_values(words)
            margins = np.bincount(words.sentence, weights=u) + self.bias
            owner = np.zeros(len(margins), np.int64)
            owner[words.sentence] = words.text
            np.maximum.at(best, owner, margins)
            total = np.bincount(words.text, weights=np.maximum(u, 0), minlength=len(texts))
        return np.column_stack([best, np.log1p(total), total / np.maximum(count, 8)])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.landmarks is None:
            return np.full(len(texts), float(self.curve[-1]))
        z = self.features(texts) @ self.curve[:-1] + self.curve[-1]
        return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _parts(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int, Words]]:
    """(first text, the text after the last one, their words), about ``most`` bytes at a time."""
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) <= most):
            size += len(texts[last])
            last += 1
        yield first, last, split_words(texts[first:last])
        first = last


def word_counts(rows: DataFrame) -> DataFrame:
    """letters (codes, a byte each), hash, and the number of toxic and clean rows, of every word of 3 to WIDTH letters."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                raw, y = encoded(batch["text"].iloc[a:b]), batch["y"].to_numpy()[a:b]
                for before, _, words in _parts(raw):
                    fits = np.flatnonzero((words.size >= 3) & (words.size <= WIDTH))
                    own, at, back = np.unique(words.hash[fits], return_index=True, return_inverse=True)
                    word, text = np.divmod(np.unique(back * len(raw) + words.text[fits]), len(raw))  # each word of a text once
                    toxic = np.bincount(word, y[before + text] == 1, len(own)).astype(np.int64)
                    every = words.letters.astype(np.uint8).tobytes()
                    letters = [every[i : i + n] for i, n in zip(words.start[fits[at]].tolist(), words.size[fits[at]].tolist())]
                    yield pd.DataFrame({"letters": letters, "hash": own.view(np.int64), "toxic": toxic,
                                        "clean": np.bincount(word, minlength=len(own)) - toxic})

    found = rows.mapInPandas(tidied(run), "letters binary, hash long, toxic long, clean long")
    return found.groupBy("letters", "hash").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def choose_landmarks(rows: DataFrame, of_class: dict[int, int], count: int) -> np.ndarray:
    """The words whose presence speaks most for a class, by the signed root of their G statistic; two of three for toxic."""
    n = [float(of_class[c]) for c in (1, 0)]

    @F.pandas_udf("double")
    def strength(toxic: pd.Series, clean: pd.Series) -> pd.Series:
        a, b = toxic.to_numpy(float), clean.to_numpy(float)
        r = (a + b) / sum(n)

        def likelihood(k, m):  # k of m against the rate r
            with np.errstate(divide="ignore", invalid="ignore"):
                return np.nan_to_num(k * np.log(k / (m * r)), nan=0.0) + np.nan_to_num((m - k) * np.log((m - k) / (m * (1 - r))), nan=0.0)

        g = likelihood(a, n[0]) + likelihood(b, n[1])
        return pd.Series(np.copysign(np.sqrt(np.maximum(g, 0)), a / n[0] - b / n[1]))

    words = written(rows.sparkSession, word_counts(rows).withColumn("strength", strength("toxic", "clean")), "word-strengths")
    unsigned = F.col("hash").bitwiseXOR(F.lit(-(1 << 63)))  # orders hashes as unsigned numbers
    toxic = words.filter("strength > 0").orderBy(F.col("strength").desc(), unsigned, "letters").limit(count * 2 // 3).collect()
    clean = words.filter("strength < 0").orderBy("strength", unsigned.desc(), "letters").limit(count - len(toxic)).collect()
    out = np.zeros((len(toxic) + len(clean), WIDTH), np.int16)
    for i, r in enumerate([*toxic, *clean]):
        out[i, : len(r["letters"])] = np.frombuffer(r["letters"], np.uint8)
    return out


def sentence_kernels(texts: list[bytes], vectors: WordVectors) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first text, next text, kernel vectors of the sentences near a landmark, their owners from 0) of runs of texts."""
    for first, last, words in _parts(texts, 1 << 18):
        each, back = vectors.of(words)
        speaks = np.flatnonzero(each.any(axis=1)[back])
        sentences, row = np.unique(words.sentence[speaks], return_inverse=True)
        owner = np.empty(len(sentences), np.int64)
        owner[row] = words.text[speaks]
        yield first, last, summed(each[back[speaks]], row, len(sentences)), owner


def kernel_table(spark: SparkSession, rows: DataFrame, marks: Landmarks) -> DataFrame:
    """Written table of runs of texts: y (a byte a text), owner (32 bits a sentence), kernel (16-bit floats)."""
    held = spark.sparkContext.broadcast(marks)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        vectors = WordVectors(held.value)
        for batch in batches:
            for a, b in slices(batch["text"]):
                y = batch["y"].to_numpy(np.int8)[a:b]
                for first, last, kernel, owner in sentence_kernels(encoded(batch["text"].iloc[a:b]), vectors):
                    yield pd.DataFrame([(y[first:last].tobytes(), owner.astype("<u4").tobytes(), kernel.astype("<f2").tobytes())],
                                       columns=["y", "owner", "kernel"])

    return written(spark, rows.mapInPandas(tidied(run), "y binary, owner binary, kernel binary"), "sentence-kernels", "zstd", RUNS)


def best_sentences(spark: SparkSession, kernels: DataFrame, weights: np.ndarray) -> DataFrame:
    """Written table of runs of texts: y, and the kernel vector of each text's sentence of the highest margin (zeros are one, too)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for y, owner, raw in zip(batch["y"], batch["owner"], batch["kernel"]):
                kernel = np.frombuffer(raw, "<f2").reshape(-1, len(weights))
                owners = np.concatenate([np.arange(len(y)), np.frombuffer(owner, "<u4").astype(np.int64)])
                margin = np.concatenate([np.zeros(len(y)), kernel.astype(np.float64) @ weights])
                order = np.lexsort((margin, owners))
                last = order[np.flatnonzero(np.diff(np.append(owners[order], -1)))] - len(y)
                best = np.zeros((len(y), len(weights)), "<f2")
                best[last >= 0] = kernel[last[last >= 0]]
                out.append((y, best.tobytes()))
            yield pd.DataFrame(out, columns=["y", "kernel"])

    return written(spark, kernels.mapInPandas(tidied(run), "y binary, kernel binary"), "best-sentences", "zstd")


def hinge_sums(best: DataFrame, half: np.ndarray, v: np.ndarray, weight: dict[int, float]) -> tuple[np.ndarray, np.ndarray]:
    """(gradient, curvature) of the squared hinge at ``v``, added up by the tasks."""
    size = len(v)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        grad, hess = np.zeros(size), np.zeros((size, size))
        for batch in batches:
            for y, raw in zip(batch["y"], batch["kernel"]):
                y = np.frombuffer(y, np.int8)
                a = np.column_stack([np.frombuffer(raw, "<f2").reshape(len(y), -1).astype(np.float64) @ half, np.ones(len(y))])
                s, c = np.where(y == 1, 1.0, -1.0), np.where(y == 1, weight[1], weight[0])
                gap = np.maximum(0, 1 - s * (a @ v))
                on = gap > 0
                grad -= 2 * a.T @ (c * s * gap)
                hess += 2 * (a[on] * c[on, None]).T @ a[on]
        yield pd.DataFrame({"sums": [np.append(grad, hess).tobytes()]})

    sums = [np.frombuffer(r["sums"]) for r in best.mapInPandas(tidied(run), "sums binary").collect()]
    total = np.sum(sums, axis=0)
    return total[:size], total[size:].reshape(size, size)


def text_features(spark: SparkSession, rows: DataFrame, model: Model) -> DataFrame:
    """Written table: y and the features best, total, share of every row."""
    held = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for a, b in slices(batch["text"]):
                found = held.value.remembering().features(encoded(batch["text"].iloc[a:b]))
                yield pd.DataFrame(found, columns=["best", "total", "share"]).assign(y=batch["y"].to_numpy()[a:b])

    return written(spark, rows.mapInPandas(tidied(run, model.name), "best double, total double, share double, y int"), "text-features")


def train(spark: SparkSession, rows: DataFrame, count: int = 96, rounds: int = 6, ridge: float = 1e-3) -> Model:
    """The model of a written table (text, y); texts and sentence kernels reach the tasks' workers in small batches."""
    with small_batches(spark):
        return _trained(spark, rows, count, rounds, ridge)


def _trained(spark: SparkSession, rows: DataFrame, count: int, rounds: int, ridge: float) -> Model:
    of_class = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(of_class) < 2:
        return Model(None, np.empty(0), 0.0, np.array([float(next(iter(of_class), 0))]))
    total = sum(of_class.values())
    chosen = choose_landmarks(rows, of_class, count)
    if not len(chosen):
        return Model(None, np.empty(0), 0.0, np.array([of_class[1] / total]))
    marks = Landmarks(chosen)
    near, k = marks.kernel(chosen)
    own = np.zeros((len(chosen), len(chosen)))
    own[near] = k
    values, vectors = np.linalg.eigh((own + own.T) / 2 + 1e-3 * np.eye(len(own)))
    half = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T  # inverse root
    kernels = kernel_table(spark, rows, marks)
    weight = {c: total / (2 * n) for c, n in of_class.items()}
    first = len(chosen) * 2 // 3
    v = np.append(half.T @ np.r_[np.ones(first), np.zeros(len(chosen) - first)], 0.0)
    for _ in range(rounds):
        best = best_sentences(spark, kernels, half @ v[:-1])  # each document's best sentence
        for _ in range(30):  # squared hinge by Newton steps
            grad, hess = hinge_sums(best, half, v, weight)
            step = np.linalg.solve(hess + ridge * total * np.eye(len(v)), grad + ridge * total * v)
            v = v - step
            if np.abs(step).max() < 1e-6:
                break
    model = Model(marks, half @ v[:-1], float(v[-1]), np.zeros(4))
    each = F.when(F.col("y") == 1, min(1.0, CLASS_WEIGHT / of_class[1])).otherwise(min(1.0, CLASS_WEIGHT / of_class[0]))
    model.curve = logistic_of(text_features(spark, rows, model), ["best", "total", "share"], each)
    return model


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    spark = docs.sparkSession
    return train(spark, training_rows(spark, docs, labels, "toxic"))


def scored(spark: SparkSession, docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """``docs`` with one more column: the toxicity probability of its whole text."""
    held = spark.sparkContext.broadcast(model)
    name_of = model.name

    @F.pandas_udf("double")
    def probability(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        only_state(name_of)
        try:
            for texts in batches:
                own = held.value.remembering()
                out = [own.scores(encoded(texts.iloc[a:b])) for a, b in slices(texts)]
                yield pd.Series(np.concatenate(out) if out else np.empty(0))
        finally:
            release_memory()

    return docs.withColumn(name, probability(text_or_empty()))


def score_documents(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    rows = scored(spark, docs.select("doc_id", "text"), fitted(docs, labels))
    return rows.select("doc_id", (remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
                       (F.col("score") >= 0.5).cast("int").alias("predicted"))
