"""Language-model scoring: a hashed maximum-entropy model with class-factored softmax.

P(token | history) = P(class | history) * P(token | class).  Tokens are words (runs of non-white bytes after lower-casing A-Z)
and one end per text.  The FREQUENT most frequent tokens are classes of their own; the others fall into TAILS classes by
their last two bytes.  P(class | history) is a softmax over hashed features: the word before (bigram), the one before that
(skip) and the classes of both (trigram); P(token | class) comes from add-one counts.

* Counts: every task counts its distinct words and sends them by hash block; a block's owner adds them up.  The written
  vocabulary (one row a block) and its totals grow with the corpus.
* Training: all training texts, dealt into ROUNDS parts.  In a round every task runs stochastic gradient steps
  over its texts, starting from the round's model; the tasks' models are averaged by their tokens (in two levels).
* Scoring: one pass scores classes in batches and the counts of the COMMON most frequent words (a bounded broadcast); the
  rarer words travel to their block's owner, who answers each batch with its texts' sums.  So no word, however frequent, gathers rows.

Also returned is the add-one unigram base: the sum of log10((c + 1) / (N + V + 1)).
Defined cases: null text is empty (the end alone); every row is scored, also with repeated or null ids (a null id counts as the
empty text for the fold); without training tokens N = V = 0 and the model is uniform over classes; empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm.common import shuffle_width, text_or_empty, written
from ledgerline.llm.labelled import remainder
from ledgerline.llm.tokens import slices
from ledgerline.llm.words import WHITE, encoded, mixed, word_hashes

FREQUENT, TAILS = 32, 32
CLASSES = FREQUENT + TAILS
ROWS = 4096  # of each of the three features
COMMON = 1 << 17
ROUNDS = 2
BATCH = 4096
FLUSH = 1_000_000
END = np.uint64(0x5851F42D4C957F2D)
MODULUS, HELD_OUT = 7, 2


def tokens(raw: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(token hashes with an END after each text, tail class of each, offsets)."""
    found: list[np.ndarray] = []
    words, at = word_hashes(raw, WHITE, found)
    tail = (np.concatenate(found) if found else np.empty(0, np.int64)).astype(np.uint64)
    tail = (mixed(tail) % np.uint64(TAILS)).astype(np.uint8)
    n = len(raw)
    place = np.arange(len(words)) + np.repeat(np.arange(n), np.diff(at))
    hashes = np.full(len(words) + n, END)
    tails = np.zeros(len(words) + n, np.uint8)
    hashes[place], tails[place] = words, tail
    return hashes, tails, at + np.arange(n + 1)


def _block(hashes: np.ndarray, blocks: int) -> np.ndarray:
    return ((hashes >> np.uint64(40)) * np.uint64(blocks)) >> np.uint64(24)


def _rows(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), (remainder(F.col("doc_id"), MODULUS) == HELD_OUT).alias("held_out"),
                       text_or_empty().alias("text"))


def _slices(batches: Iterator[pd.DataFrame]) -> Iterator[tuple[pd.DataFrame, list[bytes]]]:
    for batch in batches:
        texts = batch["text"].tolist()
        for a, b in slices(texts):
            yield batch.iloc[a:b], encoded(texts[a:b])


def vocabulary(spark: SparkSession, docs: DataFrame, blocks: int) -> DataFrame:
    """Written table, one row a block: block, hashes (ascending u64), counts (u64), tails (u8) of the training tokens."""

    def send(batches):
        held, size = [], 0

        def flush():
            h, t = (np.concatenate(x) for x in zip(*held))
            h, first, n = np.unique(h, return_index=True, return_counts=True)
            edge = np.searchsorted(_block(h, blocks), np.arange(blocks + 1, dtype=np.uint64))
            n = n.astype("<u4").view(np.uint8).reshape(-1, 4)
            return pd.DataFrame([(k, h[a:b].tobytes() + t[first[a:b]].tobytes() + n[a:b].T.tobytes())
                                 for k, (a, b) in enumerate(zip(edge, edge[1:])) if a < b], columns=["block", "raw"])

        for _, raw in _slices(batches):
            h, t, _ = tokens(raw)
            held.append((h, t))
            size += len(h)
            if size >= FLUSH:
                yield flush()
                held, size = [], 0
        if held:
            yield flush()

    def add(batches):
        block, parts = None, []

        def total():
            h, t, n = (np.concatenate(x) for x in zip(*parts))
            h, first, back = np.unique(h, return_index=True, return_inverse=True)
            n = np.bincount(back, weights=n).astype("<u8")
            return pd.DataFrame([(block, h.tobytes(), n.tobytes(), t[first].tobytes())], columns=["block", "hashes", "counts", "tails"])

        for batch in batches:
            for k, raw in zip(batch["block"].tolist(), batch["raw"]):
                if k != block:
                    if parts:
                        yield total()
                    block, parts = k, []
                m = len(raw) // 13
                n = np.frombuffer(raw, np.uint8, 4 * m, 9 * m).reshape(4, m).T
                parts.append((np.frombuffer(raw, "<u8", m), np.frombuffer(raw, np.uint8, m, 8 * m),
                              np.ascontiguousarray(n).view("<u4").ravel().astype(np.float64)))
        if parts:
            yield total()

    sent = _rows(docs).filter("NOT held_out").select("text").mapInPandas(send, "block int, raw binary")
    owned = sent.repartition(blocks, "block").sortWithinPartitions("block").mapInPandas(
        add, "block int, hashes binary, counts binary, tails binary")
    return written(spark, owned, "vocabulary")


def _unpacked(row_hashes, row_counts, row_tails):
    return np.frombuffer(row_hashes, "<u8"), np.frombuffer(row_counts, "<u8").astype(np.int64), np.frombuffer(row_tails, np.uint8)


class Model:
    """Totals, the common words' counts, and the class model."""

    def __init__(self, total: int, distinct: int, by_tail: np.ndarray, common: np.ndarray, counts: np.ndarray, tails: np.ndarray):
        self.total, self.distinct = total, distinct
        order = np.argsort(common)
        self.common, self.counts = common[order], counts[order]
        top = np.lexsort((common, -counts))[: FREQUENT]
        sure = top[np.argsort(common[top])]
        self.frequent = common[sure]
        n, v = by_tail.astype(np.float64)
        for i in sure.tolist():  # the frequent ones leave their tail classes
            n[tails[i]] -= counts[i]
            v[tails[i]] -= 1
        own = np.zeros(FREQUENT)
        own[: len(sure)] = counts[sure] + 2.0
        own[len(sure) :] = 2.0
        self.log_class = np.log10(np.concatenate([own, np.maximum(n + v, 0) + 1]))  # a class's add-one total
        self.weights = np.zeros((3 * ROWS, CLASSES), np.float32)
        self.bias = np.zeros(CLASSES, np.float32)

    def classes(self, hashes: np.ndarray, tails: np.ndarray) -> np.ndarray:
        out = tails.astype(np.int64) + FREQUENT
        if len(self.frequent):
            place = np.minimum(np.searchsorted(self.frequent, hashes), len(self.frequent) - 1)
            own = self.frequent[place] == hashes
            out[own] = place[own]
        return out

    def features(self, hashes: np.ndarray, classes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """Rows of the three features of each token; a text begins after an END, and what is before that is an END too."""
        begin = at[:-1]
        f = (mixed(hashes) & np.uint64(ROWS - 1)).astype(np.int32)
        end_f, end_c = int(mixed(np.array([END]))[0]) & (ROWS - 1), int(self.classes(np.array([END]), np.zeros(1, np.uint8))[0])

        def back(x, by, fill):
            out = np.full(len(x), fill, np.int32)
            out[by:] = x[:-by] if by else x
            out[begin] = fill
            return out

        c1, c2 = back(classes, 1, end_c), back(classes, 2, end_c)
        return back(f, 1, end_f), back(f, 2, end_f) + ROWS, c1 * CLASSES + c2 + 2 * ROWS

    def log_classes(self, rows: tuple[np.ndarray, ...], classes: np.ndarray) -> np.ndarray:
        """log10 P(class | history) of each token."""
        out = np.empty(len(classes))
        for a in range(0, len(classes), BATCH):
            z = self.bias + self.weights[rows[0][a : a + BATCH]]
            z += self.weights[rows[1][a : a + BATCH]]
            z += self.weights[rows[2][a : a + BATCH]]
            z -= z.max(axis=1, keepdims=True)
            own = z[np.arange(len(z)), classes[a : a + BATCH]]
            out[a : a + BATCH] = own - np.log(np.exp(z, out=z).sum(axis=1))
        return out / np.log(10)

    def learn(self, rows: tuple[np.ndarray, ...], classes: np.ndarray, seen: np.ndarray, rate: float = 0.4) -> None:
        """One pass of gradient steps; each weight row's rate falls with the squared gradients it has ``seen``."""
        for a in range(0, len(classes), BATCH):
            part = [r[a : a + BATCH] for r in rows]
            z = self.bias + self.weights[part[0]] + self.weights[part[1]] + self.weights[part[2]]
            z -= z.max(axis=1, keepdims=True)
            np.exp(z, out=z)
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(len(z)), classes[a : a + BATCH]] -= 1
            size = np.einsum("ij,ij->i", z, z)
            for r in part:
                order = np.argsort(r, kind="stable")
                r = r[order]
                first = np.flatnonzero(np.diff(r, prepend=-1))
                seen[r[first]] += np.add.reduceat(size[order], first)
                self.weights[r[first]] -= (rate / np.sqrt(seen[r[first]]))[:, None] * np.add.reduceat(z[order], first, axis=0)
            self.bias -= rate / np.sqrt(seen[-1] + len(z)) * z.sum(axis=0)
            seen[-1] += len(z)


def counted(spark: SparkSession, words: DataFrame, blocks: int) -> Model:
    """The totals and the most frequent words of a vocabulary; what reaches the driver is bounded by COMMON and the classes."""
    share = -(-2 * COMMON // blocks)

    def top(batches):
        for batch in batches:
            for row in zip(batch["hashes"], batch["counts"], batch["tails"]):
                h, n, t = _unpacked(*row)
                best = np.lexsort((h, -n))[:share]
                yield pd.DataFrame({"hash": h[best].view(np.int64), "n": n[best], "tail": t[best].astype(np.int32)})

    def totals(batches):
        for batch in batches:
            for row in zip(batch["hashes"], batch["counts"], batch["tails"]):
                _, n, t = _unpacked(*row)
                yield pd.DataFrame({"tail": np.arange(TAILS), "n": np.bincount(t, n, TAILS).astype(np.int64), "v": np.bincount(t, minlength=TAILS)})

    by_tail = np.zeros((2, TAILS), np.int64)
    for r in words.mapInPandas(totals, "tail int, n long, v long").groupBy("tail").agg(F.sum("n").alias("n"), F.sum("v").alias("v")).collect():
        by_tail[:, r["tail"]] = r["n"], r["v"]
    best = words.mapInPandas(top, "hash long, n long, tail int").orderBy(F.col("n").desc(), "hash").limit(COMMON).toArrow()
    return Model(int(by_tail[0].sum()), int(by_tail[1].sum()), by_tail,
                 *(best[c].to_numpy().view(k) if k else best[c].to_numpy() for c, k in (("hash", np.uint64), ("n", None), ("tail", None))))


def trained(spark: SparkSession, docs: DataFrame, model: Model, blocks: int) -> Model:
    """Rounds of distributed gradient updates with averaging; each training text is used in one round."""
    rows = _rows(docs).filter("NOT held_out").select("text").withColumn("part", F.pmod(F.xxhash64("text"), F.lit(ROUNDS)))
    pieces = 16

    def average(of: list[str]):
        def add(batches):
            key, total, weight = None, None, 0.0
            for batch in batches:
                for *k, n, raw in zip(*(batch[c] for c in of), batch["tokens"], batch["raw"]):
                    if k != key:
                        if key is not None:
                            yield pd.DataFrame([(*key, weight, (total / weight).astype("<f4").tobytes())], columns=[*of, "tokens", "raw"])
                        key, total, weight = k, 0.0, 0.0
                    total = total + np.frombuffer(raw, "<f4").astype(np.float64) * n
                    weight += n
            if key is not None:
                yield pd.DataFrame([(*key, weight, (total / weight).astype("<f4").tobytes())], columns=[*of, "tokens", "raw"])
        return add

    for part in range(ROUNDS):
        held = spark.sparkContext.broadcast(model)

        def steps(batches):
            from pyspark import TaskContext

            start = held.value
            own = Model.__new__(Model)
            own.__dict__.update(start.__dict__, weights=start.weights.copy(), bias=start.bias.copy())
            seen, n = np.ones(3 * ROWS + 1, np.float32), 0
            for _, raw in _slices(batches):
                h, t, at = tokens(raw)
                c = own.classes(h, t)
                own.learn(own.features(h, c, at), c, seen)
                n += len(c)
            if n:
                flat = np.concatenate([own.weights.ravel(), own.bias])
                salt = TaskContext.get().partitionId() % 64
                yield pd.DataFrame([(k, salt, float(n), x.astype("<f4").tobytes()) for k, x in enumerate(np.array_split(flat, pieces))],
                                   columns=["piece", "salt", "tokens", "raw"])

        sent = rows.filter(F.col("part") == part).select("text").mapInPandas(steps, "piece int, salt int, tokens double, raw binary")
        some = sent.repartition("piece", "salt").sortWithinPartitions("piece", "salt").mapInPandas(
            average(["piece", "salt"]), "piece int, salt int, tokens double, raw binary")
        one = some.repartition("piece").sortWithinPartitions("piece").mapInPandas(average(["piece"]), "piece int, tokens double, raw binary")
        got = sorted((r["piece"], r["raw"]) for r in one.collect())  # the model itself: a fixed size
        if got:
            flat = np.concatenate([np.frombuffer(raw, "<f4") for _, raw in got])
            new = Model.__new__(Model)
            new.__dict__.update(model.__dict__, weights=flat[: 3 * ROWS * CLASSES].reshape(3 * ROWS, CLASSES).copy(), bias=flat[-CLASSES:].copy())
            model = new
    return model


def score(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    blocks = shuffle_width(spark)
    words = vocabulary(spark, docs, blocks)
    model = trained(spark, docs, counted(spark, words, blocks), blocks)
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        from pyspark import TaskContext

        m, row = held.value, TaskContext.get().partitionId() << 33
        rare, size = [], 0

        def flush():
            h, r, n = (np.concatenate(x) for x in zip(*rare))
            order = np.argsort(h, kind="stable")
            h, r, n = h[order], r[order], n[order]
            edge = np.searchsorted(_block(h, blocks), np.arange(blocks + 1, dtype=np.uint64))
            part = int(r.min())  # names this batch: no other holds that text
            return pd.DataFrame([(k, part, h[a:b].tobytes() + r[a:b].tobytes() + n[a:b].astype("<u4").tobytes())
                                 for k, (a, b) in enumerate(zip(edge, edge[1:])) if a < b], columns=["block", "row", "raw"])

        for batch, raw in _slices(batches):
            h, t, at = tokens(raw)
            c = m.classes(h, t)
            begin = at[:-1]
            parts = m.log_classes(m.features(h, c, at), c) - m.log_class[c]
            place = np.minimum(np.searchsorted(m.common, h), max(0, len(m.common) - 1))
            known = m.common[place] == h if len(m.common) else np.zeros(len(h), bool)
            logs = np.zeros(len(h))
            logs[known] = np.log10(m.counts[place[known]] + 1.0)
            other = np.flatnonzero(~known)
            if len(other) and len(m.common):
                owner = np.repeat(np.arange(len(raw)), np.diff(at))[other]
                order = np.lexsort((h[other], owner))
                ho, oo = h[other][order], owner[order]
                first = np.flatnonzero(np.concatenate([[True], (ho[1:] != ho[:-1]) | (oo[1:] != oo[:-1])]))
                rare.append((ho[first], (row + oo[first]).astype("<i8"), np.diff(np.append(first, len(ho)))))
                size += len(first)
            yield pd.DataFrame({"row": row + np.arange(len(raw)), "doc_id": batch["doc_id"].astype("Int64").to_numpy(),
                                "held_out": batch["held_out"].to_numpy(), "n_tokens": np.diff(at), "n_known": np.add.reduceat(known.astype(np.int64), begin),
                                "logs": np.add.reduceat(logs, begin), "classes": np.add.reduceat(parts, begin), "block": -1, "raw": None})
            row += len(raw)
            if size >= FLUSH:
                yield flush().reindex(columns=columns)
                rare, size = [], 0
        if rare:
            yield flush().reindex(columns=columns)

    def answer(batches):
        """To each batch of a block's words: its texts, their known words and sums of logarithms."""
        block, h, logs = None, None, None
        for batch in batches:
            out = []
            for k, part, raw, hashes, counts in zip(batch["block"].tolist(), batch["row"].tolist(), batch["raw"], batch["hashes"], batch["counts"]):
                if k != block:
                    block, h = k, np.frombuffer(hashes, "<u8") if hashes is not None else np.empty(0, np.uint64)
                    logs = np.log10(np.frombuffer(counts, "<u8") + 1.0) if hashes is not None else np.empty(0)
                m = len(raw) // 20
                words, rows, n = np.frombuffer(raw, "<u8", m), np.frombuffer(raw, "<i8", m, 8 * m), np.frombuffer(raw, "<u4", m, 16 * m)
                place = np.minimum(np.searchsorted(h, words), max(0, len(h) - 1))
                hit = np.flatnonzero(h[place] == words) if len(h) else np.empty(0, np.int64)
                own, back = np.unique(rows[hit], return_inverse=True)
                n = n[hit].astype(np.float64)
                sums = np.bincount(back, n, len(own)), np.bincount(back, n * logs[place[hit]], len(own))
                if len(own):
                    out.append((part, own.tobytes() + np.concatenate(sums).astype("<f8").tobytes()))
            yield pd.DataFrame(out, columns=["part", "raw"])

    def total(batches):
        part, held = None, []

        def rows():
            own, back = np.unique(np.concatenate([x[0] for x in held]), return_inverse=True)
            known, logs = (np.bincount(back, np.concatenate([x[i] for x in held]), len(own)) for i in (1, 2))
            return pd.DataFrame({"row": own, "more_known": known.astype(np.int64), "more_logs": logs})

        for batch in batches:
            for k, raw in zip(batch["part"].tolist(), batch["raw"]):
                if k != part:
                    if held:
                        yield rows()
                    part, held = k, []
                m = len(raw) // 24
                held.append((np.frombuffer(raw, "<i8", m), np.frombuffer(raw, "<f8", m, 8 * m), np.frombuffer(raw, "<f8", m, 16 * m)))
        if held:
            yield rows()

    columns = ["row", "doc_id", "held_out", "n_tokens", "n_known", "logs", "classes", "block", "raw"]
    found = written(spark, _rows(docs).mapInPandas(
        run, "row long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, classes double, block int, raw binary"), "lm-rows")
    asked = found.filter("block >= 0").select("block", "row", "raw").repartition(blocks, "block")
    owners = words.select(F.col("block").alias("_block"), "hashes", "counts")  # one row a block
    asked = asked.join(owners.hint("merge"), F.col("block") == F.col("_block"), "left").select("block", "row", "raw", "hashes", "counts")
    answers = asked.mapInPandas(answer, "part long, raw binary").repartition(blocks, "part").sortWithinPartitions("part")
    rare = answers.mapInPandas(total, "row long, more_known long, more_logs double")  # all of a text's words are in one batch
    out = found.filter("block < 0").drop("block", "raw").join(rare, "row", "left").fillna(0, ["more_known", "more_logs"])
    logs = F.col("logs") + F.col("more_logs")
    base = float(np.log10(model.total + model.distinct + 1.0))
    return out.select("doc_id", "held_out", "n_tokens", (F.col("n_known") + F.col("more_known")).alias("n_known"),
                      F.lit(model.total).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * base).alias("base_score"),
                      (F.col("classes") + logs).alias("score"))
