"""The classifiers' inner parts against plain loops: convolution, pooling and gradients; the gapped word kernel."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pytest

from ledgerline.llm import license_scan, quality, toxicity

N = quality.VECTORS.shape[1]


def _network(rng) -> quality.Network:
    return quality.Network(rng.standard_normal((quality.TAPS * N, quality.FILTERS)).astype(np.float32) * 0.3,
                           rng.standard_normal(quality.FILTERS).astype(np.float32) * 0.1, rng.standard_normal((2 * quality.FILTERS, quality.HIDDEN)) * 0.3,
                           rng.standard_normal(quality.HIDDEN) * 0.1, rng.standard_normal(quality.HIDDEN + 1) * 0.3, rng.standard_normal(4))


def _plain_chunks(text: bytes) -> list[bytes]:
    """Chunks that begin every CHUNK - OVERLAP bytes, until one reaches the end."""
    out, at = [], 0
    while True:
        out.append(text[at : at + quality.CHUNK])
        at += quality.CHUNK - quality.OVERLAP
        if at + quality.OVERLAP >= len(text):
            return out


def _plain_logit(net, chunk: bytes) -> float:
    padded = chunk + bytes(quality.CHUNK - len(chunk))
    places = min(max((len(chunk) - quality.TAPS) // quality.STRIDE + 1, 1), quality.PLACES)
    best, total = np.zeros(quality.FILTERS), np.zeros(quality.FILTERS)
    for p in range(places):
        window = [quality.VECTORS[b] for b in padded[p * quality.STRIDE : p * quality.STRIDE + quality.TAPS]]
        for f in range(quality.FILTERS):
            r = max(0.0, sum(float(v @ net.filters[i * N : (i + 1) * N, f]) for i, v in enumerate(window)) + float(net.offsets[f]))
            best[f], total[f] = max(best[f], r), total[f] + r
    pooled = np.concatenate([best, total / places])
    hidden = [max(0.0, float(pooled @ net.dense[:, h]) + net.dense_offsets[h]) for h in range(quality.HIDDEN)]
    return float(np.dot(hidden, net.out[:-1]) + net.out[-1])


def test_convolution_and_pooling_equal_plain_loops():
    rng = np.random.default_rng(1)
    net = _network(rng)
    for size in (0, 1, 7, 9, 300, 512, 513, 1008, 1009, 1600):
        text = bytes(rng.integers(1, 256, size, dtype=np.uint8))
        z = [_plain_logit(net, c) for c in _plain_chunks(text)]
        want = [np.mean(z), max(z), min(z)]
        got = net.features([b"other text", text, b""])[1]
        assert np.allclose(got, want, atol=1e-3), size
        score = 1 / (1 + np.exp(-(np.dot(want, net.curve[:-1]) + net.curve[-1])))
        assert net.scores([text])[0] == pytest.approx(score, abs=1e-3)


def test_every_byte_lies_in_a_chunk():
    for size in (1, 511, 512, 513, 1008, 1009, 5000):
        text = bytes(i % 251 + 1 for i in range(size))
        x, _, owner = quality.chunks([b"x" * 700, text])
        rows = [r.tobytes().rstrip(b"\0") for r in x[owner == 1]]
        assert rows == _plain_chunks(text)
        assert rows[0] + b"".join(r[quality.OVERLAP :] for r in rows[1:]) == text


def test_gradients_equal_finite_differences():
    rng = np.random.default_rng(2)
    net = _network(rng)
    net.filters, net.offsets = net.filters.astype(np.float64), net.offsets.astype(np.float64)
    x, places, _ = quality.chunks([bytes(rng.integers(1, 256, n, dtype=np.uint8)) for n in (40, 512, 200)])
    y, weight = np.array([0, 1, 1]), np.array([1.0, 2.0, 0.5])

    def loss():
        z = net.logits(x, places)
        return float(np.mean(weight * (np.log1p(np.exp(-np.abs(z))) + np.maximum(z, 0) - y * z)))

    for name, gradient in net.step(x, places, y, weight).items():
        held = getattr(net, name)
        flat, own = held.reshape(-1), gradient.reshape(-1)
        for i in rng.choice(flat.size, min(12, flat.size), replace=False):
            was, h = flat[i], 1e-5
            flat[i] = was + h
            up = loss()
            flat[i] = was - h
            down = loss()
            flat[i] = was
            assert own[i] == pytest.approx((up - down) / (2 * h), abs=2e-4, rel=2e-2), (name, i)


def _plain_kernel(a: bytes, b: bytes) -> float:
    """Sum over common subsequences of three bytes, each weighed by DECAY to its span in both words, spans up to SPAN."""
    def weights(word):
        out: dict[bytes, float] = {}
        for i, j, k in combinations(range(len(word)), 3):
            if k - i < toxicity.SPAN:
                key = bytes([word[i], word[j], word[k]])
                out[key] = out.get(key, 0.0) + toxicity.DECAY ** (k - i + 1)
        return out

    x, y = weights(a), weights(b)
    return sum(w * y[s] for s, w in x.items() if s in y)


def test_word_kernel_equals_the_enumeration_of_subsequences():
    landmarks = [b"idiot", b"moron", b"aaaa", b"stupid"]
    words = [b"idiot", b"idxiot", b"ixdxixoxt", b"i-d-i-o-t", b"mooooron", b"aaaaaaa", b"abcdefghijkl", b"stupidity", b"dio", b"xy"]
    split = toxicity.split_words([w + b" . " for w in landmarks])
    letters = np.zeros((len(landmarks), toxicity.WIDTH), np.int16)
    for i in range(len(landmarks)):
        letters[i, : split.size[i]] = split.letters[split.start[i] : split.start[i] + split.size[i]]
    marks = toxicity.Landmarks(letters)
    found = toxicity.split_words([b" . ".join(words)])
    at = np.arange(len(words))
    got = np.zeros((len(words), len(landmarks)))
    for row, own in toxicity.windows(found, at):
        hit, values = marks.kernel(own)
        got[row[hit]] += values
    plain = [bytes(c for c in w if c != ord("-")) for w in words]
    for i, w in enumerate(plain):
        for j, m in enumerate(landmarks):
            own, mark = _plain_kernel(w, w), _plain_kernel(m, m)
            size = min(np.sqrt(max(own, 1e-12)), np.sqrt(mark)) * np.sqrt(mark)
            assert got[i, j] == pytest.approx(min(_plain_kernel(w, m) / size, 1) ** toxicity.POWER, abs=1e-4), (w, m)


def test_license_spans_equal_plain_diagonal_voting(spark):
    """Texts of one notice at most, whole, cut and with words inserted: best share of its 2-grams on neighbouring diagonals."""
    import random

    rnd = random.Random(3)
    notices = [n for n, _ in license_scan.NOTICES]
    rows, want = [], {}
    for i in range(80):
        notice, label = license_scan.NOTICES[i % len(notices)]
        words = notice.split()
        drop = rnd.randrange(len(words)) if i % 3 == 0 else None
        kept = [w for k, w in enumerate(words) if k != drop]
        if i % 3 == 1:
            kept.insert(rnd.randrange(1, len(kept)), "zzinsert")
        text = " ".join([f"pre{k}" for k in range(rnd.randrange(5))] + kept + [f"post{k}" for k in range(rnd.randrange(5))])
        rows.append((i, text))
        grams = set(zip(kept, kept[1:]))
        shares = {}
        for other, tag in license_scan.NOTICES:
            own = list(zip(other.split(), other.split()[1:]))
            shares[tag] = max(shares.get(tag, 0), sum(g in grams for g in own) / len(own))
        want[i] = max(shares.values())
        if want[i] >= 0.75:
            want[i] = (want[i], sorted(t for t, s in shares.items() if s == want[i]))
    got = {r.doc_id: r for r in license_scan.scan(spark, spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    bases = {x for _, x in license_scan.PHRASES}
    for i, w in want.items():
        if isinstance(w, tuple):
            assert [x for x in got[i].labels.split(",") if x not in bases] == w[1] and got[i].score in (1.0, pytest.approx(w[0])), rows[i]
