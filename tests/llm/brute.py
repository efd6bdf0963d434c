"""Plain-Python versions of the training-data operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np


def low(text) -> bytes:
    return (text or "").encode().lower()


def words(text) -> list[bytes]:
    return low(text).split()


def ids_of(texts, end: int, path: str) -> list[np.ndarray]:
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    return [np.array(t.encode(x or "", add_special_tokens=False).ids + [end], "<u4") for x in texts]


def crc(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def shingles(text, k: int = 5) -> frozenset:
    w = words(text)
    if len(w) >= k:
        return frozenset(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    return frozenset([tuple(w)]) if w else frozenset()


def components(texts) -> list[int]:
    """Index of the first text of each text's component, by all pairs."""
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if a and sets[j] and 100 * both >= 75 * (len(a) + len(sets[j]) - both):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))]


def sha(text) -> str:
    return hashlib.sha256(low(text)).hexdigest()


def leaks(text, item, k: int = 5) -> float:
    """Best weighted similarity of the item and an item-sized window of the text."""
    w, q = words(text), words(item)
    if not q or not w:
        return 0.0
    k = min(k, len(q))

    def bag(x):
        return Counter(tuple(x[i : i + k]) for i in range(len(x) - k + 1))

    own, best = bag(q), 0.0
    for s in range(max(1, len(w) - len(q) + 1)):
        found = bag(w[s : s + len(q)])
        both = sum((own & found).values())
        best = max(best, both / (sum(own.values()) + sum(found.values()) - both))
    return best


PHRASES = [("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved")]


def phrases(text) -> tuple:
    w = [x.decode() for x in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low(text))]
    at = [(i, label) for p, label in PHRASES for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in at]
    return len(w), len(at), min(starts, default=None), max(starts, default=None), ",".join(sorted({x for _, x in at}))


def unigram_base(rows, modulus: int = 7, held: int = 2) -> list[tuple]:
    """(held_out, n_tokens, n_known, N, base score) of each (doc_id, text)."""
    tokens = [words(t) + [None] for _, t in rows]
    out = [zlib.crc32(("" if d is None else str(d)).encode()) % modulus == held for d, _ in rows]
    counts = Counter(w for w_, o in zip(tokens, out) if not o for w in w_)
    total, distinct = sum(counts.values()), len(counts)
    return [(o, len(w), sum(counts[x] > 0 for x in w), total, float(sum(np.log10((counts[x] + 1) / (total + distinct + 1)) for x in w)))
            for w, o in zip(tokens, out)]
