"""Vectorised word hashes of many texts: 64-bit hashes of every word, by numpy over the UTF-8 bytes.

A word's hash is a polynomial in its bytes' random codes (modulo 2**64), taken from one running sum over the
batch, then mixed.  Lower-casing touches A-Z only.
"""

from __future__ import annotations

import numpy as np

_RNG = np.random.default_rng(20240607)
_CODES = _RNG.integers(0, 2**64, 256, dtype=np.uint64) | np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 5)
_UNBASE = np.uint64(pow(int(_BASE), -1, 2**64))
MULTIPLIERS = _RNG.integers(0, 2**64, 16, dtype=np.uint64) | np.uint64(1)
STEP = 1 << 20
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Bytes that part words: ASCII white space.
WHITE = np.zeros(256, bool)
WHITE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Bytes that are no word characters when words are runs of digits, a-z and non-ASCII characters.
NOT_ALNUM = np.ones(256, bool)
NOT_ALNUM[0x30:0x3A] = NOT_ALNUM[0x41:0x5B] = NOT_ALNUM[0x61:0x7B] = NOT_ALNUM[0x80:] = False

_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> list[np.ndarray]:
    if len(_POWERS[0]) < n:
        for i, base in enumerate((_BASE, _UNBASE)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _POWERS[i] = np.cumprod(p)
    return _POWERS


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def _pieces(text: bytes, gap: np.ndarray) -> list[bytes]:
    """A long text cut between words into pieces of about STEP bytes (more only where one word is longer)."""
    out, first = [], 0
    while len(text) - first > 4 * STEP:
        last = first + STEP
        while last < len(text):
            found = np.flatnonzero(gap[np.frombuffer(text, np.uint8, min(STEP, len(text) - last), last)])
            if len(found):
                last += int(found[0])
                break
            last = min(last + STEP, len(text))
        out.append(text[first:last])
        first = last
    return [*out, text[first:]]


def word_hashes(texts: list[bytes], gap: np.ndarray, tails: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, word offsets of the texts).  ``gap``: which byte values part words.  ``tails`` gets arrays
    of the words' last two bytes as one number (of the last byte alone for words of one byte), lower case.

    Works on about STEP bytes at a time; a longer text is cut between words."""
    codes = np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), _CODES[(np.arange(256) + 32) % 256], _CODES)
    codes[gap] = 0
    part = bytes([int(np.flatnonzero(gap)[0])])
    owners = range(len(texts))
    if any(len(t) > 4 * STEP for t in texts):
        cut = [(i, piece) for i, t in enumerate(texts) for piece in _pieces(t, gap)]
        owners, texts = [i for i, _ in cut], [piece for _, piece in cut]
    hashes, counts = [], np.zeros(len(texts), np.int64)
    first = 0
    while first < len(texts):
        last, size = first, 0
        while last < len(texts) and (last == first or size + len(texts[last]) < STEP):
            size += len(texts[last]) + 1
            last += 1
        raw = np.frombuffer(part.join(texts[first:last]) + part, np.uint8)
        lengths = np.fromiter((len(t) + 1 for t in texts[first:last]), np.int64, last - first)
        inside = ~gap[raw]
        edge = np.flatnonzero(np.diff(inside, prepend=False))  # starts and ends in turn; the last byte is a gap
        start, end = edge[0::2], edge[1::2]
        power, unpower = _powers(len(raw) + 1)
        total = np.empty(len(raw) + 1, np.uint64)
        total[0] = 0
        np.cumsum(codes[raw] * power[: len(raw)], out=total[1:])
        hashes.append(mixed((total[end] - total[start]) * unpower[start]))
        if tails is not None:
            low = _LOWER[raw]
            tails.append(low[end - 1].astype(np.int64) | np.where(end - start > 1, low[end - 2].astype(np.int64) << 8, 0))
        owner = np.searchsorted(np.cumsum(lengths), start, side="right")
        counts[first:last] = np.bincount(owner, minlength=last - first)
        first = last
    if not isinstance(owners, range):
        counts = np.bincount(owners, weights=counts).astype(np.int64)
    offsets = np.concatenate([[0], np.cumsum(counts)])
    return (np.concatenate(hashes) if hashes else np.empty(0, np.uint64)), offsets


def rolling(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all runs of ``k`` words (len(words) - k + 1 of them)."""
    if len(words) < k:
        return np.empty(0, np.uint64)
    h = words[: len(words) - k + 1] * MULTIPLIERS[0]
    for i in range(1, k):
        h = h + words[i : len(words) - k + 1 + i] * MULTIPLIERS[i]
    return mixed(h)


def encoded(texts) -> list[bytes]:
    return [t.encode("utf-8", "surrogatepass") for t in texts]
