"""Token ids of whole texts by the tokenizers library, with a bounded cache of pieces.

The byte-level tokenizer parts a text into pieces (runs of letters, digits, other characters or white space, most with
the space before them) and merges bytes inside a piece only.  Texts of ASCII and Latin letters are cut into exactly those
pieces; other texts are cut only at single spaces and line feeds between non-space characters, which always part pieces.
Each distinct piece is encoded once by the library, and the ids of a text are its pieces' ids.  The result equals
``Tokenizer.encode(text, add_special_tokens=False).ids``.
"""

from __future__ import annotations

import re
from itertools import chain, islice

import numpy as np

from ledgerline.llm.common import worker_state

_L = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u017f"
PLAIN_TEXT = re.compile(rf"[\t-\r -~{_L}]*")
PIECES = re.compile(rf" ?[{_L}]+|'(?:[stmd]|re|ve|ll)| ?[0-9]+| ?[^\s0-9{_L}]+|\s+(?!\S)|\s+")
CUT = re.compile(r"(?<=\S)(?= \S)|(?<=\S)(?=\n\S)|(?<=\S\n)(?=\S)")
JOIN = 256

def encoder(path: str, keep: int = 400_000) -> "PieceEncoder":
    """The worker's encoder for a vocabulary file; it is kept until the worker serves another operator (state ``path``)."""
    return worker_state(path, lambda: PieceEncoder(path, keep))


class Numbers(dict):
    """Numbers keys in the order in which they are first asked for."""

    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class PieceEncoder:
    """``ids(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes.

    Pieces are numbered as they are met; a slice's new ones are encoded together, and the ids of all its texts are gathered
    at once.  About ``keep`` pieces stay known; then all but the first quarter, which are the frequent ones, are forgotten."""

    def __init__(self, path: str, keep: int):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.vocabulary_size = max(vocabulary.values()) + 1
        self.byte_length = np.zeros(self.vocabulary_size, np.int64)
        for token, i in vocabulary.items():
            self.byte_length[i] = len(token)  # byte-level tokens: one character a byte
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.keep = keep
        self.numbers = Numbers()
        self.start, self.size, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, "<u4")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self) -> None:
        """Encode the new pieces; a space and letters are encoded many at once, as they part from one another."""
        known = len(self.start)
        pieces = list(islice(self.numbers, known, None))
        plain = np.fromiter((p[0] == " " and p[1:].isalpha() for p in pieces), bool, len(pieces))
        other = [pieces[i] for i in np.flatnonzero(~plain).tolist()]
        joined = [pieces[i] for i in np.flatnonzero(plain).tolist()]
        groups = [joined[i : i + JOIN] for i in range(0, len(joined), JOIN)]
        single, many = self._encode(other), self._encode(["".join(g) for g in groups])
        flat = np.fromiter(chain.from_iterable(chain(single, many)), "<u4")
        size = np.empty(len(pieces), np.int64)
        size[~plain] = np.fromiter(map(len, single), np.int64, len(single))
        at = int(size[~plain].sum())
        length = np.fromiter((len(p) if p.isascii() else len(p.encode()) for p in joined), np.int64, len(joined))
        ends = np.searchsorted(np.cumsum(self.byte_length[flat[at:]]), np.cumsum(length)) + 1
        size[plain] = np.diff(ends, prepend=0)
        if len(joined) and at + ends[-1] != len(flat):
            raise ValueError("pieces and ids do not line up")
        order = np.concatenate([np.flatnonzero(~plain), np.flatnonzero(plain)])
        start = np.empty(len(pieces), np.int64)
        start[order] = len(self.flat) + np.cumsum(size[order]) - size[order]
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        self.flat = np.concatenate([self.flat, flat])

    def _forget(self) -> None:
        """Keep the first quarter; what a call learnt lies together, so their ids are near the beginning."""
        few = self.keep // 4
        self.numbers = Numbers(islice(self.numbers.items(), few))
        self.start, self.size = self.start[:few].copy(), self.size[:few].copy()
        self.flat = self.flat[: int((self.start + self.size).max(initial=0))].copy()

    def ids(self, texts: list[str]) -> list[bytes]:
        if len(self.numbers) > self.keep:
            self._forget()
        number, own, whole = self.numbers.__getitem__, [], {}
        for i, text in enumerate(texts):
            if any(s in text for s in self.special):
                whole[i] = np.array(self._encode([text])[0], "<u4").tobytes()
                own.append(np.empty(0, np.int64))
                continue
            pieces = PIECES.findall(text) if PLAIN_TEXT.fullmatch(text) else list(filter(None, CUT.split(text)))
            own.append(np.fromiter(map(number, pieces), np.int64, len(pieces)))
        if len(self.numbers) > len(self.start):
            self._learn()
        each = np.concatenate(own) if own else np.empty(0, np.int64)
        size = self.size[each]
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = self.flat[np.repeat(self.start[each] - edge[:-1], size) + np.arange(edge[-1])].tobytes()
        ends = (4 * edge[np.cumsum([len(o) for o in own], dtype=np.int64)]).tolist()
        return [whole[i] if i in whole else ids[a:b] for i, (a, b) in enumerate(zip([0, *ends], ends))]


def spans(sizes, most: int):
    """Index ranges of at most ``most`` together (a larger one is alone), to bound what one call holds."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        if held and held + n > most:
            yield first, i
            first, held = i, 0
        held += n
    if first < len(sizes):
        yield first, len(sizes)


def slices(texts, most: int = 1_000_000):
    """Index ranges of texts of at most ``most`` characters together."""
    return spans([len(t) for t in texts], most)
