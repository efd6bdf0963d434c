"""Byte-level BPE by prefix-sharing trie traversal, and decoding.

The vocabulary's own rule (merge the pair of lowest rank, leftmost first, until none is left) has two known consequences:
an encoding is right exactly if each pair of neighbouring tokens is one that no merge across their border would have
joined before both were complete, and the encoding of a prefix of a word is fixed by its last token together with the
encoding of what stands before that token.  So the *last token* of a prefix is its whole state.

The distinct words (pieces) of many texts are put in byte order, which is the depth-first order of their trie: the path of
a word shares as many nodes with the word before as their common prefix has bytes.  States are propagated down that path
once a node and kept on a stack; a word's ids are read off its last states from the end.  The trie thus needs the memory of
its longest word only.

Defined cases: null text is the empty text, which has no ids and decodes to the empty text.  A text of any length is
encoded as a whole; only its distinct words are held more than once.  Equal rows give equal rows, each kept.  An empty table
gives an empty result.  Other columns, whatever their names, are ignored.  Ids that are no tokens decode to nothing, null
ids to an empty text, and bytes that are no UTF-8 to U+FFFD, as in the tokenizers library.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from ledgerline.llm.common import release_memory, text_or_empty, worker_state
from ledgerline.llm.tokens import CUT, PIECES, PLAIN_TEXT, Numbers, slices, spans

#: Words whose ids a worker keeps between slices of texts.
KEEP = 400_000
#: Pairs of tokens whose border was judged that a worker keeps.
KEEP_PAIRS = 1_000_000
NEVER = 1 << 60


def byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: bytes with a visible Latin-1 character stand for
    themselves, the others take the characters from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabulary:
    """Tokens, merges and special tokens of a byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        alphabet = byte_alphabet()
        names: dict[str, int] = spec["model"]["vocab"]
        self.bytes: dict[int, bytes] = {i: bytes(alphabet[c] for c in t) for t, i in names.items()}
        self.ids: dict[bytes, int] = {b: i for i, b in self.bytes.items()}
        self.special: dict[str, int] = {}
        for t in spec["added_tokens"]:
            if t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]:
                raise ValueError(f"special token {t['content']!r} takes in its surroundings")
            self.special[t["content"]] = t["id"]
            self.bytes[t["id"]] = t["content"].encode()
        size = max(self.bytes) + 1
        self.born = [-1] * size  # rank of the merge that makes the token; -1: a byte
        self.left, self.right = [-1] * size, [-1] * size
        self.rank: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(spec["model"]["merges"]):
            a, b = merge.split(" ") if isinstance(merge, str) else merge
            made = names[a + b]
            if self.born[made] >= 0:
                raise ValueError(f"two merges make the token {a + b!r}")
            self.born[made], self.left[made], self.right[made] = rank, names[a], names[b]
            self.rank[names[a], names[b]] = rank
        #: by the last three bytes: the lengths of the tokens that end so, longest first
        lengths: dict[bytes, set[int]] = {}
        for t in self.ids:
            if len(t) > 2:
                lengths.setdefault(t[-3:], {1, 2}).add(len(t))
        self.lengths = {end: tuple(sorted(found, reverse=True)) for end, found in lengths.items()}

        #: all tokens' bytes in a row, and where each token ends in it; a token without bytes stands for what is none
        self.size = np.array([len(self.bytes.get(i, b"")) for i in range(size)] + [0], np.int64)
        self.end = np.cumsum(self.size)
        self.joined = np.frombuffer(b"".join(self.bytes.get(i, b"") for i in range(size)), np.uint8)

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The texts of runs of ids that begin and end at the offsets."""
        ids = np.where((ids >= 0) & (ids < len(self.size) - 1), ids, len(self.size) - 1)
        size = self.size[ids]
        edge = np.concatenate([[0], np.cumsum(size)])
        raw = self.joined[np.repeat(self.end[ids] - size - edge[:-1], size) + np.arange(edge[-1])].tobytes()
        at = edge[offsets].tolist()
        return [raw[a:b].decode("utf-8", "replace") for a, b in zip(at, at[1:])]

    def parted(self, a: int, b: int, top: int = NEVER) -> bool:
        """Whether no merge across the border of two complete tokens comes before they are complete.

        The tokens at the border are followed back in time, the one made last first; each pair that stood there at one time
        must not be a merge that would have been due before one of the two went into a larger token.  ``top``: the rank of
        the merge that joins a and b themselves, where that one is wanted."""
        until_a = until_b = top
        while True:
            due = self.rank.get((a, b), NEVER)
            if due < until_a and due <= until_b and due < top:
                return False
            if self.born[a] > self.born[b]:
                until_a, a = self.born[a], self.right[a]
            elif self.born[b] >= 0:
                until_b, b = self.born[b], self.left[b]
            else:
                return True

    def whole(self, t: int) -> bool:
        """Whether the token's own bytes are encoded as this one token."""
        if self.born[t] < 0:
            return True
        a, b = self.left[t], self.right[t]
        return self.whole(a) and self.whole(b) and self.parted(a, b, self.born[t])


class TrieEncoder:
    """``encode(texts)``: (ids of all texts as one array, offsets of the texts)."""

    def __init__(self, path: str, keep: int = KEEP):
        from tokenizers import Tokenizer

        self.vocabulary = Vocabulary(path)
        self.pre_tokenizer = Tokenizer.from_file(path).pre_tokenizer
        self.alphabet = byte_alphabet()
        self.keep = keep
        special = sorted(self.vocabulary.special, key=len, reverse=True)
        self.special = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None
        self.pairs: dict[tuple[int, int], bool] = {}
        self._forget()

    def _forget(self) -> None:
        self.numbers = Numbers()
        self.ids = np.empty(0, np.int32)
        self.ends = np.zeros(1, np.int64)

    def walk(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Ids of distinct words, by one depth-first walk of their trie."""
        ids_of, lengths, tokens = self.vocabulary.ids.get, self.vocabulary.lengths.get, self.vocabulary.bytes
        pairs, out, short = self.pairs, {}, (2, 1)
        if len(pairs) > KEEP_PAIRS:
            pairs.clear()
        state: list[int] = [-1]  # state[d]: last token of the first d bytes of the path
        before = b""
        for word in sorted(words):
            shared, most = 0, min(len(word), len(before))
            while shared < most and word[shared] == before[shared]:
                shared += 1
            del state[shared + 1 :]
            for depth in range(shared + 1, len(word) + 1):
                for n in lengths(word[depth - 3 : depth], short) if depth > 2 else short:
                    token = ids_of(word[depth - n : depth]) if n <= depth else None
                    if token is None:
                        continue
                    pair = (state[depth - n], token)
                    fits = pairs.get(pair)
                    if fits is None:
                        fits = pairs[pair] = self.vocabulary.whole(token) and (n == depth or self.vocabulary.parted(*pair))
                    if fits:
                        break
                state.append(token)
            ids, depth = [], len(word)
            while depth:
                ids.append(state[depth])
                depth -= len(tokens[state[depth]])
            out[word] = ids[::-1]
            before = word
        return out

    def _words(self, unit: str) -> list[bytes]:
        """The words of a unit that the texts were cut into; most are one word."""
        if unit in self.vocabulary.special:
            return []
        if PLAIN_TEXT.fullmatch(unit) and PIECES.fullmatch(unit):
            return [unit.encode()]
        return [bytes(self.alphabet[c] for c in piece) for piece, _ in self.pre_tokenizer.pre_tokenize_str(unit)]

    def _learn(self) -> None:
        """Ids of the units that were numbered since the last time."""
        units = list(self.numbers)[len(self.ends) - 1 :]
        words = [self._words(u) for u in units]
        ids = self.walk(list({w for ws in words for w in ws}))
        found = [[self.vocabulary.special[u]] if u in self.vocabulary.special else [i for w in ws for i in ids[w]]
                 for u, ws in zip(units, words)]
        size = np.fromiter(map(len, found), np.int64, len(found))
        self.ends = np.concatenate([self.ends, self.ends[-1] + np.cumsum(size)])
        self.ids = np.concatenate([self.ids, np.fromiter((i for f in found for i in f), np.int32, int(size.sum()))])

    def _units(self, text: str) -> list[str]:
        if self.special and self.special.search(text):
            out: list[str] = []
            for part in self.special.split(text):
                out += [part] if part in self.vocabulary.special else self._units(part)
            return out
        return PIECES.findall(text) if PLAIN_TEXT.fullmatch(text) else [u for u in CUT.split(text) if u]

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.numbers) > self.keep:
            self._forget()
        number = self.numbers.__getitem__
        units = [np.fromiter(map(number, self._units(t)), np.int64) for t in texts]
        if len(self.numbers) >= len(self.ends):
            self._learn()
        each = np.concatenate(units) if units else np.empty(0, np.int64)
        size = self.ends[each + 1] - self.ends[each]
        edge = np.concatenate([[0], np.cumsum(size)])
        ids = self.ids[np.repeat(self.ends[each] - edge[:-1], size) + np.arange(edge[-1])]
        offsets = edge[np.concatenate([[0], np.cumsum([len(u) for u in units], dtype=np.int64)])]
        return ids, offsets


def _trie(path: str) -> TrieEncoder:
    return worker_state(("trie", path), lambda: TrieEncoder(path))


def encode(spark: SparkSession, docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>) of every row; one pass, no shuffle."""
    rows = docs.select("doc_id", text_or_empty().alias("text"))
    schema = StructType([rows.schema["doc_id"], StructField("ids", ArrayType(IntegerType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        try:
            for batch in batches:
                texts = batch.column(1).to_pylist()
                for a, b in slices(texts, 2_000_000):
                    ids, offsets = trie.encode(texts[a:b])
                    lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids, pa.int32()))
                    yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], ["doc_id", "ids"])
        finally:
            release_memory()

    return rows.mapInArrow(run, schema)


def decode(spark: SparkSession, encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, text) of rows of (doc_id, ids)."""
    rows = encoded.select("doc_id", "ids")
    schema = StructType([*rows.schema.fields, StructField("text", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(path)
        try:
            for batch in batches:
                sizes = [n or 0 for n in pc.list_value_length(batch.column(1)).to_pylist()]
                for a, b in spans(sizes, 1_000_000):
                    part = batch.slice(a, b - a)
                    ids = pc.fill_null(pc.list_flatten(part.column(1)), -1).to_numpy()
                    texts = trie.vocabulary.texts(ids, np.concatenate([[0], np.cumsum(sizes[a:b], dtype=np.int64)]))
                    yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
        finally:
            release_memory()

    return rows.mapInArrow(run, schema)


def digests(decoded: DataFrame) -> DataFrame:
    """Per row of (doc_id, ids, text): doc_id, n_tokens, ids_sha256 (of the decimal ids, joined by commas), decoded_sha256."""
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
                          F.sha2("text", 256).alias("decoded_sha256"))
