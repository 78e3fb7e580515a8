"""Byte-pair encoding and decoding of whole texts with the vocabulary of a public tokenizer.

The merges of a word are found with a segment tree over the ranks of its neighbouring pairs: the root holds the lowest rank and,
among equals, the leftmost place. A merge changes three leaves, each a path to the root, until the root holds no mergeable pair. A
word of n symbols so takes n log n steps.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillmart.llm.common import few_at_once

# Words whose ids a Python worker remembers, twice at most, and the longest of them.
REMEMBERED = 250_000
LONGEST = 48

# Fixed value: how the vocabulary's pre-tokenizer cuts words.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""
_SEPARATORS = ("\x1c", "\x1d", "\x1e", "\x1f")  # white space for str.split, but not for the vocabulary


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable bytes as they are, others from U+0100 on."""
    plain = {*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


def merge(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Merge neighbouring pairs, lowest rank first and leftmost among equals. ranks: pair to (rank, merged symbol)."""
    n = len(symbols)
    if n < 2:
        return symbols
    size = 1 << (n - 1).bit_length()
    none = 1 << 62
    tree = [none] * (2 * size)
    for place in range(n - 1):
        found = ranks.get((symbols[place], symbols[place + 1]))
        if found:
            tree[size + place] = found[0] * size + place  # orders by rank, then by place
    for node in range(size - 1, 0, -1):
        left, right = tree[2 * node], tree[2 * node + 1]
        tree[node] = left if left < right else right
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    symbols = list(symbols)

    def put(place: int, value: int) -> None:
        node = size + place
        tree[node] = value
        node >>= 1
        while node:
            left, right = tree[2 * node], tree[2 * node + 1]
            least = left if left < right else right
            if tree[node] == least:
                break
            tree[node] = least
            node >>= 1

    while tree[1] < none:
        place = tree[1] % size
        gone = after[place]
        symbols[place] = ranks[symbols[place], symbols[gone]][1]
        symbols[gone] = -1
        follows = after[gone]
        after[place] = follows
        put(gone, none)
        if follows < n:
            before[follows] = place
            found = ranks.get((symbols[place], symbols[follows]))
            put(place, found[0] * size + place if found else none)
        else:
            put(place, none)
        first = before[place]
        if first >= 0:
            found = ranks.get((symbols[first], symbols[place]))
            put(first, found[0] * size + first if found else none)
    return [s for s in symbols if s >= 0]


class Vocabulary:
    """A byte-level vocabulary with word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, self.path = told["model"], path
        vocabulary, end = model["vocab"], model["end_of_word_suffix"] or ""
        letters = byte_letters()
        self.inner = [vocabulary[c] for c in letters]
        self.last = [vocabulary[c + end] for c in letters]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(model["merges"]):
            joined = a + b  # with word ends only the second part can carry one
            self.ranks.setdefault((vocabulary[a], vocabulary[b]), (rank, vocabulary[joined]))
        self.special = {x["content"]: x["id"] for x in told["added_tokens"]}
        self.tokens = [""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, number in [*vocabulary.items(), *self.special.items()]:
            self.tokens[number] = token
        self.specials = regex.compile("(" + "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True))) + ")")
        self.words = regex.compile(WORDS)
        self.plain: set[str] = set()  # characters known to this Python's Unicode tables
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tool = None

    def _word(self, word: str) -> list[int]:
        data = word.encode("utf-8", "replace")
        return merge([*[self.inner[b] for b in data[:-1]], self.last[data[-1]]], self.ranks)

    def _chunk(self, chunk: str) -> bytes:
        """The ids of a piece of normalised text without white space."""
        ids = array("I")
        for word in self.words.findall(chunk):
            ids.extend(self._word(word))
        return ids.tobytes()

    def _remembered(self, chunk: str) -> bytes:
        if (ids := self.older.get(chunk)) is None:
            ids = self._chunk(chunk)
        if len(chunk) <= LONGEST:
            if len(self.known) >= REMEMBERED:  # words in use come back from the older ones
                self.older, self.known = self.known, {}
            self.known[chunk] = ids
        return ids

    def _part(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        if not text.isascii():
            strange = set(text) - self.plain
            if any(unicodedata.category(c) == "Cn" for c in strange):
                return self._by_library(text)  # newer characters than this Python knows
            self.plain |= strange
            text = unicodedata.normalize("NFC", text)
            # one character at a time, so a last sigma stays an inner one
            text = text.replace("Σ", "σ")
        text = text.lower()
        if any(c in text for c in _SEPARATORS):
            chunks = regex.split(r"\s+", text)
        else:
            chunks = text.split()
        return b"".join([self.known.get(c) or self._remembered(c) for c in chunks])

    def _by_library(self, text: str) -> bytes:
        """As ``_part``; the tokenizers library normalises and cuts, the merges are found here."""
        if self.tool is None:
            from tokenizers import Tokenizer

            self.tool = Tokenizer.from_file(self.path)
        tool = self.tool
        ids = array("I")
        letter = {c: b for b, c in enumerate(byte_letters())}
        for word, _ in tool.pre_tokenizer.pre_tokenize_str(tool.normalizer.normalize_str(text)):
            data = [letter[c] for c in word]
            ids.extend(merge([*[self.inner[b] for b in data[:-1]], self.last[data[-1]]], self.ranks))
        return ids.tobytes()

    def encode(self, text: str | None) -> np.ndarray:
        """The ids of a text as little-endian unsigned 32-bit numbers; a special token's string is that token."""
        text = text or ""
        if "<" not in text:
            return np.frombuffer(self._part(text), "<u4")
        parts = [
            np.array([self.special[p]], "<u4").tobytes() if p in self.special else self._part(p)
            for p in self.specials.split(text)
        ]
        return np.frombuffer(b"".join(parts), "<u4")

    def decode(self, ids: np.ndarray) -> str:
        """The tokens, joined by blanks: the file names no decoder. Special tokens are kept."""
        return " ".join(map(self.tokens.__getitem__, ids.tolist()))


_LOADED: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary, loaded once in each Python process."""
    if path not in _LOADED:
        _LOADED[path] = Vocabulary(path)
    return _LOADED[path]


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids array<int>, decoded) per row of ``docs`` (doc_id, text): the whole text encoded, and its ids decoded again.

    A null text counts as empty, with no ids and an empty decoded text. Repeated rows and null doc_ids are carried along; other
    columns are not looked at. An empty table gives an empty table. ``path`` must hold the vocabulary on every executor.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            ids = [words.encode(t) for t in batch.column(1).to_pylist()]
            decoded = [words.decode(x) for x in ids]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = pa.array(np.concatenate([*ids, np.zeros(0, "<u4")]).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.ListArray.from_arrays(pa.array(offsets), flat), pa.array(decoded, pa.string())],
                ["doc_id", "ids", "decoded"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``, as ``encoded``; the digests are made in the same pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = vocabulary(path)
        for batch in batches:
            counts, of_ids, of_text = [], [], []
            for text in batch.column(1).to_pylist():
                ids = words.encode(text)
                counts.append(len(ids))
                of_ids.append(hashlib.sha256(ids).hexdigest())
                of_text.append(hashlib.sha256(words.decode(ids).encode("utf-8")).hexdigest())
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_text, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, columns)
