"""Token counts of whole texts and of all their prefixes, by dynamic programming over prefixes.

For every prefix of a word there is one token that ends its encoding, and the rest of the encoding is that of the shorter
prefix before it. So going through the prefixes in order, the count of a prefix is one more than that of the prefix before
its last token; the last token is the one which stays apart from the last token before it when both are encoded together.
Counts of words are put together to a count for every prefix of the text, from which truncations and budgets are read off
without encoding again.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from tillmart.llm.bpe import byte_letters, merge
from tillmart.llm.common import few_at_once

# Words whose table a Python worker remembers, twice at most, and the longest of them.
REMEMBERED = 250_000
LONGEST = 48
LIMIT = 1024

# Fixed value: how the vocabulary's pre-tokenizer cuts a text.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class PrefixCounts:
    """A byte-level vocabulary without word ends, read from a tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        vocabulary, letters = told["model"]["vocab"], byte_letters()
        letter = {c: b for b, c in enumerate(letters)}
        self.path = path
        self.single = [vocabulary[c] for c in letters]
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(told["model"]["merges"]):
            self.ranks.setdefault((vocabulary[a], vocabulary[b]), (rank, vocabulary[a + b]))
        self.special = [x["content"] for x in told["added_tokens"]]
        self.data = {number: bytes(letter[c] for c in token) for token, number in vocabulary.items() if set(token) <= letter.keys()}
        self.number = {d: n for n, d in self.data.items()}
        self.longest = max(map(len, self.number))
        self.specials = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.words = regex.compile(WORDS)
        self.space = regex.compile(r"\s+").fullmatch
        self.plain: set[str] = set()
        self.made = {merged: (rank, pair) for pair, (rank, merged) in reversed(self.ranks.items())}
        self.edges: tuple[dict, dict] = ({}, {})
        self.pairs: dict[int, bool] = {}
        self.whole: dict[int, bool] = {}
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.tool = None

    def _stays(self, token: int) -> bool:
        """Whether the token is what its own bytes are encoded to."""
        if (found := self.whole.get(token)) is None:
            found = self.whole[token] = merge([self.single[b] for b in self.data[token]], self.ranks) == [token]
        return found

    def _edge(self, token: int, side: int) -> list[tuple[int, int]]:
        """The symbols at one side (0 left, 1 right) of a token while it is put together, and the rank that ends each."""
        if (found := self.edges[side].get(token)) is None:
            found, ends, symbol = [], 1 << 62, token
            while True:
                found.append((symbol, ends))
                if symbol not in self.made:
                    break
                ends, pair = self.made[symbol]
                symbol = pair[side]
            self.edges[side][token] = found
        return found

    def _apart(self, one: int, two: int) -> bool:
        """Whether the two tokens stay as they are when encoded together.

        They do not if two symbols that face each other at some time have a rank before the merges that end them; of
        equal ranks the left one goes first.
        """
        pair = one << 32 | two
        if (found := self.pairs.get(pair)) is None:
            if len(self.pairs) >= 400_000:
                self.pairs.clear()
            found = self.pairs[pair] = self._facing(one, two)
        return found

    def _facing(self, one: int, two: int) -> bool:
        rank = self.ranks.get
        for left, left_ends in self._edge(one, 1):
            for right, right_ends in self._edge(two, 0):
                found = rank((left, right))
                if found and found[0] < left_ends and found[0] <= right_ends:
                    return False
        return self._stays(two)

    def by_byte(self, data: bytes) -> list[int]:
        """Token counts of the prefixes of a word of 0, 1, ... bytes."""
        counts, last, longest = [0], [-1], self.longest
        number, pairs, apart = self.number.get, self.pairs.get, self._apart
        for end in range(1, len(data) + 1):
            for start in range(end - longest if end > longest else 0, end):
                token = number(data[start:end])
                if token is None:
                    continue
                if start:
                    before = last[start]
                    fits = pairs(before << 32 | token)
                    if fits is None:
                        fits = apart(before, token)
                else:
                    fits = self._stays(token)
                if fits:
                    counts.append(counts[start] + 1)
                    last.append(token)
                    break
        return counts

    def _table(self, word: str) -> np.ndarray:
        """Token counts of the prefixes of a word of 1, 2, ... code points."""
        data = word.encode("utf-8")
        if word[0] == "'" and word in ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d"):
            # cut short, the letters are a word of their own after the apostrophe
            inner = [1 + n for n in self.by_byte(data[1:])[:-1]]
            return np.array([*inner, self.by_byte(data)[-1]], np.int64)
        counts = self.by_byte(data)
        data += b" "  # the next character begins where a byte does not continue one
        return np.array([counts[n] for n in range(1, len(data)) if data[n] & 0xC0 != 0x80], np.int64)

    def _remembered(self, word: str) -> bytes | None:
        """The table as bytes, None for a word that is too long for that."""
        if len(word) > LONGEST:
            return None
        if len(self.known) >= REMEMBERED:  # words in use come back from the older ones
            self.older, self.known = self.known, {}
        if (table := self.older.get(word)) is not None:
            pass
        elif word.isascii() and word[0] != "'":
            table = bytes(self.by_byte(word.encode("ascii"))[1:])
        else:
            table = self._table(word).astype(np.uint8).tobytes()
        self.known[word] = table
        return table

    def _cut(self, text: str) -> list[str]:
        if not text.isascii():
            strange = set(text) - self.plain
            if any(unicodedata.category(c) == "Cn" for c in strange):  # newer characters than this Python knows
                if self.tool is None:
                    from tokenizers import Tokenizer

                    self.tool = Tokenizer.from_file(self.path)
                letter = {c: b for b, c in enumerate(byte_letters())}
                cut = self.tool.pre_tokenizer.pre_tokenize_str(text)
                return [bytes(letter[c] for c in word).decode("utf-8") for word, _ in cut]
            self.plain |= strange
        return self.words.findall(text)

    def _part(self, text: str) -> np.ndarray:
        """Token counts of the prefixes of 1, 2, ... code points of a text without special tokens."""
        words = self._cut(text)
        if not words:
            return np.zeros(0, np.int64)
        tables = [self.known.get(w) or self._remembered(w) for w in words]
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if None in tables:
            parts = [self._table(w) if t is None else np.frombuffer(t, np.uint8) for w, t in zip(words, tables)]
            inner = np.concatenate(parts).astype(np.int64)
        else:
            inner = np.frombuffer(b"".join(tables), np.uint8).astype(np.int64)
        ends = np.cumsum(lengths)
        totals = inner[ends - 1]
        counts = inner + np.repeat(np.cumsum(totals) - totals, lengths)
        # Of several white spaces the last one goes with what follows; a prefix that ends there has them all in one word.
        for n, word in enumerate(words[:-1]):
            if word.isspace() and self.space(word) and self.space(words[n + 1][0]):
                before = counts[ends[n - 1] - 1] if n else 0
                counts[ends[n]] = before + self._table(word + words[n + 1][0])[-1]
        return counts

    def prefixes(self, text: str | None) -> np.ndarray:
        """The token count of text[:n] for each n from 0 to the length of the text."""
        text = text or ""
        if not any(s in text for s in self.special):
            return np.concatenate([[0], self._part(text)]).astype(np.int64)
        counts, base, before = [np.zeros(1, np.int64)], 0, ""
        for part in self.specials.split(text):
            if part in self.special:
                # up to its last character it is ordinary text after what stands before it
                inner = self._part(before + part[:-1])[len(before) :]
                counts.append(np.append(base - self._last(before) + inner, base + 1))
                base, before = base + 1, ""
            else:
                own = self._part(part)
                counts.append(base + own)
                base, before = base + self._last(part), part
        return np.concatenate(counts)

    def _last(self, text: str) -> int:
        return int(self._part(text)[-1]) if text else 0


_LOADED: dict[str, PrefixCounts] = {}


def counter(path: str) -> PrefixCounts:
    """The vocabulary, loaded once in each Python process."""
    if path not in _LOADED:
        _LOADED[path] = PrefixCounts(path)
    return _LOADED[path]


def prefix_counts(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, counts array<int>) per row of ``docs`` (doc_id, text): counts[n] is the token count of the first n code points.

    A special token's string counts as one token from its last character on. A null text counts as empty: [0]. Repeated rows
    and null doc_ids are carried along; other columns are not looked at. An empty table gives an empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(path)
        for batch in batches:
            tables = pa.array([words.prefixes(t).astype(np.int32) for t in batch.column(1).to_pylist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), tables], ["doc_id", "counts"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, counts array<int>")


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit, fits) per row of ``docs``, read off the table of prefixes.

    over_limit: more than ``limit`` tokens. fits: code points of the longest prefix with at most ``limit`` tokens. Nulls, empty
    texts and repeated rows as in ``prefix_counts``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = counter(path)
        for batch in batches:
            size, count, fits = [], [], []
            for text in batch.column(1).to_pylist():
                table = words.prefixes(text)
                size.append(len((text or "").encode("utf-8", "surrogatepass")))
                count.append(int(table[-1]))
                fits.append(int(np.flatnonzero(table <= limit)[-1]) if table[-1] > limit else len(table) - 1)
            over = [n > limit for n in count]
            columns = [batch.column(0), pa.array(size, pa.int64()), pa.array(count, pa.int64()), pa.array(over, pa.bool_())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(fits, pa.int64())], ["doc_id", "n_bytes", "n_tokens", "over_limit", "fits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_bytes bigint, n_tokens bigint, over_limit boolean, fits bigint"
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, columns)
