"""Alignment of the tokens of two tokenizers over the same text.

Two tokenizers cut the same bytes into tokens; the places where tokens of both end cut the text into groups, and the two tokens
that end at such a place are linked. The end offsets of each tokenizer's tokens are a sorted list, and the two lists are merged by
paths: diagonals at equal distances, each met by the path of the merge at a place that a binary search finds, divide the merge
into pieces of equal work. Each piece merges its part by itself and emits the ends that meet in it; where the two equal ends fall
to either side of a border, the border is stitched. All pieces of a batch of texts are merged at once.

How often two ids are linked is counted over the whole corpus. Of two tokens that end together one's bytes are the end of the
other's, so the number of pairs of ids is bounded by the vocabularies and not by the corpus (``most_pairs``).
"""

from __future__ import annotations

import hashlib
import json
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmart.llm.bpe import byte_letters
from tillmart.llm.common import few_at_once, stored

WORK = 64  # ends that one piece of a merge takes
AT_ONCE = 1 << 20  # characters of the texts that are aligned at once, unless one text is longer
MOST_BROADCAST = 2_000_000  # pairs of ids, of some 32 bytes each, that are sent to every executor
# A run of this many characters without a cut is left to the tokenizers library, whose merges take n log n steps.
LONG_RUN = 1000

# Fixed value: how the byte-level vocabulary cuts a text before merging.
WORDS = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteLevel:
    """Tokenizer A: a byte-level vocabulary, read from a tokenizer file; strings of special tokens are plain text."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            told = json.load(file)
        model, letter = told["model"], {c: b for b, c in enumerate(byte_letters())}
        special = {x["id"] for x in told["added_tokens"]}
        self.path, self.tool, self.fast = path, None, None
        self.data = {n: bytes(letter[c] for c in t) for t, n in model["vocab"].items() if n not in special}
        made = [model["vocab"]["".join(m.split(" ") if isinstance(m, str) else m)] for m in model["merges"]]
        if made == list(range(256, 256 + len(made))):  # merges in the order of their ids, as ranks name them
            import tiktoken

            ranks = {d: n for n, d in self.data.items()}
            self.fast = tiktoken.Encoding("ranks", pat_str=WORDS, mergeable_ranks=ranks, special_tokens={})
        self.long = regex.compile(rf"\S{{{LONG_RUN}}}|\s{{{LONG_RUN}}}")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._one(t) for t in texts]

    def _one(self, text: str) -> list[int]:
        if self.fast is not None and not self.long.search(text):
            return self.fast.encode_ordinary(text)
        if self.tool is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self.tool = Tokenizer.from_file(self.path)
            self.tool.encode_special_tokens = True
            self.tool.no_truncation()
            self.tool.no_padding()
        return self.tool.encode(text, add_special_tokens=False).ids


class Pieces:
    """Tokenizer B: a sentencepiece model with byte fallback, which puts a space before a text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self.tool = sentencepiece.SentencePieceProcessor(model_file=path)
        self.data = {}
        for n in range(self.tool.get_piece_size()):
            piece = self.tool.id_to_piece(n)
            self.data[n] = bytes([int(piece[3:5], 16)]) if self.tool.is_byte(n) else piece.replace("▁", " ").encode("utf-8")

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.tool.encode(texts, num_threads=1)


_LOADED: dict[tuple[str, str], tuple[ByteLevel, Pieces]] = {}


def tokenizers(path_a: str, path_b: str) -> tuple[ByteLevel, Pieces]:
    """Both tokenizers, loaded once in each Python process."""
    if (path_a, path_b) not in _LOADED:
        _LOADED[path_a, path_b] = ByteLevel(path_a), Pieces(path_b)
    return _LOADED[path_a, path_b]


def most_pairs(path_a: str, path_b: str) -> int:
    """How many pairs of ids can end together at most: those of which one's bytes are the end of the other's."""
    a, b = (Counter(t.data.values()) for t in tokenizers(path_a, path_b))
    longer = sum(n * b.get(data[k:], 0) for data, n in a.items() for k in range(len(data)))
    return longer + sum(n * a.get(data[k:], 0) for data, n in b.items() for k in range(1, len(data)))


def borders(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where the path of merging two sorted lists meets every ``work``-th diagonal: how many of each lie before it.

    Of equal values that of ``a`` comes first.
    """
    total = len(a) + len(b)
    diagonal = np.append(np.arange(0, total, work), total)
    low, high = np.maximum(0, diagonal - len(b)), np.minimum(diagonal, len(a))
    while (low < high).any():
        middle = (low + high) // 2
        open_ = low < high
        i, j = np.minimum(middle, max(len(a) - 1, 0)), np.clip(diagonal - middle - 1, 0, max(len(b) - 1, 0))
        first = open_ & (a[i] <= b[j])  # the value of a goes before, so the border lies behind it
        low, high = np.where(first, middle + 1, low), np.where(open_ & ~first, middle, high)
    return low, diagonal - low


def meeting(a: np.ndarray, b: np.ndarray, work: int = WORK) -> tuple[np.ndarray, np.ndarray]:
    """The places (in ``a``, in ``b``) of the values that two strictly ascending lists share, in order."""
    if not len(a) or not len(b):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at_a, at_b = borders(a, b, work)
    i, j, last_i, last_j = at_a[:-1].copy(), at_b[:-1].copy(), at_a[1:], at_b[1:]
    # a value beyond all others ends each list, so that a piece at the end of one can look at its next place
    beyond = np.int64(1) << 62
    a, b = np.append(a, beyond), np.append(b, beyond)
    held = np.full(len(i), -1, np.int64)  # the last value of a that a piece has taken
    found_a, found_b = [], []
    for _ in range(work):
        left_a, left_b = i < last_i, j < last_j
        from_a = left_a & (~left_b | (a[i] <= b[j]))
        from_b = left_b & ~from_a
        met = from_b & (held == b[j])
        found_a.append(i[met] - 1)
        found_b.append(j[met])
        held = np.where(from_a, a[i], held)
        i, j = i + from_a, j + from_b
    # stitched: the last of one piece is of a, the first of the next is its equal of b
    ends_a, begins_b = at_a[1:-1], at_b[1:-1]
    split = (ends_a > at_a[:-2]) & (a[np.maximum(ends_a, 1) - 1] == b[begins_b]) & (begins_b < len(b) - 1)
    found_a.append(ends_a[split] - 1)
    found_b.append(begins_b[split])
    places_a, places_b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(places_a, kind="stable")
    return places_a[order], places_b[order]


class Aligner:
    """Aligns batches of texts."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = tokenizers(path_a, path_b)
        self.size_b = len(self.b.data)
        self.lengths_a, self.lengths_b = (self._lengths(t.data) for t in (self.a, self.b))
        most = max(len(self.lengths_a), self.size_b)
        width = len(str(most))
        self.digits = np.zeros((most, width + 1), np.uint8)  # each id's decimal digits; zero where nothing follows
        for n in range(most):
            told = str(n).encode()
            self.digits[n, : len(told)] = np.frombuffer(told, np.uint8)
        self.n_digits = (self.digits > 0).sum(1)

    @staticmethod
    def _lengths(data: dict[int, bytes]) -> np.ndarray:
        lengths = np.zeros(max(data) + 1, np.int64)
        for n, d in data.items():
            lengths[n] = len(d)
        return lengths

    def _whole(self, data: dict[int, bytes], ids: list[int], wanted: bytes) -> bool:
        try:
            return b"".join(map(data.__getitem__, ids)) == wanted
        except KeyError:
            return False

    def align(self, texts: list[str | None]) -> list[tuple]:
        """(n_a, n_b, n_groups, groups_sha256, pairs) of each text; ``pairs`` has (id of A * size of B + id of B) << 32 | times."""
        found: list[tuple] = [(0, 0, 0, "", np.zeros(0, np.int64))] * len(texts)
        present = [n for n, t in enumerate(texts) if t]
        spaced = [" " + texts[n] for n in present]
        of_a, of_b = self.a.encode(spaced), self.b.encode([texts[n] for n in present])
        rows, kept_a, kept_b = [], [], []
        for n, told, ids_a, ids_b in zip(present, spaced, of_a, of_b):
            data = told.encode("utf-8", "surrogatepass")
            if self._whole(self.a.data, ids_a, data) and self._whole(self.b.data, ids_b, data):
                rows.append(n)
                kept_a.append(ids_a)
                kept_b.append(ids_b)
        if not rows:
            return found
        ids_a, ids_b = (np.fromiter((x for ids in kept for x in ids), np.int64, sum(map(len, kept))) for kept in (kept_a, kept_b))
        # The texts stand one behind the other; both tokenizers end a token where a text ends.
        at_a, at_b = meeting(np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b]))
        ends_a = np.cumsum([len(x) for x in kept_a])
        ends = np.searchsorted(at_a, ends_a - 1) + 1  # groups up to the end of each text
        begins = np.append(0, ends[:-1])
        digests = self._digests(ids_a, ids_b, at_a, at_b, begins, ends)
        pairs = ids_a[at_a] * self.size_b + ids_b[at_b]
        row = np.repeat(np.arange(len(rows)), ends - begins)
        order = np.lexsort((pairs, row))
        pairs, row = pairs[order], row[order]
        new = np.flatnonzero(np.append(True, (pairs[1:] != pairs[:-1]) | (row[1:] != row[:-1])))
        times = np.diff(np.append(new, len(pairs)))
        packed, owner = pairs[new] << 32 | times, row[new]
        cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
        for k, n in enumerate(rows):
            groups = int(ends[k] - begins[k])
            found[n] = len(kept_a[k]), len(kept_b[k]), groups, digests[k], packed[cuts[k] : cuts[k + 1]]
        return found

    def _digests(self, ids_a, ids_b, at_a, at_b, begins, ends) -> list[str]:
        """The hash of the written groups of each text, a part of the groups at a time."""
        hashes = [hashlib.sha256() for _ in begins]
        part = 1 << 18
        for first in range(0, len(at_a), part):
            last = min(first + part, len(at_a))
            written, stops = self._written(ids_a, ids_b, at_a, at_b, first, last)
            k = int(np.searchsorted(ends, first, "right"))
            while k < len(ends) and begins[k] < last:
                start = stops[max(begins[k], first) - first - 1] if begins[k] > first else 0
                stop = stops[min(ends[k], last) - first - 1]
                # the last group of a text is not followed by a semicolon
                hashes[k].update(written[start : stop - 1 if ends[k] <= last else stop])
                k += 1
        return [h.hexdigest() for h in hashes]

    def _written(self, ids_a, ids_b, at_a, at_b, first: int, last: int) -> tuple[bytes, np.ndarray]:
        """Groups ``first`` to ``last`` as ``a1,a2|b1;``, and where each ends."""
        from_a, from_b = (int(at[first - 1]) + 1 if first else 0 for at in (at_a, at_b))
        a, b = ids_a[from_a : at_a[last - 1] + 1], ids_b[from_b : at_b[last - 1] + 1]
        ends_a, ends_b = at_a[first:last] - from_a, at_b[first:last] - from_b
        sizes_a, sizes_b = np.diff(ends_a, prepend=-1), np.diff(ends_b, prepend=-1)
        before_b = np.cumsum(sizes_b) - sizes_b
        place_a = np.arange(len(a)) + np.repeat(before_b, sizes_a)
        place_b = np.arange(len(b)) + np.repeat(ends_a + 1, sizes_b)
        ids, marks = np.empty(len(a) + len(b), np.int64), np.full(len(a) + len(b), ord(","), np.uint8)
        ids[place_a], ids[place_b] = a, b
        marks[place_a[ends_a]], marks[place_b[ends_b]] = ord("|"), ord(";")
        letters, size = self.digits[ids], self.n_digits[ids]
        letters[np.arange(len(ids)), size] = marks
        stops = np.cumsum(size + 1)[place_b[ends_b]]
        return letters[letters > 0].tobytes(), stops


def linked(docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, pairs) per row of ``docs`` (doc_id, text).

    ``pairs`` holds, for each pair of ids linked in the text, (id of A * size of B + id of B) << 32 | times. A text that is null or
    empty, or that one of the tokenizers does not give back byte for byte after a space, has no tokens: zeros, an empty
    string and no pairs. Repeated rows and null doc_ids are carried along; other columns are not looked at; an empty table gives an
    empty table.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(path_a, path_b)
        for batch in batches:
            texts, begin = batch.column(1).to_pylist(), 0
            while begin < len(texts):
                stop, size = begin, 0
                while stop < len(texts) and (stop == begin or size + len(texts[stop] or "") <= AT_ONCE):
                    size += len(texts[stop] or "")
                    stop += 1
                n_a, n_b, groups, digests, pairs = zip(*aligner.align(texts[begin:stop]))
                offsets = pa.array(np.concatenate([[0], np.cumsum([len(p) for p in pairs])]), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(begin, stop - begin),
                        *[pa.array(column, pa.int64()) for column in (n_a, n_b, groups)],
                        pa.array(digests, pa.string()),
                        pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(pairs), pa.int64())),
                    ],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs"],
                )
                begin = stop

    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>"
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, columns)


def pair_counts(found: DataFrame, size_b: int) -> DataFrame:
    """(pair, id_a, id_b, n, best) over the rows of ``linked``: the links of each pair of ids, and whether no other pair of its B id has more."""
    each = found.select(F.explode("pairs").alias("packed"))
    counted = each.groupBy(F.shiftright("packed", 32).alias("pair")).agg(F.sum(F.col("packed").bitwiseAND(0xFFFFFFFF)).alias("n"))
    ids = counted.select("pair", F.floor(F.col("pair") / size_b).alias("id_a"), (F.col("pair") % size_b).alias("id_b"), "n")
    return ids.withColumn("best", F.col("n") == F.max("n").over(Window.partitionBy("id_b")))


def aligned(spark: SparkSession, docs: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per row of ``docs``; rows as in ``linked``.

    n_links counts the pairs of tokens that end together, n_best those links whose pair of ids is the most frequent one of its B id in
    the corpus (ties included), count_sum the sum over the links of how often their pair is linked in the corpus.
    """
    found = stored(spark, linked(docs, path_a, path_b), "linked")
    counts = stored(spark, pair_counts(found, tokenizers(path_a, path_b)[1].tool.get_piece_size()), "pair-counts")
    counts = counts.select("pair", "n", "best")
    if most_pairs(path_a, path_b) <= MOST_BROADCAST:
        counts = F.broadcast(counts)
    whole = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]
    numbered = found.withColumn("row", F.monotonically_increasing_id())  # before the generator, or each of its rows gets a number
    each = numbered.select("row", *whole, F.explode_outer("pairs").alias("packed"))
    times = F.col("packed").bitwiseAND(0xFFFFFFFF)
    each = each.select("row", *whole, F.shiftright("packed", 32).alias("pair"), times.alias("times")).join(counts, "pair", "left")
    none = F.lit(0).cast("bigint")
    summed = each.groupBy("row", *whole).agg(
        F.coalesce(F.sum("times"), none).alias("n_links"),
        F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), none).alias("n_best"),
        F.coalesce(F.sum(F.col("times") * F.col("n")), none).alias("count_sum"),
    )
    return summed.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
