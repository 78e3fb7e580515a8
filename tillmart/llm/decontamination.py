"""Documents that hold passages of a benchmark, found by the q-gram lemma in diagonal bands and verified by alignment.

A passage of m characters within k edits of a place in a text shares at least m - q + 1 - k q of its q-grams with it, and all
of these lie within k + 1 neighbouring diagonals (position in the text minus position in the passage). Diagonals are cut into bands
that start every k + 1 and overlap by k, so one band holds them all. Bands with enough shared q-grams are regions, which are
then aligned exactly.

The passages are a stated query set. They go to the tasks in blocks of bounded size, and the documents stream through all
blocks in turn without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillmart.llm.common import few_at_once

Q = 7
EDIT_SHARE = 0.1  # edits allowed per character of a passage
BLOCK_CHARACTERS = 2_000_000  # of passages sent to the tasks at once; a longer passage is a block of its own
BLOCK_ITEMS = 30_000
CHUNK_CHARACTERS = 1_000_000  # of documents looked at together
SLICE = 1_000_000  # pairs of a shared q-gram's places in text and passages that are counted at once

_BASE = np.uint64(0x9E3779B97F4A7C15)
_TABLE_BITS = 20


def normal(text: str | None) -> str:
    """Lower case, white space collapsed to one blank."""
    return " ".join((text or "").lower().split())


def budget(length: int, q: int = Q, share: float = EDIT_SHARE) -> int:
    """Edits allowed in a passage: its share, but no more than leaves the lemma at least one q-gram."""
    return max(0, min(int(length * share), (length - q) // q))


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int) -> np.ndarray:
    """The hash of each q-gram."""
    n = len(codes) - q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    wide = codes.astype(np.uint64)
    value = wide[:n].copy()
    for step in range(1, q):
        value *= _BASE
        value += wide[step : n + step]
    value ^= value >> np.uint64(29)
    value *= np.uint64(0xBF58476D1CE4E5B9)
    return value


@dataclass(frozen=True)
class Block:
    """The q-gram index of some passages."""

    ids: list
    texts: list[str]
    edits: np.ndarray  # per passage
    least: np.ndarray  # shared q-grams needed
    grams: np.ndarray  # distinct hashes, ascending
    first: np.ndarray  # where the occurrences of each begin, one more at the end
    item: np.ndarray  # of each occurrence
    place: np.ndarray
    table: np.ndarray  # by the leading bits of the hash: whether any q-gram has them
    short: list[int]  # passages shorter than a q-gram, looked up as they are
    q: int


def block(items: list[tuple], q: int = Q, share: float = EDIT_SHARE) -> Block:
    ids, texts = [i for i, _ in items], [t for _, t in items]
    lengths = np.array([len(t) for t in texts], np.int64)
    edits = np.array([budget(len(t), q, share) for t in texts], np.int64)
    hashes = [_grams(_codes(t), q) for t in texts]
    counts = [len(h) for h in hashes]
    every = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    item = np.repeat(np.arange(len(texts), dtype=np.int64), counts)
    place = np.concatenate([np.arange(n, dtype=np.int64) for n in counts]) if counts else np.zeros(0, np.int64)
    order = np.argsort(every, kind="stable")
    grams, first = np.unique(every[order], return_index=True)
    table = np.zeros(1 << _TABLE_BITS, bool)
    table[(grams >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)] = True
    short = [n for n, t in enumerate(texts) if 0 < len(t) < q]
    least = lengths - q + 1 - edits * q
    return Block(ids, texts, edits, least, grams, np.append(first, len(every)), item[order], place[order], table, short, q)


def distance(passage: np.ndarray, text: np.ndarray, low: int, high: int, edits: int) -> int | None:
    """The fewest edits between the passage and a piece of the text, None if more than ``edits``.

    Only alignments in a band of diagonals are looked at: those where character ``n`` of the passage lies at ``n + low`` to ``n + high`` of the
    text, which may begin before the text or end behind it. Row by row of the passage, as many cells each as the band has diagonals.
    """
    width = high - low + 1
    across = np.arange(width)
    # the text under the band, with characters that equal none before its begin and behind its end
    padded = np.full(len(passage) + width, -1, np.int64)
    begin, end = max(0, low), min(len(text), low + len(padded))
    if begin < end:
        padded[begin - low : end - low] = text[begin:end]
    never = edits + 1 + len(passage) + width
    # cell d of row n: the passage's first n characters against a piece that ends before place n + low + d
    at = low + across
    row = np.where((at >= 0) & (at <= len(text)), 0, never)
    for n, code in enumerate(passage, 1):
        replaced = row + (padded[n - 1 : n - 1 + width] != code)
        dropped = np.append(row[1:] + 1, never)
        outside = (at + n < 0) | (at + n > len(text))
        best = np.where(outside, never, np.minimum(replaced, dropped))
        row = np.where(outside, never, np.minimum.accumulate(best - across) + across)
        if row.min() > edits:
            return None
    return int(row.min())


def _hits(codes: np.ndarray, index: Block) -> tuple[np.ndarray, np.ndarray]:
    """Positions whose q-gram some passage has, and its number in the index; looked up window by window."""
    places, slots = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for begin in range(0, len(codes) if len(index.grams) else 0, CHUNK_CHARACTERS):
        hashes = _grams(codes[begin : begin + CHUNK_CHARACTERS + index.q - 1], index.q)
        at = np.flatnonzero(index.table[(hashes >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)])
        slot = np.searchsorted(index.grams, hashes[at])
        slot[slot == len(index.grams)] = 0
        real = index.grams[slot] == hashes[at]
        places.append(at[real] + begin)
        slots.append(slot[real])
    return np.concatenate(places), np.concatenate(slots)


def _slices(at: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of the hits, in order, that stand for at most ``SLICE`` pairs of places each, or are a single hit."""
    ends, begin = np.cumsum(times), 0
    while begin < len(at):
        done = int(ends[begin - 1]) if begin else 0
        stop = max(begin + 1, int(np.searchsorted(ends, done + SLICE, "right")))
        yield begin, stop
        begin = stop


def regions(codes: np.ndarray, starts: np.ndarray, index: Block) -> Iterator[tuple[int, int, int, int]]:
    """(document, passage, first and last diagonal) of the bands in joined documents that have enough shared q-grams.

    A frequent q-gram of a text meets every place that passages have it at. These pairs are counted per band in slices of
    bounded size, in the order of the text, and a band is judged and forgotten as soon as the text has gone past it; so what is held at a
    time does not grow with how often a q-gram occurs in a text.
    """
    at, slot = _hits(codes, index)
    if not len(at):
        return
    longest = max(map(len, index.texts))
    times = index.first[slot + 1] - index.first[slot]
    keys, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for begin, stop in _slices(at, times):
        size = times[begin:stop]
        place = np.repeat(at[begin:stop], size)
        shift = np.arange(len(place)) - np.repeat(np.cumsum(size) - size, size)
        occurrence = np.repeat(index.first[slot[begin:stop]], size) + shift
        item = index.item[occurrence]
        doc = np.searchsorted(starts, place, side="right") - 1
        diagonal = place - starts[doc] - index.place[occurrence] + longest  # never negative
        band = diagonal // (index.edits[item] + 1) + 1
        # each hit lies in the band that starts at or before its diagonal and in the one before that
        key = (doc << np.int64(48)) | (item << np.int64(33))
        new, more = np.unique(np.concatenate([key | band, key | (band - 1)]), return_counts=True)
        keys, again = np.unique(np.concatenate([keys, new]), return_inverse=True)
        counts = np.bincount(again, np.concatenate([counts, more]), len(keys)).astype(np.int64)
        item = (keys >> np.int64(33)) & np.int64(0x7FFF)
        step = index.edits[item] + 1
        doc, low = keys >> np.int64(48), ((keys & np.int64((1 << 33) - 1)) - 1) * step - longest  # first diagonal of the band
        if stop < len(at):
            over = starts[doc] + low + 2 * step + longest < at[stop]
        else:
            over = np.ones(len(keys), bool)
        enough = over & (counts >= index.least[item])
        for d, i, a, e in zip(doc[enough].tolist(), item[enough].tolist(), low[enough].tolist(), index.edits[item][enough].tolist()):
            yield d, i, a - e, a + 3 * e + 2
        keys, counts = keys[~over], counts[~over]


def matches(texts: list[str], index: Block) -> list[dict[int, int]]:
    """For each normalised text, the passages it holds and the edits of each."""
    found: list[dict[int, int]] = [{} for _ in texts]
    lengths = np.array([len(t) for t in texts], np.int64)
    starts = np.cumsum(lengths) - lengths
    codes = _codes("".join(texts))
    passages: dict[int, np.ndarray] = {}
    aligned: dict[tuple, int | None] = {}
    for doc, item, low, high in regions(codes, starts, index):
        known = found[doc].get(item)
        if known == 0:
            continue
        begin, end = max(0, low), min(len(texts[doc]), max(0, high + len(index.texts[item])))
        if texts[doc].find(index.texts[item], begin, end) >= 0:
            found[doc][item] = 0
            continue
        if item not in passages:
            passages[item] = _codes(index.texts[item]).astype(np.int64)
        same = (item, low - begin, high - begin, texts[doc][begin:end])
        if same not in aligned:  # a text that repeats itself has many equal regions
            if len(aligned) >= 10_000:
                aligned.clear()
            text = codes[starts[doc] + begin : starts[doc] + end]
            aligned[same] = distance(passages[item], text, low - begin, high - begin, int(index.edits[item]))
        edits = aligned[same]
        if edits is not None and (known is None or edits < known):
            found[doc][item] = edits
    for item in index.short:
        for doc, text in enumerate(texts):
            if index.texts[item] in text:
                found[doc][item] = 0
    return found


def _chunks(texts: list[str], most: int) -> Iterator[tuple[int, int]]:
    begin, size = 0, 0
    for n, text in enumerate(texts):
        if n > begin and (size + len(text) > most or n - begin >= 30_000):
            yield begin, n
            begin, size = n, 0
        size += len(text)
    if begin < len(texts):
        yield begin, len(texts)


def _blocks(rows: Iterable) -> Iterator[list[tuple]]:
    part, size = [], 0
    for row in rows:
        text = normal(row["text"])
        if not text:
            continue
        if part and (size + len(text) > BLOCK_CHARACTERS or len(part) >= BLOCK_ITEMS):
            yield part
            part, size = [], 0
        part.append((row["item_id"], text))
        size += len(text)
    if part:
        yield part


def contaminated(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, q: int = Q, share: float = EDIT_SHARE) -> DataFrame:
    """(doc_id, item_ids, edits) per row of ``docs`` (doc_id, text): the passages of ``benchmark`` (item_id, text) in it.

    A passage is held if some piece of the text is within ``share`` of its length in edits (insert, delete, replace), both
    normalised as ``normal`` does; a passage so short that the lemma would ask for no q-gram is given fewer edits. item_ids ascends; edits has
    the fewest edits found for each. A null text is empty and holds nothing; a passage that is null or empty is in no text. Passages
    with the same text are all reported. A null item_id stays null in the list, last. Repeated rows and null doc_ids are carried along; other columns
    are not looked at. An empty table on either side gives no matches.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    named = benchmark.schema["item_id"].dataType
    columns = f"doc_id {kind}, text string, item_ids array<{named.simpleString()}>, edits array<int>"
    carried, first = few_at_once(docs).select("doc_id", "text"), True
    for shipped in _shipped(spark, benchmark, q, share):
        carried = carried.mapInArrow(_Pass(shipped, first, to_arrow_type(named)), columns)
        first = False
    if first:
        nothing = [F.array().cast(f"array<{named.simpleString()}>").alias("item_ids"), F.array().cast("array<int>").alias("edits")]
        return carried.select("doc_id", *nothing)
    return carried.select("doc_id", "item_ids", "edits")


def clean(spark: SparkSession, docs: DataFrame, benchmark: DataFrame, q: int = Q, share: float = EDIT_SHARE) -> DataFrame:
    """``docs`` without the rows that hold a passage of ``benchmark``, as ``contaminated`` finds them; all columns stay as they are."""
    for shipped in _shipped(spark, benchmark, q, share):
        docs = few_at_once(docs).where(~_holds(shipped)("text"))
    return docs


def _shipped(spark: SparkSession, benchmark: DataFrame, q: int, share: float) -> Iterator:
    """The passages in blocks of bounded size, each sent to all executors."""
    for items in _blocks(benchmark.select("item_id", "text").toLocalIterator()):
        yield spark.sparkContext.broadcast(block(items, q, share))


def _found(texts: list[str | None], index: Block) -> list[dict[int, int]]:
    plain = [normal(t) for t in texts]
    found: list[dict[int, int]] = []
    for begin, end in _chunks(plain, CHUNK_CHARACTERS):
        found += matches(plain[begin:end], index)
    return found


def _holds(shipped):
    @F.pandas_udf("boolean")
    def holds(text: pd.Series) -> pd.Series:
        return pd.Series([bool(one) for one in _found([t if isinstance(t, str) else None for t in text], shipped.value)], dtype=bool)

    return holds


class _Pass:
    """One pass of the documents through a block; the text goes on to the next block."""

    def __init__(self, shipped, first: bool, kind: pa.DataType):
        self.shipped, self.first, self.kind = shipped, first, kind

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = self.shipped.value
        for batch in batches:
            found = _found(batch.column(1).to_pylist(), index)
            pairs = [[(index.ids[i], n) for i, n in one.items()] for one in found]
            if not self.first:
                before = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
                pairs = [list(zip(ids, edits)) + new for (ids, edits), new in zip(before, pairs)]
            pairs = [sorted(p, key=lambda x: (x[0] is None, *(x if x[0] is not None else x[1:]))) for p in pairs]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([[i for i, _ in p] for p in pairs], pa.list_(self.kind)),
                    pa.array([[n for _, n in p] for p in pairs], pa.list_(pa.int32())),
                ],
                ["doc_id", "text", "item_ids", "edits"],
            )
