"""Fingerprints of texts by the quartiles of their hashed byte triplets.

Six byte triplets of each window of five bytes are hashed into ``BUCKETS`` counters. A digest holds the length of the text on a
logarithmic scale and, for each bucket, in which quarter of all buckets its counter lies (two bits). A change touches few counters
and moves few of them to another quarter, so digests of similar texts differ little.

The difference of two digests adds up per bucket what its move between quarters costs, and the steps between the lengths; it
is bounded by what digests of unrelated texts differ by, or what these two could differ by if that is less, as it is for short
texts. The likeness of two digests is 1 for no difference and 0 at the bound.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmart.llm.common import few_at_once, stored

BUCKETS = 1024  # a power of two
# Places of the triplets in a window, the multiplier of the hash, the cost of moves by 0, 1, 2, 3 quarters, length
# steps per doubling, their cost and the most of them that count.
TRIPLETS = ((0, 1, 2), (0, 1, 3), (0, 2, 3), (0, 1, 4), (0, 2, 4), (0, 3, 4))
MULTIPLIER = 2654435761
MOVES = np.array([0, 1, 2, 6])
STEPS, STEP_COST, MOST_STEPS = 4, 8, 32
# What independent digests differ by on the average: 6, 4 and 2 of 16 pairs of quarters are 1, 2 and 3 apart.
BOUND = BUCKETS * 26 // 16

_SHIFT = np.uint32(32 - (BUCKETS.bit_length() - 1))
DONE, FIRST, LAST = 0, 1, 2


def triplet_counts(data: bytes) -> np.ndarray:
    """How many of the triplets of all windows fall into each bucket; the end of the text holds incomplete windows."""
    counts = np.zeros(BUCKETS, np.int64)
    for begin in range(0, len(data), 1 << 20):  # a long text part by part, each with the four bytes after it
        x = np.frombuffer(data, np.uint8, min(len(data) - begin, (1 << 20) + 4), begin).astype(np.uint32)
        for kind, (a, b, c) in enumerate(TRIPLETS):
            size = min(len(x) - c, 1 << 20)
            if size > 0:
                triplet = x[a : a + size] | x[b : b + size] << np.uint32(8) | x[c : c + size] << np.uint32(16)
                hashed = (triplet + np.uint32(kind << 24)) * np.uint32(MULTIPLIER)
                counts += np.bincount(hashed >> _SHIFT, minlength=BUCKETS)
    return counts


def digest(text: str) -> bytes:
    """Two bytes for the length, then two bits for each bucket."""
    data = text.encode("utf-8", "surrogatepass")
    counts = triplet_counts(data)
    ordered = np.sort(counts)
    quarter = sum((counts > ordered[BUCKETS * n // 4 - 1]).astype(np.uint8) for n in (1, 2, 3))
    packed = quarter[0::4] | quarter[1::4] << 2 | quarter[2::4] << 4 | quarter[3::4] << 6
    length = int(STEPS * np.log2(1 + len(data)))
    return length.to_bytes(2, "big") + packed.tobytes()


def _quarters(fingerprint: bytes) -> np.ndarray:
    packed = np.frombuffer(fingerprint, np.uint8, offset=2)
    return np.stack([packed >> shift & 3 for shift in (0, 2, 4, 6)], 1).ravel().astype(np.int8)


def likeness(one: bytes, two: bytes) -> float:
    """From 0, as different as unrelated texts or more, to 1, no difference."""
    if one == two:
        return 1.0
    steps = STEP_COST * min(MOST_STEPS, abs(int.from_bytes(one[:2], "big") - int.from_bytes(two[:2], "big")))
    a, b = _quarters(one), _quarters(two)
    bound = min(BOUND, steps + int(MOVES[a].sum() + MOVES[b].sum()))
    return 1.0 - min(steps + int(MOVES[np.abs(a - b)].sum()), bound) / bound


def edited(text: str, following: str) -> str:
    """The text with its last floor(length / 2) code points replaced by the first as many, or all, of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint) per row of ``docs`` (doc_id, text). A null text counts as empty; repeated rows and null doc_ids are
    carried along; other columns are not looked at; an empty table gives an empty table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [digest(t or "").hex() for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], ["doc_id", "fingerprint"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fingerprint string")


_RESULT = "n_chars bigint, edited_sha256 binary, fingerprint binary, edited_fingerprint binary, near_edited double, near_next double"
_FIELDS = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]


def _compared(text: str, own: bytes, following: str, next_digest: bytes) -> tuple:
    changed = edited(text, following)
    of_changed = own if changed == text else digest(changed)
    sha = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).digest()
    return len(text), sha, own, of_changed, likeness(own, of_changed), likeness(own, next_digest)


def neighbours(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Each document beside its edited text and the next document, in ascending order of doc_id, after the last the first.

    Returns (doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next) per row of ``docs`` (doc_id, text).
    The texts are shuffled once, into ranges of the order; a task streams through its range and needs two texts at a time, and
    the two ends of a range are stored and joined with those of its neighbours. Rows without a doc_id come first; rows of one
    doc_id follow the hash of their text, so a hot doc_id spreads over ranges. A null text counts as empty. The next of an only
    row is itself. Other columns are not looked at; an empty table gives an empty table.
    """
    text = F.coalesce("text", F.lit("")).alias("text")
    order = ["doc_id", "_hash", "text"]
    ranged = docs.select("doc_id", text).withColumn("_hash", F.xxhash64("text"))
    ranged = ranged.repartitionByRange("doc_id", "_hash").sortWithinPartitions(*order)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        before = None  # (doc_id, text, digest) of the row that still waits for its next one
        for batch in batches:
            ids, made, ends = [], [], []
            for doc, own in zip(batch.column(0), batch.column(1).to_pylist()):
                found = before[2] if before and own == before[1] else digest(own)
                if before is None:
                    ends.append((FIRST, doc, own))
                else:
                    ids.append(before[0])
                    made.append(_compared(before[1], before[2], own, found))
                before = doc, own, found
            yield from _rows(part, batch.schema.field(0).type, ids, made, ends)
        if before:
            yield from _rows(part, batch.schema.field(0).type, [], [], [(LAST, before[0], before[1])])

    found = few_at_once(ranged).select("doc_id", "text").mapInArrow(run, f"part int, kind int, doc_id {kind}, text string, {_RESULT}")
    found = stored(spark, found, "digests")
    results = ["doc_id", *[c.split()[0] for c in _RESULT.split(", ")]]
    whole = found.where(F.col("kind") == DONE).select(*results).unionByName(_closed(found, kind))
    written = {n: F.lower(F.hex(n)) for n in ("edited_sha256", "fingerprint", "edited_fingerprint")}  # stored as half as many bytes
    return whole.withColumns(written)


def _rows(part: int, kind: pa.DataType, ids: list, made: list, ends: list) -> Iterator[pa.RecordBatch]:
    """The finished rows and, with their texts, the ends of a range."""
    n, m = len(made), len(ends)
    if n + m == 0:
        return
    columns = list(zip(*made)) if made else [()] * len(_FIELDS)
    docs = [d.as_py() for d in ids] + [d.as_py() for _, d, _ in ends]
    arrays = [
        pa.array([part] * (n + m), pa.int32()),
        pa.array([DONE] * n + [k for k, _, _ in ends], pa.int32()),
        pa.array(docs, kind),
        pa.array([None] * n + [t for _, _, t in ends], pa.string()),
        *[pa.array([*column, *[None] * m], field) for column, field in zip(columns, _FIELDS)],
    ]
    names = ["part", "kind", "doc_id", "text", *[c.split()[0] for c in _RESULT.split(", ")]]
    yield pa.RecordBatch.from_arrays(arrays, names)


def _closed(found: DataFrame, kind: str) -> DataFrame:
    """The last row of each range beside the first of the next range; only the numbers of the ranges are put in order at once."""
    firsts = found.where(F.col("kind") == FIRST).select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    numbers = found.where(F.col("kind") == FIRST).select("part")
    ascending = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    following = numbers.select("part", F.lead("part").over(Window.orderBy("part")).alias("after"), F.first("part").over(ascending).alias("first"))
    following = following.select("part", F.coalesce("after", "first").alias("next_part"))
    lasts = found.where(F.col("kind") == LAST).select("part", "doc_id", "text")
    paired = lasts.join(following, "part").join(firsts, "next_part").select("doc_id", "text", "next_text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                _compared(own, digest(own), after, digest(after))
                for own, after in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())
            ]
            columns = list(zip(*made)) if made else [()] * len(_FIELDS)
            arrays = [batch.column(0), *[pa.array(list(c), field) for c, field in zip(columns, _FIELDS)]]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", *[c.split()[0] for c in _RESULT.split(", ")]])

    return paired.mapInArrow(run, f"doc_id {kind}, {_RESULT}")
