"""Document quality by a factorisation machine.

A document is a sparse vector: log-scaled counts of its words, hashed into buckets and scaled to length 1, together with structure
statistics and metadata of the text (length, lines) in buckets of their own. The score is the logistic of a bias, a linear part and the
interactions of all pairs of features, whose weights are inner products of short vectors. With the sum-of-squares identity the interactions cost
one pass over the features that are not zero: half of (sum of v x) squared less the sum of (v x) squared, for each factor.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import few_at_once, smallest_hashes

BUCKETS = 1 << 14
FACTORS = 8
EPOCHS = 8
# Labelled documents that the machine is fitted on at most: those with the smallest hash of doc_id.
SAMPLE = 5_000
THRESHOLD = 0.3
FOLDS = 5

_UPPER, _LOWER = slice(65, 91), slice(97, 123)
_MARKS = [n for n in range(33, 127) if not chr(n).isalnum()]
_STATISTICS = 14
SIZE = BUCKETS + _STATISTICS


def statistics(text: str) -> list[float]:
    """Structure and metadata of a text, each between 0 and about 1."""
    bytes_of = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
    size = max(1, int(bytes_of.sum()))
    upper, lower = int(bytes_of[_UPPER].sum()), int(bytes_of[_LOWER].sum())
    words = text.split()
    lines = text.split("\n")
    filled = [line for line in lines if line.strip()]
    count = max(1, len(words))
    marks = int(bytes_of[_MARKS].sum())
    return [
        upper / max(1, upper + lower),
        int(bytes_of[48:58].sum()) / size,
        marks / size,
        int(bytes_of[124] + bytes_of[60] + bytes_of[62] + bytes_of[123] + bytes_of[125]) / count,
        int(bytes_of[33] + bytes_of[35] + bytes_of[36] + bytes_of[37] + bytes_of[38] + bytes_of[42]) / count,
        int(bytes_of[46] + bytes_of[44]) / count,
        int(bytes_of[128:].sum()) / size,
        len(set(words)) / count,
        len(set(filled)) / max(1, len(filled)),
        min(1.0, len(text) / count / 20),
        math.log1p(len(words)) / 12,
        math.log1p(len(lines)) / 10,
        min(1.0, len(words) / max(1, len(filled)) / 60),
        float(not words),
    ]


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The buckets that are not zero, and their values."""
    text = text or ""
    counts = Counter(text.lower().split())
    at = np.fromiter((zlib.crc32(w.encode("utf-8", "surrogatepass")) % BUCKETS for w in counts), np.int64, len(counts))
    by_bucket = np.bincount(at, weights=np.fromiter(counts.values(), np.float64, len(counts)), minlength=1) if len(at) else np.zeros(1)
    used = np.flatnonzero(by_bucket)
    value = np.log1p(by_bucket[used])
    value /= max(1e-12, float(np.sqrt((value**2).sum())))
    place = np.arange(BUCKETS, SIZE, dtype=np.int64)
    return np.concatenate([used, place]), np.concatenate([value, statistics(text)])


@dataclass(frozen=True)
class Machine:
    bias: float
    linear: np.ndarray  # (SIZE,)
    factors: np.ndarray  # (SIZE, FACTORS)

    def margin(self, at: np.ndarray, value: np.ndarray) -> float:
        part = self.factors[at] * value[:, None]
        return float(self.bias + self.linear[at] @ value + 0.5 * ((part.sum(0) ** 2).sum() - (part**2).sum()))

    def score(self, text: str | None) -> float:
        return 1 / (1 + math.exp(-max(-40.0, min(40.0, self.margin(*features(text))))))


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = EPOCHS, seed: int = 7) -> Machine:
    """Fit by stochastic gradient steps with a step size of its own for each weight. rows: buckets, values and the label 0 or 1.

    Without rows the machine scores everything one half.
    """
    draw = np.random.default_rng(seed)
    linear, factors = np.zeros(SIZE), draw.normal(0, 0.02, (SIZE, FACTORS))
    seen_linear, seen_factors = np.full(SIZE, 1e-2), np.full((SIZE, FACTORS), 1e-2)
    ones = sum(label for _, _, label in rows)
    bias, step, decay = math.log((ones + 1) / (len(rows) - ones + 1)), 0.1, 1e-5
    for _ in range(epochs):
        for n in draw.permutation(len(rows)):
            at, value, label = rows[n]
            part = factors[at] * value[:, None]
            total = part.sum(0)
            margin = bias + linear[at] @ value + 0.5 * ((total**2).sum() - (part**2).sum())
            error = 1 / (1 + math.exp(-max(-40.0, min(40.0, float(margin))))) - label
            bias -= 0.01 * error
            slope = error * value + decay * linear[at]
            seen_linear[at] += slope**2
            linear[at] -= step * slope / np.sqrt(seen_linear[at])
            slope = error * value[:, None] * (total - part) + decay * factors[at]
            seen_factors[at] += slope**2
            factors[at] -= 0.5 * step * slope / np.sqrt(seen_factors[at])
    return Machine(bias, linear, factors)


def held_out(doc_id: Column) -> Column:
    """Whether labels of the document are kept from training; a null doc_id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Machine:
    """Fit on at most ``sample`` labelled documents (doc_id, text; doc_id, quality) outside the held-out fold.

    Which ones does not depend on their order or partitions: those with the smallest hash of doc_id. Their features are made by the
    tasks; only these bounded vectors reach the driver. Rows with a null doc_id, quality or text do not count. Of
    repeated doc_ids the smallest text each counts.
    """
    known = labels.where("quality in (0, 1) and doc_id is not null").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    chosen = smallest_hashes(known, ["doc_id"], sample, known.count())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([at.astype(np.int32) for at, _ in rows], pa.list_(pa.int32())),
                    pa.array([value.astype(np.float32) for _, value in rows], pa.list_(pa.float32())),
                ],
                ["doc_id", "quality", "at", "value"],
            )

    texts = few_at_once(docs).where("text is not null").select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # at most ``sample`` short rows
    texts = texts.groupBy("doc_id", F.col("quality").cast("int").alias("quality")).agg(F.min("text").alias("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = texts.mapInArrow(
        run, f"doc_id {kind}, quality int, at array<int>, value array<float>"
    )
    table = rows.toArrow().to_pandas().sort_values("doc_id", kind="stable")
    return fit([(a.astype(np.int64), v.astype(np.float64), int(q)) for q, a, v in zip(table["quality"], table["at"], table["value"])])


def scorer(spark: SparkSession, machine: Machine):
    """A function from a text column to its score; the machine has a fixed size."""
    shipped = spark.sparkContext.broadcast(machine)

    @F.pandas_udf("double")
    def score(text: pd.Series) -> pd.Series:
        model = shipped.value
        return pd.Series([model.score(t if isinstance(t, str) else "") for t in text], dtype="float64")

    return score


def scored(spark: SparkSession, docs: DataFrame, machine: Machine) -> DataFrame:
    """(doc_id, held_out, score, predicted) per row of ``docs`` (doc_id, text).

    A null text scores like an empty one; repeated rows and null doc_ids are carried along; no other column is looked at. An empty
    table gives an empty table.
    """
    score = scorer(spark, machine)
    rows = few_at_once(docs).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def good(spark: SparkSession, docs: DataFrame, machine: Machine) -> DataFrame:
    """``docs`` without the rows that the machine rejects; all columns stay as they are."""
    return few_at_once(docs).where(scorer(spark, machine)("text") >= THRESHOLD)
