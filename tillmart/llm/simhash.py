"""Near-duplicate documents by SimHash fingerprints, found through pigeonring filtering.

A fingerprint is cut into four segments of 16 bits, laid in a ring. If two fingerprints differ in at most 3 bits, then
some segment starts a chain whose first 1, 2, 3 and 4 segments together differ in at most 0, 1, 2 and 3 bits (the
budget of 3 shared out in proportion to the length, rounded down). Candidates meet on a key that follows from such a
chain: the first segment is equal; the second has at most 1 differing bit, so one of its 2 halves is equal; the third at most
2, so one of its 3 parts is equal. That is 24 keys of 29 or 30 bits for each distinct fingerprint. The chain is then
checked in full, and last the distance over all 64 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm.common import few_at_once, stored
from tillmart.llm.components import components

MAX_BITS = 3
SEED = 42
# Distinct fingerprints under one key beyond which all of them are linked by midpoints instead of by pairs.
CROWD = 400

_BITS_OF_BYTE = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_COLUMN = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The SimHash of a text, 0 for one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return 0
    joined = b" ".join(words)
    count = len(words) - shingle + 1
    if count < 1:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = ends - lengths
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[a:b], SEED) for a, b in zip(starts[:count].tolist(), ends[shingle - 1 :].tolist())]
    each = np.array(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    counts = np.bincount((each + _COLUMN).ravel(), minlength=2048).reshape(8, 256) @ _BITS_OF_BYTE
    bits = (counts * 2 > len(hashes)).astype(np.uint8)
    return int.from_bytes(np.packbits(bits, axis=1, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fp) per row of ``docs``; fp is the fingerprint as a signed 64-bit number."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter((fingerprint(t, shingle) for t in batch.column(1).to_pylist()), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints.view(np.int64))], ["doc_id", "fp"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return few_at_once(docs).select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, fp bigint")


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _rotated(fp: Column, by: int) -> Column:
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by)) if by else fp


# Masks over the rotated fingerprint: first segment, then a half of the second, then a part of the third.
_FIRST = 0xFFFF << 48
_HALVES = (0xFF << 40, 0xFF << 32)
_PARTS = (0x1F << 27, 0x1F << 22, 0x3F << 16)


def _keys(fp: Column) -> Column:
    keys = []
    for start in range(4):
        turned = _rotated(fp, 16 * start)
        for half in _HALVES:
            for part in _PARTS:  # the last 16 bits are free for the number of the key
                mask = _signed(_FIRST | half | part)
                keys.append(turned.bitwiseAND(F.lit(mask)).bitwiseOR(F.lit(len(keys)).cast("bigint")))
    return F.array(*keys)


def _chain(a: Column, b: Column, key: Column) -> Column:
    """Whether the chain that starts where the key says keeps within its budgets, and the distance within 3."""
    start = key.bitwiseAND(F.lit(0xFFFF).cast("bigint")) / 6  # six keys for each start
    difference = a.bitwiseXOR(b)
    turned = F.when(start < 1, difference)
    for n in range(1, 4):
        turned = turned.when(start < n + 1, _rotated(difference, 16 * n))
    upto = lambda segments: F.bit_count(F.shiftrightunsigned(turned, 64 - 16 * segments))
    return (upto(2) <= 1) & (upto(3) <= 2) & (F.bit_count(difference) <= MAX_BITS)


def linked(spark: SparkSession, prints: DataFrame, crowd: int = CROWD) -> DataFrame:
    """(a, b): links between distinct fingerprints ``prints`` (fp) that join all within 3 bits of each other.

    Under a key with up to ``crowd`` fingerprints every link is given. The fingerprints of a fuller key, such as that of
    thousands of near copies, are linked by midpoints: at most 3 bits apart means that some 64-bit value is at most 1 bit from
    one and at most 2 from the other. At each such value all meet one of those at most 1 bit away, so connected ones stay
    connected, with rows in proportion to the fingerprints and not to their pairs.
    """
    postings = stored(spark, prints.select("fp", F.explode(_keys(F.col("fp"))).alias("key")), "postings")
    full = stored(spark, postings.groupBy("key").count().where(F.col("count") > crowd).select("key"), "full-keys")
    crowded = not full.isEmpty()
    sparse = postings.join(full, "key", "left_anti") if crowded else postings
    one, two = sparse.alias("one"), sparse.alias("two")
    a, b = F.col("one.fp"), F.col("two.fp")
    links = one.join(two, (F.col("one.key") == F.col("two.key")) & (a < b) & _chain(a, b, F.col("one.key")))
    links = links.select(a.alias("a"), b.alias("b"))
    if crowded:
        many = stored(spark, postings.join(full, "key", "left_semi").select("fp").distinct(), "crowd")
        links = links.unionByName(_midpoints(many))
    return links.distinct()


def _midpoints(prints: DataFrame) -> DataFrame:
    ones = [1 << n for n in range(64)]
    near = [0, *ones]
    pairs = [x | y for n, x in enumerate(ones) for y in ones[:n]]

    def around(masks: list[int]) -> Column:
        return F.transform(F.array(*[F.lit(_signed(m)).cast("bigint") for m in masks]), lambda m: F.col("fp").bitwiseXOR(m))

    hubs = prints.select("fp", F.explode(around(near)).alias("at")).groupBy("at").agg(F.min("fp").alias("b"))
    reach = prints.select(F.col("fp").alias("a"), F.explode(around(near + pairs)).alias("at"))
    return reach.join(hubs, "at").where("a != b").select("a", "b").distinct()


def near_duplicates(spark: SparkSession, docs: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) per row of ``docs``; other columns are not looked at.

    fingerprint: 16 lowercase hex digits. component_id: the smallest doc_id among the documents that can be reached over
    links of at most 3 differing bits. A null or empty text has fingerprint zero, like any text without words, and is linked
    like any other. A repeated row gives a repeated row. A null doc_id is no candidate for component_id: where a component has no
    other, component_id is null. An empty table gives an empty table.
    """
    prints, of_print = _grouped(spark, docs, shingle)
    found = prints.join(of_print, "fp")
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _grouped(spark: SparkSession, docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """(doc_id, fp) per row of ``docs``, and (fp, root, component_id) per fingerprint; root names the component."""
    prints = stored(spark, fingerprints(docs, shingle), "fingerprints")
    distinct = stored(spark, prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct-fingerprints")
    links = linked(spark, distinct.select("fp"))
    roots = stored(spark, components(spark, links).select(F.col("node").alias("fp"), "root"), "roots")
    grouped = roots.join(distinct, "fp")
    smallest = grouped.groupBy("root").agg(F.min("least").alias("smallest"))
    of_root = stored(spark, grouped.select("fp", "root").join(smallest, "root").select("fp", "root", "smallest"), "components")
    of_print = distinct.join(of_root, "fp", "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), F.coalesce("smallest", "least").alias("component_id")
    )
    return prints, stored(spark, of_print, "component-of-fingerprint")


def keep_one(spark: SparkSession, docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with one document of each component: the one whose doc_id is the smallest.

    All columns stay as they are. Where that doc_id has several rows in the component, the one with the smallest fingerprint, and of those
    the smallest text, stays; a doc_id with rows in several components can stay in each. Rows without a doc_id stay: nothing says
    which are the same.
    """
    prints, of_print = _grouped(spark, docs, shingle)
    first = prints.join(of_print, "fp").where("doc_id = component_id")
    kept = stored(spark, first.groupBy("root", "doc_id").agg(F.min("fp").alias("fp")).select("doc_id", "fp"), "kept")
    repeated = prints.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id")
    repeated = stored(spark, repeated, "repeated")
    rest = docs.join(kept.join(repeated, "doc_id", "left_anti"), "doc_id", "left_semi").select(*docs.columns)
    rest = rest.unionByName(docs.where("doc_id is null"))
    if repeated.isEmpty():
        return rest

    @F.pandas_udf("bigint")
    def print_of(text: pd.Series) -> pd.Series:
        prints = (fingerprint(t if isinstance(t, str) else None, shingle) for t in text)
        return pd.Series(np.fromiter(prints, np.uint64, len(text)).view(np.int64))

    # only for these rows a fingerprint is made again, and the tasks drop most of one doc_id before it meets in one
    several = few_at_once(docs).join(kept.join(repeated, "doc_id", "left_semi"), "doc_id", "left_semi")
    whole = F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row")
    rows = several.select("doc_id", print_of("text").alias("fp"), whole).join(kept, ["doc_id", "fp"], "left_semi")
    one = rows.groupBy("doc_id", "fp").agg(F.min_by("row", F.coalesce("row.text", F.lit(""))).alias("row"))
    return rest.unionByName(one.select("row.*"))
