"""Ranked lexical search over a K2-treap of terms and documents.

The documents are indexed in shards. A shard is a grid with a row for each of its terms and a column for each of its documents, kept
as a K2-treap (``grid_treap``): a point holds the impact of the term on the document, a cell the maximum of the impacts below it.
Rows are in the order of how many documents they hold, columns by their strongest term and length, so that like documents stand
together. For a query the row paths of its terms descend jointly and best first over ranges of documents, so that documents far from
the first places are never looked at, and yet the result is exact.

A term's weight is floor(1000 ln((2N + 2) / (2 df + 1))), its impact 10^9 tf div (1000 tf + 20 m), where m = 50 + 50 n N div L; N documents
have terms, L terms in all with repeats, n terms one document.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmart.llm.common import few_at_once, rows_at_once, stored
from tillmart.llm.grid_treap import Treap, best_columns, smallest_places

MOST = 50
POSTINGS = 500_000  # points after which a task closes a shard and begins another
ITEMS_PER_BLOCK = 256  # items whose paths are handed to a shard at once
ITEMS_AT_ONCE = 16  # items that descend together

# Fixed value: what a term is made of; only A-Z are lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")  # the same over UTF-8


def _terms(text: str | None) -> list[bytes]:
    return _TERM_BYTES.findall((text or "").encode("utf-8", "surrogatepass").lower())


class Index(NamedTuple):
    """shards: one row per shard; n_docs and n_terms: N and L of all documents."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def totals(docs: DataFrame) -> tuple[int, int]:
    """How many documents have a term, and how many terms they have, with repeats."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = [len(_terms(t)) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_pydict({"docs": [sum(n > 0 for n in sizes)], "terms": [sum(sizes)]})

    found = few_at_once(docs).select("text").mapInArrow(run, "docs bigint, terms bigint").agg(F.sum("docs"), F.sum("terms")).first()
    return found[0] or 0, found[1] or 0


class _Shard:
    """The documents of a shard while a task gathers them."""

    def __init__(self, n_docs: int, n_terms: int):
        self.n_docs, self.n_terms = n_docs, n_terms
        self.ids, self.lengths, self.sizes = [], [], []
        self.terms: list[bytes] = []
        self.tfs: list[int] = []

    def add(self, doc: pa.Scalar, words: list[bytes]) -> None:
        counts = Counter(words)
        self.ids.append(doc.as_py())
        self.lengths.append(len(words))
        self.sizes.append(len(counts))
        self.terms.extend(counts.keys())
        self.tfs.extend(counts.values())

    def row(self, shard: int, kind: pa.DataType) -> pa.RecordBatch:
        coded = pa.array(self.terms, pa.binary()).dictionary_encode()
        words, code = coded.dictionary, coded.indices.to_numpy().astype(np.int64)
        df = np.bincount(code, minlength=len(words))
        by_df = np.argsort(-df, kind="stable")
        row_of = np.empty(len(words), np.int64)
        row_of[by_df] = np.arange(len(words))
        rows, tf = row_of[code], np.array(self.tfs, np.int64)
        n, size = np.array(self.lengths, np.int64), np.array(self.sizes, np.int64)
        doc = np.repeat(np.arange(len(n)), size)
        # a document's strongest term: the most frequent one, of equals the one in most documents
        order = np.lexsort((rows, -tf, doc))
        strongest = rows[order[np.cumsum(size) - size]]
        by_likeness = np.lexsort((np.arange(len(n)), n, strongest))
        column_of = np.empty(len(n), np.int64)
        column_of[by_likeness] = np.arange(len(n))
        m = 50 + 50 * n * self.n_docs // self.n_terms
        impact = 1_000_000_000 * tf // (1000 * tf + 20 * m[doc])
        treap = Treap.build(rows, column_of[doc], impact)
        ids = [self.ids[k] for k in by_likeness]
        places = np.empty(len(n), np.int32)
        places[sorted(range(len(n)), key=lambda k: (ids[k] is None, ids[k]) if ids[k] is not None else (True,))] = np.arange(len(n), dtype=np.int32)
        arrays = {
            "shard": pa.array([shard], pa.int64()),
            "terms": pa.array([words.take(pa.array(by_df)).cast(pa.string())], pa.list_(pa.string())),
            "df": pa.array([df[by_df].astype(np.int32)], pa.list_(pa.int32())),
            "docs": pa.array([ids], pa.list_(kind)),
            "places": pa.array([places], pa.list_(pa.int32())),
            "height": pa.array([treap.height], pa.int32()),
            "step": pa.array([treap.step], pa.int64()),
            "masks": pa.array([treap.masks.tobytes()], pa.binary()),
            "bounds": pa.array([treap.bounds.tobytes()], pa.binary()),
            "impacts": pa.array([treap.values.astype("<u4").tobytes()], pa.binary()),
        }
        return pa.RecordBatch.from_arrays(list(arrays.values()), list(arrays))


def index(spark: SparkSession, docs: DataFrame) -> Index:
    """Index every row of ``docs`` (doc_id, text).

    Each task makes shards of the rows it reads, so nothing is shuffled and a shard is bounded by ``POSTINGS`` and one document
    more. Repeated rows are documents of their own; a row without a doc_id is ranked behind others of its score; a text without
    terms, or null, is in no shard. Other columns are not looked at. An empty table gives an index without shards.
    """
    n_docs, n_terms = totals(docs)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, made, kind_of = _Shard(n_docs, n_terms), TaskContext.get().partitionId() << 32, None
        for batch in batches:
            kind_of = batch.schema.field(0).type
            for doc, text in zip(batch.column(0), batch.column(1).to_pylist()):
                if words := _terms(text):
                    shard.add(doc, words)
                    if len(shard.terms) >= POSTINGS:
                        yield shard.row(made, kind_of)
                        shard, made = _Shard(n_docs, n_terms), made + 1
        if shard.ids:
            yield shard.row(made, kind_of)

    columns = (
        f"shard bigint, terms array<string>, df array<int>, docs array<{kind}>, places array<int>, height int, step bigint, "
        "masks binary, bounds binary, impacts binary"
    )
    return Index(stored(spark, few_at_once(docs).select("doc_id", "text").mapInArrow(run, columns), "lexical-index"), n_docs, n_terms)


def item_terms(text: Column) -> Column:
    """The terms of a text, once each."""
    return F.array_distinct(F.regexp_extract_all(F.translate(text, _UPPER, _LOWER), F.lit(TERM), F.lit(0)))


def search(spark: SparkSession, found: Index, items: DataFrame, most: int = MOST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``most`` best documents for every row of ``items`` (item_id, text), all of them if fewer.

    Equal scores go by ascending doc_id. An item without terms, or whose terms no document has, gives no row; a repeated item is
    answered for each row. Other columns are not looked at.

    Terms of items and of shards meet in a join, which gives the document frequencies and where the paths of an item begin; blocks of items
    then go to the shards that they have terms in. What returns is ``most`` rows an item and shard.
    """
    numbered = stored(spark, items.select("item_id", "text").withColumn("item", F.monotonically_increasing_id()), "items")
    blocks = -(-numbered.count() // ITEMS_PER_BLOCK)
    wanted = numbered.select("item", F.explode(item_terms(F.col("text"))).alias("term"))
    rows = found.shards.select("shard", F.posexplode(F.arrays_zip("terms", "df")).alias("row", "entry"))
    rows = rows.select("shard", "row", F.col("entry.terms").alias("term"), F.col("entry.df").alias("df"))
    met = stored(spark, rows.join(wanted.select("term").distinct(), "term"), "met-terms")
    ratio = (F.lit(2 * found.n_docs + 2).cast("double")) / (2 * F.sum("df") + 1).cast("double")
    weighed = met.groupBy("term").agg(F.floor(1000 * F.log(ratio)).cast("bigint").alias("weight"))
    paths = met.select("shard", "row", "term").join(weighed, "term").join(wanted, "term")
    block = F.pmod(F.xxhash64("item"), F.lit(max(1, blocks)))
    paths = paths.groupBy("shard", block.alias("block")).agg(F.collect_list(F.struct("item", "row", "weight")).alias("paths"))

    docs = found.shards.schema["docs"].dataType.elementType
    entering = found.shards.drop("terms", "df").join(paths, "shard")
    with rows_at_once(spark, 1):  # a row holds a whole shard
        best = stored(spark, _descended(entering, docs.simpleString(), most), "lexical-best")
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= most)
    return ranked.join(numbered.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _descended(entering: DataFrame, kind: str, most: int) -> DataFrame:
    """(item, doc_id, score): the best documents of each shard for the items whose paths enter it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = {name: batch.column(n) for n, name in enumerate(batch.schema.names)}
            for k in range(batch.num_rows):
                masks, bounds, impacts = (np.frombuffer(column[c][k].as_buffer(), t) for c, t in (("masks", "u1"), ("bounds", "u1"), ("impacts", "<u4")))
                treap = Treap(column["height"][k].as_py(), masks, bounds, impacts, column["step"][k].as_py())
                places = column["places"][k].values.to_numpy().astype(np.int64)
                smallest, docs = smallest_places(places, treap.height), column["docs"][k].values
                entered = column["paths"][k].values
                item, row, weight = (entered.field(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in ("item", "row", "weight"))
                order = np.lexsort((row, item))
                item, row, weight = item[order], row[order], weight[order]
                names, owner = np.unique(item, return_inverse=True)
                for first in range(0, len(names), ITEMS_AT_ONCE):
                    some = (owner >= first) & (owner < first + ITEMS_AT_ONCE)
                    query, place, score = best_columns(treap, owner[some], row[some], weight[some], smallest, most)
                    arrays = [pa.array(names[query]), docs.take(pa.array(place)), pa.array(score)]
                    yield pa.RecordBatch.from_arrays(arrays, ["item", "doc_id", "score"])

    return entering.mapInArrow(run, f"item bigint, doc_id {kind}, score bigint")
