"""Approximate nearest neighbours by a permutation index.

Each vector is represented by its nearest pivots in order. A block of the index posts its vectors in one inverted file for each
pivot, with the place that the pivot has in the vector's order. A query walks the files of its own pivots and sums the footrule
distance: the differences of places, where a pivot that a vector lacks stands behind its last one. The vectors with the
smallest distances are reranked by the measure itself.

The index is cut into blocks by a hash of the id, and each of its vectors goes to one task. Queries are streamed through the blocks
in batches, and the best of the blocks are merged for each query. A task holds one block and one batch of queries, however large the tables are.

What a query costs grows more slowly than the index of N vectors: pivots grow with the square root of N, so the files
that a query walks have about 1,400 sqrt(N) postings in all; blocks grow likewise, so a query is sent to about sqrt(N)/18 of them;
and 8 N^0.55 vectors are reranked for it, 4 times as many for 10 times the rows. Blocks are random parts of the index, so each one reranks its share
of these, and a standard deviation more.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tillmart.llm.common import smallest_hashes, stored

ORDER = 64  # pivots kept for each vector
LEAST = 500  # vectors that are reranked at least, in the whole index
LARGEST_BLOCK = 131_072  # vectors in a block of the index, whose size stops growing at 53 million vectors
PIVOT_SAMPLE = 4_096  # vectors that the pivots are drawn from: those with the smallest hash


def pivots_for(size: int) -> int:
    return max(64, round(3 * size**0.5))


def block_for(size: int) -> int:
    """Vectors in a block, on average."""
    return min(LARGEST_BLOCK, max(2_048, round(18 * size**0.5)))


def reranked_for(size: int) -> int:
    """Vectors that are reranked for a query, but for what chance adds in each block."""
    return max(LEAST, round(8 * size**0.55))


@dataclass(frozen=True)
class Pivots:
    vectors: np.ndarray

    def orders(self, vectors: np.ndarray, order: int = ORDER) -> np.ndarray:
        """The numbers of the nearest pivots of each vector, nearest first; equally near ones by number."""
        near = vectors @ self.vectors.T
        return np.argsort(-near, axis=1, kind="stable")[:, : min(order, len(self.vectors))]


class BlockIndex:
    """Inverted files of one block, which reranks its share of ``reranked`` of all vectors. Rows are in ascending order of id."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, pivots: Pivots, reranked: int, size: int):
        self.ids, self.vectors = ids, vectors
        share = reranked * len(ids) / size
        self.most = int(np.ceil(share + share**0.5)) if len(ids) < size else reranked
        orders = pivots.orders(vectors)
        self.order = orders.shape[1]
        pivot, row = orders.ravel(), np.repeat(np.arange(len(ids)), self.order)
        place = np.tile(np.arange(self.order), len(ids))
        by_pivot = np.argsort(pivot, kind="stable")
        self.first = np.searchsorted(pivot[by_pivot], np.arange(len(pivots.vectors) + 1))
        self.rows, self.weights = row[by_pivot], (self.order - place[by_pivot]).astype(np.float64)

    def footrule(self, order: np.ndarray) -> np.ndarray:
        """The footrule distance of each row to a query's order, without what is the same for all rows.

        With m places, a pivot at place a of one order and b of the other adds |a - b|; were it missing from both it would add
        (m - a) + (m - b). The difference is twice the smaller of m - a and m - b, so a walk over the postings adds up these.
        """
        files = [slice(self.first[pivot], self.first[pivot + 1]) for pivot in order.tolist()]
        rows = np.concatenate([self.rows[file] for file in files])
        own = np.repeat(self.order - np.arange(len(order), dtype=np.float64), [file.stop - file.start for file in files])
        near = np.minimum(np.concatenate([self.weights[file] for file in files]), own)
        return -2 * np.bincount(rows, near, len(self.ids)).astype(np.int64)

    def search(self, query: int, vector: np.ndarray, order: np.ndarray, k: int) -> list[tuple[int, float]]:
        """The k best rows but for the query's own, by inner product and then by id."""
        most = self.most
        if most < len(self.ids):
            rank = self.footrule(order) * len(self.ids) + np.arange(len(self.ids))
            rows = np.argpartition(rank, most)[:most]
        else:
            rows = np.arange(len(self.ids))
        rows = rows[self.ids[rows] != query]
        if not len(rows):
            return []
        score = self.vectors[rows] @ vector
        if len(rows) > k:
            rows = rows[score >= np.partition(score, -k)[-k] - 1e-9 * max(1.0, float(np.abs(score).max()))]
        score = (self.vectors[rows] * vector).sum(axis=1)  # row by row, so equal vectors have equal scores
        best = np.lexsort((self.ids[rows], -score))[:k]
        return list(zip(self.ids[rows[best]].tolist(), score[best].tolist()))


def usable(vector: Column) -> Column:
    """Whether a vector has components, all of them finite, and not all zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(True)) & F.exists(vector, lambda x: x != 0)


def nearest(
    spark: SparkSession,
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    pivots: int | None = None,
    sample: int = PIVOT_SAMPLE,
    block: int | None = None,
    reranked: int | None = None,
) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row of ``queries`` the k nearest rows of ``vectors`` found, both (vec_id, embedding).

    Nearness is the inner product in double precision; equal ones go to the smaller vec_id; a row with the query's own vec_id is
    no candidate. Rows whose vec_id is null, or whose vector is null, empty, zero or has components that are null or not finite, take no
    part; nor do vectors of another length than the most frequent one of the sample that the pivots are drawn from. Of repeated
    vec_ids the smallest vector takes part, compared component by component. Other columns are not looked at. An empty table on either side gives an empty result.

    ``pivots``, ``block`` and ``reranked`` follow from the number of vectors where they are not given. At most ``sample`` pivots are there.
    """
    def clean(frame: DataFrame) -> DataFrame:
        rows = frame.where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
        vector = F.col("embedding").cast("array<double>")
        rows = rows.select(F.col("vec_id").cast("bigint").alias("vec_id"), vector.alias("embedding"))
        # one row for each length, as only one length takes part
        once = rows.groupBy("vec_id", F.size("embedding")).agg(F.min("embedding").alias("embedding"))
        return once.select("vec_id", "embedding")

    index, asked = stored(spark, clean(vectors), "vectors"), stored(spark, clean(queries), "queries")
    size = index.count()
    drawn = smallest_hashes(index, ["vec_id"], sample, size).toPandas()
    columns = "query_id bigint, vec_id bigint, score double"
    if not size:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    lengths = drawn["embedding"].map(len)
    width = int(lengths.mode().min())
    rows = np.array(drawn["embedding"][lengths == width].tolist(), np.float64)
    unique = np.unique(rows, axis=0)  # copies of one vector would be one pivot
    chosen = np.random.default_rng(11).permutation(len(unique))[: pivots or pivots_for(size)]
    shipped = spark.sparkContext.broadcast(Pivots(unique[chosen] / np.linalg.norm(unique[chosen], axis=1)[:, None]))

    blocks = -(-size // (block or block_for(size)))
    most = reranked or reranked_for(size)

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come by block, those of the index before the queries."""
        number, ids, rows, known = None, [], [], None
        for batch in batches:
            for here, part in batch.groupby("block", sort=False):
                if here != number:
                    number, ids, rows, known = here, [], [], None
                matrix, asked, named = np.array(part["embedding"].tolist(), np.float64), part["asked"].to_numpy(), part["vec_id"].to_numpy()
                if not asked.all():
                    ids.append(named[~asked])
                    rows.append(matrix[~asked])
                if not asked.any() or not ids:
                    continue
                if known is None:
                    known = BlockIndex(np.concatenate(ids), np.concatenate(rows), shipped.value, most, size)
                    rows = []
                found = []
                for query, vector, own in zip(named[asked].tolist(), matrix[asked], shipped.value.orders(matrix[asked])):
                    found += [(query, vec, score) for vec, score in known.search(query, vector, own, k)]
                frame = pd.DataFrame(found, columns=["query_id", "vec_id", "score"])
                yield frame.astype({"query_id": "int64", "vec_id": "int64", "score": "float64"})

    same = F.size("embedding") == width
    posted = index.where(same).select(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)).cast("int").alias("block"), F.lit(False).alias("asked"), "vec_id", "embedding")
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
    sent = asked.where(same).select(everywhere, F.lit(True).alias("asked"), "vec_id", "embedding")
    dealt = posted.unionByName(sent).repartitionById(blocks, F.col("block"))
    best = dealt.sortWithinPartitions("block", "asked", "vec_id").mapInPandas(search, columns)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
