"""Lines that repeat across documents, dropped everywhere but in one document; DataFrame functions only.

The store is a set of levelled runs in the shared folder. A run has one row for each line hash: the documents that hold it and the
largest doc_id among them. It is a Parquet table in buckets of line hashes, one sorted file a bucket, and all runs of a store
have the same buckets. Each batch of documents adds a run of its own at level 0; as soon as a level has ``FANOUT`` runs they are merged,
two and two by full merge joins, into one run of the next level, so a store of n batches has about log n runs and each row is rewritten that often.

A new batch is merge-joined with the runs: its own run, one row a hash, is read along with the older ones in their common order,
which moves and sorts nothing. The few hashes that prove to be frequent are then anti-joined with the lines of the batch: a line
stays unless a run says that it is frequent and that another document keeps it.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillmart.llm.common import stored
from tillmart.session import scratch_path

LEAST_LENGTH = 40  # code points of a line's key
LEAST_DOCUMENTS = 5
FANOUT = 4
BATCHES = 4

_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def key(line: Column) -> Column:
    """The line without white space at both ends, A-Z lower-cased."""
    return F.translate(F.trim(line, F.lit(_SPACE)), _UPPER, _LOWER)


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_hashes(docs: DataFrame) -> DataFrame:
    """(doc_id, body, pos, h1, h2) of each line whose key is long enough; body is a hash of the document's text.

    Two 64-bit hashes stand for a key: equal pairs of different keys are not to be expected at any real size.
    """
    text = F.coalesce("text", F.lit(""))
    lines = docs.select("doc_id", F.xxhash64(text).alias("body"), F.posexplode(_lines(F.col("text"))).alias("pos", "line"))
    keyed = lines.select("doc_id", "body", "pos", key(F.col("line")).alias("key"))
    long = keyed.where(F.length("key") >= LEAST_LENGTH)
    second = F.xxhash64(F.lit("second"), "key")
    return long.select("doc_id", "body", "pos", F.xxhash64("key").alias("h1"), second.alias("h2"))


@contextmanager
def _sorted_files(spark: SparkSession) -> Iterator[None]:
    """Jobs planned inside read bucketed tables by bucket, and count on the order of a bucket that has one file."""
    wanted = {
        "spark.sql.legacy.bucketedTableScan.outputOrdering": "true",
        "spark.sql.sources.bucketing.autoBucketedScan.enabled": "false",
    }
    before = {name: spark.conf.get(name) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


class LineRuns:
    """The levelled runs below a folder, which a later session finds again when it is given the same folder.

    The list of runs is written anew with each batch, under the next number and after the runs themselves; the highest number
    counts. A batch that fails half-way leaves the list as it was. Of two sessions that add at once, the second is refused with a
    ``RuntimeError`` and changes nothing; it opens the store again and repeats its batch. A driver lost in the middle of a batch
    leaves its claim behind, which the error names.

    A new store has as many buckets as the session has shuffle partitions, and keeps them. Runs are known to the session's catalog
    as external tables named ``line_run_<id>``.
    """

    def __init__(self, spark: SparkSession, root: str | None = None, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.root = (root or scratch_path(spark, "line-runs")).rstrip("/")
        self.number, self.levels, self.keeper_type = 0, [[]], "bigint"
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        try:
            lists = spark.read.schema(_LISTS).parquet(f"{self.root}/list")
        except AnalysisException:
            return
        last = lists.agg(F.max("number")).first()[0]
        if last is not None:
            rows = lists.where(F.col("number") == last).collect()  # as many as there are runs
            self.number, self.buckets, self.keeper_type = last, rows[0]["buckets"], rows[0]["keeper_type"]
            self.levels = [[r["path"] for r in rows if r["level"] == n] for n in range(1 + max(r["level"] for r in rows))]

    def add(self, lines: DataFrame) -> str:
        """Add the run of a batch of new documents (rows of ``line_hashes``) and return its path."""
        number = self.number + 1
        claim = self._claim(number)
        try:
            if not self.number:
                self.keeper_type = lines.schema["doc_id"].dataType.simpleString()
            of_doc = lines.select("doc_id", "h1", "h2").distinct()
            run = of_doc.groupBy("h1", "h2").agg(F.count("*").alias("documents"), F.max("doc_id").alias("keeper"))
            levels = [list(level) for level in self.levels]
            level = 0
            # a grouping deals its rows in the same way, if it has as many partitions
            own = self._write(run, 0, self.buckets == int(self.spark.conf.get("spark.sql.shuffle.partitions")))
            levels[0].append(own)
            while len(levels[level]) >= self.fanout:
                merged = self._merge(levels[level], level + 1)
                levels[level] = []
                level += 1
                levels += [[]] * (level == len(levels))
                levels[level].append(merged)
            rows = [(number, n, path, self.buckets, self.keeper_type) for n, paths in enumerate(levels) for path in paths]
            self.spark.createDataFrame(rows, _LISTS).coalesce(1).write.mode("append").parquet(f"{self.root}/list")
        except BaseException:
            claim.getFileSystem(self._hadoop()).delete(claim, False)
            raise
        self.number, self.levels = number, levels
        return own

    def _hadoop(self):
        return self.spark._jsparkSession.sessionState().newHadoopConf()

    def _claim(self, number: int):
        """An empty file that only one session can make."""
        claim = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/claims/{number}")
        if not claim.getFileSystem(self._hadoop()).createNewFile(claim):
            raise RuntimeError(f"Another session adds, or added, batch {number} to this store: {claim.toString()} is there.")
        return claim

    def _write(self, run: DataFrame, level: int, dealt: bool) -> str:
        """Write a run, which may be dealt into the buckets already, and return its path."""
        name = uuid.uuid4().hex
        path = f"{self.root}/level-{level}/run-{name}"
        if not dealt:
            run = run.repartition(self.buckets, "h1", "h2")
        with _sorted_files(self.spark):
            columns = {"h1": "bigint", "h2": "bigint", "documents": "bigint", "keeper": self.keeper_type}
            typed = run.select(*[F.col(c).cast(t).alias(c) for c, t in columns.items()])
            writer = typed.write.format("parquet").bucketBy(self.buckets, "h1", "h2").sortBy("h1", "h2")
            writer.option("path", path).saveAsTable(f"line_run_{name}")
        return path

    def _read(self, path: str) -> DataFrame:
        name = f"line_run_{path.rsplit('-', 1)[1]}"
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} (h1 BIGINT, h2 BIGINT, documents BIGINT, keeper {self.keeper_type}) USING parquet "
            f"CLUSTERED BY (h1, h2) SORTED BY (h1, h2) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )
        return self.spark.table(name)

    def _pair(self, one: str, two: str) -> DataFrame:
        """One row for each hash of two runs: a full merge join in the order of the files."""
        other = self._read(two).select("h1", "h2", F.col("documents").alias("more"), F.col("keeper").alias("other"))
        joined = self._read(one).join(other.hint("merge"), ["h1", "h2"], "full")
        documents = F.coalesce("documents", F.lit(0)) + F.coalesce("more", F.lit(0))
        return joined.select("h1", "h2", documents.alias("documents"), F.greatest("keeper", "other").alias("keeper"))

    def _merge(self, paths: list[str], level: int) -> str:
        """The path of one run with the rows of all these."""
        while len(paths) > 1:
            pairs = [paths[n : n + 2] for n in range(0, len(paths), 2)]
            paths = [self._write(self._pair(*pair), level, dealt=True) if len(pair) == 2 else pair[0] for pair in pairs]
        return paths[0]

    def read(self) -> DataFrame | None:
        """(h1, h2, documents, keeper) over all runs."""
        runs = [path for level in reversed(self.levels) for path in level]
        return self._read(self._merge(runs, 0)) if runs else None

    def standing(self, own: str, others: list[str]) -> DataFrame:
        """(h1, h2, documents, keeper) of the hashes of one run, over it and the others: merge joins in the order of the files."""
        known = self._read(own)
        for path in others:
            older = self._read(path).select("h1", "h2", F.col("documents").alias("more"), F.col("keeper").alias("other"))
            joined = known.join(older.hint("merge"), ["h1", "h2"], "left")
            documents = (F.col("documents") + F.coalesce("more", F.lit(0))).alias("documents")
            known = joined.select("h1", "h2", documents, F.greatest("keeper", "other").alias("keeper"))
        return known

    def dedup(self, docs: DataFrame) -> DataFrame:
        """A new batch of documents without the lines that, by the runs and its own one, another document keeps.

        Columns as :func:`dedup_lines` returns them. Documents of earlier batches are not looked at again: a line they
        gave out before it was frequent, or before a larger doc_id came, stays in them.
        """
        lines = stored(self.spark, line_hashes(docs), "line-hashes")
        older = [path for level in self.levels for path in level]
        own = self.add(lines)
        return apply_positions(docs, surviving_positions(self.spark, lines, self.standing(own, older)))


_LISTS = "number bigint, level int, path string, buckets int, keeper_type string"


def surviving_positions(spark: SparkSession, lines: DataFrame, runs: DataFrame, least: int = LEAST_DOCUMENTS) -> DataFrame:
    """(doc_id, body, positions): the positions in ascending order of the long lines that a document keeps."""
    with _sorted_files(spark):
        frequent = stored(spark, runs.where(F.col("documents") >= least).select("h1", "h2", "keeper"), "frequent-lines")
    mine, run = lines.alias("mine"), frequent.alias("run")
    elsewhere = (
        (F.col("mine.h1") == F.col("run.h1"))
        & (F.col("mine.h2") == F.col("run.h2"))
        & ~F.col("mine.doc_id").eqNullSafe(F.col("run.keeper"))
    )
    stay = mine.join(run, elsewhere, "left_anti")
    # a set, as repeated rows of a document give each position several times
    return stay.groupBy("doc_id", "body").agg(F.array_sort(F.collect_set("pos")).alias("positions"))


def _unused(name: str, frame: DataFrame) -> str:
    taken = {column.lower() for column in frame.columns}
    while name in taken:
        name += "_"
    return name


def apply_positions(docs: DataFrame, positions: DataFrame) -> DataFrame:
    """``docs`` (doc_id, text, ...) with the columns _kept (text of the lines that stay), _n_lines and _n_dropped.

    Columns of ``docs`` with one of these names are replaced.
    """
    docs = docs.drop("_kept", "_n_lines", "_n_dropped")
    stay, remaining = _unused("_stay", docs), _unused("_lines", docs)
    one, two = docs.alias("one"), positions.alias("two")
    text = F.coalesce("one.text", F.lit(""))
    same = F.col("one.doc_id").eqNullSafe(F.col("two.doc_id")) & (F.xxhash64(text) == F.col("two.body"))
    joined = one.join(two, same, "left").select("one.*", F.coalesce("two.positions", F.array().cast("array<int>")).alias(stay))
    position = F.col(stay)
    shifted = F.concat(F.array(F.lit(-1)), position)  # one longer: the last gap is null and falls away
    gaps = F.zip_with(position, shifted, lambda p, q: F.when(p.isNotNull(), F.concat(F.array_repeat(F.lit(False), p - q - 1), F.array(F.lit(True)))))
    flags = F.flatten(F.filter(gaps, lambda g: g.isNotNull()))
    # Zipping evaluates the lines and the flags once each; it pads the flags with null, which means: does not survive.
    zipped = F.arrays_zip(_lines(F.col("text")).alias("line"), flags.alias("stays"))
    short = lambda line: F.length(F.trim(line, F.lit(_SPACE))) < LEAST_LENGTH
    kept = F.filter(zipped, lambda z: F.coalesce(z["stays"], F.lit(False)) | short(z["line"]))
    columns = [F.col(f"`{name}`") for name in docs.columns]
    result = joined.select(*columns, F.size(_lines(F.col("text"))).cast("bigint").alias("_n_lines"), kept.alias(remaining))
    return result.select(
        *columns,
        F.array_join(F.transform(remaining, lambda z: z["line"]), "\n").alias("_kept"),
        "_n_lines",
        (F.col("_n_lines") - F.size(remaining)).alias("_n_dropped"),
    )


def dedup_lines(spark: SparkSession, docs: DataFrame, batches: int = BATCHES) -> DataFrame:
    """The columns of ``docs`` plus _kept, _n_lines and _n_dropped, for every row.

    Lines whose key has at least 40 code points and is found in at least 5 documents (different doc_id) stay only in the document
    with the largest doc_id, all of them there; others lose all their lines with this key. The lines that stay are joined by \\n.
    A null or empty text is one empty line. A repeated row is the same document, and each copy loses the same lines.
    Rows without a doc_id count together as one document, smaller than any other. Columns of ``docs`` named
    _kept, _n_lines or _n_dropped are replaced, all others stay. An empty table gives an empty table.

    The rule looks at all documents, so no line can be decided before the last batch has added its run; :meth:`LineRuns.dedup` decides
    batches as they come.
    """
    number = F.pmod(F.xxhash64("doc_id"), F.lit(batches)).cast("int")
    path = scratch_path(spark, "line-hashes")
    hashed = line_hashes(docs).withColumn("batch", number)
    hashed.write.partitionBy("batch").parquet(path)
    lines = spark.read.schema(hashed.schema).parquet(path)
    runs = LineRuns(spark)
    for batch in range(batches):
        runs.add(lines.where(F.col("batch") == batch))
    return apply_positions(docs, surviving_positions(spark, lines.drop("batch"), runs.read()))
