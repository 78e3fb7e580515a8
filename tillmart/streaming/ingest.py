"""Stream of POS messages into Raw and Silver."""

from __future__ import annotations

import hashlib
import time
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tillmart import schemas
from tillmart.functions import safe_batch_id
from tillmart.operators.silver import to_items, to_transactions
from tillmart.sources.json_files import BATCH_KEY
from tillmart.sources.messages import MESSAGE, PROBLEMS, accepted, decode, rejected, strict
from tillmart.streaming.progress import IDLE_SECONDS, TALLY, TOTAL_SECONDS, Outcome, awaited, end_when

RUN, MICRO_BATCH = "run", "micro_batch"


@dataclass(frozen=True)
class Targets:
    """Folders the stream fills.

    Raw holds the accepted messages as they came, below their batch, where
    :func:`tillmart.sources.json_files.read_raw_batch` finds them. All are partitioned by run and micro-batch; a run is a
    checkpoint, so a stream that starts anew with another one adds and overwrites nothing.
    """

    raw: str
    transactions: str
    items: str
    rejected: str

    @classmethod
    def below(cls, root: str) -> Targets:
        return cls(f"{root}/raw", f"{root}/transactions", f"{root}/items", f"{root}/rejected")


def ingest(messages: DataFrame, targets: Targets, checkpoint: str, value: str = "value", poll: str | None = None) -> StreamingQuery:
    """Start a query that takes what is available, then stops; with an interval ``poll``, it goes on looking for more.

    A micro-batch that is run again after a failure overwrites its own partition, so each event lands once.
    Events that cannot be loaded are kept apart; :func:`tillmart.sources.messages.strict` is the failing
    alternative.
    """

    run = hashlib.sha256(checkpoint.encode()).hexdigest()[:12]

    def write(batch: DataFrame, number: int) -> None:
        decoded = decode(batch, value=value).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            events = accepted(decoded)
            _write(_raw(decoded), targets.raw, run, number, BATCH_KEY)
            _write(to_transactions(events), targets.transactions, run, number)
            _write(to_items(events), targets.items, run, number)
            _write(rejected(decoded), targets.rejected, run, number)
        finally:
            decoded.unpersist()

    timing = {"processingTime": poll} if poll else {"availableNow": True}
    return messages.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**timing).start()


def ingest_batch(
    messages: DataFrame,
    targets: Targets,
    checkpoint: str,
    batch_id: str,
    announced: int,
    idle: float = IDLE_SECONDS,
    total: float = TOTAL_SECONDS,
    value: str = "value",
) -> Outcome:
    """Read until all announced events of a batch were ingested, or none came for ``idle`` seconds, or ``total`` are over.

    Events of other batches that come along are ingested as well, as their messages are used up. Whether the batch is
    complete is for the caller to decide, from the outcome or from what is stored.
    """
    begun = time.monotonic()
    TALLY.listen(messages.sparkSession)
    wanted = F.get_json_object(F.col(value).cast("string"), "$.batch_id") == F.lit(batch_id)
    query = ingest(awaited(messages, wanted), targets, checkpoint, value, poll="0 seconds")
    return end_when(query, announced, idle, total, begun)


def _raw(decoded: DataFrame) -> DataFrame:
    """The accepted messages, each on one line: line breaks can only stand between the tokens of a document."""
    fine = decoded.where(F.size(PROBLEMS) == 0)
    return fine.select(safe_batch_id(F.col("batch_id")).alias(BATCH_KEY), F.regexp_replace(MESSAGE, r"[\r\n]+", " ").alias("value"))


def _write(frame: DataFrame, path: str, run: str, number: int, *above: str) -> None:
    (
        frame.withColumns({RUN: F.lit(run), MICRO_BATCH: F.lit(number)})
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*above, RUN, MICRO_BATCH)
        .format("text" if above else "parquet")
        .save(path)
    )


def read_transactions(spark: SparkSession, targets: Targets) -> DataFrame:
    return _read(spark, targets.transactions, schemas.TRANSACTIONS)


def read_items(spark: SparkSession, targets: Targets) -> DataFrame:
    return _read(spark, targets.items, schemas.ITEMS)


def read_raw(spark: SparkSession, targets: Targets) -> DataFrame:
    return strict(decode(spark.read.text(targets.raw)))


def _read(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*schema.fieldNames())
