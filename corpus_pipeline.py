"""A pipeline that prepares the documents of a corpus for training, one operator for each stage.

Each stage takes (spark, docs, sf_dir), where docs is what the stage before it kept, and returns a DataFrame; the runner writes
it as Parquet and reads it again for the next. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import bpe, decontamination, line_dedup, quality, simhash
from tillmart.llm.common import stored
from tillmart.llm.queries import WORD_VOCABULARY

# Nothing in SQL stands for a trained classifier or a tokenizer.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject; it learns from the labels of the documents given."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.good(spark, docs, quality.train(spark, docs, labels))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that another one keeps; n_chars follows the text. A text that loses no line, or is null, stays as it is."""
    others = [name for name in docs.columns if name not in ("doc_id", "text")]
    plain = docs.select("doc_id", "text", *[F.col(f"`{name}`").alias(f"c{n}") for n, name in enumerate(others)])
    found = line_dedup.dedup_lines(spark, plain)
    changed = F.col("_n_dropped") > 0
    columns = {"doc_id": F.col("doc_id"), "text": F.when(changed, F.col("_kept")).otherwise(F.col("text"))}
    columns |= {name: F.col(f"c{n}") for n, name in enumerate(others)}
    if "n_chars" in columns:
        columns["n_chars"] = F.when(changed, F.length("_kept").cast("bigint")).otherwise(columns["n_chars"])
    return found.select(*[columns[name].alias(name) for name in docs.columns])


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash.keep_one(spark, docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of the benchmark."""
    return decontamination.clean(spark, docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, decoded_sha256) of each document."""
    found = bpe.encoded(docs, public_tokenizers.path(WORD_VOCABULARY))
    data = F.sha2(F.encode("decoded", "UTF-8"), 256)
    return found.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), "ids", data.alias("decoded_sha256"))


STAGES = [
    ("quality", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", simhash_stage),
    ("benchmark decontamination", benchmark_stage),
    ("bpe encoding", bpe_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stored(spark, stage(spark, docs, sf_dir), f"corpus-stage-{number}")
    return docs
