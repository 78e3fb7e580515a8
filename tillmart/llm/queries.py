"""The operators of this subpackage as queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillmart.llm import (
    bpe,
    decontamination,
    lexical_search,
    licenses,
    line_dedup,
    permutation_index,
    quality,
    quartile_digest,
    secret_scan,
    simhash,
    token_alignment,
    token_counts,
    url_filter,
)

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"
PIECE_VOCABULARY = "piece_bpe_32k.model"

# The rules for URLs.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents."""
    return simhash.near_duplicates(spark, _table(spark, sf_dir, "documents"))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents, scanned into a new ledger."""
    found = secret_scan.find(spark, _table(spark, sf_dir, "documents"))
    text = F.array_join(F.transform("spans", lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    kinds = [count(rule.kind) for rule in secret_scan.RULES]
    # the ledger adds no spans of its own, so all spans are base spans
    return found.select("doc_id", *kinds, F.sha2(text, 256).alias("base_sha256"), text.alias("spans"))


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded."""
    return bpe.digests(_table(spark, sf_dir, "documents"), public_tokenizers.path(WORD_VOCABULARY))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score for all documents."""
    docs = _table(spark, sf_dir, "documents")
    return quality.scored(spark, docs, quality.train(spark, docs, _table(spark, sf_dir, "labels")))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict for the URL of every page."""
    return url_filter.judged(spark, _table(spark, sf_dir, "pages"), URL_RULES)


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents."""
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_VOCABULARY))


def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of all vectors for every twentieth one."""
    vectors = _table(spark, sf_dir, "embeddings")
    return permutation_index.nearest(spark, vectors, vectors.where("vec_id % 20 = 0"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without lines that another one keeps."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = line_dedup.dedup_lines(spark, docs)
    kept = F.sha2("_kept", 256).alias("kept_sha256")
    return found.select("doc_id", F.col("_n_lines").alias("n_lines"), F.col("_n_dropped").alias("n_dropped"), kept)


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in all documents."""
    docs = _table(spark, sf_dir, "documents")
    found = licenses.scanned(spark, docs, licenses.train(spark, docs))
    return found.select("doc_id", "families", F.size("notices").cast("bigint").alias("n_notices"), "notices")


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontamination.contaminated(spark, docs, benchmark)
    held = F.size("item_ids").cast("bigint")
    return found.select("doc_id", (held > 0).alias("contaminated"), held.alias("n_items"), "item_ids", "edits")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents, beside those of their edited texts and of the next documents."""
    return quartile_digest.neighbours(spark, _table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best of all documents for each item of the benchmark."""
    found = lexical_search.index(spark, _table(spark, sf_dir, "documents"))
    return lexical_search.search(spark, found, _table(spark, sf_dir, "benchmark"))


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of two tokenizers over all documents, aligned."""
    paths = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY)
    return token_alignment.aligned(spark, _table(spark, sf_dir, "documents"), *paths)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_secrets": op2_secrets,
    "op3_bpe": op3_bpe,
    "op4_quality": op4_quality,
    "op5_urls": op5_urls,
    "op6_token_counts": op6_token_counts,
    "op7_nearest": op7_nearest,
    "op8_line_dedup": op8_line_dedup,
    "op9_licenses": op9_licenses,
    "op10_decontamination": op10_decontamination,
    "op11_fingerprints": op11_fingerprints,
    "op12_lexical_search": op12_lexical_search,
    "op13_alignment": op13_alignment,
}
