"""Secrets in a history of texts, found with DataFrame functions only.

Every version of every path is addressed by the SHA-256 of its content (its blob). The ledger is a table with one row for
each blob and rule version that was scanned, with the spans found in it, empty or not. A scan looks only at pairs which the
ledger lacks; findings are then joined back to all paths, and all versions of a path, that hold the blob. The rule version is derived
from the rules themselves, so changed rules are a new version. Two scans at once may both add a blob; it counts once.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from dataclasses import astuple, dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from tillmart.llm.common import stored
from tillmart.session import scratch_path


@dataclass(frozen=True)
class Rule:
    """Leftmost, non-overlapping matches of ``pattern`` whose group has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int
    least: int
    hint: str  # matches somewhere in each text in which the pattern has a long enough match


# Kinds, patterns and least lengths.
RULES = (
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        2,
        6,
        r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]""",
    ),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, r"AKIA[A-Z0-9]{16}"),
    # The pattern is greedy, so only runs of 24 or more can be long enough.
    Rule("hex", r"[0-9a-f]{24,}", 0, 24, r"[0-9a-f]{24}"),
)
VERSION = "1"

SPAN = "struct<start:bigint,`end`:bigint,rank:int,kind:string>"
LEDGER = f"blob string, rule_version string, spans array<{SPAN}>"


def rule_version(rules: Sequence[Rule] = RULES, version: str = VERSION) -> str:
    """The version that the ledger holds for these rules: the given one, and a digest of every rule."""
    digest = hashlib.sha256(repr([astuple(rule) for rule in rules]).encode()).hexdigest()
    return f"{version}-{digest[:16]}"


def blobs(versions: DataFrame, path: str = "path", keys: Sequence[str] = ()) -> DataFrame:
    """(path, keys, text, blob) of versions with the columns ``path`` and ``text``; a null text counts as empty.

    ``keys`` tell the versions of a path apart, such as a commit or a time.
    """
    text = F.coalesce("text", F.lit(""))
    return versions.select(F.col(path).alias("path"), *keys, text.alias("text"), F.sha2(text, 256).alias("blob"))


def scan(versions: DataFrame, ledger: DataFrame | None, path: str = "path", rules=RULES, version: str = VERSION) -> DataFrame:
    """The ledger rows to add for ``versions``: blobs that ``ledger`` has not seen under this rule version."""
    held = blobs(versions, path).select("blob", "text")
    if ledger is not None:
        seen = ledger.where(F.col("rule_version") == rule_version(rules, version)).select("blob").distinct()
        held = held.join(seen, "blob", "left_anti")
    unseen = held.groupBy("blob").agg(F.first("text").alias("text"))
    hint = "|".join(rule.hint for rule in rules)
    pieces = F.array(*[_pieces(rule, n) for n, rule in enumerate(rules)])
    rows = unseen.select("blob", F.explode_outer(F.when(F.col("text").rlike(hint), pieces)).alias("of"))
    rows = rows.select("blob", "of.rank", F.posexplode_outer("of.pieces").alias("n", "piece"))
    before = Window.partitionBy("blob", "rank").orderBy("n")
    sums = F.sum(F.length("piece.gap").cast("bigint") + F.length("piece.hit")).over(before)
    size = F.length("piece.hit")
    placed = rows.select("blob", "rank", (sums - size).alias("start"), sums.alias("end"), F.length("piece.secret").alias("long"))
    kind, least = F.element_at(_listed([r.kind for r in rules]), F.col("rank") + 1), _listed([r.least for r in rules])
    found = F.when(
        F.col("long") >= F.element_at(least, F.col("rank") + 1), F.struct("start", "end", "rank", kind.alias("kind"))
    )
    spans = F.array_sort(F.collect_list(found))
    return placed.groupBy("blob").agg(spans.alias("spans")).select(
        "blob", F.lit(rule_version(rules, version)).alias("rule_version"), F.col("spans").cast(f"array<{SPAN}>").alias("spans")
    )


def _listed(values: list) -> Column:
    return F.array(*[F.lit(v) for v in values])


def _pieces(rule: Rule, rank: int) -> Column:
    """The text cut at the rule's matches: what stands before each match, the match, and the part that must be long."""
    pattern = F.lit(rule.pattern)
    gaps = F.split("text", rule.pattern, -1)
    hits = F.regexp_extract_all("text", pattern, F.lit(0))
    secrets = F.regexp_extract_all("text", pattern, F.lit(rule.group)) if rule.group else hits
    zipped = F.arrays_zip(gaps.alias("gap"), hits.alias("hit"), secrets.alias("secret"))
    return F.struct(F.lit(rank).alias("rank"), F.filter(zipped, lambda z: z["hit"].isNotNull()).alias("pieces"))


def join_back(
    versions: DataFrame, ledger: DataFrame, path: str = "path", rules=RULES, version: str = VERSION, keys: Sequence[str] = ()
) -> DataFrame:
    """(path, keys, blob, spans) for every row of ``versions``; spans is null where the ledger lacks the blob under these rules.

    The findings, each blob once, are written to the shared folder first.
    """
    held = blobs(versions, path, keys).select("path", *keys, "blob")
    own = ledger.where(F.col("rule_version") == rule_version(rules, version))
    # written, as the adaptive join can split a blob of very many paths only if no grouping shares its shuffle
    findings = stored(ledger.sparkSession, own.groupBy("blob").agg(F.first("spans").alias("spans")), "findings")
    return held.join(findings, "blob", "left").select("path", *keys, "blob", "spans")


class Ledger:
    """The ledger as Parquet under a shared folder, one folder for each scan.

    Blob and spans are in one row, so a scan that fails leaves neither. A repeated scan adds nothing. Of scans at the same time each adds
    what it found unseen, so rows may be repeated; they are equal, and :func:`scan` and :func:`join_back` take them once.
    """

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark, self.root = spark, (root or scratch_path(spark, "blob-ledger")).rstrip("/")

    def read(self) -> DataFrame | None:
        try:
            return self.spark.read.schema(LEDGER).parquet(f"{self.root}/scan-*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return None

    def update(self, versions: DataFrame, path: str = "path", rules=RULES, version: str = VERSION) -> DataFrame:
        """Scan what is new in ``versions`` and return the whole ledger."""
        rows = scan(versions, self.read(), path, rules, version)
        rows.write.parquet(f"{self.root}/scan-{uuid.uuid4().hex}")
        return self.read()


def find(spark: SparkSession, docs: DataFrame, root: str | None = None, rules=RULES, version: str = VERSION) -> DataFrame:
    """(doc_id, blob, spans) per row of ``docs`` (doc_id, text), scanning only blobs that the ledger at ``root`` lacks.

    spans: start and end in code points (end exclusive), rank and kind of the rule, by start and then rank. A null text is an
    empty one and has no spans; repeated rows share a blob and each get its spans; a null doc_id is carried along; other
    columns are not looked at. An empty table gives an empty table.
    """
    ledger = Ledger(spark, root).update(docs, "doc_id", rules, version)
    return join_back(docs, ledger, "doc_id", rules, version).withColumnRenamed("path", "doc_id")
