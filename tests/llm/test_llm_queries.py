"""The registered queries against SQL, and the pipeline stage by stage."""

import re

import duckdb
import pytest

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from tillmart.llm import decontamination, line_dedup, quality, simhash
from tillmart.llm.oracle import SQL

FOLDER = "/root/testdata/sf0.01"


def test_registered():
    names = [n for n in queries() if n.startswith("op")]
    assert [int(re.match(r"op(\d+)_", n)[1]) for n in names] == list(range(1, 14))
    assert "pipeline" in queries() and set(SQL) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_rows_as_sql(spark, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    result = connection.execute(SQL[name])
    columns = [c[0] for c in result.description]
    frame = queries()[name](spark, FOLDER)
    assert sorted(frame.columns) == sorted(columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in frame.collect()) == sorted(map(repr, result.fetchall()))


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = stages["quality"](spark, docs, FOLDER).cache()
    machine = quality.train(spark, docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    assert sorted(r.doc_id for r in good.collect()) == sorted(r.doc_id for r in docs.collect() if machine.score(r.text) >= 0.3)

    lines = stages["line dedup"](spark, good, FOLDER).cache()
    kept = {r.doc_id: r for r in line_dedup.dedup_lines(spark, good.select("doc_id", "text")).collect()}
    assert lines.columns == docs.columns and lines.count() == good.count()
    assert all(r.text == kept[r.doc_id]._kept and r.n_chars == len(r.text) for r in lines.collect())

    single = stages["simhash near-dedup"](spark, lines, FOLDER).cache()
    groups = {r.doc_id: r.component_id for r in simhash.near_duplicates(spark, lines).collect()}
    assert sorted(r.doc_id for r in single.collect()) == sorted(set(groups.values()))

    clean = stages["benchmark decontamination"](spark, single, FOLDER).cache()
    items = [decontamination.normal(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    left = [decontamination.normal(r.text) for r in clean.collect()]
    assert not any(item in text for text in left for item in items)
    assert clean.columns == docs.columns and 0 < single.count() - clean.count() < 60

    tokens = stages["bpe encoding"](spark, clean, FOLDER)
    assert sorted(r.doc_id for r in tokens.collect()) == sorted(r.doc_id for r in clean.collect())
    whole = queries()["pipeline"](spark, FOLDER)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, tokens.collect()))


def test_stages_on_odd_tables(spark):
    rows = [(None, None, None, "x", None, "y"), (1, "", None, "x", 0, None), (1, "", None, "x", 0, None), (2, "word " * 50_000, "en", None, 9, "")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, c0 string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            result = stage(spark, frame, FOLDER)
            assert "doc_id" in result.columns
            if name != "bpe encoding":
                assert result.columns == docs.columns
            result.collect()
