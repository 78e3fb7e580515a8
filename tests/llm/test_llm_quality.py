"""The classifier on labels kept from training, and on odd rows."""

import numpy as np

from tillmart.llm import quality

FOLDER = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{t}.parquet") for t in ("documents", "labels"))
    machine = quality.train(spark, docs, labels)
    known = labels.where("quality is not null")
    rows = quality.scored(spark, docs, machine).where("held_out").join(known, "doc_id").select("score", "predicted", "quality").collect()
    score, label = np.array([r.score for r in rows]), np.array([r.quality for r in rows])
    assert len(rows) > 500
    good, bad = score[label == 1], score[label == 0]
    assert np.mean(good[:, None] > bad[None]) > 0.85
    predicted = np.array([r.predicted for r in rows])
    assert (predicted[label == 1] == 1).mean() > 0.95
    assert (predicted[label == 0] == 0).mean() > 0.6


def test_interactions_by_hand():
    draw = np.random.default_rng(1)
    machine = quality.Machine(0.3, draw.normal(size=quality.SIZE), draw.normal(size=(quality.SIZE, 3)))
    at, value = quality.features("Some words, and some MORE words!! 12\nof text")
    pairs = sum(
        float(machine.factors[at[i]] @ machine.factors[at[j]]) * value[i] * value[j] for j in range(len(at)) for i in range(j)
    )
    assert abs(machine.margin(at, value) - (0.3 + float(machine.linear[at] @ value) + pairs)) < 1e-6


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 5), (2, "", 6), (None, "text", 7), (3, "word " * 100_000, 8), (3, "word " * 100_000, 8), (4, "\ud83c".encode("utf-8", "replace").decode(), 1)],
        "doc_id bigint, text string, score int",
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (3, 1), (None, 1), (9, None)], "doc_id bigint, quality int")
    machine = quality.train(spark, docs, labels)
    rows = quality.scored(spark, docs, machine).collect()
    assert len(rows) == 6 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert rows[0].score == rows[1].score
    assert quality.good(spark, docs, machine).columns == docs.columns
    nothing = quality.train(spark, docs.limit(0), labels.limit(0))
    assert quality.scored(spark, docs.limit(0), nothing).collect() == []


def test_fold_and_repeatability(spark):
    import zlib

    docs = spark.createDataFrame([(n, f"text {n} " * (n % 9 + 1)) for n in range(100)], "doc_id bigint, text string")
    labels = spark.createDataFrame([(n, n % 2) for n in range(100)], "doc_id bigint, quality int")
    one, two = quality.train(spark, docs, labels), quality.train(spark, docs.repartition(7), labels.repartition(3))
    assert np.array_equal(one.linear, two.linear) and np.array_equal(one.factors, two.factors)
    for row in quality.scored(spark, docs, one).collect():
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 5 == 0)


def test_repeated_doc_ids_in_training(spark):
    """Of a doc_id with several texts the smallest counts, whatever the order of rows."""
    rows = [(n, f"{'good' if n % 2 else 'bad'} words number {n}") for n in range(40)]
    labels = spark.createDataFrame([(n, n % 2) for n in range(40)], "doc_id int, quality int")
    again = [(n, text.replace("words", "zzz")) for n, text in rows]
    once, one, two = (quality.train(spark, spark.createDataFrame(part, "doc_id int, text string").coalesce(1), labels) for part in (rows, rows + again, again + rows))
    assert once.bias == one.bias == two.bias and (once.linear == one.linear).all() and (once.linear == two.linear).all()
