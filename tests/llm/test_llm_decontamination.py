"""Passages found against a full edit distance over all places."""

import random
import tracemalloc

import pytest

from tillmart.llm import decontamination as d


def plain_distance(passage, text):
    row = [0] * (len(text) + 1)
    for n, a in enumerate(passage, 1):
        last, row[0] = row[0], n
        for m, b in enumerate(text, 1):
            last, row[m] = row[m], min(last + (a != b), row[m] + 1, row[m - 1] + 1)
    return min(row)


def edited(draw, text, edits):
    letters = list(text)
    for _ in range(edits):
        at = draw.randrange(len(letters))
        kind = draw.randrange(3)
        if kind == 0:
            letters[at] = draw.choice("abcxyz ")
        elif kind == 1:
            letters.insert(at, draw.choice("abcxyz "))
        else:
            del letters[at]
    return "".join(letters)


@pytest.fixture(scope="module")
def sample():
    draw = random.Random(9)
    words = ["".join(draw.choice("abcdeé") for _ in range(draw.randrange(2, 8))) for _ in range(80)]

    def prose(n):
        return " ".join(draw.choice(words) for _ in range(n))

    items = [(n, prose(draw.randrange(6, 40))) for n in range(12)] + [(20, "tiny"), (21, "sixsix"), (22, None), (23, " "), (24, "Exactly  Ten"), (None, "with no id at all here")]
    docs = [(n, prose(60)) for n in range(15)]
    for n in range(60):
        item = draw.choice(items[:12])[1]
        docs.append((100 + n, prose(draw.randrange(30)) + " " + edited(draw, item, draw.randrange(len(item) // 7 + 1)) + " " + prose(draw.randrange(30))))
    docs += [(200, None), (201, ""), (202, "a tiny thing, exactly ten"), (203, items[0][1].upper().replace(" ", "\n")), (204, items[1][1] * 2), (None, items[2][1]), (204, items[1][1] * 2), (205, "With no id  at all here")]
    return docs, items


def wanted(text, items):
    found = {}
    for item, passage in items:
        passage = d.normal(passage)
        if passage:
            edits = plain_distance(passage, d.normal(text))
            if edits <= d.budget(len(passage)):
                found[item] = edits
    return found


def test_against_all_places(spark, sample):
    docs, items = sample
    frame = spark.createDataFrame([(*r, "x", 1) for r in docs], "doc_id bigint, text string, item_ids string, edits int")
    benchmark = spark.createDataFrame([(*r, "x") for r in items], "item_id bigint, text string, doc_id string")
    found = d.contaminated(spark, frame, benchmark).collect()
    assert len(found) == len(docs)
    hit = 0
    for row, (doc, text) in zip(found, docs):
        assert row.doc_id == doc
        expected = wanted(text, items)
        assert set(row.item_ids) == set(expected), (doc, text)
        assert dict(zip(row.item_ids, row.edits)) == expected
        hit += bool(expected)
    assert hit > 40
    assert [r.doc_id for r in d.clean(spark, frame, benchmark).collect()] == [r.doc_id for r in found if not r.item_ids]


def test_blocks_of_passages_and_chunks_of_documents(spark, sample, monkeypatch):
    docs, items = sample
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    whole = [tuple(r) for r in d.contaminated(spark, frame, benchmark).collect()]
    monkeypatch.setattr(d, "BLOCK_CHARACTERS", 300)
    assert len(list(d._blocks(benchmark.collect()))) > 3
    assert [tuple(r)[:2] for r in d.contaminated(spark, frame, benchmark).collect()] == [r[:2] for r in whole]


def test_windows_of_long_texts(monkeypatch, sample):
    docs, items = sample
    index = d.block([(i, d.normal(t)) for i, t in items if d.normal(t)])
    texts = [d.normal(t) for _, t in docs]
    whole = d.matches(texts, index)
    monkeypatch.setattr(d, "CHUNK_CHARACTERS", 37)
    assert d.matches(texts, index) == whole


def test_alignment():
    draw = random.Random(3)
    for _ in range(200):
        passage = "".join(draw.choice("ab") for _ in range(draw.randrange(1, 30)))
        text = "".join(draw.choice("ab") for _ in range(draw.randrange(0, 60)))
        exact = plain_distance(passage, text)
        found = d.distance(d._codes(passage), d._codes(text), -len(passage), len(text), 5)
        assert found == (exact if exact <= 5 else None)


def test_alignment_in_a_band():
    """Every path inside the band counts, none outside it."""
    draw = random.Random(5)
    for _ in range(200):
        passage = "".join(draw.choice("ab") for _ in range(draw.randrange(1, 12)))
        text = "".join(draw.choice("ab") for _ in range(draw.randrange(0, 25)))
        low = draw.randrange(-6, 12)
        high = low + draw.randrange(0, 8)
        inside = {(0, j): 0 for j in range(len(text) + 1) if low <= j <= high}
        for n in range(1, len(passage) + 1):
            for j in range(len(text) + 1):
                if low <= j - n <= high:
                    inside[n, j] = min(
                        inside.get((n - 1, j - 1), 99) + (j == 0 or passage[n - 1] != text[j - 1]),
                        inside.get((n - 1, j), 99) + 1,
                        inside.get((n, j - 1), 99) + 1,
                    )
        exact = min([v for (n, _), v in inside.items() if n == len(passage)], default=99)
        assert d.distance(d._codes(passage), d._codes(text), low, high, 4) == (exact if exact <= 4 else None)


def test_slices_of_frequent_grams(monkeypatch, sample):
    docs, items = sample
    rules = [(30, "-" * 200), (31, "=-" * 60), (32, "ab " * 40)]
    index = d.block([(i, d.normal(t)) for i, t in items + rules if d.normal(t)])
    texts = [d.normal(t) for _, t in docs] + ["-" * 3000, "=-" * 400 + "x" * 50 + "-" * 150, "-" * 195 + "xx" + "-" * 30, "ab " * 300]
    whole = d.matches(texts, index)
    assert whole[-4] == {len(index.texts) - 3: 0} and whole[-2][len(index.texts) - 3] == 2
    monkeypatch.setattr(d, "SLICE", 40)
    assert d.matches(texts, index) == whole


def test_many_dashes_take_bounded_memory():
    index = d.block([(1, "-" * 200), (2, "-" * 150 + "a heading" + "-" * 41)])
    tracemalloc.start()
    try:
        found = d.matches(["-" * 60_000], index)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == [{0: 0, 1: 9}] and peak < 200_000_000


def test_ids_of_any_type(spark, sample):
    docs, items = sample
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    named = spark.createDataFrame([(None if i is None else f"item {i:03}", t) for i, t in items], "item_id string, text string")
    numbered = d.contaminated(spark, frame, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    found = d.contaminated(spark, frame, named).collect()
    assert [[None if i is None else f"item {i:03}" for i in r.item_ids] for r in numbered] == [r.item_ids for r in found]


def test_empty_tables(spark, sample):
    docs, items = sample
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    assert d.contaminated(spark, frame.limit(0), benchmark).collect() == []
    assert {tuple(r.item_ids) for r in d.contaminated(spark, frame, benchmark.limit(0)).collect()} == {()}
    assert d.clean(spark, frame, benchmark.limit(0)).count() == len(docs)
