"""Ranked search, against scores of every document."""

import math
import re
from collections import Counter

import numpy as np
import pytest

from tillmart.llm import lexical_search as s
from tillmart.llm.grid_treap import Treap, best_columns, smallest_places


def every_score(docs, items, most=50):
    """All documents scored one by one; doc_ids distinct."""
    def terms(text):
        return re.findall(s.TERM, (text or "").translate(str.maketrans(s._UPPER, s._LOWER)))

    counts = {d: Counter(terms(t)) for d, t in docs}
    counts = {d: c for d, c in counts.items() if c}
    n_docs, n_terms = len(counts), sum(c.total() for c in counts.values())
    df = Counter(t for c in counts.values() for t in c)
    found = []
    for item, text in items:
        scores = []
        for d, c in counts.items():
            m = 100 - 50 + 50 * c.total() * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 20 * m))
                for t in set(terms(text)) if t in c
            )
            if score > 0:
                scores.append((-score, d))
        found += [(item, k + 1, d, -score) for k, (score, d) in enumerate(sorted(scores)[:most])]
    return sorted(found)


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "clash") for d, t in docs], "doc_id bigint, text string, shard string"),
        spark.createDataFrame([(i, t, 1) for i, t in items], "item_id bigint, text string, item int"),
    )


def searched(spark, docs, items, most=50):
    docs, items = frames(spark, docs, items)
    found = s.search(spark, s.index(spark, docs), items, most)
    assert found.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted(tuple(r) for r in found.collect())


def texts(seed, n, words=60, longest=40):
    random = np.random.default_rng(seed)
    chosen = random.zipf(1.3, (n, longest)) % words
    return [(k, " ".join(f"W{w}" for w in row[: random.integers(0, longest)])) for k, row in enumerate(chosen)]


@pytest.mark.parametrize("postings", [40, 700, 10**9])
def test_all_shards_together_give_every_score(spark, monkeypatch, postings):
    monkeypatch.setattr(s, "POSTINGS", postings)
    monkeypatch.setattr(s, "ITEMS_PER_BLOCK", 7)
    docs = [(d * 3 % 301, t) for d, t in texts(1, 300)]
    items = [(k, t) for k, t in texts(2, 20, words=70, longest=12)]
    assert searched(spark, docs, items, 13) == every_score(docs, items, 13)


def test_odd_texts_and_ties(spark):
    docs = [
        (0, None), (1, ""), (2, "--- \n\t"), (3, "Straße STRASSE straße"), (4, "É é e"), (5, "漢字 kanji 漢字"), (6, "a_b a-b ab"),
        *[(100 - k, "the same text again") for k in range(60)], (7, "again " * 5000), (8, "\x7fx\x80y"), (9, "😀"),
    ]
    items = [(1, "the same again"), (2, "straße"), (3, "É 漢字"), (4, None), (5, ""), (6, "missing"), (7, "A_B"), (8, "😀 \x80y"), (9, "the the same")]
    found = searched(spark, docs, items)
    assert found == every_score(docs, items)
    assert [r[2] for r in found if r[0] == 9] == list(range(41, 91))


def test_empty_tables(spark):
    assert searched(spark, [], [(1, "word")]) == []
    assert searched(spark, [(1, "word")], []) == []
    assert searched(spark, [(1, None)], [(1, "word")]) == []


def test_repeated_and_unnamed_rows(spark):
    docs = [(None, "red apple"), (5, "red apple"), (5, "red apple"), (6, "green pear"), (7, "blue sky"), (8, "old sea")]
    docs, items = frames(spark, docs, [(1, "red"), (1, "red"), (None, "green")])
    found = s.search(spark, s.index(spark, docs), items).collect()
    rows = sorted((r.item_id or 0, r["rank"], r.doc_id or 0) for r in found)
    assert rows == [(0, 1, 6), (1, 1, 5), (1, 1, 5), (1, 2, 5), (1, 2, 5), (1, 3, 0), (1, 3, 0)]


@pytest.mark.parametrize("seed", range(4))
def test_treap_finds_the_best_sums(seed):
    random = np.random.default_rng(seed)
    shape = (random.integers(1, 90), random.integers(1, 400))
    grid = random.integers(1, 1_000_000, shape) * (random.random(shape) < 0.1)
    grid[0, 0] = 7
    rows, columns = grid.nonzero()
    treap = Treap.build(rows, columns, grid[rows, columns])
    places = random.permutation(shape[1])
    queries = [random.choice(shape[0], min(shape[0], random.integers(1, 20)), replace=False) for _ in range(6)]
    owner = np.repeat(np.arange(6), [len(q) for q in queries])
    chosen = np.concatenate(queries)
    weights = random.integers(0, 5, len(chosen))
    found = best_columns(treap, owner, chosen, weights, smallest_places(places, treap.height), 10)
    for k in range(6):
        sums = weights[owner == k] @ grid[chosen[owner == k]]
        wanted = sorted((-int(sums[c]), int(places[c]), c) for c in range(shape[1]) if sums[c] > 0)[:10]
        assert [(c, int(v)) for q, c, v in zip(*found) if q == k] == [(c, -v) for v, _, c in wanted]
