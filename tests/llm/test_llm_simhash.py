"""Fingerprints and components against plain Python over all pairs."""

import random

import pytest
import xxhash

from tillmart.llm import simhash
from tillmart.llm.components import components

SCHEMA = "doc_id bigint, text string, fingerprint string, lang string"


def plain_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words, word = [], ""
    for c in lowered + " ":
        if c in " \t\n\x0b\f\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    shingles = [" ".join(words[n : n + 3]) for n in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(prints):
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    known = list(root)
    for n, a in enumerate(known):
        for b in known[:n]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    return {p: find(p) for p in known}


def expected(rows):
    prints = [plain_fingerprint(r[1]) for r in rows]
    of = plain_components(prints)
    least = {}
    for r, p in zip(rows, prints):
        if r[0] is not None:
            least[of[p]] = min(least.get(of[p], r[0]), r[0])
    return sorted((r[0] is None, r[0] or 0, f"{p:016x}", least.get(of[p])) for r, p in zip(rows, prints))


def actual(frame):
    return sorted((r[0] is None, r[0] or 0, r[1], r[2]) for r in frame.collect())


def sample():
    draw = random.Random(3)
    words = [draw.choice("abcdefgh") * draw.randrange(1, 5) + str(n) for n in range(60)]
    rows = [(0, None), (1, ""), (2, " \t\n"), (3, "One"), (4, "one"), (5, "a\x1cb c"), (6, "É É é"), (None, "one"), (None, "alone here now")]
    for n in range(10, 16):
        text = [draw.choice(words) for _ in range(150)]
        for copy in range(6):
            text[draw.randrange(150)] = draw.choice(words)
            rows.append((n * 10 + copy, " ".join(text)))
    rows += [rows[-1], rows[-1], (900, " ".join(words * 3000))]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame([(*r, "kept out", None) for r in sample()], SCHEMA)


def test_fingerprints():
    for _, text in sample():
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_components_of_documents(spark, docs):
    assert actual(simhash.near_duplicates(spark, docs)) == expected(sample())


def test_links_of_random_prints(spark):
    draw = random.Random(5)
    prints = {draw.getrandbits(64) for _ in range(40)}
    for p in list(prints):
        for _ in range(6):
            for _ in range(draw.randrange(1, 5)):
                p ^= 1 << draw.randrange(64)
            prints.add(p)
    signed = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in signed], "fp bigint")
    pairs = {tuple(sorted((r.a, r.b))) for r in simhash.linked(spark, frame).collect()}
    mask = (1 << 64) - 1
    assert pairs == {(a, b) for n, b in enumerate(signed) for a in signed[:n] if ((a ^ b) & mask).bit_count() <= 3}
    # fuller keys take the way over midpoints, which keeps what is connected
    crowded = simhash.linked(spark, frame, crowd=1)
    assert all(((r.a ^ r.b) & mask).bit_count() <= 3 for r in crowded.collect())
    one = sorted(components(spark, crowded).collect())
    two = sorted(components(spark, spark.createDataFrame(sorted(pairs), "a bigint, b bigint")).collect())
    assert one == two


def test_components_of_a_chain(spark):
    order = list(range(200))
    random.Random(1).shuffle(order)
    links = [(order[n], order[n + 1]) for n in range(150)] + [(1000, 1001), (1001, 1000), (7, 7), (None, 3)]
    found = dict(components(spark, spark.createDataFrame(links, "a bigint, b bigint")).collect())
    assert {found[n] for n in order[:151]} == {min(order[:151])}
    assert found[1001] == 1000 == found[1000]
    assert set(found) == set(order[:151]) | {1000, 1001}


def test_empty_table(spark, docs):
    assert simhash.near_duplicates(spark, docs.limit(0)).collect() == []
    assert simhash.keep_one(spark, docs.limit(0)).collect() == []


def test_keep_one(spark, docs):
    kept = simhash.keep_one(spark, docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    wanted = {c for _, _, _, c in expected(sample())}
    assert sorted(i for i in ids if i is not None) == sorted(c for c in wanted if c is not None)
    assert ids.count(None) == 2


def test_keep_one_of_repeated_doc_ids(spark):
    """A doc_id with two texts stays with the one of its own component, in each component of which it is the smallest."""
    draw = random.Random(5)
    one, two, three = (" ".join(draw.choice("abcdefgh") * 3 + str(draw.randrange(99)) for _ in range(80)) for _ in range(3))
    many = [(9, three)] * 50
    rows = [(1, one), (3, one), (3, two), (4, two), (7, two), (7, three), (7, three), *many, (None, one), (None, one), (None, None)]
    for part in (rows, rows[::-1]):
        docs = spark.createDataFrame([(*r, "kept out", None) for r in part], SCHEMA).repartition(3)
        kept = simhash.keep_one(spark, docs)
        assert kept.columns == docs.columns
        assert sorted((r.doc_id or 0, r.text or "") for r in kept.collect()) == sorted([(0, one), (0, one), (0, ""), (1, one), (3, two), (7, three)])
    docs = spark.createDataFrame([(*r, "kept out", None) for r in [(1, one), (1, two), (5, one), (7, two)]], SCHEMA)
    assert sorted((r.doc_id, r.text) for r in simhash.keep_one(spark, docs).collect()) == sorted([(1, one), (1, two)])


def test_rows_without_doc_id_meet_in_no_task(spark, docs):
    assert "Window" not in simhash.keep_one(spark, docs)._jdf.queryExecution().toString()
