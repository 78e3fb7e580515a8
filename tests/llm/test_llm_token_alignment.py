"""Alignment of two tokenizers, against the libraries and sets of offsets."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tillmart.llm import token_alignment as t
from tillmart.llm.bpe import byte_letters
from tillmart.llm.queries import BYTE_VOCABULARY, PIECE_VOCABULARY, op13_alignment

FOLDER = "/root/testdata/sf0.001"
PATHS = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_VOCABULARY)


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def expected(libraries, rows):
    """By sets of end offsets, one text after the other."""
    a, b = libraries
    letter = {c: n for n, c in enumerate(byte_letters())}
    texts, links = [], []
    for doc, text in rows:
        cuts, linked, ids_a, ids_b = [], [], [], []
        if text:
            ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            data_a = [bytes(letter[c] for c in a.id_to_token(n)) for n in ids_a]
            data_b = [bytes([int(p[3:5], 16)]) if b.is_byte(n) else p.replace("▁", " ").encode() for n in ids_b for p in [b.id_to_piece(n)]]
            if b"".join(data_a) == b"".join(data_b) == (" " + text).encode():
                ends_a, ends_b = ({e: n for n, e in enumerate(np.cumsum([len(d) for d in data]))} for data in (data_a, data_b))
                for end in sorted(ends_a.keys() & ends_b.keys()):
                    cuts.append((ends_a[end] + 1, ends_b[end] + 1))
                    linked.append((ids_a[cuts[-1][0] - 1], ids_b[cuts[-1][1] - 1]))
            else:
                ids_a, ids_b = [], []
        groups = [
            ",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])) for (i, j), (k, m) in zip([(0, 0), *cuts], cuts)
        ]
        sha = hashlib.sha256(";".join(groups).encode()).hexdigest() if cuts else ""
        texts.append((doc, len(ids_a), len(ids_b), len(cuts), sha))
        links.append(linked)
    counts = Counter(pair for linked in links for pair in linked)
    best = {}
    for (_, id_b), n in counts.items():
        best[id_b] = max(n, best.get(id_b, 0))
    return [
        (doc, n_a, n_b, groups, len(linked), sum(counts[p] == best[p[1]] for p in linked), sum(counts[p] for p in linked), sha)
        for (doc, n_a, n_b, groups, sha), linked in zip(texts, links)
    ]


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_the_query_equals_the_libraries(spark, libraries):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    frame = op13_alignment(spark, FOLDER)
    assert frame.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert all(kind == "bigint" for name, kind in frame.dtypes if name != "groups_sha256")
    assert found(frame) == sorted(expected(libraries, rows), key=repr)


def test_odd_texts(spark, libraries):
    texts = [
        None, "", " ", "a", "▁", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", "zażółć 😀 漢字 \x00 \t\n\r", "  two  spaces  ",
        "-" * 5000, "x" * 3000 + " y", "\n" * 4000, "word " * 3000, "é é ﬁ", "same", "same", "﻿    ",
    ]
    rows = [(n if n != 3 else None, text) for n, text in enumerate(texts)]
    frame = spark.createDataFrame([(d, x, 0, "clash") for d, x in rows], "doc_id int, text string, n_a int, pairs string")
    assert found(t.aligned(spark, frame, *PATHS)) == sorted(expected(libraries, rows), key=repr)


def test_an_empty_table(spark):
    assert t.aligned(spark, spark.createDataFrame([], "doc_id bigint, text string"), *PATHS).count() == 0


@pytest.mark.parametrize("work", [1, 2, 3, 7, 64])
def test_pieces_and_borders(work):
    random = np.random.default_rng(work)
    for n, m, most in [(0, 5, 9), (5, 0, 9), (1, 1, 2), (1, 1, 3), (30, 30, 31), (200, 90, 400), (90, 200, 250), (500, 500, 501)]:
        a, b = (np.sort(random.choice(np.arange(1, most), min(size, most - 1), replace=False)).astype(np.int64) for size in (n, m))
        at_a, at_b = t.meeting(a, b, work)
        assert list(a[at_a]) == list(b[at_b]) == sorted(set(a.tolist()) & set(b.tolist()))
        if n and m:
            i, j = t.borders(a, b, work)
            merged = sorted([(x, 0) for x in a] + [(x, 1) for x in b])
            for k, (x, y) in enumerate(zip(i, j)):
                head = merged[: k * work]
                assert (x, y) == (sum(s == 0 for _, s in head), sum(s == 1 for _, s in head))


def test_written_groups_in_parts(libraries):
    aligner = t.Aligner(*PATHS)
    text = "A few words, für alle. " * 30_000  # more groups than are written at once
    (row,) = expected(libraries, [(0, text[:2000])])
    assert aligner.align([text[:2000]])[0][:4] == (*row[1:4], row[7])
    n_a, n_b, groups, sha, _ = aligner.align(["before", text, "after"])[1]
    (row,) = expected_long(libraries, text)
    assert (n_a, n_b, groups, sha) == row


def expected_long(libraries, text):
    """As above without quadratic searches."""
    a, b = libraries
    letter = {c: n for n, c in enumerate(byte_letters())}
    ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    ends_a = np.cumsum([len(a.id_to_token(n)) for n in ids_a])
    ends_b = np.cumsum([1 if b.is_byte(n) else len(b.id_to_piece(n).replace("▁", " ").encode()) for n in ids_b])
    assert letter and ends_a[-1] == ends_b[-1]
    common, at_a, at_b = np.intersect1d(ends_a, ends_b, return_indices=True)
    groups, i, j = [], 0, 0
    for k, m in zip(at_a + 1, at_b + 1):
        groups.append(",".join(map(str, ids_a[i:k])) + "|" + ",".join(map(str, ids_b[j:m])))
        i, j = k, m
    return [(len(ids_a), len(ids_b), len(common), hashlib.sha256(";".join(groups).encode()).hexdigest())]


def test_pairs_are_bounded_by_the_vocabularies():
    assert 100_000 < t.most_pairs(*PATHS) < t.MOST_BROADCAST
