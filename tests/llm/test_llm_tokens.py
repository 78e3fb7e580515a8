"""Encoding, decoding and prefix counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tillmart.llm import bpe, token_counts

WORD, BYTE = (public_tokenizers.path(f"{name}.json") for name in ("word_bpe_49k", "byte_bpe_50k"))
LETTERS = "abcdeTHE 'sreéÉΣσİﬁ  \n\t\x1c\xa0漢字🎉123.,!?-_<|>ñ́Ɤ\U0001e030don'tll've"


def texts():
    draw = random.Random(1)
    made = ["".join(draw.choice(LETTERS) for _ in range(draw.randrange(40))) for _ in range(400)]
    made += ["a <|endoftext|> b<|startoftext|>", "<|endoftext|>", "", "x" * 3000, "  \n\n a   b  ", "it's we'll I'VE x'r 'r 'l 'v"]
    return made + ["<|endoftext|><|endoftext|>a  <|endoftext|>", "<|endoftext", "ab" * 20_000, "\n" * 400 + "x"]


def test_encode_and_decode():
    own, library = bpe.Vocabulary(WORD), Tokenizer.from_file(WORD)
    for text in texts():
        ids = own.encode(text)
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text[:50]
        assert own.decode(ids) == library.decode(ids.tolist(), skip_special_tokens=False)


def test_every_prefix():
    own, library = token_counts.PrefixCounts(BYTE), Tokenizer.from_file(BYTE)
    draw = random.Random(2)
    for text in texts():
        counts = own.prefixes(text)
        assert len(counts) == len(text) + 1
        every = range(len(text) + 1) if len(text) < 100 else [len(text), *(draw.randrange(len(text)) for _ in range(5))]
        for n in every:
            assert counts[n] == len(library.encode(text[:n], add_special_tokens=False).ids), (text[:n], n)


def test_words_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    own, library = bpe.Vocabulary(WORD), Tokenizer.from_file(WORD)
    text = "one two three four five one two three one six seven one two"
    assert own.encode(text).tolist() == library.encode(text, add_special_tokens=False).ids


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(n, t, "x") for n, t in enumerate(texts())] + [(1000, None, "x"), (None, "hello", None), (0, texts()[0], "x")]
    return spark.createDataFrame(rows, "doc_id bigint, text string, ids string")


def test_tables(spark, docs):
    library = Tokenizer.from_file(WORD)
    for row in bpe.encoded(docs, WORD).join(docs.dropDuplicates(["doc_id"]).drop("ids"), "doc_id").collect():
        assert row.ids == library.encode(row.text or "", add_special_tokens=False).ids
    assert bpe.digests(docs, WORD).count() == docs.count()
    counted = {r.doc_id: r for r in token_counts.token_counts(docs, BYTE, 100).collect()}
    library = Tokenizer.from_file(BYTE)
    for n, text in enumerate(texts()):
        row, count = counted[n], len(library.encode(text, add_special_tokens=False).ids)
        assert (row.n_bytes, row.n_tokens, row.over_limit) == (len(text.encode()), count, count > 100)
        assert len(library.encode(text[: row.fits], add_special_tokens=False).ids) <= 100
    assert (counted[1000].n_tokens, counted[1000].n_bytes, counted[1000].fits) == (0, 0, 0)
    assert {r.doc_id: r.counts for r in token_counts.prefix_counts(docs, BYTE).collect()}[1000] == [0]


def test_empty_table(spark, docs):
    assert bpe.encoded(docs.limit(0), WORD).collect() == []
    assert token_counts.token_counts(docs.limit(0), BYTE).collect() == []
