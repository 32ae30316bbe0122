"""Token ids against the tokenizer library, with every awkward text."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tamis.llm import bpe

TEXTS = [None, "", "   ", "\n\n \n", "hello world", "aaaaaaa aaaa a  aaaa", "<|endoftext|> is text", "it's I'll 'S", "x" * 20_000, "ab" * 5_000, "é́퟿𐍈😀", "\xa0　a  b ", "1234567890 ½²③", "​﻿", "店は運河のそばにあり、席は4席です。", "핸드드립은 원두 18그램"]


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(bpe.vocabulary_path())
    t.encode_special_tokens = True
    return t


def test_awkward_texts(reference):
    got = bpe.PairIndexEncoder(bpe.vocabulary_path()).encode(TEXTS)
    assert got == [x.ids for x in reference.encode_batch([t or "" for t in TEXTS], add_special_tokens=False)]
    assert got[0] == got[1] == [] and got[2]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs"]), max_size=60), max_size=8))
def test_any_text(reference, texts):
    e = bpe.encoder(bpe.vocabulary_path())
    got = e.encode(texts)
    assert got == [x.ids for x in reference.encode_batch(texts, add_special_tokens=False)]
    assert [reference.decode(i, skip_special_tokens=False) for i in got] == texts


def test_small_chunks(reference, monkeypatch):
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 10)
    monkeypatch.setattr(bpe, "MEMORY_WORDS", 3)
    texts = ["one two three", "four", "five six seven eight nine ten", ""] * 3
    assert bpe.PairIndexEncoder(bpe.vocabulary_path()).encode(texts) == [x.ids for x in reference.encode_batch(texts, add_special_tokens=False)]


def test_documents(spark, reference):
    rows = [(1, "hello", "a"), (2, None, "b"), (2, None, "b"), (3, "", "c"), (4, " ", "d")]
    got = bpe.encode_documents(spark.createDataFrame(rows, "doc_id bigint, text string, ids string"))
    assert sorted((r[0], list(r[1])) for r in got.collect()) == [(1, reference.encode("hello").ids), (2, []), (2, []), (3, []), (4, reference.encode(" ").ids)]
    assert bpe.encode_documents(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_ids_decode_to_the_text(spark):
    rows = [(1, "Washed Guji, 250 g — très bon\r\n"), (2, ""), (3, None), (4, " \t​"), (5, "커피 " * 3000), (5, "again")]
    got = sorted((r[0], r[1]) for r in bpe.decoded_documents(spark.createDataFrame(rows, "doc_id bigint, text string")).collect())
    assert got == sorted((i, t or "") for i, t in rows)
