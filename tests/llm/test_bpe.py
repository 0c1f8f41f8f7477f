"""Encoding and decoding against the tokenizers library."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from keystitch.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", None, "  \t\n", "a b\x1cc\x1d d", "ΑΣ ΣΑΣ İstanbul ǅ", "it's we'll I'D '", "áx é",
    "<|endoftext|>x<|startoftext|> <|ENDOFTEXT|>", "he said<|endoftext|>lo", "aaaaaaaaaaaaaa" * 300, "漢字かな 12345 ½ ²³",
    "\x01 ​ x　y\xa0z\x85w", "🙂🙂👍🏽 ﬁ ß ẞ", "!!!???...---" * 30, "same", "same",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_matches_the_library(spark, sf, library):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()] + ODD
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    got = bpe.decode(bpe.encode(docs.repartition(3), PATH), PATH).toPandas().sort_values("doc_id")
    want = library.encode_batch([t or "" for t in texts], add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got.ids] == [w.ids for w in want]
    assert got.decoded.tolist() == [library.decode(w.ids, skip_special_tokens=False) for w in want]


def test_random_texts(library):
    rng = np.random.default_rng(0)
    texts = ["".join(rng.choice(list("abAB 'sS\n\tßéΣ1²!.́ᲀ\xad "), 60)) for _ in range(400)]
    got = bpe._Encoder(bpe.Vocabulary(PATH)).encode(texts)
    want = library.encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(g, "<u4").tolist() for g in got] == [w.ids for w in want]


def test_a_full_table_of_chunks_is_forgotten(monkeypatch, library):
    monkeypatch.setattr(bpe, "CACHED_CHUNKS", 5)
    encoder = bpe._Encoder(bpe.Vocabulary(PATH))
    for text in ["one two three four", "five six seven", "one eight <|endoftext|>", "two"]:
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == want


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([], "text string, keep int, decoded double")
    out = bpe.decode(bpe.encode(docs, PATH), PATH)
    assert out.columns == ["text", "keep", "ids", "decoded"] and out.count() == 0
    assert bpe.digests(docs.selectExpr("1L doc_id", "text"), PATH).count() == 0
