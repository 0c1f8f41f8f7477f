"""Removal of repeated word passages and byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from keystitch.llm import substrings, suffixes


def words_of(text):
    return (text or "").encode().split()


def plain_words(docs, n):
    least = {}
    for i, text in docs:
        if i is not None:
            w = words_of(text)
            for at in range(len(w) - n + 1):
                key = tuple(w[at : at + n])
                least[key] = min(least.get(key, i), i)
    out = []
    for i, text in docs:
        w = words_of(text)
        gone = set()
        for at in range(len(w) - n + 1):
            if i is not None and least[tuple(w[at : at + n])] < i:
                gone |= set(range(at, at + n))
        out.append((i, b" ".join(x for j, x in enumerate(w) if j not in gone).decode(), len(w), len(gone)))
    return sorted(out, key=repr)


def made(seed, vocabulary, joint=" "):
    random.seed(seed)
    words = ["".join(random.choice("abcdeéß") for _ in range(random.randint(1, 6))) for _ in range(vocabulary)]
    text = lambda n: " ".join(random.choice(words) for _ in range(n))
    shared = [text(random.randint(10, 60)) for _ in range(10)]
    docs = []
    for _ in range(150):
        parts = [
            random.choice([text(random.randint(1, 40)), random.choice(shared), random.choice(shared)[: random.randint(20, 300)], "ab " * random.randint(5, 100)])
            for _ in range(random.randint(0, 5))
        ]
        docs.append(joint.join(parts))
    return [*docs, None, "", " \t", docs[5], docs[5], docs[7] + " x"]


@pytest.mark.parametrize("n, shortest", [(13, 7), (20, 4), (5, 7), (2, 1)])
def test_words(spark, rows, n, shortest):
    docs = list(enumerate(made(n, 60, " \n\x0b")))
    docs += [(None, docs[3][1]), (None, " a  b\r"), (3, docs[9][1]), (-4, docs[11][1]), (-4, docs[11][1])]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, kept int").repartition(4)
    got = rows(substrings.dedup(df, n, shortest).select("doc_id", "kept", "n_words", "n_removed"))
    assert got == plain_words(docs, n)


def test_words_of_other_spaces_and_no_rows(spark):
    df = spark.createDataFrame([(1, "a\xa0b\x1cc " * 13), (2, "a\xa0b\x1cc " * 13)], "doc_id long, text string")
    assert [(r.n_words, r.n_removed) for r in substrings.dedup(df).orderBy("doc_id").collect()] == [(13, 0), (13, 13)]
    assert substrings.dedup(df.limit(0)).count() == 0 and suffixes.dedup(df.limit(0)).count() == 0
    kept = substrings.dedup(df.selectExpr("doc_id", "text", "'x' as lang"), original=True)
    assert kept.columns == ["doc_id", "text", "lang", "kept", "n_words", "n_removed"]


def plain_bytes(texts, length):
    data, count = [(t or "").encode() for t in texts], {}
    for b in data:
        for i in range(len(b) - length + 1):
            count[b[i : i + length]] = count.get(b[i : i + length], 0) + 1
    out = []
    for b in data:
        gone = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if count[b[i : i + length]] > 1:
                gone[i] += 1
                gone[i + length] -= 1
        lost = np.cumsum(gone)[:-1] > 0
        runs = int((lost[1:] & ~lost[:-1]).sum() + lost[:1].sum())
        kept = np.frombuffer(b, np.uint8)[~lost].tobytes()
        out.append((len(b), int(lost.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return out


def test_bytes(spark):
    texts = made(2, 300, "|") + ["a" * 199, "b" * 200, "c" * 201, "d" * 1000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = [tuple(r)[1:] for r in suffixes.digests(df).orderBy("doc_id").collect()]
    assert got == plain_bytes(texts, 200)


@pytest.mark.parametrize("length, gram, block", [(40, 20, 5), (30, 9, 4), (25, 25, 10)])
def test_bytes_of_other_lengths(spark, length, gram, block):
    texts = made(length, 80, "")
    ids = [None if i % 7 == 0 else i // 2 for i in range(len(texts))]
    df = spark.createDataFrame(list(zip(ids, texts, range(len(texts)), strict=True)), "doc_id long, text string, n int")
    got = suffixes.dedup(df.repartition(4), length, gram, block).orderBy("n").collect()
    found = [(r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest()) for r in got]
    assert found == plain_bytes(texts, length)


def test_suffix_array():
    random.seed(1)
    for _ in range(1500):
        symbols = [random.randint(1, random.randint(1, 4)) for _ in range(random.randint(0, 40))] + [0]
        assert suffixes.suffix_array(symbols) == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_registered_query_on_the_driver_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    got = [tuple(r)[1:] for r in suffixes.digests(docs).orderBy("doc_id").collect()]
    assert got == plain_bytes([r.text for r in docs.orderBy("doc_id").collect()], 200)
