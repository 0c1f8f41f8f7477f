"""Toxicity and quality: against plain models, on held-out labels, and in the defined cases."""

import math
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from keystitch.llm import quality, toxicity

MEDIUM = "/root/testdata/sf0.1"


def both(spark, folder):
    return (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))


def rank_score(score, label):
    place = np.empty(len(score))
    place[np.argsort(score, kind="stable")] = np.arange(len(score))
    n = label.sum()
    return (place[label == 1].mean() - (n - 1) / 2) / (len(label) - n)


def test_toxicity_on_held_out_documents(spark):
    docs, labels = both(spark, MEDIUM)
    got = toxicity.score(docs, labels).toPandas()
    assert len(got) == docs.count() and got.score.between(0, 1).all()
    assert all((zlib.crc32(str(i).encode()) % 5 == 0) == h for i, h in zip(got.doc_id, got.held_out, strict=True))
    assert ((got.score >= 0.5) == (got.predicted == 1)).all()
    seen = got.merge(labels.toPandas(), on="doc_id").query("held_out")
    flagged = seen[seen.predicted == 1]
    assert rank_score(seen.score.to_numpy(), seen.toxic.to_numpy()) > 0.8
    assert (flagged.toxic == 1).mean() > 0.65 and (flagged.toxic == 1).sum() > 0.5 * seen.toxic.sum()


def test_held_out_labels_do_not_matter(spark, sf, rows):
    docs, labels = both(spark, sf)
    other = labels.withColumn("toxic", labels.toxic * 0 + 1).where("crc32(cast(doc_id as string)) % 5 = 0")
    changed = labels.where("crc32(cast(doc_id as string)) % 5 <> 0").unionByName(other)
    assert rows(toxicity.score(docs, labels)) == rows(toxicity.score(docs, changed))


def test_toxicity_cases(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "x"), (2, ""), (7, "a" * 500)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    docs = docs.selectExpr("*", "1 as score", "'x' as toxic")
    assert toxicity.score(docs, labels).count() == 5
    assert {r.score for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).count() == 0
    assert toxicity.windows("A" * 100) == ["a" * 48, "a" * 48, "a" * 4]


def test_what_only_the_toxic_passages_shorten_counts():
    calm = [f"the quiet river number {i} runs past fields" for i in range(40)]
    rude = [f"the quiet river number {i} blorgwort runs zanktrumper past" for i in range(40)]
    meter = toxicity.Meter(toxicity.Dictionaries.train(calm, rude))
    assert meter.features("the quiet river runs past fields")[0] == 0
    assert meter.features("this Blorgwort runs")[0] > 0
    assert meter.features("")[2] == 0


def plain_model(texts, order):
    """Probability of a byte after a context by interpolated modified Kneser-Ney, from the definition."""
    pad = b"\x02" * (order - 1)
    grams = Counter(t[i : i + order] for t in (pad + x for x in texts) for i in range(len(t) - order + 1))
    tables = {order: grams}
    for k in range(order - 1, 0, -1):
        tables[k] = Counter(g[1:] for g in tables[k + 1])
    cuts, contexts = {}, {}
    for k, table in tables.items():
        of = Counter(min(c, 5) for c in table.values())
        y = of[1] / (of[1] + 2 * of[2]) if of[1] + of[2] else 0.5
        cuts[k] = []
        for c in (1, 2, 3):
            ratio = of[c + 1] / of[c] if of[c] else 0.5
            cuts[k].append(min(max(c - (c + 1) * y * ratio, 0.05), c - 0.05))
        contexts[k] = defaultdict(Counter)
        for g, c in table.items():
            contexts[k][g[:-1]][g[-1:]] = c

    def p(g):
        if not g:
            return 1 / 256
        after = contexts[len(g)].get(g[:-1])
        if after is None:
            return p(g[1:])
        cut = [cuts[len(g)][min(c, 3) - 1] for c in after.values()]
        c = after[g[-1:]]
        own = c - cuts[len(g)][min(c, 3) - 1] if c else 0
        return (own + sum(cut) * p(g[1:])) / sum(after.values())

    return p


def test_probabilities_follow_the_definition(spark):
    texts = [b"the cat sat on the mat", b"the hat of the cat", b"a mat", "été à la mer".encode()]
    p = plain_model(texts, quality.ORDER)
    wanted = texts + [b"zzz the cat!", b"q"]
    value, _ = quality.ngrams(wanted)
    grams = Counter(quality.ngrams(texts)[0].tolist())
    rows = [(g, grams[g]) for g in sorted(set(value.tolist()))]
    got = dict(quality.probabilities(spark.createDataFrame(rows, "g long, c long")).collect())
    for g, c in rows:
        assert math.isclose(math.exp(got[g]), p(g.to_bytes(quality.ORDER, "big")), rel_tol=1e-9), (g, c)
    context = b" the"
    assert math.isclose(sum(p(context + bytes([b])) for b in range(256)), 1, rel_tol=1e-9)


@pytest.mark.parametrize("shard", [1 << 21, 37])
def test_perplexity_of_documents(spark, monkeypatch, shard):
    monkeypatch.setattr(quality, "SHARD_NGRAMS", shard)
    texts = ["the cat sat on the mat", "the hat", "", None, "cat été", "zzz"]
    docs = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(0,), (4,), (99,)], "doc_id long")
    p = plain_model([texts[0].encode(), texts[4].encode()], quality.ORDER)
    for r in quality.perplexities(docs.repartition(3), trusted).collect():
        text = (texts[r.doc_id] or "").encode()
        padded = b"\x02" * (quality.ORDER - 1) + text
        logs = [math.log(p(padded[i : i + quality.ORDER])) for i in range(len(text))]
        assert (r.perplexity is None) == (not text)
        assert not text or math.isclose(r.perplexity, math.exp(-sum(logs) / len(text)), rel_tol=1e-5)


def test_quality_on_labels(spark):
    docs, labels = both(spark, MEDIUM)
    got = quality.classify(docs, labels).toPandas()
    seen = got.merge(labels.toPandas(), on="doc_id")
    assert len(got) == docs.count()
    assert seen.rejected[seen.quality == 1].mean() < 0.02
    assert seen.rejected[seen.quality == 0].mean() > 0.7
    assert rank_score((seen.perplexity / seen.threshold).to_numpy(), 1 - seen.quality.to_numpy()) > 0.9


def test_quality_cases(spark):
    data = [(1, None, "en"), (2, "", None), (None, "x y", "en"), (3, "abc", "xx"), (3, "abc", "xx")]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string").selectExpr("*", "1 as trusted", "2 as ll")
    labels = spark.createDataFrame([(3, 1), (3, 0), (None, 1), (1, None)], "doc_id long, quality int")
    for some in (labels, labels.limit(0)):
        got = quality.classify(docs, some).collect()
        assert len(got) == 5 and not any(r.rejected for r in got)
    assert quality.classify(docs.limit(0), labels).count() == 0


def test_languages_with_few_trusted_documents_keep_their_clean_ones(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows, trusted = [], []
    for lang, n, level, held in (("en", 400, 3.0, 300), ("xx", 200, 9.0, 1), ("yy", 200, 9.0, 0), (None, 100, 9.0, 0), ("zz", 5, 9.0, 1)):
        for i in range(n):
            junk = lang in ("en", "xx", "yy") and i >= n - 10
            rows.append((len(rows), lang, float(level * np.exp(3.0 * junk + 0.1 * rng.normal()))))
            trusted += [len(rows) - 1] * (i < held)
    scores = spark.createDataFrame(rows, "doc_id long, lang string, perplexity double")
    monkeypatch.setattr(quality, "perplexities", lambda docs, trusted: scores)
    monkeypatch.setattr(quality, "HELD_OUT", 1)
    labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
    got = {r.doc_id: r.rejected for r in quality.classify(scores, labels).collect()}
    junk = [p > 25 for _, _, p in rows]
    assert len(got) == len(rows) and all(got[i] for i, j in enumerate(junk) if j)
    for lang in ("xx", "yy", None, "zz"):
        assert not any(got[i] for i, of, _ in rows if of == lang and not junk[i])
    assert sum(got[i] for i, of, _ in rows if of == "en" and not junk[i]) <= 10


def test_table_of_open_slots():
    rng = np.random.default_rng(0)
    keys = np.unique(rng.integers(0, 1 << 40, 5000, dtype=np.uint64))
    table = quality.Table(keys, np.arange(1, len(keys) + 1, dtype=np.float32))
    assert np.array_equal(table.get(keys), np.arange(1, len(keys) + 1))
    absent = np.setdiff1d(rng.integers(0, 1 << 40, 5000, dtype=np.uint64), keys)
    assert not table.get(absent).any()


def test_table_is_filled_in_little_memory():
    rng = np.random.default_rng(9)
    keys = rng.permutation(np.arange(1, 400_001, dtype=np.uint64) * np.uint64(1_000_003))
    values = rng.random(len(keys)).astype(np.float32)
    tracemalloc.start()
    try:
        table = quality.Table(keys, values)
        most = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert most < 2 * (table.keys.nbytes + table.values.nbytes)
    assert (table.get(keys) == values).all() and not table.get(keys + np.uint64(1)).any()
