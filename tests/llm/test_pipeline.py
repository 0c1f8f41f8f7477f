"""The pipeline stage by stage, and its guard."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from keystitch.llm import jaccard, quality, substrings, toxicity
from keystitch.llm import rows as joins
from keystitch.sources.tables import TEXT_ROWS, stage
from tests.llm.test_passages import plain_words

SMALL = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def outputs(spark):
    docs, found = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    found.append(docs)
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, SMALL), "pipeline-test")
        found.append(docs)
    return found


def test_stages(outputs):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality classifier", "toxicity", "n-gram Jaccard join", "substring dedup", "best-fit packing"]
    for before, after in zip(outputs[:4], outputs[1:5], strict=True):
        assert after.columns == before.columns and after.dtypes == before.dtypes
    counts = [x.count() for x in outputs]
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] > counts[5] > 0


def test_clean_documents_stay(spark, outputs):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    clean = labels.where("quality = 1 and toxic = 0").select("doc_id")
    docs = outputs[0].join(clean, "doc_id", "left_semi")
    for kept in outputs[1:3]:
        assert docs.join(kept, "doc_id", "left_semi").count() >= 0.95 * docs.count()
    toxic = outputs[1].join(labels.where("toxic = 1"), "doc_id", "left_semi")
    assert toxic.join(outputs[2], "doc_id", "left_semi").count() < 0.6 * toxic.count()


def test_one_of_each_group(outputs):
    kept = {r.doc_id for r in outputs[3].collect()}
    exact = {}
    for r in outputs[2].collect():
        exact.setdefault(" ".join(r.text.lower().split()), []).append(r.doc_id)
    for ids in exact.values():
        assert not kept & set(sorted(ids)[1:])


def test_passages(outputs):
    before = [(r.doc_id, r.text) for r in outputs[3].collect()]
    want = {i: (text, gone) for i, text, _, gone in plain_words(before, corpus_pipeline.PASSAGE_WORDS)}
    for r in outputs[4].collect():
        text, gone = want[r.doc_id]
        assert r.text == (text if gone else dict(before)[r.doc_id]) and r.n_chars == len(r.text)


def test_sequences_hold_all_documents(outputs):
    held = {i for r in outputs[5].collect() for i in r.doc_ids}
    assert held == {r.doc_id for r in outputs[4].collect()}


def test_stages_on_odd_documents(spark):
    data = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b c", None, "s", 5), (2, "a b c", None, "s", 5)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
    for table in (docs, docs.limit(0)):
        for _, function in corpus_pipeline.STAGES:
            function(spark, table, SMALL).collect()


def test_rows_are_told_apart(spark, rows):
    text = " ".join(f"w{i}" for i in range(40))
    data = [(7, text, "b"), (7, text, "a"), (None, text, "c"), (9, f"{text} more", "d"), (None, "", "e"), (8, "q r", "f")]
    docs = spark.createDataFrame(data, "doc_id long, text string, row string")
    kept = corpus_pipeline.keep_one_of_each(spark, docs, SMALL)
    assert kept.columns == docs.columns
    got = rows(kept)
    assert [r for r in got if r[0] == 7] in ([(7, text, "a")], [(7, text, "b")])
    assert sorted(r[2] for r in got if r[0] != 7) == ["e", "f"]
    nameless = spark.createDataFrame(data[2:3] * 3, docs.schema)
    assert corpus_pipeline.keep_one_of_each(spark, nameless, SMALL).count() == 1


def test_keys_of_rows(spark, rows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    twice = stage(docs.unionByName(docs).repartition(5), "pipeline-test")
    numbered, name = joins.keyed(twice)
    assert numbered.columns == [*docs.columns, name]
    assert numbered.select(name).distinct().count() == twice.count() == numbered.count()
    assert rows(numbered.drop(name)) == rows(twice)
    for other in (twice.select("*", F.explode(F.array(F.lit(1), F.lit(2)))), twice.where("doc_id < 50"), twice.limit(0)):
        numbered, name = joins.keyed(other)
        assert numbered.select(name).distinct().count() == other.count()


def test_rejected_rows_alone_go(spark, rows):
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    scored = toxicity.score(docs, labels)
    bad = docs.join(scored.where("predicted = 1"), "doc_id", "left_semi").orderBy("doc_id").first()
    good = docs.join(labels.where("quality = 1 and toxic = 0"), "doc_id", "left_semi").orderBy("doc_id").first()
    mixed = spark.createDataFrame(
        [(good.doc_id, bad.text), (good.doc_id, good.text), (None, bad.text), (None, good.text)], "doc_id long, text string"
    )
    held = docs.select("doc_id", "text").where(F.col("doc_id") != good.doc_id).unionByName(mixed)
    left = corpus_pipeline.keep_civil(spark, held, SMALL)
    assert {r.text for r in left.where(F.col("doc_id").isNull() | (F.col("doc_id") == good.doc_id)).collect()} == {good.text}
    assert left.where("doc_id is null").count() == 1


def test_clashing_names_pass_all_stages(spark):
    names = ["home", "kept", "n_words", "n_removed", "row", "score", "rejected", "component_id", "Trusted", "ll"]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").limit(60)
    docs = docs.select(*[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names], *docs.columns)
    for _, function in corpus_pipeline.STAGES[:4]:
        docs = stage(function(spark, docs, SMALL), "pipeline-test")
        assert docs.columns[: len(names)] == names
        assert not docs.where(" or ".join(f"`{n}` <> concat('{n}-', doc_id)" for n in names)).count()
    assert docs.count() > 0 and corpus_pipeline.into_sequences(spark, docs, SMALL).count() > 0


def test_lists_of_ids_beyond_the_broadcast(spark, monkeypatch, rows):
    docs = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c"), (2, "d")], "doc_id long, text string")
    ids = spark.createDataFrame([(2,), (2,), (None,)], "doc_id long")
    want = rows(joins.without(docs, ids)), rows(joins.flagged(docs, ids, "f"))
    assert want[0] == [(1, "a"), (None, "c")] and len(want[1]) == 4
    monkeypatch.setattr(joins, "BROADCAST_IDS", 0)
    assert (rows(joins.without(docs, ids)), rows(joins.flagged(docs, ids, "f"))) == want


def test_texts_come_to_workers_in_short_batches(spark, monkeypatch):
    def checked(function):
        def run(batches):
            def short():
                for pdf in batches:
                    if len(pdf) > 1000:
                        raise ValueError(f"{len(pdf)} texts at once")
                    yield pdf

            return function(short())

        return run

    assert TEXT_ROWS == 1000
    for module, name in ((jaccard, "_describe"), (jaccard, "_sign"), (jaccard, "_tokens"), (substrings, "_first_level"), (quality, "_add")):
        make = getattr(module, name)
        monkeypatch.setattr(module, name, lambda *a, make=make: checked(make(*a)))
    monkeypatch.setattr(quality, "_count", checked(quality._count))
    pdf = pd.DataFrame({"doc_id": range(2500), "lang": "en", "text": [f"a{i} b{i} c{i % 9} d e f g h i j k l m n" for i in range(2500)]})
    docs = spark.createDataFrame(pdf).coalesce(1)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert jaccard.join(docs).count() == substrings.dedup(docs).count() == 2500
    trusted = docs.where("doc_id % 2 = 0").select("doc_id")
    assert stage(quality.perplexities(docs, trusted), "scores", TEXT_ROWS).count() == 2500
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
