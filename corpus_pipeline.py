"""From raw documents to training sequences, stage by stage.

Each stage is called with the session, the documents that its predecessor kept and the folder of the tables, and
returns a DataFrame; `run` writes it below the shared folder and reads it back for the next one. All stages but the
last return the columns of `documents`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.llm import jaccard, packing, quality, rows, substrings, toxicity
from keystitch.sources.tables import TEXT_ROWS, stage

#: Near copies share four fifths of their shingles of five words.
NEAR_WORDS, NEAR_PERCENT = 5, 80
#: Passages of more than 50 words that repeat are taken out where they are not in the document with the smallest id.
PASSAGE_WORDS = 50


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_fluent(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    docs, row = rows.keyed(docs)
    judged = quality.classify(docs, _labels(spark, sf_dir), keep=[row])
    return rows.without(docs, stage(judged.where("rejected").select(row), "rejected"), row).drop(row)


def keep_civil(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not predicted to be toxic."""
    docs, row = rows.keyed(docs)
    scored = toxicity.score(docs, _labels(spark, sf_dir), keep=[row])
    return rows.without(docs, stage(scored.where("predicted = 1").select(row), "rejected", TEXT_ROWS), row).drop(row)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies.

    Rows are the nodes of the join, so repeated rows and rows without an id are copies like any others; a row without an
    id stays only if no row of its component has one."""
    docs, row = rows.keyed(docs)
    found = jaccard.join(docs.select(F.col(row).alias("doc_id"), "text"), NEAR_WORDS, NEAR_PERCENT)
    found = stage(found.select(F.col("doc_id").alias("node"), "component_id"), "components")
    # rows alone in their component are not looked at again
    copied = found.where("component_id <> node").select("component_id").distinct()
    groups = found.join(copied, "component_id").join(docs.select(F.col(row).alias("node"), "doc_id"), "node")
    groups = stage(groups.select("component_id", "node", F.col("doc_id").isNull().alias("nameless"), "doc_id"), "groups")
    least = groups.groupBy("component_id").agg(F.min(F.struct("nameless", "doc_id", "node")).alias("first"))
    copies = groups.join(least.select(F.col("first.node").alias("node")), "node", "left_anti").select("node")
    return rows.without(docs, stage(copies, "rejected"), row).drop(row)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a document with a smaller id has too; untouched texts stay as they are."""
    names = [c if c in ("doc_id", "text") else f"column_{i}" for i, c in enumerate(docs.columns)]
    done = substrings.dedup(docs.toDF(*names), PASSAGE_WORDS, original=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    length = F.when(F.col("n_removed") > 0, F.length("kept").cast("long"))
    found = {"text": text, "n_chars": length.otherwise(F.col(names[docs.columns.index("n_chars")]))}
    return done.select(*(found.get(c, F.col(n)).alias(c) for c, n in zip(docs.columns, names, strict=True)))


def into_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Training sequences of the documents that are left."""
    return packing.pack_documents(docs)


STAGES = [
    ("quality classifier", keep_fluent),
    ("toxicity", keep_civil),
    ("n-gram Jaccard join", keep_one_of_each),
    ("substring dedup", without_passages),
    ("best-fit packing", into_sequences),
]

#: The models are trained and scores are real numbers, which SQL cannot follow; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        docs = stage(function(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
