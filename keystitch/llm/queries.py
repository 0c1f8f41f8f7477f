"""The queries of the document operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from keystitch.llm import ann, bpe, interactions, jaccard, negatives, packing, quality, secretscan, substrings, suffixes, topk, toxicity, warc

#: The files of public tokenizers are a setting of the site; nothing is copied from there.
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


QUERIES = {
    "op2_warc": lambda spark, sf_dir: warc.archive(_table(spark, sf_dir, "pages")),
    "op3_packing": lambda spark, sf_dir: packing.pack_documents(_table(spark, sf_dir, "documents")),
    "op4_topk": lambda spark, sf_dir: topk.search(_table(spark, sf_dir, "embeddings")),
    "op5_substrings": lambda spark, sf_dir: substrings.digests(_table(spark, sf_dir, "documents")),
    "op7_suffixes": lambda spark, sf_dir: suffixes.digests(_table(spark, sf_dir, "documents")),
    "op8_toxicity": lambda spark, sf_dir: toxicity.score(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ),
    "op9_jaccard": lambda spark, sf_dir: jaccard.linked(_table(spark, sf_dir, "documents")),
    "op10_quality": lambda spark, sf_dir: quality.classify(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ),
    "op6_ann": lambda spark, sf_dir: ann.search(_table(spark, sf_dir, "embeddings")),
    "op1_bpe": lambda spark, sf_dir: bpe.digests(_table(spark, sf_dir, "documents"), WORD_BPE),
    "op11_interactions": lambda spark, sf_dir: interactions.audit(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    ),
    "op12_negatives": lambda spark, sf_dir: negatives.mine(_table(spark, sf_dir, "embeddings")),
    "op13_secrets": lambda spark, sf_dir: secretscan.scan(_table(spark, sf_dir, "documents")),
}

#: DuckDB SQL of the queries that SQL can express.
ORACLES: dict[str, str] = {
    "op4_topk": topk.SEARCH_SQL,
    "op5_substrings": substrings.DIGESTS_SQL,
    "op9_jaccard": jaccard.LINKED_SQL,
    "op11_interactions": interactions.AUDIT_SQL,
    "op12_negatives": negatives.MINE_SQL,
}
