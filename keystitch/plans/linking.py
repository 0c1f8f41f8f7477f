"""Link documents and movements."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.operators.links import DOCUMENT_LINK, MOVEMENT_LINK, link_documents, link_movements
from keystitch.operators.reports import link_counts, link_summary
from keystitch.sources.tables import stage


@dataclass(frozen=True)
class LinkRun:
    """`new_*` are the rows to append; the two tables are the old links with them."""

    new_document_links: DataFrame
    new_movement_links: DataFrame
    document_links: DataFrame
    movement_links: DataFrame
    counts: DataFrame
    summary: DataFrame


def _stored(new: DataFrame, columns: list[str]) -> DataFrame:
    return new.select(*columns, F.lit(1).alias("active"))


def link_all(
    documents: DataFrame,
    maintenances: DataFrame,
    accidents: DataFrame,
    document_links: DataFrame,
    movements: DataFrame,
    units: DataFrame,
    movement_links: DataFrame,
) -> LinkRun:
    """New links of both kinds, and the report. A second run adds nothing."""
    started = time.monotonic()
    new_documents = stage(link_documents(documents, maintenances, accidents, document_links), "document-links")
    new_movements = stage(link_movements(movements, units, movement_links), "movement-links")
    counts = link_counts(document_links, new_documents, movement_links, new_movements)
    documents_to_append = _stored(new_documents, DOCUMENT_LINK)
    movements_to_append = _stored(new_movements, MOVEMENT_LINK)
    return LinkRun(
        documents_to_append,
        movements_to_append,
        document_links.unionByName(documents_to_append, allowMissingColumns=True),
        movement_links.unionByName(movements_to_append, allowMissingColumns=True),
        counts,
        link_summary(counts, elapsed=time.monotonic() - started),
    )


def link_tables(
    spark: SparkSession,
    documents: str,
    maintenances: str,
    accidents: str,
    document_links: str,
    movements: str,
    units: str,
    movement_links: str,
) -> LinkRun:
    """`link_all` over catalog tables; the new links are appended to the two link tables, whose other columns are NULL
    there. Where there are no new links of a kind, its table is not written."""
    names = (documents, maintenances, accidents, document_links, movements, units, movement_links)
    run = link_all(*map(spark.table, names))
    counts = run.counts.select("documents.delta", F.col("movements.delta").alias("other")).first()
    for new, name, number in (
        (run.new_document_links, document_links, counts["delta"]),
        (run.new_movement_links, movement_links, counts["other"]),
    ):
        if number:
            table = spark.table(name)
            columns = [
                (F.col(f.name) if f.name in new.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in table.schema
            ]
            new.select(*columns).write.insertInto(name)
    return run
