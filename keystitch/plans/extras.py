"""Bring the free-text columns of the documents up to date."""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.operators.extras import EXTRA_COLUMNS, changed_texts, rows_with_text
from keystitch.operators.merge import patch
from keystitch.operators.reports import counts_row, patch_summary
from keystitch.sources.tables import counted, stage, stage_counted, swap_table


@dataclass(frozen=True)
class PatchRun:
    """The patched table as it was written, and the summary of the run."""

    table: DataFrame
    counts: dict[str, int]
    summary: DataFrame


def patch_extras(
    source: DataFrame,
    target: DataFrame,
    source_key: str = "CIDDOCUMENTO",
    key: str = "document_id",
    columns: Mapping[str, str] = EXTRA_COLUMNS,
    write: Callable[[DataFrame], DataFrame] | None = None,
) -> PatchRun:
    """Overwrite the texts of the rows that differ. Texts that were all cleared at the source never
    arrive, as such a row is not read.

    `write` puts the new table where it belongs and returns it; by default it is staged. It is not called where nothing
    differs. The counters are those of the writes: `candidates` changes found, `updated` rows overwritten, and as
    `errors` the changes that met no row any more."""
    started = time.monotonic()
    names = list(columns.values())
    rows = rows_with_text(source, source_key, key, columns)
    found = changed_texts(rows, target, key, columns)
    changes, counts = stage_counted(found, "texts", candidates=F.count(F.lit(1)))
    table, counts["updated"] = target, 0
    if counts["candidates"]:
        flagged = patch(target, changes, key, names, flag="_met")

        def put(df: DataFrame) -> DataFrame:
            return (write or (lambda new: stage(new, "patched")))(df.drop("_met"))

        table, met = counted(flagged, put, updated=F.count_if("_met"))
        counts |= met
    counts["errors"] = max(0, counts["candidates"] - counts["updated"])
    row = counts_row(source.sparkSession, counts)
    return PatchRun(table, counts, patch_summary(row, elapsed=time.monotonic() - started))


def patch_table(spark: SparkSession, source: DataFrame, table: str, base: str) -> PatchRun:
    """Patch a catalog table; its new version goes below `base`. A table whose texts all agree is not written."""
    return patch_extras(source, spark.table(table), write=lambda new: swap_table(new, table, base))
