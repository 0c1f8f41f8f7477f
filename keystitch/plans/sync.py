"""Load what is missing or modified at the source."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.operators.changes import change_keys, change_rows, watermark_time
from keystitch.operators.keys import split_rejects
from keystitch.operators.merge import merge_rows, with_synced_at
from keystitch.operators.reports import COUNTERS, counts_row, sync_report, sync_summary
from keystitch.plans.quarantine import keep_rejects, with_pending
from keystitch.sources.specs import BLOCK, TableSpec, map_columns, misfit, with_block
from keystitch.sources.tables import overwrite_partitions, stage, stage_counted, swap_table


@dataclass(frozen=True)
class SyncRun:
    table: DataFrame
    report: DataFrame
    rejects: DataFrame
    good: DataFrame
    counts: dict[str, int]


def sync_table(
    source: DataFrame,
    target: DataFrame,
    spec: TableSpec,
    synced_at: datetime | str,
    order: Sequence[str] = (),
    checks: dict[str, Column] | None = None,
    again: DataFrame | None = None,
    keep_source: bool = False,
) -> SyncRun:
    """One table: missing and modified rows, upserted by key.

    1. The keys to load come from a narrow scan of both sides and are staged.
    2. The full rows of these keys are fetched, checked and staged. With few keys this is a broadcast
       filter over the source.
    3. The new table is the old one with the good rows merged in; with few rows again without a
       shuffle of the table.

    With a `block_size` the returned table holds only the blocks that change, and only they are read
    in the last step; `target` then has the column `key_block`.

    The watermark is read before anything is loaded, so no edit can fall between two runs. `order`
    names further source columns that tell which of several rows of a key is the last one. Rows that
    fail one of `checks` (by target column names), or do not fit the declared types, are rejected.

    Keys in `again` are loaded whatever their stamp is. With `keep_source` the rejects also hold the rows without a
    key, and each has its source row in the column `_source`.
    """
    key, stamp = spec.key, spec.modified_col
    ordinals = {f"_order_{i}": F.col(c) for i, c in enumerate(order)}
    extra = [c.alias(name) for name, c in ordinals.items()]
    if keep_source:
        extra.append(F.struct(*source.columns).alias("_source"))
    rows = map_columns(source, spec, keep=[*extra, misfit(source, spec).alias("_misfit")])
    watermark = stage(watermark_time(target, stamp), "watermark").scalar() if stamp else None
    outcome, copies = F.col("outcome"), F.col("copies")
    keys, found = stage_counted(
        change_keys(rows, target, key, stamp, watermark, again),
        "keys",
        missing=F.sum(F.when(outcome != "updated", copies)),
        keyless=F.sum(F.when(outcome == "rejected", copies)),
    )
    changed = change_rows(rows, keys, key, stamp, watermark, [*ordinals]).drop(*ordinals)
    changed = with_block(with_synced_at(changed, synced_at), spec)
    checks = {"value does not fit its type": F.col("_misfit").isNull()} | (checks or {})
    fits = F.col("reason").isNull()
    changed, applied = stage_counted(
        split_rejects(changed, checks).drop("_misfit"),
        "changes",
        inserted=F.count_if(fits & (outcome == "inserted")),
        updated=F.count_if(fits & (outcome == "updated")),
        rejected=F.count_if(~fits),
    )
    good = changed.filter(fits & outcome.isin("inserted", "updated")).drop("_source")
    rejects = changed.filter(~fits)
    if keep_source and found["keyless"]:
        keyless = rows.filter(F.col(key).isNull()).select("_source", F.lit("no key").alias("reason"))
        rejects = rejects.unionByName(keyless, allowMissingColumns=True)

    if "synced_at" not in target.columns:
        target = target.withColumn("synced_at", F.lit(None).cast("timestamp"))
    blocks = []
    if spec.block_size is not None:
        blocks = [BLOCK]
        target = target.join(good.select(BLOCK).distinct(), BLOCK, "left_semi").select(*target.columns)
    table = merge_rows(
        target,
        good.filter(F.col("outcome") == "updated"),
        good.filter(F.col("outcome") == "inserted"),
        key,
        [*spec.value_columns, "synced_at", *blocks],
    )
    counts = {
        "missing": found["missing"],
        "inserted": applied["inserted"],
        "updated": applied["updated"],
        "errors": found["keyless"] + applied["rejected"],
    }
    report = counts_row(source.sparkSession, {c: counts[c] for c in COUNTERS}, spec.name)
    return SyncRun(table, report, rejects, good, counts)


def fitting(spec: TableSpec, target: DataFrame) -> TableSpec:
    """The spec, without its blocks where the table has no column of them."""
    return spec if BLOCK in target.columns else replace(spec, block_size=None)


@dataclass(frozen=True)
class TablesRun:
    report: DataFrame
    summary: DataFrame


def sync_run(
    specs: Sequence[TableSpec],
    read_source: Callable[[TableSpec], DataFrame],
    base: str,
    synced_at: datetime | str,
    rejects: str | None = None,
) -> TablesRun:
    """Synchronise catalog tables one after the other; gives the report with its total, and the summary with the time
    it took.

    `read_source` gives the source table of a spec. `base` is the folder for the new versions of
    tables without blocks; a table with blocks is a partitioned one and changes in place. A table
    without changes is not written. `rejects` is a folder for the stores of rejected rows, one a table, that offer them
    again (see `keystitch.plans.quarantine`); a store changes after its table, so a run that fails in between
    offers a row once too often and never too seldom.
    """
    started, reports = time.monotonic(), []
    for spec in specs:
        source = read_source(spec)
        target, store = source.sparkSession.table(spec.target), f"{rejects}/{spec.target}"
        spec = fitting(spec, target)
        if rejects is None:
            run = sync_table(source, target, spec, synced_at)
        else:
            source, again = with_pending(source, spec, store)
            run = sync_table(source, target, spec, synced_at, again=again, keep_source=True)
        if not run.counts["inserted"] + run.counts["updated"]:
            pass
        elif spec.block_size is None:
            swap_table(run.table, spec.target, f"{base}/{spec.target}")
        else:
            overwrite_partitions(stage(run.table, "blocks"), spec.target)
        if rejects is not None:
            keep_rejects(run.rejects, spec, store, synced_at)
        reports.append(run.report)
    report = sync_report(reports)
    return TablesRun(report, sync_summary(report, elapsed=time.monotonic() - started))


def sync_tables(
    specs: Sequence[TableSpec],
    read_source: Callable[[TableSpec], DataFrame],
    base: str,
    synced_at: datetime | str,
    rejects: str | None = None,
) -> DataFrame:
    """The report of `sync_run`."""
    return sync_run(specs, read_source, base, synced_at, rejects).report
