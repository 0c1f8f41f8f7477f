"""A run over several tables that is decided as a whole and goes on where it was cut off.

A journal is a folder with one folder a run, in order. A run first prepares a complete new version of every table, beside
the old ones, and notes each when it is done. One file then decides the run: before it is there no table has changed,
after it all will. What is left to do then is to point tables to versions that are written, and to repeat it is harmless.
The next call finishes a run that was cut off, before or after that file, and prepares again only what was not noted.

Intermediate tables of a run lie in one folder, which goes when the run has prepared its versions, or when the next call
takes up a run that was cut off. Only one process may work on a journal at a time, and only runs of the journal may
write its tables; a version prepared against a table that was pointed elsewhere since is prepared again.
"""

from __future__ import annotations

import json
import time
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from keystitch.operators.reports import counts_row, sync_report, sync_summary
from keystitch.plans.quarantine import with_pending, write_rejects
from keystitch.plans.sync import TablesRun, fitting, sync_table
from keystitch.sources.specs import TableSpec
from keystitch.sources.tables import (
    drop_folder,
    folder_exists,
    folders_in,
    names_in,
    overwrite_partitions,
    partitioned,
    point_table,
    put_text,
    read_text,
    replace_folder,
    run_folder,
    table_location,
)


@dataclass(frozen=True)
class Version:
    """What a run has prepared for one table. `path` is None where nothing changes; `store` and `rejects` are the folder
    of rejected rows and the one that is to take its place, if rejected rows are kept."""

    name: str
    target: str
    before: str
    path: str | None
    blocks: bool
    counts: dict[str, int]
    store: str | None = None
    rejects: str | None = None


@dataclass(frozen=True)
class Run:
    spark: SparkSession
    folder: str
    name: str

    def _path(self, note: str) -> str:
        return f"{self.folder}/{self.name}/{note}.json"

    def has(self, note: str) -> bool:
        return folder_exists(self.spark, self._path(note))

    def get(self, note: str):
        return json.loads(read_text(self.spark, self._path(note)))

    def put(self, note: str, content) -> None:
        put_text(self.spark, self._path(note), json.dumps(content))

    def drop(self, note: str) -> None:
        drop_folder(self.spark, self._path(note))


def last_run(spark: SparkSession, journal: str) -> Run | None:
    names = folders_in(spark, journal)
    return Run(spark, journal, max(names)) if names else None


def _taken_up(spark: SparkSession, journal: str, synced_at: datetime | str) -> Run:
    """The run that was cut off, or else a new one."""
    last = last_run(spark, journal)
    if last is not None and not last.has("done"):
        run = last
    else:
        number = int(last.name.removeprefix("run-")) + 1 if last else 1
        run = Run(spark, journal, f"run-{number:08d}")
    if not run.has("begin"):
        run.put("begin", {"synced_at": str(synced_at)})
    return run


def _prepared(
    run: Run, spec: TableSpec, read_source: Callable[[TableSpec], DataFrame], base: str, rejects: str | None
) -> Version:
    spark, note, before = run.spark, f"table-{spec.target}", table_location(run.spark, spec.target)
    if run.has(note):
        noted = Version(**run.get(note))
        if noted.before == before:
            return noted
        run.drop(note)
    spec = fitting(spec, spark.table(spec.target))
    if spec.block_size is None and partitioned(spark, spec.target):
        raise ValueError(f"{spec.target} is partitioned, and not by blocks of its key")
    source, target, at = read_source(spec), spark.table(spec.target), run.get("begin")["synced_at"]
    store = new = None
    if rejects is None:
        found = sync_table(source, target, spec, at)
    else:
        store = f"{rejects}/{spec.target}"
        new = f"{store}.{run.name}.new"
        source, again = with_pending(source, spec, store)
        found = sync_table(source, target, spec, at, again=again, keep_source=True)
        # an earlier try may have left part of it
        drop_folder(spark, new)
        write_rejects(found.rejects, spec, store, at, new)
    path = None
    if found.counts["inserted"] + found.counts["updated"]:
        path = f"{base}/{spec.target}/{run.name}"
        found.table.write.mode("overwrite").parquet(path)
    version = Version(spec.name, spec.target, before, path, spec.block_size is not None, found.counts, store, new)
    run.put(note, asdict(version))
    return version


def _publish(run: Run, version: Version) -> None:
    """Make a prepared version the table; what has been done already is skipped or done again."""
    spark, path, note = run.spark, version.path, f"published-{version.target}"
    if path is not None and not version.blocks:
        point_table(spark, version.target, path)
    elif path is not None:
        # noted before the folder goes: half a folder must never be taken for the blocks
        if not run.has(note):
            rows = spark.read.schema(spark.table(version.target).schema).parquet(path)
            overwrite_partitions(rows, version.target)
            run.put(note, {})
        drop_folder(spark, path)
    if version.rejects is not None and folder_exists(spark, version.rejects):
        replace_folder(spark, version.rejects, version.store)


def sync_together(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    read_source: Callable[[TableSpec], DataFrame],
    base: str,
    synced_at: datetime | str,
    journal: str,
    rejects: str | None = None,
) -> TablesRun:
    """As `sync_run`, but no table changes before all are prepared, and a run that was cut off is finished instead.

    A run that goes on keeps its own time of synchronisation and the versions it has noted; its report covers them. Where
    it was decided already, `specs` do not count any more. Call again for a run over the present sources.
    """
    started = time.monotonic()
    run = _taken_up(spark, journal, synced_at)
    if not run.has("commit"):
        with run_folder(spark, run.name, journal):
            versions = [_prepared(run, spec, read_source, base, rejects) for spec in specs]
        run.put("commit", [asdict(v) for v in versions])
    versions = [Version(**v) for v in run.get("commit")]
    for version in versions:
        _publish(run, version)
    run.put("done", {})
    report = sync_report([counts_row(spark, v.counts, v.name) for v in versions])
    return TablesRun(report, sync_summary(report, elapsed=time.monotonic() - started))


def abandon(spark: SparkSession, journal: str) -> None:
    """Give up a run that was cut off before it was decided: its versions go, and no table has changed."""
    run = last_run(spark, journal)
    if run is None or run.has("done"):
        return
    if run.has("commit"):
        raise ValueError(f"{run.name} is decided and can only be finished")
    with run_folder(spark, run.name, journal):
        pass
    notes = names_in(spark, f"{journal}/{run.name}", folders=False)
    for note in (n.removesuffix(".json") for n in notes if n.startswith("table-") and n.endswith(".json")):
        version = Version(**run.get(note))
        for folder in (version.path, version.rejects):
            if folder is not None:
                drop_folder(spark, folder)
    run.put("done", {"abandoned": True})
