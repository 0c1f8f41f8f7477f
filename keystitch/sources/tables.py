"""Tables on shared storage: key scans, staged intermediate tables and the swap of a new version."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


#: Folder of the run that is being prepared, for its intermediate tables.
_RUN: ContextVar[str | None] = ContextVar("run folder", default=None)
#: Texts that a worker gets at a time. Batches of Spark's 10,000 texts are buffers of tens of MB in the executor and again
#: in the worker, and neither gives all of that back.
TEXT_ROWS = 1000


def scan_keys(table: DataFrame, source_key: str, key: str | None = None) -> DataFrame:
    """Only the key column; Parquet and JDBC scans then read nothing else."""
    return table.select(F.col(source_key).alias(key or source_key))


def shared_dir(spark: SparkSession) -> str:
    """Shared folder the cluster names in `spark.checkpoint.dir`; where that is unset, one in the
    warehouse, which every session has and all executors reach."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/keystitch-staged"
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    return f"{_RUN.get() or shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession, run: str, journal: str) -> Iterator[str]:
    """Within the block, `new_folder` and `stage` use one folder, named after the run and its journal. It goes with the
    block, however that ends; what a killed process left of it goes at the start."""
    path = f"{shared_dir(spark)}/{run}-{hashlib.sha256(journal.encode()).hexdigest()[:16]}"
    drop_folder(spark, path)
    before = _RUN.set(path)
    try:
        yield path
    finally:
        _RUN.reset(before)
        drop_folder(spark, path)


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stage(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back.

    Later steps then neither recompute it nor depend on the executors that made it, read only the
    columns they use, and see its real size when they choose between a broadcast and a shuffle. Shuffle files of the
    write go with it; otherwise they stay until the driver happens to collect garbage. `batch_rows` is the number of
    rows that Python gets at a time, where rows are as long as texts.
    """
    spark, path = df.sparkSession, new_folder(df.sparkSession, name)
    with ExitStack() as settings:
        settings.enter_context(_setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"))
        if batch_rows:
            settings.enter_context(_setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows)))
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def counted(df: DataFrame, write, **counters: Column):
    """What `write(df)` returns, and the values of some aggregates of `df` that the write itself adds up.

    The counters come with the tasks of the write, so no second scan finds them. Sums of no rows are 0."""
    seen = Observation()
    zero = F.lit(0).cast("long")
    found = write(df.observe(seen, *[F.coalesce(c, zero).alias(n) for n, c in counters.items()]))
    # a plan that turns out to be empty may end without its counters
    return found, {n: (seen.get or {}).get(n) or 0 for n in counters}


def stage_counted(df: DataFrame, name: str, **counters: Column) -> tuple[DataFrame, dict[str, int]]:
    return counted(df, lambda rows: stage(rows, name), **counters)


def drop_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that `new_folder` or `stage` made, through the file system Spark uses."""
    folder, system = _at(spark, path)
    system.delete(folder, True)


def _at(spark: SparkSession, path: str):
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder, folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def replace_folder(spark: SparkSession, new: str, path: str) -> None:
    """Put the complete folder `new` in the place of `path`.

    The old folder is moved aside first and removed last, so that at any moment one complete folder exists; where the
    new one cannot be moved in, the old one goes back."""
    source, system = _at(spark, new)
    target, _ = _at(spark, path)
    old, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.old")
    there = system.exists(target)
    if there and not system.rename(target, old):
        raise RuntimeError(f"{path} could not be moved aside; {new} is complete")
    moved = False
    try:
        moved = system.rename(source, target)
    finally:
        if there and not moved:
            system.rename(old, target)
    if not moved:
        raise RuntimeError(f"{new} is complete but could not be moved to {path}")
    if there:
        system.delete(old, True)


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file that is there whole or not at all."""
    target, system = _at(spark, path)
    part, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = system.create(part)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not system.rename(part, target):
        raise RuntimeError(f"{path} could not be written; is it there already?")


def read_text(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder, system = _at(spark, path)
    return system.exists(folder)


def names_in(spark: SparkSession, path: str, folders: bool) -> list[str]:
    """Names of the folders, or of the files, right below a folder; none if it does not exist."""
    folder, system = _at(spark, path)
    found = system.listStatus(folder) if system.exists(folder) else []
    return [f.getPath().getName() for f in found if f.isDirectory() == folders]


def folders_in(spark: SparkSession, path: str) -> list[str]:
    return names_in(spark, path, True)


def partitioned(spark: SparkSession, table: str) -> bool:
    return any(c.isPartition for c in spark.catalog.listColumns(table))


def table_location(spark: SparkSession, table: str) -> str:
    return spark.sql(f"DESCRIBE FORMATTED {table}").where("col_name = 'Location'").first()["data_type"]


def point_table(spark: SparkSession, table: str, path: str) -> None:
    """Let an unpartitioned catalog table read the files at `path`."""
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)


def swap_table(df: DataFrame, table: str, base: str) -> DataFrame:
    """Replace a catalog table: write a complete new copy below `base`, then point the table to it.

    The table may be read by `df` itself. A failed write leaves the old copy in place, and readers
    see either the old or the new one. The partitions of a partitioned table have places of their
    own, which stay behind when the table moves; such a table is refused, see `overwrite_partitions`.
    """
    spark = df.sparkSession
    if spark.catalog.tableExists(table) and partitioned(spark, table):
        raise ValueError(f"{table} is partitioned; replace its partitions instead")
    path = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    if spark.catalog.tableExists(table):
        point_table(spark, table, path)
    else:
        spark.catalog.createTable(table, path=path, source="parquet", schema=df.schema)
    return spark.table(table)


def overwrite_partitions(df: DataFrame, table: str) -> None:
    """Replace the partitions of a catalog table that `df` has rows for, and no others.

    `df` holds these partitions whole, has the columns of the table in order, and must not read the
    table itself, so stage it first. A run that fails can be repeated from the staged rows.
    """
    spark = df.sparkSession
    parts = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    if parts:
        # few files a partition, whatever tasks the rows come from
        df = df.hint("rebalance", *parts)
    # only the session setting counts here: insertInto does not look at writer options
    with _setting(spark, "spark.sql.sources.partitionOverwriteMode", "dynamic"):
        df.write.insertInto(table, overwrite=True)


def empty_table(spark: SparkSession, schema: StructType, path: str, partition_by: str | None = None) -> None:
    """Create an empty Parquet table at `path` unless something is there already."""
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
