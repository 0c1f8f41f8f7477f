"""Snapshot a set of tables, one of them filtered by date, and restore it elsewhere."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import MapType, StructType

from keystitch.operators.reports import union_all
from keystitch.sources.csvfiles import read_csv_gz, write_csv_gz
from keystitch.sources.tables import counted, drop_folder, folders_in, replace_folder

#: Folder of a snapshot that tells what each table held when it was written.
MANIFEST = "snapshot-manifest"
_MANIFEST_ROW = "table string, columns int, rows long, structure_only boolean, content string"


def content(table: DataFrame) -> dict[str, Column]:
    """Aggregates that tell whether two tables hold the same rows, in any order and as often: the number of rows, and
    two sums of 64-bit hashes of whole rows. NULL, '' and a value in the next column are all different."""

    def plain(name: str, kind) -> Column:
        return F.array_sort(F.map_entries(name)) if isinstance(kind, MapType) else F.col(name)

    parts = [x for f in table.schema for x in (F.col(f"`{f.name}`").isNull(), plain(f"`{f.name}`", f.dataType))]

    def total(seed: int) -> Column:
        return F.sum(F.xxhash64(F.lit(seed), *parts).cast("decimal(38,0)"))

    return {"rows": F.count(F.lit(1)), "one": total(1), "two": total(2)}


def _written(table: DataFrame, write) -> dict[str, object]:
    """Number of rows and content of what `write` writes, from the write itself."""
    found = counted(table, write, **content(table))[1]
    return {"rows": int(found["rows"]), "content": f"{found['one']}:{found['two']}"}


def _save_manifest(spark: SparkSession, rows: list[tuple], path: str) -> None:
    spark.createDataFrame(rows, _MANIFEST_ROW).coalesce(1).write.parquet(path)


def rows_since(table: DataFrame, column: str, floor: date | str) -> DataFrame:
    """Rows on or after a day; the comparison is left bare so that it reaches the Parquet scan."""
    kind = table.schema[column].dataType.simpleString()
    return table.filter(F.col(column) >= F.lit(str(floor)).cast(kind))


def export_since(table: DataFrame, column: str, floor: date | str, path: str, name: str = "export") -> None:
    """Write the rows since a day as CSV, and beside the folder, under its name and `-manifest`, what they hold."""
    rows = rows_since(table, column, floor)
    held = _written(rows, lambda df: write_csv_gz(df, path))
    entry = (name, len(rows.columns), held["rows"], False, held["content"])
    _save_manifest(table.sparkSession, [entry], f"{path.rstrip('/')}-manifest")


def write_snapshot(tables: Mapping[str, DataFrame], folder: str, structure_only: Iterable[str] = ()) -> None:
    """Write every table below `folder`, and a manifest of what they hold; those named in `structure_only` keep their
    schema but no rows."""
    bare, entries = set(structure_only), []
    for name, table in tables.items():
        kept = table.limit(0) if name in bare else table
        held = _written(kept, lambda df, name=name: df.write.parquet(f"{folder}/{name}"))
        entries.append((name, len(table.columns), held["rows"], name in bare, held["content"]))
    _save_manifest(table.sparkSession, entries, f"{folder}/{MANIFEST}")


def read_snapshot(spark: SparkSession, folder: str, names: Iterable[str]) -> dict[str, DataFrame]:
    return {name: spark.read.parquet(f"{folder}/{name}") for name in names}


def snapshot_manifest(tables: Mapping[str, DataFrame], structure_only: Iterable[str] = ()) -> DataFrame:
    """(table, columns, rows, structure_only) of each table of a snapshot."""
    bare = set(structure_only)
    return union_all(
        [
            t.agg(F.count(F.lit(1)).alias("rows")).select(
                F.lit(name).alias("table"),
                F.lit(len(t.columns)).alias("columns"),
                "rows",
                F.lit(name in bare).alias("structure_only"),
            )
            for name, t in tables.items()
        ]
    )


def restore_table(spark: SparkSession, source: str, target: str, schema: StructType | None = None) -> DataFrame:
    """Replace what is at `target` by a snapshot table, or by a CSV export if a schema is given.

    The rows are written beside it first, so that a load that fails leaves the old table as it is."""
    rows = spark.read.parquet(source) if schema is None else read_csv_gz(spark, source, schema)
    beside = f"{target}.{uuid.uuid4().hex}"
    rows.write.parquet(beside)
    replace_folder(spark, beside, target)
    return spark.read.parquet(target)


def restore_snapshot(
    spark: SparkSession,
    folder: str,
    names: Iterable[str],
    target: str,
    exports: Mapping[str, str] | None = None,
) -> dict[str, DataFrame]:
    """Replace the tables below `target` by those of a snapshot; tables the snapshot lacks are removed
    once all others are in place.

    `exports` gives for some tables the folder of a filtered CSV export to load instead; the snapshot
    then only provides their schema.
    """
    exports = exports or {}
    if any(f"{p}/".startswith(f"{target.rstrip('/')}/") for p in (folder, *exports.values())):
        raise ValueError("the snapshot lies below the target and would be removed")
    restored = {}
    for name, held in read_snapshot(spark, folder, names).items():
        schema = held.schema if name in exports else None
        source = exports.get(name, f"{folder}/{name}")
        restored[name] = restore_table(spark, source, f"{target}/{name}", schema)
    for name in folders_in(spark, target):
        if name not in restored:
            drop_folder(spark, f"{target}/{name}")
    return restored


def verify_restore(
    spark: SparkSession,
    folder: str,
    restored: Mapping[str, DataFrame],
    exports: Mapping[str, str] | None = None,
    ids: Mapping[str, str] | None = None,
) -> DataFrame:
    """(table, expected, found, same, next_base) for each table of the snapshot, and for each restored one it lacks.

    `expected` rows are those of the manifest, or of the export a table was loaded from; `same` tells whether the
    content is the same row for row, false where a table is missing on either side. `next_base` is the start value of
    the key generator of a table whose id column `ids` names. Each restored table is scanned once.
    """
    exports, ids = exports or {}, ids or {}
    said = spark.read.parquet(f"{folder}/{MANIFEST}").where(~F.col("table").isin(*exports) if exports else F.lit(True))
    for name, path in exports.items():
        own = spark.read.parquet(f"{path.rstrip('/')}-manifest")
        said = said.unionByName(own.withColumn("table", F.lit(name)))
    zero, found = F.lit(0).cast("decimal(38,0)"), []
    for name, table in restored.items():
        sums = content(table)
        base = F.coalesce(F.max(ids[name]), F.lit(1)) if name in ids else F.lit(None)
        text = F.concat_ws(":", *[F.coalesce(sums[c], zero).cast("string") for c in ("one", "two")])
        found.append(
            table.agg(sums["rows"].alias("found"), text.alias("held"), base.cast("bigint").alias("next_base")).select(
                F.lit(name).alias("table"), "found", "held", "next_base"
            )
        )
    both = said.join(union_all(found), "table", "full_outer")
    same = F.coalesce((F.col("held") == F.col("content")) & (F.col("found") == F.col("rows")), F.lit(False))
    return both.select("table", F.col("rows").alias("expected"), "found", same.alias("same"), "next_base")
