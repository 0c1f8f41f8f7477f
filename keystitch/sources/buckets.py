"""Targets that never move: catalog tables bucketed and sorted by their key.

A bucketed table is laid out the way a shuffle by its key would lay it out. A join on the key therefore moves only the
other side, into as many partitions as there are buckets, and its result can be written as buckets again without a
shuffle. A bucket holds the keys of one hash, so each key stands in one file, however often it occurs.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.operators.merge import last_changes, with_synced_at
from keystitch.sources.tables import stage


def write_buckets(rows: DataFrame, table: str, path: str, key: str, buckets: int) -> DataFrame:
    """Make `rows` the catalog table `table` at `path`, in so many buckets by `key`, each of one sorted file."""
    dealt = rows.repartition(buckets, key)
    _save(dealt, table, path, key, buckets)
    return rows.sparkSession.table(table)


def _save(dealt: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    dealt.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)


def bucketing(spark: SparkSession, table: str) -> tuple[str, int]:
    """Key and number of buckets of a table; raises if it has none, or several key columns."""
    about = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    columns = about.get("Bucket Columns", "[]").strip("[]").replace("`", "").split(", ")
    if columns == [""] or len(columns) > 1:
        raise ValueError(f"{table} is not bucketed by one key")
    return columns[0], int(about["Num Buckets"])


def missing_keys_in(table: str, source_keys: DataFrame) -> DataFrame:
    """Source keys the bucketed table does not have, as often as the source has them. Only the keys of the source move."""
    spark = source_keys.sparkSession
    key, buckets = bucketing(spark, table)
    moved = source_keys.select(key).repartition(buckets, key)
    # a merge join takes both sides as they lie; a broadcast would send the whole target
    return moved.join(spark.table(table).select(key).hint("merge"), key, "left_anti")


def _met(table: str, rows: DataFrame, how: str) -> tuple[DataFrame, str, int]:
    """The target with a column `_new`, the struct of the row of its key or NULL, bucket by bucket."""
    spark = rows.sparkSession
    key, buckets = bucketing(spark, table)
    new = rows.select(F.col(key).alias("_key"), F.struct("*").alias("_new")).repartition(buckets, "_key")
    target = spark.table(table)
    # the flag tells a row without a key from no row at all
    held = target.select("*", F.lit(True).alias("_held")).hint("merge")
    return held.join(new, F.col(key) == F.col("_key"), how), key, buckets


def _overwritten(met: DataFrame, names: Sequence[str], key: str, columns: Sequence[str]) -> DataFrame:
    hit = F.col("_new").isNotNull()

    def value(c: str) -> Column:
        if c == key:
            return F.when(F.col("_held"), F.col(c)).otherwise(F.col("_key")).alias(c)
        return F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)

    return met.select(*[value(c) for c in names])


def upsert_in(
    table: str, rows: DataFrame, columns: Sequence[str], synced_at: datetime | str | None = None, order: Sequence[str] = ()
) -> DataFrame:
    """The bucketed table with rows inserted or overwritten by key, as `merge.upsert` does it, in one join.

    `rows` is reduced to the last row of each key and staged, as it is met by the table and no longer by its source."""
    spark = rows.sparkSession
    key, _ = bucketing(spark, table)
    columns = [c for c in columns if c != key]
    rows = last_changes(rows, key, columns, order)
    names = spark.table(table).columns
    if synced_at is not None:
        if "synced_at" not in names:
            raise ValueError(f"{table} has no column synced_at")
        rows, columns = with_synced_at(rows, synced_at), [*columns, "synced_at"]
    met, key, _ = _met(table, stage(rows, "upsert-rows"), "full_outer")
    return _overwritten(met, names, key, columns)


def patch_in(table: str, changes: DataFrame, columns: Sequence[str], order: Sequence[str] = ()) -> DataFrame:
    """The bucketed table with some columns of known keys overwritten, as `merge.patch` does it."""
    key, _ = bucketing(changes.sparkSession, table)
    changes = stage(last_changes(changes, key, columns, order), "patch-rows")
    met, key, _ = _met(table, changes, "left")
    return _overwritten(met, changes.sparkSession.table(table).columns, key, columns)


def replace_buckets(new: DataFrame, table: str, base: str) -> DataFrame:
    """Put `new`, which may read the table itself, in its place, in the same buckets.

    Rows of `upsert_in` and `patch_in` lie in these buckets already and are written without a shuffle. The new
    version is complete before the table points to it; the old one stays where it is until it is removed."""
    spark = new.sparkSession
    key, buckets = bucketing(spark, table)
    path, beside = f"{base.rstrip('/')}/{uuid.uuid4().hex}", f"{table}_{uuid.uuid4().hex}"
    _save(new, beside, path, key, buckets)
    # of an external table only the entry goes
    spark.sql(f"DROP TABLE {beside}")
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{path}'")
    spark.catalog.refreshTable(table)
    return spark.table(table)
