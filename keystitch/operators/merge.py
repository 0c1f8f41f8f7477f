"""Table mutations as pure functions of the old table and the changes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.operators.keys import first_per_key, last_per_key


def with_synced_at(rows: DataFrame, synced_at: datetime | str) -> DataFrame:
    """Add the load time of the run, a parameter so that a repeated run gives the same rows."""
    return rows.withColumn("synced_at", F.lit(synced_at).cast("timestamp"))


def last_changes(changes: DataFrame, key: str, columns: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One change per key, the last one by `order`, so that target rows never multiply."""
    names = dict.fromkeys(c for c in (*columns, *order) if c != key)
    return last_per_key(changes.select(key, *names), [key], order).select(key, *columns)


def overwrite_rows(
    target: DataFrame, changes: DataFrame, key: str, columns: Sequence[str], flag: str | None = None
) -> DataFrame:
    """Target with `columns` replaced where `changes`, of one row per key, has the key; a NULL overwrites too. `flag`
    names a column to add that tells which rows were met.

    A left join: the target keeps its place and is not shuffled when the changes are small, and a
    skewed target partition can be split when they are not.
    """
    new = changes.select(key, F.struct(*columns).alias("_new"))
    hit = F.col("_new").isNotNull()

    def value(c: str) -> Column:
        return F.when(hit, F.col("_new")[c]).otherwise(F.col(c)).alias(c) if c in columns else F.col(c)

    met = [] if flag is None else [hit.alias(flag)]
    return target.join(new, key, "left").select(*[value(c) for c in target.columns], *met)


def merge_rows(
    target: DataFrame, updates: DataFrame, inserts: DataFrame, key: str, columns: Sequence[str]
) -> DataFrame:
    """Overwrite by `updates`, then append `inserts`; columns the inserts lack are NULL there."""
    kept = overwrite_rows(target, updates, key, columns)
    return kept.unionByName(inserts.select(key, *columns), allowMissingColumns=True)


def upsert(
    target: DataFrame,
    rows: DataFrame,
    key: str,
    columns: Sequence[str],
    synced_at: datetime | str | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Insert or overwrite rows by key. Of several rows of a key the last one by `order` wins; target
    columns that are not in `columns` stay as they are, and are NULL in new rows."""
    columns = [c for c in columns if c != key]
    rows = last_changes(rows, key, columns, order)
    if synced_at is not None:
        rows, columns = with_synced_at(rows, synced_at), [*columns, "synced_at"]
        if "synced_at" not in target.columns:
            target = target.withColumn("synced_at", F.lit(None).cast("timestamp"))
    inserts = rows.join(target.select(key), key, "left_anti")
    return merge_rows(target, rows, inserts, key, columns)


def upsert_outcome(target: DataFrame, rows: DataFrame, key: str) -> DataFrame:
    """(key, outcome): `inserted` or `updated` for every row an upsert would apply."""
    known = target.select(key).distinct().withColumn("_known", F.lit(True))
    outcome = F.when(F.col("_known").isNull(), "inserted").otherwise("updated")
    return rows.select(key).join(known, key, "left").select(key, outcome.alias("outcome"))


def new_rows(target: DataFrame, rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Rows an insert that skips conflicts would append: the first of each key, if the key is new."""
    first = first_per_key(rows, keys, order)
    return first.join(target.select(*keys), list(keys), "left_anti")


def patch(
    target: DataFrame,
    changes: DataFrame,
    key: str,
    columns: Sequence[str],
    order: Sequence[str] = (),
    flag: str | None = None,
) -> DataFrame:
    """Overwrite some columns of known keys; nothing is inserted and no load time is set. Of several
    changes of a key the last one by `order` counts."""
    return overwrite_rows(target, last_changes(changes, key, columns, order), key, columns, flag)


def delete_where(target: DataFrame, condition: Column) -> DataFrame:
    """Rows for which the condition is not true; a NULL condition keeps the row."""
    return target.filter(~F.coalesce(condition, F.lit(False)))
