"""Operators on table keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def missing_keys(source_keys: DataFrame, target_keys: DataFrame, key: str) -> DataFrame:
    """Source keys the target does not have, as often as the source has them."""
    return source_keys.select(key).join(target_keys.select(key), key, "left_anti")


def fetch_rows(source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Full source rows of the given keys."""
    return source.join(keys.select(key), key, "left_semi")


def _top_row(rows: DataFrame, keys: Sequence[str], order: Sequence[str], direction) -> DataFrame:
    # Spark turns a row number limited to one into a group limit before the shuffle: each map task
    # passes on one row per key, so a key with a third of all rows costs no more than any other.
    # The remaining columns break ties, so that a task that is run again makes the same choice.
    rest = [c for c in rows.columns if c not in keys and c not in order]
    window = Window.partitionBy(*keys).orderBy(*[direction(c) for c in (*order, *rest)])
    return rows.withColumn("_n", F.row_number().over(window)).filter(F.col("_n") == 1).drop("_n")


def last_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key in the given order, as ordered upserts leave it."""
    return _top_row(rows, keys, order, F.desc_nulls_last)


def first_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each key in the given order, as ordered inserts that skip conflicts leave it."""
    return _top_row(rows, keys, order, F.asc_nulls_first)


def split_rejects(rows: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Add `reason`: the name of the first check a row fails, NULL for a good row.

    A check that is NULL has failed. One pass; filter on `reason` for either part.
    """
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return rows.withColumn("reason", F.coalesce(*failed, F.lit(None).cast("string")))


def reject_sample(rejects: DataFrame, key: str, n: int = 3) -> DataFrame:
    """A few rejected rows for the log."""
    return rejects.filter(F.col("reason").isNotNull()).orderBy(key).limit(n)
