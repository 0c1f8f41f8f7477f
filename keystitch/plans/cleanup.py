"""Look at the malformed hours, and remove them when told to."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.operators.quality import (
    bad_hour_by_date,
    bad_hour_count,
    bad_hour_profile,
    bad_hour_sample,
    bad_hours,
    without_bad_hours,
)
from keystitch.sources.tables import overwrite_partitions, stage


@dataclass(frozen=True)
class CleanupRun:
    table: DataFrame
    count: DataFrame
    sample: DataFrame
    by_date: DataFrame
    profile: DataFrame


def clean_hours(table: DataFrame, execute: bool = False) -> CleanupRun:
    """Report on the malformed rows; the returned table is the old one unless `execute` is set.

    The malformed rows are staged, so the four reports scan the table once.
    """
    bad = stage(bad_hours(table), "bad-hours")
    return CleanupRun(
        without_bad_hours(table) if execute else table,
        bad_hour_count(bad),
        bad_hour_sample(bad),
        bad_hour_by_date(bad),
        bad_hour_profile(bad),
    )


def clean_table(spark: SparkSession, name: str) -> CleanupRun:
    """Remove the malformed rows of a catalog table partitioned by `date`; only days that have some are rewritten, so a
    second run changes no file."""
    table = spark.table(name)
    run = clean_hours(table)
    days = run.by_date.select("date")
    touched = table.join(days, table["date"].eqNullSafe(days["date"]), "left_semi").select(*table.columns)
    kept = stage(without_bad_hours(touched), "kept-hours")
    if run.count.first().total:
        overwrite_partitions(kept, name)
        # a day of which nothing is left is no partition of the new rows; there is a row a day at most
        left = kept.select("date").distinct()
        for day in days.join(left, days["date"].eqNullSafe(left["date"]), "left_anti").collect():
            spec = "null" if day["date"] is None else f"date'{day['date']}'"
            spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (date = {spec})")
        spark.catalog.refreshTable(name)
    return CleanupRun(spark.table(name), run.count, run.sample, run.by_date, run.profile)
