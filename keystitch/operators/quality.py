"""Malformed hours: count, look at, profile and remove."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.functions.hours import is_bad_hour
from keystitch.operators.merge import delete_where

# Fixed value: number of rows shown before a deletion.
SAMPLE_ROWS = 5


def bad_hours(table: DataFrame) -> DataFrame:
    return table.filter(is_bad_hour(F.col("hour")))


def bad_hour_count(table: DataFrame) -> DataFrame:
    return bad_hours(table).agg(F.count(F.lit(1)).cast("int").alias("total"))


def bad_hour_sample(table: DataFrame, n: int = SAMPLE_ROWS) -> DataFrame:
    """The newest malformed rows."""
    return bad_hours(table).orderBy(F.desc("id")).limit(n)


def bad_hour_by_date(table: DataFrame) -> DataFrame:
    per_day = bad_hours(table).groupBy("date").agg(F.count(F.lit(1)).cast("int").alias("rows"))
    return per_day.orderBy("date")


def bad_hour_profile(table: DataFrame) -> DataFrame:
    """One row: days affected, first and last day, fewest and most malformed rows of a day."""
    per_day = bad_hours(table).groupBy("date").agg(F.count(F.lit(1)).cast("int").alias("rows"))
    return per_day.agg(
        F.count(F.lit(1)).alias("days"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.min("rows").alias("min_rows"),
        F.max("rows").alias("max_rows"),
    )


def without_bad_hours(table: DataFrame) -> DataFrame:
    """The table after the deletion; rows without an hour stay."""
    return delete_where(table, is_bad_hour(F.col("hour")))
