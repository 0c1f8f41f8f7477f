"""Which days a run has to load."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.functions.days import LOCAL_ZONE, day_span, yesterday
from keystitch.operators.links import active

# Fixed value: a run over more days than this gives a warning.
MANY_DAYS = 7


def high_water_range(target: DataFrame, now: datetime, zone: str = LOCAL_ZONE) -> DataFrame:
    """One row (last_date, from_day, to_day, empty, up_to_date): the day after the last active reading
    up to yesterday. An empty table asks for yesterday only. Holes further back are not seen."""
    return range_after(active(target).agg(F.max("date").alias("last_date")), now, zone)


def range_after(newest: DataFrame, now: datetime, zone: str = LOCAL_ZONE) -> DataFrame:
    """The row of `high_water_range` for a known last day, the one row (last_date) of `newest`."""
    last = F.col("last_date")
    return (
        newest.select(
            last,
            F.coalesce(F.date_add(last, 1), yesterday(now, zone)).alias("from_day"),
            yesterday(now, zone).alias("to_day"),
            last.isNull().alias("empty"),
        )
        .withColumn("up_to_date", F.col("from_day") > F.col("to_day"))
    )


def manual_range(spark: SparkSession, first: date | None, last: date | None) -> DataFrame:
    """One row as above for given bounds; a missing bound equals the other one."""
    first, last = first or last, last or first
    if first is None:
        raise ValueError("give at least one bound")
    if first > last:
        raise ValueError(f"range runs backwards: {first} > {last}")
    return spark.range(1).select(
        F.lit(None).cast("date").alias("last_date"),
        F.lit(first).alias("from_day"),
        F.lit(last).alias("to_day"),
        F.lit(False).alias("empty"),
        F.lit(False).alias("up_to_date"),
    )


def pending_days(day_range: DataFrame) -> DataFrame:
    """(day): one row per day of the range, none when it is up to date."""
    return day_range.select(F.explode(day_span(F.col("from_day"), F.col("to_day"))).alias("day"))


def range_warnings(day_range: DataFrame) -> DataFrame:
    """The range with its length and an array of warnings."""
    days = F.greatest(F.date_diff(F.col("to_day"), F.col("from_day")) + 1, F.lit(0))
    notes = F.array(
        F.when(
            F.col("empty"),
            F.format_string("The table is empty: only %s is loaded; give a range for older days.", "to_day"),
        ),
        F.when(F.col("days") > MANY_DAYS, F.format_string("%d days in one run (more than 7).", "days")),
    )
    return day_range.withColumn("days", days).withColumn("warnings", F.array_compact(notes))


def day_sequence(table: DataFrame, column: str) -> DataFrame:
    """(day): every day from the first to the last one of a date column."""
    ends = table.agg(F.min(column).alias("first"), F.max(column).alias("last"))
    return ends.select(F.explode(day_span(F.col("first"), F.col("last"))).alias("day"))


def missing_days(target: DataFrame) -> DataFrame:
    """(day): days between the first and the last active reading that have none."""
    live = active(target)
    return day_sequence(live, "date").join(
        live.select(F.col("date").alias("day")).distinct(), "day", "left_anti"
    )
