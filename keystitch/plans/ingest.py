"""Load landed sensor responses day by day."""

from __future__ import annotations

import time
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keystitch.functions.days import LOCAL_ZONE
from keystitch.operators.links import active
from keystitch.operators.ranges import manual_range, pending_days, range_after, range_warnings
from keystitch.operators.readings import (
    complete_days,
    ingest_totals,
    map_readings,
    new_readings,
    run_counts,
    valid_readings,
)
from keystitch.operators.reports import readings_summary
from keystitch.sources.responses import ARRIVAL, PLACE, explode_responses, failed_days, scan_bodies, with_place
from keystitch.sources.tables import folders_in, stage

READINGS_SCHEMA = T.StructType(
    [
        T.StructField("hour", T.StringType()),
        T.StructField("tank_number", T.IntegerType()),
        T.StructField("actual_status", T.IntegerType()),
        T.StructField("volume", T.DoubleType()),
        T.StructField("compensated_volume", T.DoubleType()),
        T.StructField("height", T.DoubleType()),
        T.StructField("temperature", T.DoubleType()),
        T.StructField("water_volume", T.DoubleType()),
        T.StructField("active", T.IntegerType()),
        T.StructField("date", T.DateType()),
    ]
)


@dataclass(frozen=True)
class IngestRun:
    day_counts: DataFrame
    totals: DataFrame
    summary: DataFrame


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """The readings table, partitioned by date."""
    return spark.read.schema(READINGS_SCHEMA).parquet(path)


def newest_active_day(spark: SparkSession, path: str) -> date | None:
    """The last day with an active reading of the table at `path`, None if there is none.

    The days are the names of its folders. Only the newest folder is read, and where it holds nothing active twice as
    many before it, and so on: old days are not opened, however many there are.
    """
    days = []
    for name in folders_in(spark, path):
        column, _, value = name.partition("=")
        try:
            if column == "date":
                days.append(date.fromisoformat(value))
        except ValueError:
            continue  # readings without a day
    if not days:
        return None
    days.sort()
    table, end, width = read_readings(spark, path), len(days), 1
    while end > 0:
        begin = max(0, end - width)
        some = table.filter(F.col("date").between(F.lit(days[begin]), F.lit(days[end - 1])))
        newest = active(some).agg(F.max("date")).first()[0]
        if newest is not None:
            return newest
        end, width = begin, 2 * width
    return None


def _one_day(spark: SparkSession, day: date | None) -> DataFrame:
    return spark.range(1).select(F.lit(day).cast("date").alias("last_date"))


def high_water_days(spark: SparkSession, path: str, now: datetime, zone: str = LOCAL_ZONE) -> DataFrame:
    """`high_water_range` of the table at `path`, from its newest folders alone."""
    return range_after(_one_day(spark, newest_active_day(spark, path)), now, zone)


def append_readings(new: DataFrame, path: str) -> None:
    """Append new readings. Rebalancing writes few files per day, and splits a day that is too big
    for one task."""
    rows = new.withColumn("active", F.lit(1)).select(*READINGS_SCHEMA.names)
    rows.hint("rebalance", "date").write.mode("append").partitionBy("date").parquet(path)


def ingest_readings(
    spark: SparkSession,
    landed: str,
    table: str,
    now: datetime,
    first: date | None = None,
    last: date | None = None,
    zone: str = LOCAL_ZONE,
) -> IngestRun:
    """Append the readings of the pending days, or of a given range, and count them per day.

    Both the responses and the table are pruned to these days. Runs can be repeated: a known
    (date, hour, tank_number) is skipped. A day without a landed body, or with an unreadable one, is
    a failed day: what can be read of it is loaded, and in the totals it counts as an error only.
    """
    started = time.monotonic()
    manual = first is not None or last is not None
    target = read_readings(spark, table)
    asked = manual_range(spark, first, last) if manual else high_water_days(spark, table, now, zone)
    span = range_warnings(asked).first()  # one row by construction
    low, high = span["from_day"], span["to_day"]

    bodies = scan_bodies(spark, landed).filter(F.col("day").between(str(low), str(high)))
    read = with_place(explode_responses(bodies, every_body=True))
    # the one scan of the bodies: what they hold, and the state of those that hold nothing
    read = stage(map_readings(read, keep=["dia", *ARRIVAL, PLACE, "pos", "unreadable", "given"]), "readings")
    failed = stage(failed_days(read, pending_days(asked), "dia"), "failed-days")
    mapped = read.filter(F.col("pos").isNotNull())
    known = target.filter(F.col("date").between(F.lit(low), F.lit(high)))
    new = stage(new_readings(known, valid_readings(mapped), [*ARRIVAL, PLACE]), "new-readings")
    counts = stage(complete_days(run_counts(mapped, new), pending_days(asked)), "day-counts")
    append_readings(new, table)

    done = None if manual else _one_day(spark, newest_active_day(spark, table))
    totals = ingest_totals(counts, failed)
    elapsed = time.monotonic() - started
    summary = readings_summary(totals, span, done, elapsed=elapsed)
    return IngestRun(counts.orderBy("day"), totals, summary)
