"""Sensor readings: renaming, validity, insertion and the counters of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.functions.hours import is_hour, normalize_hour
from keystitch.functions.numbers import finite, parse_number, whole
from keystitch.functions.text import script_trim
from keystitch.operators.merge import new_rows

READING_KEY = ["date", "hour", "tank_number"]


# Measures of a reading and their names in a response, one of them misspelt there.
MEASURES = {
    "volume": "volumen",
    "compensated_volume": "volumen_compensado",
    "height": "altura",
    "temperature": "temperatura",
    "water_volume": "volument_agua",
}


def map_readings(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Rename the response fields and give them their types; `date` stays text until it is checked."""
    hour = normalize_hour(script_trim(F.col("hora").cast("string")))
    tank = parse_number(F.col("numero_tanque").cast("string"))
    # Hour and tank come out of a generator: a later filter on them is then not pushed below it,
    # where the optimizer would write out the whole parse once per use.
    parsed = raw.select(
        *keep,
        "fecha",
        F.inline(F.array(F.struct(hour.alias("hour"), tank.alias("_tank")))),
        parse_number(F.col("status_actual").cast("string")).alias("_status"),
        *[parse_number(F.col(f).cast("string")).alias(name) for name, f in MEASURES.items()],
    )
    return parsed.select(
        *keep,
        F.col("fecha").alias("date"),
        "hour",
        whole(F.col("_tank")).alias("tank_number"),
        whole(F.col("_status")).alias("actual_status"),
        *[finite(F.col(name)).alias(name) for name in MEASURES],
    )


def is_valid_reading() -> Column:
    """Date and hour present, hour `HH:MM`, tank number above zero."""
    return (
        F.coalesce(F.col("date") != "", F.lit(False))
        & is_hour(F.col("hour"))
        & F.coalesce(F.col("tank_number") > 0, F.lit(False))
    )


def same_day(day: str = "dia") -> Column:
    """The reading is of the requested day; compared as text, before any cast."""
    return F.coalesce(F.col("date") == F.col(day), F.lit(False)) & F.col(day).try_cast("date").isNotNull()


def valid_readings(mapped: DataFrame, day: str = "dia") -> DataFrame:
    """Valid readings of their requested day, with `date` as a date."""
    good = mapped.filter(is_valid_reading() & same_day(day))
    return good.withColumn("date", F.col("date").try_cast("date"))


def new_readings(target: DataFrame, valid: DataFrame, order: Sequence[str]) -> DataFrame:
    """Readings to append: the first to arrive of each (date, hour, tank) the target does not have."""
    return new_rows(target, valid, READING_KEY, order)


def day_counts(mapped: DataFrame, target: DataFrame, day: str = "dia") -> DataFrame:
    """(day, fetched, valid, inserted, skipped) per requested day, by day.

    Counted per key first, which shrinks the rows before the only wide shuffle, so neither a busy
    day nor a much repeated reading lands on one task.
    """
    good = is_valid_reading() & same_day(day)
    per_key = (
        mapped.select(
            F.col(day).alias("day"),
            good.alias("good"),
            *[F.when(good, F.col(c)).alias(c) for c in ("hour", "tank_number")],
        )
        .withColumn("date", F.when(F.col("good"), F.col("day").try_cast("date")))
        .groupBy("day", "good", *READING_KEY)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = target.select(*READING_KEY).distinct().withColumn("_known", F.lit(True))
    return (
        per_key.join(known, READING_KEY, "left")
        .groupBy("day")
        .agg(
            F.sum("n").alias("fetched"),
            F.coalesce(F.sum(F.when(F.col("good"), F.col("n"))), F.lit(0)).alias("valid"),
            F.count_if(F.col("good") & F.col("_known").isNull()).alias("inserted"),
        )
        .withColumn("skipped", F.col("valid") - F.col("inserted"))
        .orderBy("day")
    )


def run_counts(mapped: DataFrame, new: DataFrame, day: str = "dia") -> DataFrame:
    """As `day_counts`, for a run that has its new rows at hand: no key is compared with the table again."""
    good = is_valid_reading() & same_day(day)
    read = mapped.groupBy(F.col(day).alias("day")).agg(
        F.count(F.lit(1)).alias("fetched"), F.count_if(good).alias("valid")
    )
    added = new.groupBy(F.col(day).alias("day")).agg(F.count(F.lit(1)).alias("inserted"))
    inserted = F.coalesce("inserted", F.lit(0))
    return read.join(added, "day", "left").select(
        "day", "fetched", "valid", inserted.alias("inserted"), (F.col("valid") - inserted).alias("skipped")
    )


def complete_days(counts: DataFrame, days: DataFrame) -> DataFrame:
    """Counts for every requested day; a day nothing was landed for has zeros."""
    names = ["fetched", "valid", "inserted", "skipped"]
    requested = days.select(F.col("day").cast("string").alias("day"))
    return requested.join(counts, "day", "left").select(
        "day", *[F.coalesce(F.col(c), F.lit(0)).alias(c) for c in names]
    ).orderBy("day")


def ingest_totals(counts: DataFrame, failed_days: DataFrame | None = None) -> DataFrame:
    """One row of totals. A failed day adds to `errors` and to nothing else."""
    names = ["fetched", "valid", "inserted", "skipped"]
    rows = counts.select("day", *names, F.lit(0).alias("failed"))
    if failed_days is not None:
        failed = failed_days.select(F.col("day").cast("string").alias("day"))
        rows = rows.join(failed, "day", "left_anti").unionByName(
            failed.select("day", *[F.lit(0).cast("bigint").alias(c) for c in names], F.lit(1).alias("failed"))
        )
    return rows.agg(
        F.count(F.lit(1)).alias("days"),
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in names],
        F.coalesce(F.sum("failed"), F.lit(0)).alias("errors"),
    )
