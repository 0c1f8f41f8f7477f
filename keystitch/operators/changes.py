"""What changed at the source: watermarks, modified rows and the change set."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keystitch.functions.stamps import has_stamp, modified_after, parse_stamp
from keystitch.operators.keys import last_per_key


def watermark_text(target: DataFrame, stamp: str) -> DataFrame:
    """One row `last_ts`: the greatest stamp by text order, '' if there is none.

    Stamps start with the month, so December of an old year beats January of a new one. The result
    is never later than the true maximum: a run from it reads too much, never too little.
    """
    return target.filter(has_stamp(F.col(stamp))).agg(
        F.coalesce(F.max(stamp), F.lit("")).alias("last_ts")
    )


def watermark_time(target: DataFrame, stamp: str) -> DataFrame:
    """One row `last_time`: the greatest stamp as a time, NULL if there is none."""
    return target.filter(has_stamp(F.col(stamp))).agg(F.max(parse_stamp(F.col(stamp))).alias("last_time"))


def text_as_time(watermark: DataFrame) -> DataFrame:
    return watermark.select(parse_stamp(F.col("last_ts")).alias("last_time"))


def modified_rows(source: DataFrame, stamp: str, watermark: Column) -> DataFrame:
    """Rows stamped strictly after the watermark, usually `watermark_time(...).scalar()`; none when it
    is NULL."""
    return source.filter(modified_after(F.col(stamp), watermark))


def stamps_after_load(source: DataFrame, target: DataFrame, key: str, stamp: str) -> DataFrame:
    """Stamps the target holds once the missing rows are in. A watermark over these can pass over
    rows that were edited before the newest inserted row; use it only to repeat that behaviour."""
    missing = source.select(key, stamp).join(target.select(key), key, "left_anti")
    return target.select(stamp).unionByName(missing.select(stamp))


def _modified(stamp: str | None, watermark: Column | None) -> Column:
    if stamp is None or watermark is None:
        return F.lit(False)
    return modified_after(F.col(stamp), watermark)


def change_keys(
    source: DataFrame,
    target: DataFrame,
    key: str,
    stamp: str | None = None,
    watermark: Column | None = None,
    again: DataFrame | None = None,
) -> DataFrame:
    """Keys to load: (key, copies, outcome, retried), one row per key.

    `inserted` for a key the target lacks, `updated` for a known key with a modified row, `rejected`
    for the NULL key. `copies` counts the source rows. Without stamp and watermark only missing keys
    are found. Keys in `again` are loaded whatever their stamp is, and marked as retried. Reads nothing but key and
    stamp of the source and the key of the target, so that the shuffle stays narrow however wide the tables are.
    """
    found = (
        source.select(key, _modified(stamp, watermark).alias("modified"))
        .groupBy(key)
        .agg(F.max("modified").alias("modified"), F.count(F.lit(1)).alias("copies"))
    )
    known = target.select(key).distinct().withColumn("_known", F.lit(True))
    outcome = (
        F.when(F.col(key).isNull(), "rejected")
        .when(F.col("_known").isNull(), "inserted")
        .when(F.col("modified") | F.col("retried"), "updated")
    )
    if again is None:
        found = found.withColumn("retried", F.lit(False))
    else:
        wanted = again.select(key).distinct().withColumn("_again", F.lit(True))
        found = found.join(wanted, key, "left").withColumn("retried", F.coalesce("_again", F.lit(False)))
    return (
        found.join(known, key, "left")
        .select(key, "copies", outcome.alias("outcome"), "retried")
        .filter(F.col("outcome").isNotNull())
    )


def change_rows(
    source: DataFrame,
    keys: DataFrame,
    key: str,
    stamp: str | None = None,
    watermark: Column | None = None,
    order: Sequence[str] = (),
) -> DataFrame:
    """Full rows of `change_keys` with their outcome, one per key.

    Of several source rows the last modified one wins, else the last one, by `order`. The source is
    first cut to the wanted keys; with few staged keys that is a filter against a broadcast, and only
    what is left is sorted. Each task passes on one row per key, so a much repeated key is never collected.
    """
    retried = F.col("retried") if "retried" in keys.columns else F.lit(False)
    wanted = keys.filter(F.col("outcome") != "rejected").select(key, "outcome", retried.alias("retried"))
    rows = source.filter(F.col(key).isNotNull()).withColumn("_modified", _modified(stamp, watermark))
    rows = last_per_key(rows.join(wanted.select(key), key, "left_semi"), [key], ["_modified", *order])
    wins = (F.col("outcome") == "inserted") | F.col("retried") | F.col("_modified")
    return rows.join(wanted, key).filter(wins).drop("_modified", "retried")


def change_counts(keys: DataFrame, name: str) -> DataFrame:
    """One report row of `change_keys`: (name, missing, inserted, updated, errors)."""
    copies, outcome = F.col("copies"), F.col("outcome")
    absent = outcome.isin("inserted", "rejected")
    return keys.agg(
        F.coalesce(F.sum(F.when(absent, copies)), F.lit(0)).alias("missing"),
        F.count_if(outcome == "inserted").alias("inserted"),
        F.count_if(outcome == "updated").alias("updated"),
        F.coalesce(F.sum(F.when(outcome == "rejected", copies)), F.lit(0)).alias("errors"),
    ).select(F.lit(name).alias("name"), "missing", "inserted", "updated", "errors")
