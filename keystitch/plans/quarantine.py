"""A durable store of rejected source rows, which are offered again in the next run.

A rejected edit would be lost otherwise: once a later edit of another row is loaded, the watermark has passed it.

The store is a folder of Parquet: `entry` is the text of the source key, or a digest of the row where that is NULL;
`row` is the source row as JSON; `reason`, `first_run`, `last_run` and `attempts` tell its history. Each run offers all
entries, so the rejects of a run are the next store; a row that was mended, or fits looser checks, leaves it.
"""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from keystitch.sources.specs import TableSpec, map_columns
from keystitch.sources.tables import folder_exists, replace_folder

STORE = "entry string, reason string, row string, first_run timestamp, last_run timestamp, attempts int"


def read_rejects(spark: SparkSession, store: str) -> DataFrame:
    """The entries of a store; none where nothing was ever rejected."""
    if not folder_exists(spark, store):
        return spark.createDataFrame([], STORE)
    return spark.read.schema(STORE).parquet(store)


def with_pending(source: DataFrame, spec: TableSpec, store: str) -> tuple[DataFrame, DataFrame]:
    """The source with the stored rows whose key it no longer has, and the keys to load whatever their stamp is.

    Where the source still has the key, its own row counts, mended or not. Rows without a key stay in the store only as
    long as the source has them, since nothing but the source can give them one.
    """
    raw = spec.source_key
    pending = read_rejects(source.sparkSession, store).select(F.from_json("row", source.schema).alias("row")).select("row.*")
    pending = pending.filter(F.col(raw).isNotNull())
    gone = pending.join(source.select(raw), raw, "left_anti").select(*source.columns)
    again = map_columns(pending, spec).select(spec.key).filter(F.col(spec.key).isNotNull())
    return source.unionByName(gone), again


def write_rejects(rejects: DataFrame, spec: TableSpec, store: str, run_at: datetime | str, new: str) -> None:
    """Write what the store is to hold after a run, its rejects with their source rows, to the folder `new`. Equal
    entries are one."""
    spark = rejects.sparkSession
    row, at = F.to_json("_source"), F.lit(run_at).cast("timestamp")
    entry = F.coalesce(F.col("_source").getField(spec.source_key).cast("string"), F.sha2(row, 256))
    found = rejects.select(entry.alias("entry"), F.struct("reason", row.alias("row")).alias("last"))
    found = found.groupBy("entry").agg(F.min("last").alias("last"))
    before = read_rejects(spark, store).select("entry", "first_run", "attempts")
    after = found.join(before, "entry", "left").select(
        "entry",
        "last.reason",
        "last.row",
        F.coalesce("first_run", at).alias("first_run"),
        at.alias("last_run"),
        (F.coalesce("attempts", F.lit(0)) + 1).alias("attempts"),
    )
    after.write.parquet(new)


def keep_rejects(rejects: DataFrame, spec: TableSpec, store: str, run_at: datetime | str) -> None:
    """Make the rejects of a run the new content of the store.

    Call it after the table has been written. The new store is complete before it takes the place of the old one.
    """
    new = f"{store}.{uuid.uuid4().hex}.new"
    write_rejects(rejects, spec, store, run_at, new)
    replace_folder(rejects.sparkSession, new, store)
