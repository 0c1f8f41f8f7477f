"""Incremental ingest of landed sensor responses."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from keystitch.operators.readings import map_readings, new_readings, valid_readings
from keystitch.plans.ingest import READINGS_SCHEMA, append_readings, read_readings
from keystitch.sources.responses import ARRIVAL, PLACE, stream_responses, with_place
from keystitch.sources.tables import empty_table


def append_batch(batch: DataFrame, table: str) -> None:
    """Append what is new in one micro-batch.

    The keyed anti join makes this safe to repeat: rows a failed attempt did write are known the
    second time. Only the day partitions the batch touches are read.
    """
    order = [*ARRIVAL, PLACE]
    valid = valid_readings(map_readings(with_place(batch), keep=["dia", *order])).persist()
    try:
        # a late reading of an old day adds that day, not all days since
        days = valid.select("date").distinct()
        target = read_readings(batch.sparkSession, table).join(days, "date", "left_semi")
        append_readings(new_readings(target, valid, order), table)
    finally:
        valid.unpersist()


def ingest_stream(
    spark: SparkSession, landed: str, table: str, checkpoint: str, files_per_trigger: int | None = None
) -> None:
    """Take in everything that has landed since the last run, then stop.

    The checkpoint remembers which files were read, so there is no high-water mark to keep, and a day
    that lands late is still taken in.
    """
    empty_table(spark, READINGS_SCHEMA, table, "date")
    query = (
        stream_responses(spark, landed, files_per_trigger)
        .writeStream.foreachBatch(lambda batch, _: append_batch(batch, table))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
