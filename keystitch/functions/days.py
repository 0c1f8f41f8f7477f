from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the time zone whose calendar decides what "yesterday" is.
LOCAL_ZONE = "America/Mexico_City"


def yesterday(now: datetime, zone: str = LOCAL_ZONE) -> Column:
    """The day before `now` on the calendar of `zone`, whatever the session time zone.

    `now` is an aware datetime, or a naive one in UTC. The clock is always a parameter.
    """
    if now.tzinfo is not None:
        now = now.astimezone(timezone.utc).replace(tzinfo=None)
    utc = F.lit(now.isoformat(sep=" ")).cast("timestamp_ntz")
    return F.date_sub(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc).cast("date"), 1)


def day_span(first: Column, last: Column) -> Column:
    """Array of the days from first to last, both included; NULL when first > last."""
    return F.when(first <= last, F.sequence(first, last, F.expr("interval 1 day")))
