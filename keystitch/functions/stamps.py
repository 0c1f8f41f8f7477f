"""Modified stamps that the source keeps as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stamp format, and the stamp the source writes for "never".
STAMP_FORMAT = "MM/dd/yyyy HH:mm:ss:SSS"
NEVER = "12/30/1899 00:00:00:000"


def has_stamp(c: Column) -> Column:
    return c.isNotNull() & ~c.isin("", NEVER)


def parse_stamp(c: Column) -> Column:
    """Text stamp to timestamp; NULL where the text is no valid stamp."""
    return F.try_to_timestamp(c, F.lit(STAMP_FORMAT))


def modified_after(c: Column, watermark: Column) -> Column:
    """Strictly after the watermark; a tie, a bad stamp or a missing watermark is False."""
    return F.coalesce(has_stamp(c) & (parse_stamp(c) > watermark), F.lit(False))
