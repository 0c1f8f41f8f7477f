"""Time-of-day text of the readings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted and malformed shapes of the hour text.
CLOCK = r"^[0-9]{2}:[0-9]{2}(:[0-9]{2})?\z"
DIGITS = r"^[0-9]+\z"
HOUR = r"^[0-9]{2}:[0-9]{2}\z"
BAD_HOUR = r"^[0-9]{2}:[0-9]:\z"


def normalize_hour(text: Column) -> Column:
    """Trimmed text to `HH:MM`. `HH:MM[:SS]` keeps its first five characters; a run of digits is read
    as HHmmss after padding to six on the left (so `0930` is 00:09); anything else is NULL."""
    # lpad would also cut a longer run, which keeps the same first four digits
    digits = F.lpad(text, 6, "0")
    return F.when(text.rlike(CLOCK), F.substring(text, 1, 5)).when(
        text.rlike(DIGITS), F.concat(F.substring(digits, 1, 2), F.lit(":"), F.substring(digits, 3, 2))
    )


def is_hour(c: Column) -> Column:
    return F.coalesce(c.rlike(HOUR), F.lit(False))


def is_bad_hour(c: Column) -> Column:
    """`HH:N:`; NULL is not malformed."""
    return F.coalesce(c.rlike(BAD_HOUR), F.lit(False))
