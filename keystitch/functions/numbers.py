"""Text to numbers. Parsing and checking are apart, so that a job can parse in one projection and
check the result in the next, instead of repeating the parse inside the check."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keystitch.functions.text import script_trim

NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\z"


def parse_number(c: Column) -> Column:
    """Text to double; empty and junk become NULL, so they cannot poison a sum.

    The pattern is needed because a plain cast also accepts forms like '1d' or 'Infinity'. Most
    numbers pass with plain blanks trimmed; only the rest is searched for other blanks.
    """

    def parsed(text: Column) -> Column:
        return F.when(text.rlike(NUMBER), text.try_cast("double"))

    return F.coalesce(parsed(F.trim(c)), parsed(script_trim(c)))


def finite(number: Column) -> Column:
    """NULL for what is too large for a double."""
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def whole(number: Column) -> Column:
    """For an integer column: anything with a fraction, or out of range, becomes NULL."""
    return F.when(number == F.floor(number), number.try_cast("int"))
