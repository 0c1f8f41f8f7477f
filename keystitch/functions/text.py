"""Text rules. There are three different ideas of "empty" in these jobs; each has its own function."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the characters a JavaScript String.trim() removes.
SCRIPT_BLANKS = (
    "\t\n\x0b\x0c\r \u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000\ufeff"
)


def script_trim(c: Column) -> Column:
    """Trim every Unicode blank, tab and newline at both ends; NULL stays NULL."""
    return F.btrim(c, F.lit(SCRIPT_BLANKS))


def text_differs(a: Column, b: Column) -> Column:
    """True where two texts differ after `script_trim`, with NULL read as ''; never NULL.

    Most compared rows are equal as they stand, so only the rest is trimmed.
    """
    return F.when(a.eqNullSafe(b), F.lit(False)).otherwise(
        F.coalesce(script_trim(a), F.lit("")) != F.coalesce(script_trim(b), F.lit(""))
    )


def has_text(c: Column) -> Column:
    """More than trailing blanks, which the source ignores in a comparison with ''; NULL for NULL."""
    return F.rtrim(c) != ""


def any_has_text(cols: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, [has_text(c) for c in cols])


def empty_to_null(c: Column) -> Column:
    """'' becomes NULL; blanks are kept."""
    return F.nullif(c, F.lit(""))
