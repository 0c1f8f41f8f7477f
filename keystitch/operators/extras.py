"""Free-text columns of the documents: find the rows that differ."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keystitch.functions.text import any_has_text, empty_to_null, text_differs

# Source and target names of the text columns.
EXTRA_COLUMNS = {
    "CTEXTOEXTRA1": "extra_text_one",
    "CTEXTOEXTRA2": "extra_text_two",
    "CTEXTOEXTRA3": "extra_text_three",
}


def rows_with_text(
    source: DataFrame, source_key: str, key: str, columns: Mapping[str, str] = EXTRA_COLUMNS
) -> DataFrame:
    """Source rows with text in at least one of the columns, under the target names."""
    return source.filter(any_has_text([F.col(c) for c in columns])).select(
        F.col(source_key).alias(key), *[F.col(s).alias(t) for s, t in columns.items()]
    )


def changed_texts(
    rows: DataFrame, target: DataFrame, key: str, columns: Mapping[str, str] = EXTRA_COLUMNS
) -> DataFrame:
    """New texts of the target rows whose trimmed texts differ in any column.

    The new texts are stored untrimmed, with '' as NULL.
    """
    names = list(columns.values())
    old = target.select(key, *[F.col(c).alias(f"_old_{c}") for c in names])
    differs = reduce(lambda a, b: a | b, [text_differs(F.col(f"_old_{c}"), F.col(c)) for c in names])
    return rows.join(old, key).filter(differs).select(key, *[empty_to_null(F.col(c)).alias(c) for c in names])
